"""Substring dedup by content-defined chunks (operator 10).

A gear hash rolls over the UTF-8 bytes of a text; a chunk ends where its high bits are zero, so boundaries follow
the content and an insertion shifts only the chunks that it touches. Where it has no zeros for long, the least hash of
the bytes around decides, and in periodic text the least of a period, so that copies are cut in one phase. Chunks are compared by a 128-bit digest. Of
equal chunks the earliest stays, in order of (id, row, byte); later ones go where neighbours that go together
make up at least min_run bytes, which spares short common phrases. Boundaries fall between characters, so what stays is text.

Chunks are cut twice, for counting and for finding what goes: a table of them would take as much disk as the corpus itself.

Nulls: a null text has no chunks and stays null; rows with a null id come first. Equal rows (all columns) are one row
for the order and lose the same chunks. Extra columns are kept, whatever their names and types; ``__bytes`` and ``__removed`` get further
underscores where docs has columns of these names. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.rows import Rows

#: Least and largest chunk in bytes (before a boundary moves to a character's start), and the zero bits that end one.
LEAST, MOST, BITS = 24, 160, 5
#: Bytes that a run of repeated chunks needs in order to go.
MIN_RUN = 80
BLOCK = 1 << 20


def gear_table() -> np.ndarray:
    """256 words by a multiplicative mix of the byte."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = gear_table()


def gear_hits(data: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Offsets behind which the hash of the last 32 bytes has its high bits zero, for offsets of 32 and more."""
    hits = []
    for at in range(0, len(data), BLOCK):
        begin = max(0, at - 31)
        h = GEAR[data[begin : at + BLOCK]]
        for k in (1, 2, 4, 8, 16):  # h over 2k bytes from h over k bytes
            if len(h) > k:
                h = np.concatenate([h[:k], h[k:] + (h[:-k] << np.uint32(k))])
        found = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + begin + 1
        hits.append(found[(found > at) & (found >= 32)])
    return np.concatenate(hits) if hits else np.empty(0, np.int64)


def least_hashes(raw: np.ndarray, start: int, end: int) -> np.ndarray:
    """Hashes of the last 8 bytes for the offsets start to end; what lies before the text counts as largest."""
    begin = max(0, start - 8)
    h = GEAR[raw[begin:end]]
    for k in (1, 2, 4):
        if len(h) > k:
            h = np.concatenate([h[:k], h[k:] + (h[:-k] << np.uint32(k))])
    h = (h << np.uint32(24)) | (h >> np.uint32(8))  # the low bits know the last bytes only; all 8 decide
    whole = np.full(end - start + 1, 0xFFFFFFFF, np.uint32)
    first = max(start, begin + 8)
    if first <= end:
        whole[first - start :] = h[first - begin - 1 :]
    return whole


def lowest(raw: np.ndarray, start: int, end: int, reach: int = LEAST) -> list[int]:
    """Offsets between start and end whose hash of 8 bytes is less than the reach before and no more than the reach behind."""
    a, b = max(0, start - reach), min(len(raw), end + reach)
    h = np.pad(least_hashes(raw, a, b), reach, constant_values=0xFFFFFFFF)
    least = np.lib.stride_tricks.sliding_window_view(h, reach).min(axis=1)
    mid = h[reach:-reach]
    found = np.flatnonzero((mid < least[: len(mid)]) & (mid <= least[reach + 1 : reach + 1 + len(mid)])) + a
    return found[(found > start) & (found < end)].tolist()


def boundaries(data: bytes, least: int = LEAST, most: int = MOST, bits: int = BITS) -> list[int]:
    """0, the chunk ends, and so len(data) last; [0] for no bytes."""
    raw = np.frombuffer(data, np.uint8)
    n, last, out = len(data), 0, [0]

    def at_character(i: int) -> int:
        while i < n and data[i] & 0xC0 == 0x80:
            i += 1
        return i

    for hit in [*gear_hits(raw, bits).tolist(), n]:
        hit = at_character(hit)
        bare = hit - last > most
        inner = [i for i in lowest(raw, last, hit) if hit - i >= least] if bare else []
        for stop in [*map(at_character, inner), hit]:
            while bare and stop - last > most // 2:  # periodic, or a slope: the least hash of what may end a chunk
                start = last + least
                last = at_character(start + int(least_hashes(raw, start, last + most // 2).argmin()))
                out.append(last)
            if stop - last >= least or stop == n and stop > last:
                out.append(stop)
                last = stop
    return out


def runs(starts: list[int], ends: list[int], min_run: int) -> list[tuple[int, int]]:
    """Neighbouring spans joined; those of at least min_run bytes."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and out[-1][1] >= a:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out if b - a >= min_run]


def chunk_rows(rows: Rows, least: int = LEAST, most: int = MOST, bits: int = BITS) -> DataFrame:
    """(k, th, id, at, size, d1, d2): one row per chunk, d1 and d2 being its digest."""
    picked = rows.df.where(F.col(rows.text).isNotNull()).select("k", "th", F.col(rows.id).alias("id"), F.col(rows.text).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()

    def run(batches):
        import xxhash

        for batch in batches:
            owner, at, size, digests = [], [], [], []
            for row, text in enumerate(batch.column(3).to_pylist()):
                data = text.encode()
                cuts = boundaries(data, least, most, bits)
                owner += [row] * (len(cuts) - 1)
                at += cuts[:-1]
                size += map(int.__sub__, cuts[1:], cuts)
                digests += [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(cuts, cuts[1:])]
            own = pa.array(owner, pa.int32())
            d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            for i in range(0, len(owner), 50_000):
                part = slice(i, i + 50_000)
                take = own[part]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(take) for k in range(3)), pa.array(at[part], pa.int32()), pa.array(size[part], pa.int32()), pa.array(d[part, 0].copy()), pa.array(d[part, 1].copy())],
                    ["k", "th", "id", "at", "size", "d1", "d2"],
                )

    return picked.mapInArrow(run, f"k bigint, th bigint, id {kind}, at int, size int, d1 bigint, d2 bigint")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """docs with repeated runs cut out of text_col, and __bytes, __removed: its size before, and how much went."""
    rows = Rows(docs, id_col, text_col)
    chunks = chunk_rows(rows)
    first = chunks.groupBy("d1", "d2").agg(F.min(F.struct("id", "th", "at")).alias("pos"), F.count("*").alias("n")).where("n > 1")
    first = first.select("d1", "d2", F.col("pos.th").alias("first_th"), F.col("pos.at").alias("first_at"))
    later = chunks.drop("id").join(first, ["d1", "d2"]).where("NOT (first_th = th AND first_at = at)")
    gone = later.groupBy("k", "th").agg(F.collect_set(F.struct("at", (F.col("at") + F.col("size")).alias("end"))).alias("gone"))  # of one row, or of equal ones

    @F.pandas_udf("text string, removed bigint")
    def without(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(text, starts, ends):
            cut = runs([int(x) for x in a], [int(x) for x in b], min_run) if a is not None and t is not None else []
            if cut:
                data, kept, last = t.encode(), [], 0
                for x, y in cut:
                    kept.append(data[last:x])
                    last = y
                t = b"".join([*kept, data[last:]]).decode()
            out.append((t, sum(y - x for x, y in cut)))
        return pd.DataFrame(out, columns=["text", "removed"])

    joined = rows.df.join(gone, ["k", "th"], "left")
    cut = joined.withColumn("cut", without(F.col(rows.text), F.col("gone.at"), F.col("gone.end")))
    return rows.back(cut, F.col("cut.text"), __bytes=F.coalesce(F.octet_length(rows.text), F.lit(0)).cast("long"), __removed=F.col("cut.removed"))
