"""Exact repeated-substring removal through two-stage suffix sorting (operator 9).

A byte goes if it lies in a string of `width` bytes that also starts anywhere else, in another document or the same.

Windows of `width` bytes are dealt by content: each belongs to the least hash among its 32-byte grams, so equal windows
share that key, and neighbouring windows with one key travel as one span. A key with one span, whose gram
doesn't recur inside it, has no repeats. Spans of one key that are equal are repeats as a whole. Only keys with
different spans need sorting: the distinct spans of many keys make one buffer, its suffixes are sorted in two stages
(directly those smaller than their successor, the rest by scanning buckets), and neighbours with a
common prefix of `width` bytes are repeats.

A task holds at most about BUFFER + LARGEST bytes of spans. A key whose distinct spans are more than LARGEST isn't sorted in
one task: its windows become rows (key, digest) that Spark counts with partial aggregation, which gives the same answer at any size.

Nulls: a null text counts as empty. Equal rows (all columns) are repeats of each other, as any copies are. Extra columns
are kept, whatever their names and types; ``__spans`` and ``__kept`` get further underscores where docs has columns of these names.
An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.rows import Rows
from strandloom.plans.lineage import spread, stored

WIDTH, GRAM = 400, 32
#: Windows of a span at most; bytes of spans that are sorted together, and of one key's spans, at most (sorting takes about 90 times as much); bytes of text handled at a time.
RUN, BUFFER, LARGEST, BLOCK = 4096, 1 << 20, 1 << 22, 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit polynomial hash of every `width` bytes, by doubling."""
    h, power, size = data.astype(np.uint64) + np.uint64(1), np.uint64(0x100000001B3), 1
    out, have, at = None, 0, h
    with np.errstate(over="ignore"):
        while True:
            if width & size:
                # prepend the block of this size: the windows so far begin behind it
                tail = 0 if out is None else have
                out = at if out is None else (at[: len(at) - tail] * power_of(tail) + out[size:])[: len(data) - size - tail + 1]
                have += size
            if size * 2 > width:
                return (out ^ (out >> np.uint64(29))) * _MIX
            at = at[:-size] * power + at[size:]
            power, size = power * power, size * 2


def power_of(n: int) -> np.uint64:
    return np.uint64(pow(0x100000001B3, n, 1 << 64))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def window_runs(data: bytes, width: int = WIDTH):
    """(at, n, key, again): runs of n windows from byte `at` with one key; again: its gram recurs within the run."""
    raw = np.frombuffer(data, np.uint8)
    for begin in range(0, len(raw) - width + 1, BLOCK):
        part = raw[begin : begin + BLOCK + width - 1]
        grams = rolling(part, GRAM)
        keys = least_of(grams, width - GRAM + 1)
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        long = sizes > RUN
        if long.any():
            starts = np.concatenate([np.arange(s, s + n, RUN) for s, n in zip(starts.tolist(), sizes.tolist())])
            sizes = np.diff(np.append(starts, len(keys)))
        for s, n in zip(starts.tolist(), sizes.tolist()):
            key = keys[s]
            yield begin + s, n, int(key.view(np.int64)), bool(np.count_nonzero(grams[s : s + n + width - GRAM] == key) > 1)


def two_stage(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of data, right to at least `depth` bytes (suffixes equal that far stand in any order)."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    raw = data.tobytes()
    # smaller than its successor: the first different byte behind the run of equal ones is larger
    last = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)
    after = np.append(data[last[:-1] + 1], 0).astype(np.int16)
    run = np.repeat(np.arange(len(last)), np.diff(np.append(-1, last)))
    small = after[run] > data
    small[run == len(last) - 1] = False
    head = np.concatenate([[0], np.cumsum(np.bincount(data, minlength=256))])
    sa = np.full(n, -1, np.int64)
    # first stage: direct sorting of the small ones, by two bytes and then bucket by bucket
    direct = np.flatnonzero(small)
    pair = data[direct].astype(np.uint16) << 8 | data[np.minimum(direct + 1, n - 1)]
    direct = direct[np.argsort(pair, kind="stable")]
    pair = np.sort(pair, kind="stable")
    cuts = np.append(np.flatnonzero(np.append(True, pair[1:] != pair[:-1])), len(pair)) if len(pair) else np.zeros(1, np.int64)
    ordered = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        some = direct[a:b].tolist()
        some.sort(key=lambda i: raw[i : i + depth])
        ordered += some
    n_small = np.bincount(data[small], minlength=256)
    at = 0
    for c in np.flatnonzero(n_small).tolist():
        k = int(n_small[c])
        sa[head[c + 1] - k : head[c + 1]] = ordered[at : at + k]
        at += k
    # second stage: predecessors that are larger than their successor fall in place as buckets are scanned upwards
    front = head[:-1].copy()
    sa[front[data[-1]]] = n - 1
    front[data[-1]] += 1

    def place(found: np.ndarray, c: int) -> None:
        before = found[found > 0] - 1
        before = before[~small[before]]
        into = data[before]
        order = np.argsort(into, kind="stable")
        before, into = before[order], into[order]
        where = np.flatnonzero(np.append(True, into[1:] != into[:-1])) if len(into) else []
        for a, b in zip(where, np.append(where[1:], len(into))):
            x = into[a]
            sa[front[x] : front[x] + b - a] = before[a:b]
            front[x] += b - a

    for c in range(256):
        done = head[c]
        while done < front[c]:  # the scan of a bucket may add to the bucket itself
            upto = front[c]
            place(sa[done:upto], c)
            done = upto
        k = int(n_small[c])
        if k:
            place(sa[head[c + 1] - k : head[c + 1]], c)
    return sa


def repeated_windows(spans: list[bytes], width: int) -> list[np.ndarray]:
    """For each span, which of its windows also start elsewhere in the spans."""
    data = np.frombuffer(b"".join(spans), np.uint8)
    size = np.array([len(s) for s in spans], np.int64)
    begin = np.cumsum(size) - size
    whole = np.zeros(len(data) + 1, np.int64)
    whole[begin] += 1
    np.subtract.at(whole, begin + size - width + 1, 1)
    whole = np.cumsum(whole[:-1]) > 0
    sa = two_stage(data, width)
    sa = sa[whole[sa]]
    digest = rolling(data, width)
    same = digest[sa[1:]] == digest[sa[:-1]]
    raw = data.tobytes()
    at = np.flatnonzero(same)
    same[at] = [raw[a : a + width] == raw[b : b + width] for a, b in zip(sa[at].tolist(), sa[at + 1].tolist())]
    hit = np.zeros(len(data), bool)
    hit[sa[1:][same]] = True
    hit[sa[:-1][same]] = True
    return [hit[b : b + s - width + 1] for b, s in zip(begin.tolist(), size.tolist())]


def ranges(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last index of every run of true."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()


def _spans(rows: Rows, width: int) -> DataFrame:
    picked = rows.df.where(F.octet_length(rows.text) >= width).select("k", "th", F.col(rows.text).alias("text"))

    def run(batches):
        import xxhash

        for batch in batches:
            owner, at, n, key, again, digest = [], [], [], [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                data = text.encode()
                for a, m, k, g in window_runs(data, width):
                    owner.append(row)
                    at.append(a)
                    n.append(m)
                    key.append(k)
                    again.append(g)
                    digest.append(xxhash.xxh3_128_digest(data[a : a + m + width - 1]))
            d = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
            own = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), batch.column(1).take(own), pa.array(at, pa.int64()), pa.array(n, pa.int32()), pa.array(key, pa.int64()), pa.array(again, pa.bool_()), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())],
                ["k", "th", "at", "n", "key", "again", "d1", "d2"],
            )

    return picked.mapInArrow(run, "k bigint, th bigint, at bigint, n int, key bigint, again boolean, d1 bigint, d2 bigint")


def _bytes_of(reps: DataFrame, rows: Rows, width: int) -> DataFrame:
    """reps (key, d1, d2, held: where one copy is) with their bytes."""
    want = reps.groupBy("held.k", "held.th").agg(F.collect_list(F.struct("key", "d1", "d2", F.col("held.at").alias("at"), "n")).alias("want"))
    joined = rows.df.select("k", "th", F.col(rows.text).alias("text")).join(want, ["k", "th"])

    def take(batches):
        for batch in batches:
            out = {c: [] for c in ("key", "d1", "d2", "span")}
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (text or "").encode()
                for w in wanted:
                    for c in ("key", "d1", "d2"):
                        out[c].append(w[c])
                    out["span"].append(data[w["at"] : w["at"] + w["n"] + width - 1])
            yield pa.RecordBatch.from_arrays([*(pa.array(out[c], pa.int64()) for c in ("key", "d1", "d2")), pa.array(out["span"], pa.binary())], list(out))

    taken = joined.select("text", "want").mapInArrow(take, "key bigint, d1 bigint, d2 bigint, span binary")
    return taken.dropDuplicates(["key", "d1", "d2"])  # equal rows each give their copy


def _sorted_repeats(spans: DataFrame, width: int) -> DataFrame:
    """(key, d1, d2, first, last): runs of repeated windows, for keys of at most LARGEST bytes."""

    def run(batches):
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def solve(part):
            out: list[list] = [[], [], [], [], []]
            for (key, d1, d2, _), hit in zip(part, repeated_windows([p[3] for p in part], width)):
                first, last = ranges(hit)
                for column, v in zip(out, ([key] * len(first), [d1] * len(first), [d2] * len(first), first, last)):
                    column += v
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["key", "d1", "d2", "first", "last"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= BUFFER and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    dealt = spans.select("key", "d1", "d2", "span").repartition("key").sortWithinPartitions("key", "d1", "d2")
    return dealt.mapInArrow(run, "key bigint, d1 bigint, d2 bigint, first bigint, last bigint")


def _counted_repeats(spans: DataFrame, width: int) -> DataFrame:
    """The same for keys of any size: every window a row, counted by its digest."""

    def run(batches):
        import xxhash

        for batch in batches:
            for key, d1, d2, span in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(span) - width + 1
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(span[i : i + width]) for i in range(n)), "<i8").reshape(-1, 2)
                same = [pa.array(np.full(n, x, np.int64)) for x in (key, d1, d2)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(n)), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy())], ["key", "d1", "d2", "first", "w1", "w2"])

    # a key's spans came in one task: they are dealt anew before each of them makes its windows
    windows = spread(spans.select("key", "d1", "d2", "span"), "key", "d1", "d2").mapInArrow(run, "key bigint, d1 bigint, d2 bigint, first bigint, w1 bigint, w2 bigint")
    twice = windows.groupBy("key", "w1", "w2").count().where("count > 1").drop("count")
    again = windows.join(twice, ["key", "w1", "w2"], "left_semi")
    island = F.col("first") - F.row_number().over(Window.partitionBy("key", "d1", "d2").orderBy("first"))  # at most RUN windows each
    runs = again.withColumn("island", island).groupBy("key", "d1", "d2", "island").agg(F.min("first").alias("a"), F.max("first").alias("b"))
    return runs.select("key", "d1", "d2", F.col("a").alias("first"), F.col("b").alias("last"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """docs with __spans, the maximal removed byte runs array<struct<start, end>>, and __kept, the other bytes in a row."""
    rows = Rows(docs, id_col, text_col)
    spans = stored(_spans(rows, width))
    keys = spans.groupBy("key").agg(F.count("*").alias("spans"), (F.min("d1") != F.max("d1")).alias("mixed"), F.max("again").alias("within"))
    keys = keys.where("spans > 1 OR within").select("key", (F.col("mixed") | F.col("within")).alias("sort"))
    live = stored(spans.drop("again").join(keys, "key"))
    held = F.struct("k", "th", "at")
    reps = live.groupBy("key", "d1", "d2", "n").agg(F.min(held).alias("held"), F.count("*").alias("copies"), F.first("sort").alias("sort"))
    texts = stored(_bytes_of(reps.where("sort"), rows, width))
    big = texts.groupBy("key").agg(F.sum(F.octet_length("span")).alias("size")).where(F.col("size") > LARGEST).select("key")
    found = _sorted_repeats(texts.join(big, "key", "left_anti"), width).unionByName(_counted_repeats(texts.join(big, "key", "left_semi"), width))
    copied = reps.where("copies > 1").select("key", "d1", "d2", F.lit(0).cast("long").alias("first"), (F.col("n") - 1).cast("long").alias("last"))
    cover = stored(found.unionByName(copied).groupBy("key", "d1", "d2").agg(F.collect_list(F.struct("first", "last")).alias("runs")))
    placed = live.join(cover, ["key", "d1", "d2"]).select("k", "th", "at", F.explode("runs").alias("r"))
    ends = F.struct((F.col("at") + F.col("r.first")).alias("start"), (F.col("at") + F.col("r.last") + width).alias("end"))
    gone = placed.groupBy("k", "th").agg(F.collect_set(ends).alias("gone"))  # of one row, or of equal ones

    @F.pandas_udf("spans array<struct<start: bigint, end: bigint>>, kept binary")
    def cut(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(text, starts, ends):
            data, merged = (t or "").encode(), []
            for x, y in sorted(zip(a, b)) if a is not None else []:
                if merged and merged[-1]["end"] >= x:
                    merged[-1]["end"] = max(merged[-1]["end"], int(y))
                else:
                    merged.append({"start": int(x), "end": int(y)})
            kept, last = [], 0
            for m in merged:
                kept.append(data[last : m["start"]])
                last = m["end"]
            out.append((merged, b"".join([*kept, data[last:]])))
        return pd.DataFrame(out, columns=["spans", "kept"])

    joined = rows.df.join(gone, ["k", "th"], "left")
    done = joined.withColumn("cut", cut(F.col(rows.text), F.col("gone.start"), F.col("gone.end")))
    return rows.back(done, __spans=F.col("cut.spans"), __kept=F.col("cut.kept"))
