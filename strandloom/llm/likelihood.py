"""Quality rules and a hashed n-gram log-likelihood ratio (operator 13).

A text's words and pairs of neighbouring words (letters A-Z lowered) are hashed into 2 ** bits counters. Two multinomials are estimated, each with
one added to every counter: the raw corpus, from every document whole, and the trusted target, from every document marked as TARGET. A text's
score is the sum of log(target / raw) over its n-grams, divided by their number. The threshold is fixed by rows marked CLEAN and JUNK, which
are in no target: their scores are counted in bins of 1/256, and of all cuts the one is taken with the largest
clean_weight * (clean kept) - (junk kept), shares each; of equally good neighbouring cuts the middle one. Every document is then judged by that number.

Counters grow with the corpus, one to 17 to 34 n-grams as estimated from its bytes, up to 2 ** most_bits (beyond some 300 MB more n-grams share one): the ratios are sent to every
worker as four bytes a counter, 16 MB at the default of 22 bits. Tasks count into arrays and give out blocks of 4,096 counters
packed as bit masks and counts; blocks are dealt by number and summed as a stream, so a task holds one block's sum at a time. Marks, of which there
may be as many as documents, are joined by id; up to MARKED of them are broadcast.

The rules are exact counts of the text itself (``text_counts``): five-word windows are told apart by ranks, not by hashes.

Nulls: a null text has no word, fails the rules and is not kept. A text without n-grams scores 0. Without target rows every text that passes the rules is kept; without CLEAN and JUNK
rows the cut is at 0; with one kind only, at its edge. Rows of null id carry no mark. Equal rows are judged alike. Texts are read whole, however long, one document's arrays at a
time. An empty table gives an empty one. Columns named in `keep` stay, whatever their names; added ones get further underscores where they clash.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.rows import free_name
from strandloom.plans.lineage import spread, stored

TARGET, CLEAN, JUNK = 1, 2, 3
#: Marks up to this number are broadcast (some 50 MB); counters of a block; score bins of one unit; words whose hashes a worker keeps.
MARKED, BLOCK, BINS, KNOWN = 1_000_000, 4096, 256, 500_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"


class _Hashes(dict):
    """Hashes of words met before, at most KNOWN of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def repeated_words(ids: np.ndarray, window: int = 5) -> int:
    """How many places lie in a window of so many ids that is found twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n].astype(np.uint64)
    mixed.sort()
    if (mixed[1:] != mixed[:-1]).all():  # equal windows would be equal here
        return 0
    rank = ids
    for k in range(1, window):  # rank of the window of k + 1 from that of k and the next id
        _, rank = np.unique(rank[: len(ids) - k] * (int(ids.max()) + 1) + ids[k:], return_inverse=True)
    twice = (np.bincount(rank) > 1)[rank]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    """COUNTS of a text."""
    words = text.encode().split()  # of bytes: parts at the six ASCII spaces and no others
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            again += line in seen
            seen.add(line)
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), again, repeated_words(ids)


def ngrams(text: str, bits: int) -> np.ndarray:
    """The counters of a text's words, then of its pairs of neighbours."""
    words = text.encode().lower().split()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    pairs = (pairs ^ (pairs >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (np.concatenate([h, pairs]) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Likelihood:
    """log(target / raw) of every counter, and the cut in bins: a score is kept from cut / BINS on. No ratios: everything is kept."""

    bits: int
    ratios: np.ndarray | None
    cut: int

    def score(self, text: str) -> float:
        at = ngrams(text, self.bits) if self.ratios is not None else ()
        return float(self.ratios[at].mean(dtype=np.float64)) if len(at) else 0.0


def _count(rows: DataFrame, bits: int) -> DataFrame:
    """(block, mask, raw, target): counters of (text, mark) rows by task, packed."""
    width = min(BLOCK, 1 << bits)

    def run(batches):
        totals = np.zeros((2, 1 << bits), np.int64)
        held: tuple[list, list] = ([], [])
        size = 0

        def add():
            for total, texts in zip(totals, held):
                if texts:
                    at, n = np.unique(np.concatenate(texts), return_counts=True)
                    total[at] += n
                    texts.clear()

        for batch in batches:
            for text, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = ngrams(text, bits)
                held[0].append(found)
                if mark == TARGET:
                    held[1].append(found)
                size += len(found)
                if size > 1_000_000:
                    add()
                    size = 0
        add()
        for b, (raw, target) in enumerate(zip(*totals.reshape(2, -1, width))):
            at = raw > 0
            if at.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "mask": [np.packbits(at).tobytes()], "raw": [raw[at].tobytes()], "target": [target[at].tobytes()]})

    return rows.mapInArrow(run, "block int, mask binary, raw binary, target binary")


def _sum(parts: DataFrame, bits: int) -> DataFrame:
    """(block, raw, target, n_raw, n_target): each block's counters over all tasks."""
    width = min(BLOCK, 1 << bits)

    def run(batches):
        now, total = None, np.zeros((2, width), np.int64)

        def out():
            return pa.RecordBatch.from_pydict(
                {"block": pa.array([now], pa.int32()), "raw": [total[0].tobytes()], "target": [total[1].tobytes()], "n_raw": [int(total[0].sum())], "n_target": [int(total[1].sum())]}
            )

        for batch in batches:
            for block, mask, raw, target in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    if now is not None:
                        yield out()
                    now, total = block, np.zeros((2, width), np.int64)
                at = np.unpackbits(np.frombuffer(mask, np.uint8), count=width).astype(bool)
                total[0, at] += np.frombuffer(raw, np.int64)
                total[1, at] += np.frombuffer(target, np.int64)
        if now is not None:
            yield out()

    dealt = spread(parts, "block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "block int, raw binary, target binary, n_raw bigint, n_target bigint")


def _best_cut(bins: list[tuple[int, int, int]], clean_weight: float) -> int:
    """The bin from which scores are kept, of (bin, clean rows, junk rows)."""
    clean, junk = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not bins:
        return 0
    bins = sorted(bins)
    kept_clean, kept_junk = clean, junk
    gains, cuts = [], []
    for b, c, j in [*bins, (bins[-1][0] + 1, 0, 0)]:  # keep from b on
        gains.append(clean_weight * kept_clean * max(junk, 1) - kept_junk * max(clean, 1))  # shares, times both totals
        cuts.append(b)
        kept_clean, kept_junk = kept_clean - c, kept_junk - j
    i = int(np.argmax(gains))
    lower = cuts[i - 1] + 1 if i else cuts[i]  # every cut from here to cuts[i] keeps the same rows
    return (lower + cuts[i]) // 2


def fit(docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None, most_bits: int = 22, clean_weight: float = 4.0) -> Likelihood:
    """The ratios and the cut. marks: (id_col, mark), mark one of TARGET, CLEAN, JUNK; of several marks of an id the least holds."""
    if bits is None:
        size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
        bits = int(np.clip(np.round(np.log2(max(size / 72, 1))), 8, most_bits))  # a word of six bytes gives two n-grams: some 24 of them to a counter
    marks = marks.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min("mark").alias("__mark"))
    marks = stored(marks.where(F.col("__mark").isNotNull()))
    if marks.count() <= MARKED:
        marks = F.broadcast(marks)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    marked = texts.join(marks, F.col("id") == F.col("__id"), "left").select("text", "__mark")
    sums = stored(_sum(_count(marked, bits), bits))
    n_raw, n_target = sums.agg(F.sum("n_raw"), F.sum("n_target")).first()
    if not n_target:
        return Likelihood(bits, None, 0)
    width, counters = min(BLOCK, 1 << bits), 1 << bits

    def run(batches):
        for batch in batches:
            out = []
            for raw, target in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                t, r = np.frombuffer(target, np.int64) + 1.0, np.frombuffer(raw, np.int64) + 1.0
                out.append((np.log(t / (n_target + counters)) - np.log(r / (n_raw + counters))).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["block", "ratio"])

    ratios = np.full(counters, np.log((n_raw + counters) / (n_target + counters)), np.float32)  # of a counter that nothing came to
    for block, ratio in sums.select("block", "raw", "target").mapInArrow(run, "block int, ratio binary").toLocalIterator():  # counters * 4 bytes in all
        ratios[block * width : (block + 1) * width] = np.frombuffer(ratio, np.float32)
    model = Likelihood(bits, ratios, 0)
    known = judged(marked.where(F.col("__mark").isin(CLEAN, JUNK)), model, "text", ("__mark",)).where("NOT base_failed")
    bins = known.groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(F.sum((F.col("__mark") == CLEAN).cast("long")), F.sum((F.col("__mark") == JUNK).cast("long")))
    return Likelihood(bits, ratios, _best_cut([tuple(r) for r in bins.collect()], clean_weight))


def judged(docs: DataFrame, model: Likelihood, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of keep, then COUNTS, base_failed, score and kept, one row per row of docs."""
    inner = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    names = [f"c{i}" for i in range(len(keep))]
    schema = ", ".join([f"{c} {inner.schema[c].dataType.simpleString()}" for c in names] + [f"{c} bigint" for c in COUNTS] + ["score double"])

    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            counts = np.array([text_counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, counts.T), pa.array([model.score(t) for t in texts], pa.float64())], [*names, *COUNTS, "score"])

    out = inner.mapInArrow(run, schema)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~failed & (F.lit(model.ratios is None) | (F.floor(F.col("score") * BINS) >= model.cut))
    columns, taken = [F.col(n).alias(c) for n, c in zip(names, keep)], list(keep)
    for name, c in [*((c, F.col(c)) for c in COUNTS), ("base_failed", failed), ("score", F.col("score")), ("kept", kept)]:
        columns.append(c.alias(free_name(name, taken)))
        taken.append(name)
    return out.select(*columns)
