"""Phrase collocations by weighted acyclic automata (operator 11).

Texts are lowered (A-Z), cut at PIECES into pieces and these into words at spaces and tabs. A phrase's count is that of all its places inside pieces,
in its group's texts. Phrases of 2 to max_words words with min_count places are candidates; the cut of a candidate after its first k words is scored
floor(scale * a * a / (l * r)), l and r being the counts of the two parts, and the least score counts. A candidate goes if a longer one that contains it has
`share` per cent of its places.

1. A task sorts the n-grams of its shard of the texts (some BATCH bytes of one group) and builds count transducers of them, one for each prefix range:
   ranges are stretches of the order of all n-grams, of about range_bytes of text each. Their bounds come from the n-grams of a part of the texts; they decide
   where an n-gram is counted, never whether.
2. A range's transducers come to one task as a stream and are united, weights summed, HELD arcs at a time; n-grams below min_count go, since every part of a
   candidate has at least its count. What is left is stored: one transducer a range.
3. The parts of candidates, each once, are dealt to the ranges that hold them and composed with the range's transducer; their counts are
   joined back to the candidates.

A frequent word is many ranges, cut by its second and third words. Arithmetic is exact: decimals of 38 digits, and an overflow is an error, not a wrong score.

Nulls: a null text has no words, a null group is `und`, together with rows that say so. Ties in the score go to the shorter first part; ranks are by score and count, both descending, then
phrase by bytes. Equal rows count as often as they are there. A long text is cut between pieces, so whole texts of any length are counted in bounded memory. An empty
table gives an empty one. Columns of docs don't appear in the result, so none can clash.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.merkle import numbered
from strandloom.llm.transducers import Transducer, _codes, built, compose, place_of, summed, union
from strandloom.plans.lineage import spread, stored

PIECES = b".,;:!?\n\v\f\r"
#: Bytes of text that a shard's n-grams are sorted for at once; arcs held before a range's transducers are united; a part of the n-grams that bounds come from; parts asked at once.
BATCH, HELD, EVERY, ASKED = 4 << 20, 1_500_000, 512, 50_000
#: Parts of a group whose first phrases are found before those of the group.
PARTS = 64
_SPLIT = bytes.maketrans(PIECES, b"\n" * len(PIECES))
PACKED = "words binary, lengths binary, label binary, target binary, weight binary"

Bounds = list[tuple[bytes, ...]]  # (group, word, word, ...) of the first n-gram of every range but the first


def shard_ngrams(text: bytes, longest: int) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """The words of a text (lowered, pieces on lines) in order, and its n-grams in order with their counts."""
    found = text.split()
    if not found:
        return [], [np.empty(0, np.int32)] * longest, np.empty(0, np.int64)
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, found), np.int32, len(found))
    words = sorted(number)
    rank = np.empty(len(words), np.int32)
    rank[[number[w] for w in words]] = np.arange(1, len(words) + 1)
    ids = rank[ids]
    letters = np.frombuffer(text, np.uint8)
    space = (letters == 32) | (letters == 9) | (letters == 10)
    begins = ~space
    begins[1:] &= space[:-1]
    piece = np.cumsum(letters == 10, dtype=np.int32)[begins]
    base = len(words) + 1
    none = np.zeros(len(ids), np.int32)
    parts = [[ids] + [none] * (longest - 1)]
    for n in range(2, longest + 1):
        inside = np.flatnonzero(piece[n - 1 :] == piece[: len(piece) - n + 1]) if len(piece) >= n else np.empty(0, np.int64)
        parts.append([ids[inside + k] for k in range(n)] + [none[: len(inside)]] * (longest - n))
    if base**longest < 2**63:
        codes, counts = np.unique(np.concatenate([_codes(p, base) for p in parts]), return_counts=True)
        columns = []
        for _ in range(longest):
            codes, last = np.divmod(codes, base)
            columns.append(last.astype(np.int32))
        return words, columns[::-1], counts.astype(np.int64)
    columns = [np.concatenate(c) for c in zip(*parts)]
    return words, *summed(columns, np.ones(len(columns[0]), np.int64), base)


def _shards(batches):
    """(group, text) of about BATCH bytes and whole pieces; batches hold groups and texts."""
    held: defaultdict[bytes, list[bytes]] = defaultdict(list)
    size: defaultdict[bytes, int] = defaultdict(int)
    for batch in batches:
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            group, text = group.encode(), text.encode().lower().translate(_SPLIT)
            at = 0
            while at < len(text):
                end = len(text) if len(text) - at <= BATCH else text.find(b"\n", at + BATCH)
                end = len(text) if end < 0 else end
                held[group].append(text[at:end])
                size[group] += end - at
                at = end
                if size[group] >= BATCH:
                    yield group, b"\n".join(held.pop(group))
                    size[group] = 0
    for group, texts in held.items():
        yield group, b"\n".join(texts)


def _bounds(texts: DataFrame, longest: int, range_bytes: int) -> Bounds:
    """Where ranges begin, so that each has some range_bytes of text; at most one for each partition that the session shuffles into in a small corpus."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // range_bytes))

    def some(batches):
        for group, text in _shards(batches):
            words, columns, _ = shard_ngrams(text, longest)
            picked = zip(*(c[EVERY // 2 :: EVERY].tolist() for c in columns))
            keys = [" ".join(words[i - 1].decode() for i in gram if i) for gram in picked]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([group.decode()] * len(keys), pa.string()), "key": pa.array(keys, pa.string())})

    part = min(1.0, max(BATCH / max(size, 1), 0.01))
    keys = (texts.sample(part, seed=11) if part < 1 else texts).mapInArrow(some, "lang string, key string").distinct().withColumn("all", F.lit(0))
    order = numbered(keys, ["all"], ["lang", "key"])
    step = F.greatest(F.ceil(F.col("n") / ranges), F.lit(1))
    first = order.where((F.col("pos") > 0) & (F.col("pos") % step == 0)).select("lang", "key").collect()  # one row a range
    return sorted({(r["lang"].encode(), *r["key"].encode().split(b" ")) for r in first})


def _count_shards(texts: DataFrame, bounds: Bounds, longest: int) -> DataFrame:
    """(range, lang, transducer) of every shard and range."""

    def run(batches):
        for group, text in _shards(batches):
            words, columns, weights = shard_ngrams(text, longest)
            if not len(weights):
                continue
            lo, hi = bisect_left(bounds, (group,)), bisect_left(bounds, (group + b"\0",))
            base = len(words) + 1
            codes = _codes(columns, base)
            if codes is None:  # more words than 63 bits hold n-grams of: whole numbers of any size
                codes = sum(c.astype(object) * base ** (longest - 1 - i) for i, c in enumerate(columns))
            cuts = [0, *np.searchsorted(codes, [place_of(words, b[1:], longest) for b in bounds[lo:hi]]).tolist(), len(weights)]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    packed = built(words, [c[a:b] for c in columns], weights[a:b]).packed()
                    yield pa.RecordBatch.from_arrays([pa.array([lo + i], pa.int32()), pa.array([group.decode()]), *(pa.array([p], pa.binary()) for p in packed)], ["range", "lang", *(c.split()[0] for c in PACKED.split(", "))])

    return texts.mapInArrow(run, f"range int, lang string, {PACKED}")


def _united(shards: DataFrame, longest: int, least: int) -> DataFrame:
    """(range, lang, n, transducer): one for every range; n is how many words it counts."""

    def run(batches):
        now, held, arcs = None, [], 0

        def out():
            last = union(held, longest)
            columns, weights = last.ngrams(longest)
            n = int(weights[columns[1] == 0].sum()) if longest > 1 else int(weights.sum())
            packed = union([last], longest, least).packed()
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]], pa.int32()), pa.array([now[1]]), pa.array([n], pa.int64()), *(pa.array([p], pa.binary()) for p in packed)],
                ["range", "lang", "n", *(c.split()[0] for c in PACKED.split(", "))],
            )

        for batch in batches:
            for at, lang, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (at, lang):
                    if now is not None:
                        yield out()
                    now, held, arcs = (at, lang), [], 0
                held.append(Transducer.unpacked(*packed))
                arcs += len(held[-1].arcs)
                if arcs > HELD:
                    held = [union(held, longest)]
                    arcs = len(held[0].arcs) // 2  # what doesn't shrink any more mustn't be united again for every row
        if now is not None:
            yield out()

    dealt = spread(shards, "range", "lang").sortWithinPartitions("range", "lang")
    return dealt.mapInArrow(run, f"range int, lang string, n bigint, {PACKED}")


def _phrases(ranges: DataFrame, longest: int) -> DataFrame:
    """(lang, words, a) of every n-gram that is left."""

    def run(batches):
        for batch in batches:
            for _, lang, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                t = Transducer.unpacked(*packed)
                names = [w.decode() for w in t.words]
                columns, weights = t.ngrams(longest)
                grams = [[names[i - 1] for i in gram if i] for gram in zip(*(c.tolist() for c in columns))]
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()), "words": pa.array(grams, pa.list_(pa.string())), "a": pa.array(weights, pa.int64())})

    return ranges.drop("n").mapInArrow(run, "lang string, words array<string>, a bigint")


def _looked_up(parts: DataFrame, ranges: DataFrame, bounds: Bounds, longest: int) -> DataFrame:
    """(lang, part, f): the counts of parts (lang, part), by composing them with the transducer of their range."""

    def deal(batches):
        for batch in batches:
            at = [bisect_right(bounds, (lang.encode(), *part.encode().split(b" "))) for lang, part in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], ["range", "lang", "part"])

    def run(batches):
        now, counts, asked = None, None, []

        def answers():
            grams = [p.encode().split(b" ") for p in asked]
            words = sorted({w for g in grams for w in g})
            number = {w: i + 1 for i, w in enumerate(words)}
            rows = np.array([[*map(number.__getitem__, g), *[0] * (longest - len(g))] for g in grams], np.int32).reshape(-1, longest)
            columns, _ = summed([rows[:, k] for k in range(longest)], np.ones(len(rows), np.int64), len(words) + 1)
            columns, weights = compose(built(words, columns, np.ones(len(columns[0]), np.int64)), counts, longest)
            names = [w.decode() for w in words]  # all of them are used
            found = [" ".join(names[i - 1] for i in gram if i) for gram in zip(*(c.tolist() for c in columns))]
            return pa.RecordBatch.from_pydict({"lang": pa.array([now[1]] * len(found), pa.string()), "part": pa.array(found, pa.string()), "f": pa.array(weights, pa.int64())})

        for batch in batches:
            for at, lang, part, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (at, lang):
                    if asked and counts is not None:
                        yield answers()
                    now, counts, asked = (at, lang), None, []
                if part is None:
                    counts = Transducer.unpacked(*packed)
                else:
                    asked.append(part)
                    if len(asked) >= ASKED and counts is not None:
                        yield answers()
                        asked = []
        if asked and counts is not None:
            yield answers()

    dealt = parts.mapInArrow(deal, "range int, lang string, part string")
    names = [c.split()[0] for c in PACKED.split(", ")]
    rows = dealt.select("range", "lang", "part", *[F.lit(None).cast("binary").alias(c) for c in names])
    rows = rows.unionByName(ranges.select("range", "lang", F.lit(None).cast("string").alias("part"), *names))
    # a range's transducer comes before its questions
    return spread(rows, "range", "lang").sortWithinPartitions("range", "lang", F.col("part").asc_nulls_first()).mapInArrow(run, "lang string, part string, f bigint")


def collocations(docs: DataFrame, group_col: str = "lang", text_col: str = "text", max_words: int = 3, min_count: int = 10, share: int = 50,
                 scale: int = 1_000_000, top: int | None = 2000, range_bytes: int = 8 << 20) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each group's phrases, the first `top` of them (None: all) by score; max_words from 2 on."""
    texts = docs.select(F.coalesce(F.col(f"`{group_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    bounds = _bounds(texts, max_words, range_bytes)
    ranges = stored(_united(_count_shards(texts, bounds, max_words), max_words, min_count))
    counted = stored(_phrases(ranges, max_words).where(F.size("words") > 1))
    joined = lambda at, n: F.array_join(F.slice("words", at, n), " ")
    length = F.size("words")
    cuts = counted.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), length - 1)).alias("k"))
    cuts = cuts.select("lang", F.array_join("words", " ").alias("phrase"), "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, length - F.col("k")).alias("rest"))
    parts = cuts.select("lang", F.explode(F.array("first", "rest")).alias("part")).distinct()
    found = stored(_looked_up(parts, ranges, bounds, max_words))
    l = found.select(F.col("lang").alias("l_lang"), F.col("part").alias("l_part"), F.col("f").alias("l"))  # noqa: E741
    r = found.select(F.col("lang").alias("r_lang"), F.col("part").alias("r_part"), F.col("f").alias("r"))
    known = cuts.join(l, (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("l_part"))).join(r, (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_part")))
    score = F.expr(f"(CAST({scale} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0))) DIV (CAST(l AS DECIMAL(16,0)) * CAST(r AS DECIMAL(16,0)))")
    best = known.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), length - 1), lambda n: F.transform(F.sequence(F.lit(1), length - n + 1), lambda at: joined(at, n))))
    longer = counted.where(length > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("of_longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("of_longer").isNull() | (100 * F.col("of_longer") < share * F.col("a")))
    words = ranges.groupBy("lang").agg(F.sum("n").alias("n"))
    order = [F.col("cut.score").desc(), F.col("a").desc(), "phrase"]
    if top is not None:  # what isn't among the first of its part of a group isn't among the group's
        parts_of = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
        kept = parts_of.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))
