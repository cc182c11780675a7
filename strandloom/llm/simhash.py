"""SimHash near-duplicates through deletion-variant signatures (operator 2).

Fingerprints of 64 bits link at ``BITS`` = 4 or fewer differing bits. Cut into three segments, two linked
fingerprints differ by at most one bit in some segment (three segments with two each would make six), so every
fingerprint is indexed under each segment with each of its bits deleted in turn: 64 keys. Equal keys join,
the whole fingerprints are compared in the join's condition, and a pair is given out by one key only.

Rows with equal fingerprints are one node: a group of copies, whatever its size, never meets itself in the join.

A key has 20 or 21 free bits, so a fingerprint meets about n / 2^20 chance partners under each of its 64 keys: six a key among 6 million
distinct fingerprints, where a task's join still costs about what its index rows do, and 100 a key, which is 6,400 comparisons a
fingerprint, among 100 million. Beyond that the comparisons, which need no shuffle, outweigh the rest.

Nulls: a null text counts as empty. Ties don't arise: a bit that is set in exactly half of the shingles is 0. Very long texts are added up
65,536 shingles at a time. Repeated rows are nodes of one fingerprint. Extra columns are left out. An empty table gives an empty one.

``similar_groups`` links texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more: six fingerprints,
independently mixed, propose pairs through the same keys (any segment that differs by at most one bit); the next fingerprint tells
chance partners apart inside the join, so what leaves it grows with the near copies there are; and exact sets decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.plans.components import connected_components
from strandloom.plans.lineage import shuffled, spread, stored

BITS, SHINGLE, SEED = 4, 4, 42
#: First bit and width of the three segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Of similar_groups: words of a shingle, fingerprints, and the share of all their bits that may differ (0.8 alike: 0.152 on average).
SIMILAR_SHINGLE, PRINTS, MOST_APART = 5, 6, 0.28
#: Bits of one of these fingerprints that may differ (0.8 alike: 9.7 on average, with a deviation of 2.9).
REACH = 20


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of the text's word shingles, repeats included; 0 without words."""
    import xxhash

    words = text.encode().lower().split()  # bytes.lower() and split() know ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())]
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        h = np.array(hashes[i : i + 65_536], "<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    value = 0
    for i in np.flatnonzero(2 * bits > len(hashes)).tolist():
        value |= 1 << i
    return value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp) with fp as signed long. Null and blank texts have fp 0; other columns are left out."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], [id_col, "fp"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, fp bigint")


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(src, dst) with src < dst for all pairs of the distinct fp column that differ in 1..bits bits."""
    if bits > 2 * len(SEGMENTS) - 1:
        raise ValueError("three segments find at most five differing bits")
    return segment_links(fps, bits)


def segment_links(fps: DataFrame, bits: int, apart: tuple[str, ...] = (), also: tuple[str, ...] = ()) -> DataFrame:
    """(src, dst, and src_ and dst_ of the columns apart and also): pairs of 1..bits bits of which some segment differs by at most one.

    Columns named in apart hold a group's number or 0; two rows of the same group are no pair. Columns named in also are further
    fingerprints, which may differ in as many bits: what meets by chance in the one is told apart by the others, inside the join.
    """
    keys = []
    for at, width in SEGMENTS:
        segment = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        for p in range(width):
            keys.append(segment.bitwiseAND(F.lit(~(1 << p)).cast("long")) + F.lit((at + p) << 22).cast("long"))
    index = spread(fps, "fp").select("fp", *apart, *also, F.explode(F.array(*keys)).alias("key"))
    a, b = index.alias("a"), index.alias("b")
    differ = "(a.fp ^ b.fp)"
    masks = [((1 << w) - 1) << at for at, w in SEGMENTS]
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    # the key that gives out a pair: of the first segment that matches, the differing bit or else the first one
    p = "(a.key >> 22)"
    first = []
    for s, (at, width) in enumerate(SEGMENTS):
        inside = f"{p} >= {at} AND {p} < {at + width}"
        earlier = "".join(f" AND bit_count({differ} & {m}L) > 1" for m in masks[:s])
        first.append(f"({inside}{earlier} AND (({differ} & {masks[s]}L) <> 0 OR {p} = {at}))")
    condition = f"a.key = b.key AND a.fp < b.fp AND bit_count({differ}) <= {bits} AND ({' OR '.join(first)})"
    condition += "".join(f" AND (a.{c} <> b.{c} OR a.{c} = 0)" for c in apart)
    condition += "".join(f" AND bit_count(a.{c} ^ b.{c}) <= {bits}" for c in also)
    ends = [F.col(f"{t}.{c}").alias(f"{name}_{c}") for c in (*apart, *also) for t, name in (("a", "src"), ("b", "dst"))]
    return shuffled(a).join(b, F.expr(condition)).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"), *ends)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id_col, fp, component_id): component_id is the smallest id reachable over links, the row itself included.

    Ids may repeat; rows with a null id get the component of their fingerprint, and a component of null ids alone is null.
    """
    rows = stored(fingerprints(docs, id_col, text_col))
    nodes = rows.groupBy("fp").agg(F.min(id_col).alias("low"))
    found = connected_components(links(nodes.select("fp"), bits))
    nodes = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    of_fp = nodes.join(lows, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(id_col, "fp", "component_id")


def shingle_hashes(text: str, shingle: int = SIMILAR_SHINGLE, seed: int = SEED) -> np.ndarray:
    """The distinct 64-bit hashes of the text's word shingles, in order; all its words are one shingle where they are fewer."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64))


def prints_of(hashes: np.ndarray, prints: int = PRINTS) -> np.ndarray:
    """So many 64-bit SimHashes of distinct hashes, each over another mix of them."""
    counts = np.zeros(64 * prints, np.int64)
    seeds = np.arange(1, prints + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(0, len(hashes), 255):  # 255 rows add up within a byte
        x = hashes[i : i + 255, None] + seeds[None, :]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
        bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """(id_col, component_id): component_id is the smallest id reachable over links of similarity `least` or more.

    Rows with equal shingle sets are one node (blank and null texts, too). Nodes are first linked to the least node that shares
    a whole segment with them; then the keys propose pairs, except within what is one component already, where a further link
    changes nothing. So a large group of near copies isn't met pair by pair. No pair is a link before its exact sets are compared.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches):
        import xxhash

        for batch in batches:
            node, size, fps = [], [], []
            for t in batch.column(2).to_pylist():
                h = shingle_hashes(t)
                node.append(xxhash.xxh64_intdigest(h.tobytes()))
                size.append(len(h))
                fps.append(prints_of(h))
            f = np.array(fps, np.uint64).reshape(-1, PRINTS).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(size, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(f[:, r].copy()) for r in range(PRINTS)]], ["id", "text_key", "node", "size", *names])

    names = [f"f{r}" for r in range(PRINTS)]
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text)
    rows = stored(keyed.mapInArrow(sign, f"id {kind}, text_key bigint, node bigint, size int, {', '.join(f'{c} bigint' for c in names)}"))
    nodes = stored(rows.groupBy("node").agg(F.min("text_key").alias("text_key"), F.first("size").alias("size"), *[F.first(c).alias(c) for c in names]))

    def sets(batches):
        for batch in batches:
            found = [shingle_hashes(t).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "set"])

    def alike(pairs: DataFrame) -> DataFrame:
        """The (src, dst) whose sets are alike; first by size and by all fingerprints, which needs no text."""
        bits = " + ".join(f"bit_count(a.{c} ^ b.{c})" for c in names)
        sized = pairs.join(shuffled(nodes).alias("a"), F.expr("src = a.node")).join(shuffled(nodes).alias("b"), F.expr("dst = b.node"))
        near = f"least(a.size, b.size) >= {least} * greatest(a.size, b.size) - 1e-9 AND {bits} <= {int(MOST_APART * 64 * PRINTS)}"
        near = stored(sized.where(near).select("src", "dst").distinct())
        ends = near.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        wanted = ends.join(shuffled(nodes.select("node", "text_key")), "node")
        texts = keyed.select("text_key", "text").join(wanted, "text_key").select("node", "text").dropDuplicates(["node"])
        of = stored(texts.mapInArrow(sets, "node bigint, set array<bigint>"))
        both = near.join(shuffled(of.select(F.col("node").alias("src"), F.col("set").alias("a"))), "src").join(shuffled(of.select(F.col("node").alias("dst"), F.col("set").alias("b"))), "dst")
        shared = both.select("src", "dst", F.size(F.array_intersect("a", "b")).alias("n"), (F.size("a") + F.size("b")).alias("all"))
        return shared.where(f"n >= {least} * (all - n) - 1e-9").select("src", "dst")

    segments = [(r, at, (1 << width) - 1) for r in range(PRINTS) for at, width in SEGMENTS]
    keys = [F.struct(F.lit(i).alias("i"), F.shiftrightunsigned(names[r], at).bitwiseAND(F.lit(mask).cast("long")).alias("v")) for i, (r, at, mask) in enumerate(segments)]
    index = nodes.select("node", F.explode(F.array(*keys)).alias("k")).select("node", "k.i", "k.v")
    lows = index.groupBy("i", "v").agg(F.min("node").alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = stored(alike(shuffled(index).join(lows, ["i", "v"]).where("node > dst").select(F.col("node").alias("src"), "dst").distinct()))
    found = connected_components(stars)
    group = F.coalesce(F.col("component"), F.lit(0)).alias("g")
    grouped = stored(nodes.join(found.withColumnRenamed("node", "__n"), F.expr("node = __n"), "left").select("node", group, *names))
    proposed = []
    for c, check in zip(names, names[1:] + names[:1]):
        of = grouped.select("node", F.col(c).alias("fp"), F.col(check).alias("check"), "g")
        pairs = segment_links(of.select("fp", "check", "g").distinct(), REACH, ("g",), ("check",))
        a, b = shuffled(of).alias("x"), shuffled(of).alias("y")
        met = pairs.join(a, F.expr("src = x.fp AND src_g = x.g AND src_check = x.check")).join(b, F.expr("dst = y.fp AND dst_g = y.g AND dst_check = y.check"))
        same = a.join(b, F.expr("x.fp = y.fp AND x.node < y.node AND (x.g <> y.g OR x.g = 0)"))
        ends = [F.least("x.node", "y.node").alias("src"), F.greatest("x.node", "y.node").alias("dst")]
        proposed.append(stored(met.select(*ends).unionByName(same.select(*ends)).distinct()))  # one by one: small plans, one index at a time
    pairs = proposed[0]
    for more in proposed[1:]:
        pairs = pairs.unionByName(more)
    joined = connected_components(stars.unionByName(stored(alike(pairs.distinct()))))
    roots = nodes.select("node").join(joined.withColumnRenamed("node", "__n"), F.expr("node = __n"), "left").select("node", F.coalesce("component", "node").alias("root"))
    of_row = stored(rows.select("id", "node").join(roots, "node").select("id", "root"))
    lowest = of_row.groupBy("root").agg(F.min("id").alias("component_id"))
    return of_row.join(lowest, "root").select(F.col("id").alias(id_col), "component_id")
