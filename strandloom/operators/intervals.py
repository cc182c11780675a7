"""Interval operators over rows (contig, id, lend, rend, strand, score, ...).

Coordinates are closed and lend <= rend. Windows are totally ordered by (lend, rend, id). Rows with a null contig or end take
no part. Piles, spans, gaps and coverage gather no contig into one task: sweeps run inside coordinate bins and are stitched
by a table of one row per bin. Chains of hits, depth and transcript coordinates are windows over a group's ordered rows (depth over its boundary
positions, which are counted first); tiers and the artifact filter depend on the order of scores and run pile by pile.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.plans.lineage import dealt
from strandloom.plans.ranges import overlap_join

BIN = 100_000
FIRST = Window.unboundedPreceding
#: Best score first, in a total order.
BEST = (F.desc, "score"), (F.asc, "lend"), (F.asc, "rend"), (F.asc, "id")


def overlap_length(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Shared bases of two closed intervals, 0 where they don't meet."""
    return F.greatest(F.lit(0), F.least(a2, b2) - F.greatest(a1, b1) + 1)


def contains(a1: Column, a2: Column, b1: Column, b2: Column, fuzz: int = 0) -> Column:
    return (b1 >= a1 - fuzz) & (b2 <= a2 + fuzz)


def piles(iv: DataFrame, by: tuple[str, ...] = ("contig",), extend: int = 0, width: int = BIN) -> DataFrame:
    """Adds pile: 1, 2, ... per `by`; an interval joins the pile while it touches the running maximum rend.

    extend widens both ends first. A crowded contig is swept bin by bin of `width` bases: each bin starts from the
    maximum rend of the bins before it, and counts on from their piles.
    """
    rows = iv.where(F.col("lend").isNotNull() & F.col("rend").isNotNull()).withColumn("__bin", F.floor(F.col("lend") / width))
    key = (*by, "__bin")
    order = Window.partitionBy(*key).orderBy("lend", "rend", "id")
    along = Window.partitionBy(*by).orderBy("__bin").rowsBetween(FIRST, -1)
    tops = rows.groupBy(*key).agg(F.max("rend").alias("top")).withColumn("__carry", F.max("top").over(along)).drop("top")
    swept = rows.join(tops, list(key)).withColumn("__reach", F.greatest("__carry", F.max("rend").over(order.rowsBetween(FIRST, -1))))
    fresh = F.when(F.col("lend") - extend <= F.col("__reach") + extend, 0).otherwise(1)
    swept = swept.withColumn("__fresh", fresh)
    heads = swept.groupBy(*key).agg(F.sum("__fresh").alias("n")).withColumn("__piles", F.coalesce(F.sum("n").over(along), F.lit(0))).drop("n")
    numbered = swept.join(heads, list(key)).withColumn("pile", F.col("__piles") + F.sum("__fresh").over(order.rangeBetween(FIRST, 0)))
    return numbered.select(*iv.columns, "pile")


def pile_spans(iv: DataFrame, by: tuple[str, ...] = ("contig",), extend: int = 0) -> DataFrame:
    """(by, pile, lend, rend, members): the union of the intervals, or with extend that of neighbours, by true ends."""
    return piles(iv, by, extend).groupBy(*by, "pile").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.count("*").alias("members"))


def group_spans(iv: DataFrame, by: tuple[str, ...], extend: int = 0) -> DataFrame:
    """pile_spans of groups of a few rows each, such as the segments of one structure: windows over whole groups, so that rows already dealt by some of `by` don't move."""
    rows = iv.select(*by, "lend", "rend").dropna()
    order = Window.partitionBy(*by).orderBy("lend", "rend")
    fresh = F.when(F.col("lend") - extend <= F.max("rend").over(order.rowsBetween(FIRST, -1)) + extend, 0).otherwise(1)
    piled = rows.withColumn("__fresh", fresh).withColumn("pile", F.sum("__fresh").over(order.rangeBetween(FIRST, 0)))
    return piled.groupBy(*by, "pile").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.count("*").alias("members"))


def gaps(iv: DataFrame, by: tuple[str, ...] = ("contig",), flank: int = 0) -> DataFrame:
    """(by, lend, rend): the stretches between neighbouring piles, less a flank on either side."""
    spans = pile_spans(iv, by)
    after = F.lead("lend").over(Window.partitionBy(*by).orderBy("pile"))
    out = spans.select(*by, (F.col("rend") + 1 + flank).alias("lend"), (after - 1 - flank).alias("rend"))
    return out.where("rend >= lend")


def overlap_pairs(iv: DataFrame, on: tuple[str, ...] = ("contig",), strict: bool = True, least_percent: float = 0.0, width: int = 64) -> DataFrame:
    """(on, a, b, shared, percent) with a < b for overlapping intervals; percent is of the shorter one, i.e. the larger of the two ratios."""
    slim = iv.select(*on, "id", "lend", "rend")
    met = overlap_join(slim, slim, on, width, strict).where("id < b_id")
    shared = overlap_length(F.col("lend"), F.col("rend"), F.col("b_lend"), F.col("b_rend"))
    shorter = F.least(F.col("rend") - F.col("lend"), F.col("b_rend") - F.col("b_lend")) + 1
    met = met.select(*on, F.col("id").alias("a"), F.col("b_id").alias("b"), shared.alias("shared"), (shared * 100 / shorter).alias("percent"))
    return met.where(F.col("percent") >= least_percent)


def best_by(rows: DataFrame, by: tuple[str, ...], *order: Column, n: int = 1) -> DataFrame:
    """The n first rows of each group in the given order, with their rank."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def stratified_sample(iv: DataFrame, by: tuple[str, ...], cap: int, width: int = 1000) -> DataFrame:
    """At most cap intervals of each group, round by round: every bin of `width` bases gives its best-scored one, then its next."""
    rows = dealt(iv, *by)
    start = rows.groupBy(*by).agg(F.min("lend").alias("__from"))
    binned = rows.join(start, list(by)).withColumn("bin", F.floor((F.col("lend") - F.col("__from")) / width))
    best = Window.partitionBy(*by, "bin").orderBy(F.desc("score"), "id")
    rounds = binned.withColumn("round", F.row_number().over(best)).where(F.col("round") <= cap)  # a bin's rounds come in order, so none beyond cap is taken
    take = Window.partitionBy(*by).orderBy("round", "bin", "id")
    return rounds.withColumn("taken", F.row_number().over(take)).where(F.col("taken") <= cap).drop("__from", "taken")


def introns(segments: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by, number, lend, rend): the stretches between neighbouring segments of a structure."""
    w = Window.partitionBy(*by).orderBy("lend", "rend")
    out = segments.select(*by, F.row_number().over(w).alias("number"), (F.col("rend") + 1).alias("lend"), (F.lead("lend").over(w) - 1).alias("rend"))
    return out.where("rend >= lend")


def transcript_coords(segments: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Adds mlend and mrend: positions along the structure, counted in its direction from 1."""
    along = F.when(F.col("strand") == "-", -F.col("lend")).otherwise(F.col("lend"))
    w = Window.partitionBy(*by).orderBy(along).rowsBetween(FIRST, 0)
    size = F.col("rend") - F.col("lend") + 1
    return segments.withColumn("mrend", F.sum(size).over(w)).withColumn("mlend", F.col("mrend") - size + 1)


def phases(segments: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Adds phase: coded bases before the segment, modulo 3."""
    return transcript_coords(segments, by).withColumn("phase", ((F.col("mlend") - 1) % 3).cast("int")).drop("mlend", "mrend")


def chain_hits(hits: DataFrame, by: tuple[str, ...], most_overlap: int, most_gap: int) -> DataFrame:
    """Adds chain: 1, 2, ... per group; neighbours in order of lend chain if their strand is the same, the query (qlend, qrend)
    advances in its direction and overlaps by at most most_overlap, and at most most_gap bases lie between."""
    w = Window.partitionBy(*by).orderBy("lend", "rend", "id")
    was = {c: F.lag(c).over(w) for c in ("strand", "rend", "qlend", "qrend")}
    onward = F.when(F.col("strand") == "-", F.col("qrend") < was["qrend"]).otherwise(F.col("qrend") > was["qrend"])
    shared = overlap_length(F.col("qlend"), F.col("qrend"), was["qlend"], was["qrend"])
    joins = (F.col("strand") == was["strand"]) & onward & (shared <= most_overlap) & (F.col("lend") - was["rend"] - 1 <= most_gap)
    fresh = F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)
    return hits.withColumn("__fresh", fresh).withColumn("chain", F.sum("__fresh").over(w.rowsBetween(FIRST, 0))).drop("__fresh")


def depth(iv: DataFrame, by: tuple[str, ...] = ("contig",)) -> DataFrame:
    """(by, lend, rend, depth): maximal stretches of equal, positive depth; boundary events and a running sum, no per-base rows."""
    edges = iv.select(*by, F.explode(F.array(F.struct(F.col("lend").alias("at"), F.lit(1).alias("d")), F.struct((F.col("rend") + 1).alias("at"), F.lit(-1).alias("d")))).alias("e"))
    steps = edges.groupBy(*by, F.col("e.at").alias("lend")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    w = Window.partitionBy(*by).orderBy("lend")
    out = steps.select(*by, "lend", (F.lead("lend").over(w) - 1).alias("rend"), F.sum("d").over(w.rowsBetween(FIRST, 0)).alias("depth"))
    return out.where("depth > 0")


def covered(a: DataFrame, b: DataFrame, by: tuple[str, ...] = ("contig",), width: int = 64) -> DataFrame:
    """(by, size, shared): bases of the union of a, and those of them that lie in the union of b; groups without b have 0."""
    ua, ub = pile_spans(a, by).select(*by, "lend", "rend"), pile_spans(b, by).select(*by, "lend", "rend")
    total = ua.groupBy(*by).agg(F.sum(F.col("rend") - F.col("lend") + 1).alias("size"))
    met = overlap_join(ua, ub, by, width)
    shared = met.groupBy(*by).agg(F.sum(overlap_length(F.col("lend"), F.col("rend"), F.col("b_lend"), F.col("b_rend"))).alias("shared"))
    return total.join(shared, list(by), "left").select(*by, "size", F.coalesce("shared", F.lit(0)).cast("long").alias("shared"))


def by_pile(piled: DataFrame, by: tuple[str, ...], order: tuple[tuple[Callable, str], ...], solve: Callable, schema) -> DataFrame:
    """solve(rows, starts) over whole piles, whose rows come in `order`; starts are where each of them begins.

    Piles are dealt by their number and stream through the tasks, so many small ones cost no group each, and a task holds no more than the
    largest one and a batch.
    """
    key = [*by, "pile"]

    def run(batches):
        import numpy as np
        import pandas as pd

        held: list = []  # parts of the pile that the last batch ended in

        def whole(parts):
            rows = pd.concat(parts, ignore_index=True)
            codes = rows[key].ne(rows[key].shift()).any(axis=1).to_numpy()
            return solve(rows, np.flatnonzero(codes).tolist())

        for batch in batches:
            if not len(batch):
                continue
            last = (batch[key] == batch[key].iloc[-1]).all(axis=1).to_numpy()
            at = len(batch) - int(np.argmin(last[::-1])) if not last.all() else 0
            if at or held and not (held[-1][key].iloc[-1] == batch[key].iloc[0]).all():
                yield whole([*held, batch[:at]])
                held = []
            held.append(batch[at:])
        if held:
            yield whole(held)

    return piled.where(" AND ".join(f"`{c}` IS NOT NULL" for c in key)).repartition(*key).sortWithinPartitions(*key, *[f(c) for f, c in order]).mapInPandas(run, schema)


def tiers(iv: DataFrame, by: tuple[str, ...] = ("contig",), most: int | None = None, overlaps: Callable | None = None) -> DataFrame:
    """Adds tier: features by score (best first) each go to the first tier where they overlap nothing; beyond `most` they are dropped.

    Greedy, so it runs group by group; a group is one pile, as features of different piles never meet. overlaps(a, b) may say in place of
    the usual rule whether two (lend, rend) of a pile keep each other out of a tier; it is then asked for every feature of a tier.
    """
    from bisect import bisect_left
    from itertools import pairwise

    import pandas as pd

    def deal(pdf: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
        number = []
        all_lends, all_rends = pdf["lend"].tolist(), pdf["rend"].tolist()  # taken apart once for a batch: most piles are a row or two
        for begin, end in pairwise([*starts, len(pdf)]):
            rows: list[tuple[list[int], list[int]]] = []  # each tier's ends in order, as nothing in it overlaps
            for a, b in zip(all_lends[begin:end], all_rends[begin:end]):
                for k, (lends, rends) in enumerate(rows):
                    at = bisect_left(rends, a)
                    if at == len(rends) or lends[at] > b if overlaps is None else not any(overlaps((a, b), x) for x in zip(lends, rends)):
                        break
                else:
                    k, at = len(rows), 0
                    rows.append(([], []))
                rows[k][0].insert(at, a)
                rows[k][1].insert(at, b)
                number.append(k + 1)
        return pdf.assign(tier=number)

    piled = piles(iv, by)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in piled.schema) + ", tier int"
    out = by_pile(piled, by, BEST, deal, schema).drop("pile")
    return out if most is None else out.where(F.col("tier") <= most)


def drop_artifacts(iv: DataFrame, by: tuple[str, ...] = ("contig", "strand"), overlap: float = 10.0, share: float = 10.0) -> DataFrame:
    """Keeps intervals, best score first within a pile, unless a kept one overlaps them by `overlap` percent of the
    shorter and their score is below `share` percent of its."""
    from itertools import pairwise

    import pandas as pd

    def keep(pdf: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
        stay = []
        columns = [pdf[c].tolist() for c in ("lend", "rend", "score")]  # taken apart once for a batch
        for begin, end in pairwise([*starts, len(pdf)]):
            lend, rend, score = (c[begin:end] for c in columns)
            width = max(1, sorted(map(int.__sub__, rend, lend))[len(lend) // 2] + 1)
            kept: dict[int, list[tuple[int, int, float]]] = {}  # by bins of a usual length
            for a, b, s in zip(lend, rend, score):
                bins = range(a // width, b // width + 1)
                bad = any(
                    100 * (min(b, y) - max(a, x) + 1) >= overlap * (min(b - a, y - x) + 1) and min(b, y) >= max(a, x) and 100 * s < share * t
                    for k in bins
                    for x, y, t in kept.get(k, ())
                )
                stay.append(not bad)
                if not bad:
                    for k in bins:
                        kept.setdefault(k, []).append((a, b, s))
        return pdf[stay]

    piled = piles(iv, by)
    return by_pile(piled, by, BEST, keep, piled.schema).drop("pile")
