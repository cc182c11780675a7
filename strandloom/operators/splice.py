"""Pairwise comparison of multi-segment structures (segments: contig, acc, strand, lend, rend).

Structures are paired only where their segments meet on one contig and strand, through the binned overlap join; every
label is then a relational test on exons and introns with their place in the structure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.intervals import introns
from strandloom.plans.ranges import overlap_join

KEY = ("contig", "strand")
WIDTH = 64


def exons(segments: DataFrame) -> DataFrame:
    """Segments with k, their place from the left, and n, how many their structure has."""
    w = Window.partitionBy("contig", "acc", "strand")
    return segments.select("contig", "strand", "acc", "lend", "rend", F.row_number().over(w.orderBy("lend")).alias("k"), F.count("*").over(w).alias("n"))


def meeting(a: DataFrame, b: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of a and of b of different structures that overlap; b's columns have the prefix b_."""
    return overlap_join(a, b, KEY, WIDTH, strict).where("acc <> b_acc")


def retained_introns(segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, other, lend, rend): introns of `other` strictly inside an exon of acc."""
    inner = introns(segments, ("contig", "acc", "strand")).drop("number")
    met = meeting(segments, inner, strict=False).where("lend < b_lend AND rend > b_rend")
    return met.select(*KEY, "acc", F.col("b_acc").alias("other"), F.col("b_lend").alias("lend"), F.col("b_rend").alias("rend")).distinct()


def _by_strand(left: str, right: str, is_left: Column) -> Column:
    plus = F.col("strand") != "-"
    return F.when(is_left == plus, left).otherwise(right)


def alternate_boundaries(segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, other, type, site, other_site) with acc < other: exons that meet one to one and differ at an inner end."""
    e = exons(segments)
    met = meeting(e, e)
    mine = Window.partitionBy(*KEY, "acc", "b_acc", "k")
    theirs = Window.partitionBy(*KEY, "acc", "b_acc", "b_k")
    alone = met.withColumn("x", F.count("*").over(mine)).withColumn("y", F.count("*").over(theirs)).where("x = 1 AND y = 1 AND acc < b_acc")
    left = F.when((F.col("k") > 1) & (F.col("b_k") > 1) & (F.col("lend") != F.col("b_lend")), F.struct(_by_strand("acceptor", "donor", F.lit(True)).alias("type"), F.col("lend").alias("site"), F.col("b_lend").alias("other_site")))
    right = F.when((F.col("k") < F.col("n")) & (F.col("b_k") < F.col("b_n")) & (F.col("rend") != F.col("b_rend")), F.struct(_by_strand("acceptor", "donor", F.lit(False)).alias("type"), F.col("rend").alias("site"), F.col("b_rend").alias("other_site")))
    out = alone.select(*KEY, "acc", F.col("b_acc").alias("other"), F.explode(F.array_compact(F.array(left, right))).alias("v"))
    return out.select(*KEY, "acc", "other", "v.*")


def skipped_exons(segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, other, lend, rend, exons): runs of acc's exons inside one intron of other, with exons of acc
    that meet other's on both sides of that intron."""
    e = exons(segments)
    inner = introns(segments, ("contig", "acc", "strand")).drop("number")
    inside = meeting(e, inner, strict=False).where("lend >= b_lend AND rend <= b_rend")
    run = inside.groupBy(*KEY, "acc", "b_acc", "b_lend", "b_rend").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.count("*").alias("exons"))
    anchors = meeting(e, segments).groupBy(*KEY, "acc", "b_acc").agg(F.min("b_lend").alias("first"), F.max("b_rend").alias("last"))
    both = run.join(anchors, [*KEY, "acc", "b_acc"]).where("first < b_lend AND last > b_rend")
    return both.select(*KEY, "acc", F.col("b_acc").alias("other"), "lend", "rend", "exons")


def ends_in_introns(segments: DataFrame, fuzz: int = 20) -> DataFrame:
    """(contig, strand, acc, other, type, site): outer ends of acc in an intron of other, more than fuzz bases from the exon
    that the outer exon runs into."""
    e = exons(segments)
    inner = introns(segments, ("contig", "acc", "strand")).drop("number")
    met = meeting(e, inner, strict=False)
    left = F.when((F.col("k") == 1) & (F.col("lend") >= F.col("b_lend")) & (F.col("rend") > F.col("b_rend")) & (F.col("b_rend") - F.col("lend") + 1 > fuzz), F.struct(_by_strand("starts", "ends", F.lit(True)).alias("type"), F.col("lend").alias("site")))
    right = F.when((F.col("k") == F.col("n")) & (F.col("rend") <= F.col("b_rend")) & (F.col("lend") < F.col("b_lend")) & (F.col("rend") - F.col("b_lend") + 1 > fuzz), F.struct(_by_strand("starts", "ends", F.lit(False)).alias("type"), F.col("rend").alias("site")))
    out = met.select(*KEY, "acc", F.col("b_acc").alias("other"), F.explode(F.array_compact(F.array(left, right))).alias("v"))
    return out.select(*KEY, "acc", "other", "v.*").distinct()


def alternate_terminal_exons(segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, other, left, other_left, right, other_right) with acc < other: exons before the first and behind the
    last that meet, where both structures have some."""
    e = exons(segments)
    ends = meeting(e, e).groupBy(*KEY, "acc", "b_acc").agg(
        (F.min("k") - 1).alias("left"), (F.min("b_k") - 1).alias("other_left"), F.min(F.col("n") - F.col("k")).alias("right"), F.min(F.col("b_n") - F.col("b_k")).alias("other_right"))
    found = ends.where("acc < b_acc AND (left > 0 AND other_left > 0 OR right > 0 AND other_right > 0)")
    return found.select(*KEY, "acc", F.col("b_acc").alias("other"), "left", "other_left", "right", "other_right")


def equal_exons(segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, other, equal) with acc < other: how many exons two structures have alike."""
    b = segments.select(*KEY, F.col("acc").alias("other"), "lend", "rend")
    return segments.join(b, [*KEY, "lend", "rend"]).where("acc < other").groupBy(*KEY, "acc", "other").agg(F.count("*").alias("equal"))


def intron_support(segments: DataFrame) -> DataFrame:
    """(contig, strand, lend, rend, having, spanning): structures with exactly this intron, and those with an exon across it."""
    inner = introns(segments, ("contig", "acc", "strand")).drop("number")
    having = inner.groupBy(*KEY, "lend", "rend").agg(F.countDistinct("acc").alias("having"))
    across = overlap_join(having, segments, KEY, WIDTH).where("b_lend < lend AND b_rend > rend")
    spanning = across.groupBy(*KEY, "lend", "rend").agg(F.countDistinct("b_acc").alias("spanning"))
    return having.join(spanning, [*KEY, "lend", "rend"], "left").na.fill(0, ["spanning"])


def range_class(lend: Column, rend: Column, cds_lend: Column, cds_rend: Column, span_lend: Column, span_rend: Column, strand: Column) -> Column:
    """Labels '<part>_contained' or '<part>_overlap' of a range against the coding part and the ends before and behind it."""
    five, three = F.when(strand == "-", "utr_3prime").otherwise("utr_5prime"), F.when(strand == "-", "utr_5prime").otherwise("utr_3prime")

    def label(name: Column, a: Column, b: Column) -> Column:
        meets = (a <= b) & (lend <= b) & (rend >= a)
        return F.when(meets & (lend >= a) & (rend <= b), F.concat(name, F.lit("_contained"))).when(meets, F.concat(name, F.lit("_overlap")))

    parts = F.array(label(F.lit("cds"), cds_lend, cds_rend), label(five, span_lend, cds_lend - 1), label(three, cds_rend + 1, span_rend))
    return F.array_join(F.array_sort(F.array_compact(parts)), ",")


def frame_overlap(segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, other, same, different) with acc < other: shared bases of two structures, read in the same frame or not.

    Pieces carry their offset along the structure; equal offset minus position modulo 3 means an equal frame. No base is exploded.
    """
    size = F.col("rend") - F.col("lend") + 1
    w = Window.partitionBy("contig", "acc", "strand").orderBy("lend").rowsBetween(Window.unboundedPreceding, -1)
    e = segments.select(*KEY, "acc", "lend", "rend", F.pmod(F.coalesce(F.sum(size).over(w), F.lit(0)) - F.col("lend"), F.lit(3)).alias("f"))
    met = meeting(e, e, strict=False).where("acc < b_acc")
    shared = F.least("rend", "b_rend") - F.greatest("lend", "b_lend") + 1
    return met.groupBy(*KEY, "acc", F.col("b_acc").alias("other")).agg(
        F.sum(F.when(F.col("f") == F.col("b_f"), shared).otherwise(0)).cast("long").alias("same"),
        F.sum(F.when(F.col("f") != F.col("b_f"), shared).otherwise(0)).cast("long").alias("different"))


def alternate_internal_exons(segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, other, lend, rend, other_lend, other_rend) with acc < other: an inner exon of each inside an intron
    of the other, disjoint, and with neighbours that meet on both sides."""
    w = Window.partitionBy("contig", "acc", "strand").orderBy("lend")
    e = segments.select(*KEY, "acc", "lend", "rend", *[f(c).over(w).alias(n) for f, c, n in ((F.lag, "lend", "pl"), (F.lag, "rend", "pr"), (F.lead, "lend", "nl"), (F.lead, "rend", "nr"))])
    inner = e.where("pl IS NOT NULL AND nl IS NOT NULL")
    # from the end of the exon before to the start of the next: two such stretches overlap where both exons are alternatives
    reach = inner.select(*KEY, "acc", F.col("pr").alias("lend"), F.col("nl").alias("rend"), F.col("lend").alias("x"), F.col("rend").alias("y"), "pl", "nr")
    met = meeting(reach, reach).where("acc < b_acc AND (y < b_x OR x > b_y)")
    # each exon lies in the other's intron on that side, and the flanks meet
    inside = "CASE WHEN y < b_x THEN x > b_lend AND b_y < rend ELSE b_x > lend AND y < b_rend END"
    flanks = "pl <= b_lend AND lend >= b_pl AND rend <= b_nr AND nr >= b_rend"
    return met.where(f"{inside} AND {flanks}").select(*KEY, "acc", F.col("b_acc").alias("other"), F.col("x").alias("lend"), F.col("y").alias("rend"), F.col("b_x").alias("other_lend"), F.col("b_y").alias("other_rend"))


def boundary_events(variations: DataFrame) -> DataFrame:
    """(contig, strand, type, first_site, second_site, pairs, structures): alternate boundaries gathered into events by their two sites."""
    both = F.array("acc", "other")
    rows = variations.select(*KEY, "type", F.least("site", "other_site").alias("first_site"), F.greatest("site", "other_site").alias("second_site"), F.explode(both).alias("a"))
    return rows.groupBy(*KEY, "type", "first_site", "second_site").agg((F.count("*") / 2).cast("long").alias("pairs"), F.countDistinct("a").alias("structures"))


def identical_structures(segments: DataFrame) -> DataFrame:
    """(contig, strand, shape, structures, first): structures with exactly the same segments."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lend", "rend"))), lambda s: F.concat_ws("-", s["lend"].cast("string"), s["rend"].cast("string"))), ",")
    shapes = segments.groupBy("contig", "strand", "acc").agg(text.alias("shape"))
    return shapes.groupBy(*KEY, "shape").agg(F.count("*").alias("structures"), F.min("acc").alias("first"))
