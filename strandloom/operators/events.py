"""Variations between structures: one table of all kinds, skipped exons in detail, codons in introns, and the sequences of regions.

Structures are segments (contig, acc, strand, lend, rend) as in ``splice``; what they share is found through its binned joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators import splice as sp
from strandloom.operators.intervals import introns
from strandloom.operators.report import numbered
from strandloom.plans.lineage import stored
from strandloom.plans.ranges import overlap_join

KEY = ["contig", "strand"]


def variations(segments: DataFrame, fuzz: int = 20) -> DataFrame:
    """(contig, strand, acc, type, lend, rend, variation, others): every variation of a structure once, with a number and the structures it differs from.

    The number is the same for the same table, and unique; equal (acc, type, lend, rend) are one variation however many structures show it.
    """
    seg = stored(segments)
    c = F.col
    both = lambda df, kind, a, b: df.select(*KEY, "acc", "other", kind.alias("type"), c(a).alias("lend"), c(b).alias("rend"))
    found = both(sp.retained_introns(seg), F.lit("retained_intron"), "lend", "rend")
    found = found.unionByName(both(sp.skipped_exons(seg), F.lit("skipped_exon"), "lend", "rend"))
    found = found.unionByName(both(sp.ends_in_introns(seg, fuzz), F.concat(c("type"), F.lit("_in_intron")), "site", "site"))
    alt = sp.alternate_boundaries(seg)
    kind = F.concat(F.lit("alt_"), c("type"))
    found = found.unionByName(both(alt, kind, "site", "site"))
    found = found.unionByName(alt.select(*KEY, c("other").alias("acc"), c("acc").alias("other"), kind.alias("type"), c("other_site").alias("lend"), c("other_site").alias("rend")))
    one = found.groupBy(*KEY, "acc", "type", "lend", "rend").agg(F.countDistinct("other").alias("others"))
    return numbered(one, ("contig", "strand", "acc", "type", "lend", "rend"), F.pmod(F.xxhash64("contig"), F.lit(64)), 64, name="variation")


def linked_variations(variation: DataFrame) -> DataFrame:
    """(a, b) with a < b: numbers of variations of different structures at one place and of one type."""
    x = variation.select(*KEY, "type", "lend", "rend", "acc", F.col("variation").alias("a"))
    y = variation.select(*KEY, "type", "lend", "rend", F.col("acc").alias("acc_b"), F.col("variation").alias("b"))
    return x.join(y, [*KEY, "type", "lend", "rend"]).where("a < b AND acc <> acc_b").select("a", "b").distinct()


def skipped_exon_events(segments: DataFrame) -> DataFrame:
    """(contig, strand, lend, rend, exons, having, introns, skipping): sets of exons that some structures have in a row and others skip.

    lend and rend are those of the set, exons its segments in text, having how many structures have it, introns the covering
    introns in text, and skipping how many structures have one of these.
    """
    seg = stored(segments)
    e = sp.exons(seg)
    inner = introns(seg, ("contig", "acc", "strand")).drop("number")
    inside = sp.meeting(e, inner, strict=False).where("lend >= b_lend AND rend <= b_rend")
    text = lambda a, b: F.concat_ws("-", F.col(a).cast("string"), F.col(b).cast("string"))
    runs = inside.groupBy(*KEY, "acc", "b_acc", "b_lend", "b_rend").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.array_sort(F.collect_list(F.struct("lend", "rend"))).alias("parts"))
    anchored = sp.meeting(e, seg).groupBy(*KEY, "acc", "b_acc").agg(F.min("b_lend").alias("first"), F.max("b_rend").alias("last"))
    held = runs.join(anchored, [*KEY, "acc", "b_acc"]).where("first < b_lend AND last > b_rend")
    shape = F.array_join(F.transform("parts", lambda s: F.concat_ws("-", s["lend"].cast("string"), s["rend"].cast("string"))), ",")
    held = held.select(*KEY, "acc", "b_acc", "lend", "rend", shape.alias("exons"), text("b_lend", "b_rend").alias("intron"))
    listed = F.array_join(F.array_sort(F.collect_set("intron")), ",").alias("introns")
    return held.groupBy(*KEY, "lend", "rend", "exons").agg(F.countDistinct("acc").alias("having"), listed, F.countDistinct("b_acc").alias("skipping"))


def codons_in_introns(coding: DataFrame, segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, other, start, stop): whether acc's coding part (contig, acc, strand, cds_lend, cds_rend) begins or ends in an intron of other."""
    ends = F.explode(F.array(F.struct(F.lit(True).alias("left"), F.col("cds_lend").alias("at")), F.struct(F.lit(False).alias("left"), F.col("cds_rend").alias("at"))))
    points = coding.select(*KEY, "acc", ends.alias("e")).select(*KEY, "acc", F.col("e.left").alias("left"), F.col("e.at").alias("lend"), F.col("e.at").alias("rend"))
    inner = introns(segments, ("contig", "acc", "strand")).drop("number")
    met = overlap_join(points, inner, tuple(KEY), sp.WIDTH).where("acc <> b_acc")
    first = F.col("left") == (F.col("strand") != "-")
    return met.groupBy(*KEY, "acc", F.col("b_acc").alias("other")).agg(F.bool_or(first).alias("start"), F.bool_or(~first).alias("stop"))


def region_sequences(regions: DataFrame, tiled: DataFrame, width: int, flank: int = 0) -> DataFrame:
    """regions (contig, strand, lend, rend, ...) with bases: their sequence and `flank` bases on either side, the strand's own way round.

    tiled comes from validate.tiles(..., width); a region is put together from the tiles it touches.
    """
    from strandloom.functions.seq import reverse_complement

    rows = regions.withColumns({"__id": F.struct(*regions.columns), "__a": F.greatest(F.col("lend") - flank, F.lit(1)), "__b": F.col("rend") + flank})
    rows = rows.withColumn("__t", F.explode(F.sequence(F.floor((F.col("__a") - 1) / width), F.floor((F.col("__b") - 1) / width))))
    met = rows.join(tiled.select(F.col("contig").alias("__c"), F.col("tile").alias("__tile"), "bases"), F.expr("contig = __c AND __t = __tile"))
    begin, end = F.greatest(F.col("__a") - F.col("__t") * width, F.lit(1)), F.least(F.col("__b") - F.col("__t") * width, F.lit(width))
    part = F.substring("bases", begin.cast("int"), (end - begin + 1).cast("int"))
    joined = met.groupBy("__id").agg(F.array_sort(F.collect_list(F.struct(F.col("__t").alias("t"), part.alias("s")))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["s"]), "")
    out = joined.select("__id.*", text.alias("bases"))
    return out.withColumn("bases", F.when(F.col("strand") == "-", reverse_complement(F.col("bases"))).otherwise(F.col("bases")))


def junction_regions(segments: DataFrame) -> DataFrame:
    """(contig, strand, acc, lend, rend, kind): for every intron, the exon parts on both of its sides as one region each, 'left' and 'right'."""
    e = sp.exons(segments)
    left = e.where("k < n").select(*KEY, "acc", "lend", "rend", F.lit("left").alias("kind"))
    return left.unionByName(e.where("k > 1").select(*KEY, "acc", "lend", "rend", F.lit("right").alias("kind")))


def disjoint(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """a as it is, but reading it raises if one of its keys is in b as well."""
    shared = b.select(*on).distinct().withColumn("__in_b", F.lit(True))
    marked = a.join(shared, on, "left")
    check = F.when(F.col("__in_b"), F.raise_error(F.concat_ws(" ", F.lit("in both sets:"), *[F.col(c).cast("string") for c in on])).cast("boolean")).otherwise(F.lit(True))
    return marked.where(check).drop("__in_b")


def similarity_clusters(hits: DataFrame, least_identity: float, least_percent: float, both_sides: bool = False) -> DataFrame:
    """(node, component) from hits (a, b, identity, cover_a, cover_b): single linkage of hits with enough identity and enough of one side, or of both, aligned."""
    from strandloom.plans.components import connected_components

    enough = lambda side: F.col(side) >= least_percent
    covers = enough("cover_a") & enough("cover_b") if both_sides else enough("cover_a") | enough("cover_b")
    return connected_components(hits.where((F.col("identity") >= least_identity) & covers), "a", "b")


def filtered_hits(hits: DataFrame, least_identity: float, most_gap_percent: float, strand: str | None = None) -> DataFrame:
    """Rows of formats.psl() of enough identity whose gaps in the query take at most a share of it, of one strand if it is given."""
    used = F.aggregate("segments", F.lit(0), lambda n, s: n + s["mrend"] - s["mlend"] + 1)
    span = F.array_max(F.transform("segments", lambda s: s["mrend"])) - F.array_min(F.transform("segments", lambda s: s["mlend"])) + 1
    kept = hits.where((F.col("per_id") >= least_identity) & (100 * (span - used) <= most_gap_percent * span))
    return kept if strand is None else kept.where(F.col("strand") == strand)


def first_holder(structures: DataFrame, assemblies: DataFrame, width: int = 64) -> DataFrame:
    """(contig, acc, assembly, gene_id): the first assembly (contig, assembly, gene_id, lend, rend: its segments), by number, that has a segment in common with a segment of acc."""
    met = overlap_join(structures.select("contig", "acc", "lend", "rend"), assemblies.select("contig", "assembly", "gene_id", "lend", "rend"), ("contig",), width)
    return met.groupBy("contig", "acc").agg(F.min(F.struct("b_assembly", "b_gene_id")).alias("m")).select("contig", "acc", F.col("m.b_assembly").alias("assembly"), F.col("m.b_gene_id").alias("gene_id"))


def component_of(acc: str) -> Column:
    """The family of a de novo assembled accession, up to its gene number; the accession itself where it has none."""
    a = F.col(acc)
    # The two shapes of family names, older first.
    shapes = [r"^(.*comp\d+_c\d+)", r"^(.*c\d+_g\d+)"]
    return F.coalesce(*[F.nullif(F.regexp_extract(a, x, 1), F.lit("")) for x in shapes], a)


def by_complexity(models: DataFrame) -> DataFrame:
    """models (exons, protein, acc, by) with rank: most exons first, then the longest protein, then acc, within `by`."""
    from pyspark.sql import Window

    w = Window.partitionBy("by").orderBy(F.desc(F.size("exons")), F.desc(F.length("protein")), "acc")
    return models.withColumn("rank", F.row_number().over(w))
