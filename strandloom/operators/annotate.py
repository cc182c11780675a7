"""Comparison of assembled structures with annotated genes: a status for each, by rules in a fixed order.

Statuses are the numbers of the status table: 3 same structure, 4 only the ends grow, 5 more than one gene, 8 changed structure,
10 no gene, 12 inside an existing structure, 13 grows an end, 29/36 merges genes (full-length or not), 30/35 fails to, 40 splits a gene,
42 on the other strand of a gene.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.seq import protein_identity
from strandloom.operators.intervals import overlap_length
from strandloom.plans.ranges import overlap_join

KEY = ("contig", "strand")


def hits(models: DataFrame, genes: DataFrame, least: float = 0.0, on: tuple[str, ...] = KEY) -> DataFrame:
    """Models and genes that overlap on `on`, with of_model and of_gene, the shared percent of each; at least `least` of the shorter one."""
    met = overlap_join(models, genes, on)
    shared = overlap_length(F.col("lend"), F.col("rend"), F.col("b_lend"), F.col("b_rend"))
    met = met.withColumn("of_model", 100 * shared / (F.col("rend") - F.col("lend") + 1)).withColumn("of_gene", 100 * shared / (F.col("b_rend") - F.col("b_lend") + 1))
    return met.where(F.greatest("of_model", "of_gene") >= least)


def single_status(lend: Column, rend: Column, b_lend: Column, b_rend: Column) -> Column:
    """The status of a model against its only gene, by their spans."""
    return (
        F.when((lend == b_lend) & (rend == b_rend), 3)
        .when((lend >= b_lend) & (rend <= b_rend), 12)
        .when((lend <= b_lend) & (rend >= b_rend), 4)
        .when((lend < b_lend) | (rend > b_rend), 13)
        .otherwise(8)
    )


def statuses(models: DataFrame, genes: DataFrame, least: float = 50.0) -> DataFrame:
    """(contig, id, status, gene) of every model: 3, 4, 12 or 13 by its only gene, 5 for several, 42 for genes of the other strand only, 10 for none.

    gene is the only gene's id, or the least of several.
    """
    same = hits(models, genes, least).groupBy("contig", "id").agg(
        F.count("*").alias("n"), F.min("b_id").alias("gene"), F.min(single_status(F.col("lend"), F.col("rend"), F.col("b_lend"), F.col("b_rend"))).alias("one"))
    flipped = genes.withColumn("strand", F.translate("strand", "+-", "-+"))
    anti = hits(models, flipped, least).groupBy("contig", "id").agg(F.min("b_id").alias("anti"))
    joined = models.select("contig", "id").distinct().join(same, ["contig", "id"], "left").join(anti, ["contig", "id"], "left")
    status = F.when(F.col("n") == 1, F.col("one")).when(F.col("n") > 1, 5).when(F.col("anti").isNotNull(), 42).otherwise(10)
    return joined.select("contig", "id", status.alias("status"), F.coalesce("gene", "anti").alias("gene"))


def merges(models: DataFrame, genes: DataFrame, least: float = 80.0) -> DataFrame:
    """(contig, id, status, genes): models over several genes of their strand; 29 or 36 if each is covered by `least` percent, else 30 or 35.

    models have is_full, which picks the first of the two.
    """
    many = hits(models, genes, 0.0).groupBy("contig", "id", "is_full").agg(F.count("*").alias("n"), F.min("of_gene").alias("least"), F.array_sort(F.collect_set("b_id")).alias("ids")).where("n > 1")
    good = F.when(F.col("is_full"), 29).otherwise(36)
    bad = F.when(F.col("is_full"), 30).otherwise(35)
    return many.select("contig", "id", F.when(F.col("least") >= least, good).otherwise(bad).alias("status"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("genes"))


def splits(models: DataFrame, genes: DataFrame, least: float = 80.0) -> DataFrame:
    """(contig, gene, status, groups): genes met by several groups of models that don't touch each other and together span
    `least` percent of the gene: 40; otherwise 39. models have a group; each stands in it by its widest model."""
    widest = F.max_by(F.struct("lend", "rend"), F.struct(F.col("rend") - F.col("lend"), -F.col("id"))).alias("w")
    spans = models.groupBy(*KEY, "group").agg(widest).select(*KEY, F.col("group").alias("id"), "w.lend", "w.rend")
    met = hits(spans, genes, 0.0)
    joint = F.least(F.max("rend"), F.max("b_rend")) - F.greatest(F.min("lend"), F.min("b_lend")) + 1
    many = met.groupBy("contig", F.col("b_id").alias("gene")).agg(F.count("*").alias("groups"), (100 * joint / (F.max("b_rend") - F.min("b_lend") + 1)).alias("joint")).where("groups > 1")
    return many.select("contig", "gene", F.when(F.col("joint") >= least, 40).otherwise(39).alias("status"), "groups")


def extension(lend: Column, rend: Column, b_lend: Column, b_rend: Column, strand: Column) -> Column:
    """'both', '5prime', '3prime' or 'none': at which ends of the gene a model goes further, in the gene's direction."""
    left, right = lend < b_lend, rend > b_rend
    five = F.when(strand == "-", right).otherwise(left)
    three = F.when(strand == "-", left).otherwise(right)
    return F.when(five & three, "both").when(five, "5prime").when(three, "3prime").otherwise("none")


def longest_untranslated_run(exons: Column) -> Column:
    """Longest run of neighbouring exons without a coding part; exons is array<struct<..., coding boolean>>."""
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(a: Column, e: Column) -> Column:
        run = F.when(e["coding"], 0).otherwise(a["run"] + 1)
        return F.struct(run.alias("run"), F.greatest(a["most"], run).alias("most"))

    return F.aggregate(exons, start, step, lambda a: a["most"])


def gene_errors(lend: Column, rend: Column, cds_lend: Column, cds_rend: Column, strand: Column, protein: Column) -> Column:
    """Messages of what is wrong with a gene, in a fixed order; empty if nothing is."""
    tests = [
        (~strand.isin("+", "-"), "unknown strand"),
        ((cds_lend < lend) | (cds_rend > rend), "coding part outside the transcript"),
        ((cds_rend - cds_lend + 1) % 3 != 0, "coding length not a multiple of three"),
        (~F.startswith(protein, F.lit("M")), "no start codon"),
        (~F.endswith(protein, F.lit("*")), "no stop codon"),
        (F.length(F.regexp_replace(protein, "[^*]", "")) > 1, "stop codons inside"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(True)), m) for t, m in tests]))


def same_protein(a: Column, b: Column, length: float = 70.0, identity: float = 70.0) -> Column:
    """Whether two proteins are like each other in length and in identical columns of their global alignment."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([0.0 if p is None else 100.0 if p == q else protein_identity(p, q) for p, q in zip(x, y)], dtype="float64")

    ratio = 100 * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))
    near = ratio >= length  # only these are aligned
    return near & (run(F.when(near, a), b) >= identity)


def status_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(before, after, n): how many models have which status in two runs; one that a run lacks has 0 there."""
    a, b = before.select("contig", "id", F.col("status").alias("before")), after.select("contig", "id", F.col("status").alias("after"))
    both = a.join(b, ["contig", "id"], "full_outer").na.fill(0, ["before", "after"])
    return both.groupBy("before", "after").agg(F.count("*").alias("n"))


def validity(score: Column, identity: Column, percent: Column, longest_intron: Column, shortest_intron: Column, sites_ok: Column,
             least_percent: float = 90, least_identity: float = 95, least_intron: int = 20, most_intron: int = 2000) -> Column:
    """All reasons why an alignment is not valid, in the order of the checks; empty if it is."""
    tests = [
        (~sites_ok, "splice sites"),
        (longest_intron > most_intron, "intron too long"),
        (shortest_intron < least_intron, "intron too short"),
        (percent < least_percent, "too little aligned"),
        (identity < least_identity, "too little identity"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), m) for t, m in tests]))


def consensus_pairs(minor: bool = True) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """The intron boundary pairs (left, right) of the forward strand, and of the reverse one; minor allows AT-AC as well."""
    # The intron boundary pairs on the forward strand.
    pairs = [("GT", "AG"), ("GC", "AG")] + [("AT", "AC")] * minor
    flip = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    return pairs, [(flip(b), flip(a)) for a, b in pairs]


def consensus_sites(left: Column, right: Column, strand: Column, minor: bool = True) -> Column:
    """Whether an intron's first and last two bases are a known pair for its strand."""
    plus, minus = ([F.struct(F.lit(a), F.lit(b)) for a, b in pairs] for pairs in consensus_pairs(minor))
    site = F.struct(F.upper(left), F.upper(right))
    return F.when(strand == "-", site.isin(*minus)).otherwise(site.isin(*plus))


def poly_a_sites(rows: DataFrame) -> DataFrame:
    """(contig, site, strand, transcripts) from (contig, lend, rend, strand, acc, trimmed_left, trimmed_right, offset, tail_percent):

    a transcript trimmed at one end only, whose alignment reaches within two bases of it and whose trimmed part is 80 percent A
    (of its own strand), gives a site at that end; transcripts of a site are gathered.
    """
    one = (F.col("trimmed_left") > 0) != (F.col("trimmed_right") > 0)
    at_right = (F.col("trimmed_right") > 0) == (F.col("strand") == "+")
    site = F.when(at_right, F.col("rend")).otherwise(F.col("lend"))
    good = rows.where(one & (F.col("offset") <= 2) & (F.col("tail_percent") >= 80))
    strand = F.when(at_right, "+").otherwise("-")
    return good.groupBy("contig", site.alias("site"), strand.alias("strand")).agg(F.array_join(F.array_sort(F.collect_set(F.col("acc").cast("string"))), ",").alias("transcripts"))


def transcriptome_classes(transcripts: DataFrame, assembled: DataFrame, aligned: DataFrame, mapped: DataFrame) -> DataFrame:
    """(acc, class): 'assembled', 'poor_alignment_mapped' or 'poor_alignment_unmapped' by whether it meets an assembly, 'no_alignment'."""
    mark = lambda df, n: df.select("acc").distinct().withColumn(n, F.lit(True))
    all_ = transcripts.select("acc").distinct().join(mark(assembled, "s"), "acc", "left").join(mark(aligned, "a"), "acc", "left").join(mark(mapped, "m"), "acc", "left")
    kind = F.when(F.col("s"), "assembled").when(F.col("a") & F.col("m"), "poor_alignment_mapped").when(F.col("a"), "poor_alignment_unmapped").otherwise("no_alignment")
    return all_.select("acc", kind.alias("class"))
