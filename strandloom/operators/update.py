"""Updates of an annotation: what a comparison says is kept as rows, and applied by joins.

A comparison's outcome is (compare_id, contig, acc, status, gene_id, model_id, valid, alt, novel, exons, cds): the structure of acc is to replace the
model, to become another one of its gene (alt), or to make a gene of its own (novel); valid says whether it may.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.plans.lineage import stored

LINK = ["compare_id", "contig", "acc", "status", "valid", "alt", "novel"]


def status_rows(outcome: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(status, links, updates): a status per acc, its gene and model where it has them, and the structures of valid ones."""
    status = outcome.select(*LINK).distinct()
    links = outcome.where("gene_id IS NOT NULL").select("compare_id", "acc", "gene_id", "model_id").distinct()
    updates = outcome.where(F.col("valid") & (F.size("exons") > 0)).select("compare_id", "contig", "acc", "gene_id", "model_id", "alt", "novel", "exons", "cds")
    return status, links, updates


def retrieved(status: DataFrame, updates: DataFrame, compare_id: int, where: Column | None = None) -> DataFrame:
    """The updates of one comparison whose status rows pass `where`, once for each (gene_id, model_id, structure)."""
    wanted = status.where((F.col("compare_id") == compare_id) & F.col("valid"))
    wanted = wanted if where is None else wanted.where(where)
    got = updates.where(F.col("compare_id") == compare_id).join(wanted.select("acc", "status").distinct(), "acc")
    return got.groupBy("contig", "gene_id", "model_id", "alt", "novel", "exons", "cds").agg(F.min("acc").alias("acc"), F.min("status").alias("status"))


def applied(models: DataFrame, updates: DataFrame) -> DataFrame:
    """(contig, gene_id, model_id, strand, exons, cds, origin): models after the updates (strand, acc, ...).

    A replaced model keeps its names ('updated'; of several updates of one model that of the least acc counts), an isoform is named
    after its acc within its gene ('isoform'), a novel gene after its acc ('novel'); the rest is 'kept'.
    """
    columns = ["contig", "gene_id", "model_id", "strand", "exons", "cds"]
    one = updates.where("NOT alt AND NOT novel").groupBy("gene_id", "model_id").agg(F.min_by(F.struct("exons", "cds"), "acc").alias("new"))
    both = models.select(*columns).join(one, ["gene_id", "model_id"], "left")
    new = F.col("new").isNotNull()
    pick = lambda c: F.when(new, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c)
    kept = both.select("contig", "gene_id", "model_id", "strand", pick("exons"), pick("cds"), F.when(new, "updated").otherwise("kept").alias("origin"))
    name = F.concat_ws(".", "gene_id", F.col("acc").cast("string"))
    more = updates.where("alt AND NOT novel").select("contig", "gene_id", name.alias("model_id"), "strand", "exons", "cds", F.lit("isoform").alias("origin"))
    novel = F.concat(F.lit("novel."), F.col("acc").cast("string"))
    fresh = updates.where("novel").select("contig", novel.alias("gene_id"), F.concat(novel, F.lit(".1")).alias("model_id"), "strand", "exons", "cds", F.lit("novel").alias("origin"))
    return kept.unionByName(more).unionByName(fresh)


def dumped(models: DataFrame, updates: DataFrame, unchanged: bool = True, prefix: str | None = None) -> DataFrame:
    """GFF3 lines of the annotation after the updates, with or without the genes that none of them touches; prefix renames what is new."""
    from strandloom.operators.gene import gff3_lines

    out = stored(applied(models, updates))  # the lines go over the models several times
    if not unchanged:
        touched = out.where("origin <> 'kept'").select("gene_id").distinct()
        out = out.join(touched, "gene_id", "left_semi")
    if prefix is not None:
        fresh = F.col("origin").isin("isoform", "novel")
        out = out.withColumn("model_id", F.when(fresh, F.concat(F.lit(prefix), F.col("model_id"))).otherwise(F.col("model_id")))
    return gff3_lines(out)


def purged(rows: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """rows without those whose key is in values (key): what is left of a table when a comparison, a contig or an assembly build goes."""
    return rows.join(values.select(key).distinct(), key, "left_anti")


def failure_reason(acc: DataFrame, aligned: DataFrame, valid: DataFrame, clustered: DataFrame, assembled: DataFrame) -> DataFrame:
    """(acc, reason): why a transcript is in no assembly, the first that holds: never aligned, no valid alignment (with the commonest error of
    its alignments, ties by name), in no cluster, in a cluster but not assembled; null for those that are assembled. aligned is (acc, error)."""
    mark = lambda df, n: df.select("acc").distinct().withColumn(n, F.lit(True))
    errors = aligned.groupBy("acc", "error").agg(F.count("*").alias("n")).groupBy("acc").agg(F.min_by("error", F.struct((-F.col("n")).alias("n"), "error")).alias("error"), F.lit(True).alias("a"))
    all_ = acc.select("acc").distinct().join(errors, "acc", "left").join(mark(valid, "v"), "acc", "left").join(mark(clustered, "c"), "acc", "left").join(mark(assembled, "s"), "acc", "left")
    c = F.col
    reason = F.when(c("s"), None).when(c("a").isNull(), "not aligned").when(c("v").isNull(), F.concat(F.lit("invalid: "), F.coalesce("error", F.lit("unknown")))).when(c("c").isNull(), "in no cluster").otherwise("not assembled")
    return all_.select("acc", reason.alias("reason"))
