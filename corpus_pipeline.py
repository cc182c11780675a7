"""The corpus pipeline: quality, near-equal lines, near-duplicate documents, repeated passages, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all rows its predecessor kept. All but the last return
the columns of docs; a stage that changes a text sets n_chars, where there is one, to the new length. run() writes
each stage's rows as Parquet in the session's shared folder, reads them again for the next and deletes what the stage stored on its way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.chunks import substring_dedup
from strandloom.llm.lines import line_dedup
from strandloom.llm.packing import pack, token_pieces
from strandloom.llm.quality import fit, is_held_out, predict
from strandloom.llm.registry import vocabulary
from strandloom.llm.rows import Rows
from strandloom.llm.simhash import similar_groups
from strandloom.plans.lineage import settled

#: SQL has no counterpart of the classifier and of the tokenizer; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def _as_documents(changed: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(changed.schema["n_chars"].dataType))
    return changed.select(*[F.col(f"`{c}`") for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the rule ensemble, fitted to labels of sf_dir outside the held-out third, predicts as good.

    Null and long texts are judged whole, null as empty; a score of exactly 0.5 keeps; equal rows are judged alike; an empty table stays empty. Columns of any name stay.
    """
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality", learn=~is_held_out())
    names = {c: f"__kept_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    own = (names["doc_id"], names["text"])
    judged = predict(renamed, model, *own, keep=tuple(n for n in names.values() if n != own[0]))
    return judged.where("predicted = 1").select(*[F.col(n).alias(c) for c, n in names.items()])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines with an equal or near-equal earlier one; a null text stays null, equal rows lose the same lines, lines of any length are compared whole, an empty table stays empty."""
    return _as_documents(line_dedup(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least doc_id of each component of five-word similarity 0.8 or more; without an id there is nothing to keep it by, so it stays.

    Of several rows of that id, all different ones stay and equal ones become one. Texts of fewer than five words, null ones included, are told apart by their whole
    sequence of words; long texts count with all their shingles; an empty table stays empty.
    """
    kept = similar_groups(docs).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    rows = Rows(named, "doc_id", "text")
    return rows.back(rows.df.dropDuplicates(["k", "th"])).unionByName(docs.where(F.col("doc_id").isNull()))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out repeated passages; a document that is all repeats stays with an empty text, a null one stays null, equal rows lose the same, texts of any length are cut whole, an empty table stays empty."""
    return _as_documents(substring_dedup(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset, in windows of 4096.

    A null text is packed as an empty one, which is its end id alone; texts of more than a window are cut into full ones first; equal rows have pieces each, equal lengths are
    packed in any order; an empty table gives no pieces. Columns of docs but the id don't appear.
    """
    pieces = token_pieces(docs, vocabulary("word_bpe_49k.json"), end_id=2, capacity=4096)
    pieces = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(pieces, 4096)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
