"""Token counts by rank-synchronous array merging (operator 7).

Texts are cut into white-space words; words a worker has not met are merged together in ragged numpy
arrays, every sequence's lowest-ranked pair at once (``merges``), and the surviving symbols are counted.
Null texts count as empty; nulls in the id column pass through; equal rows give equal rows; only the
named id column is kept, so other columns cannot clash. Pairs of one rank merge from the left. Texts are cut into words 2,000,000
characters at a time, and an unbroken word of more than 2,000 bytes is merged by itself, rank by rank (``merges.merge_long``).
An empty table gives an empty one.
Words that hold one of the vocabulary's special strings are coded by the library itself, and words beyond Latin letters pass its normaliser and pre-tokeniser before they are merged here.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.wordbpe import word_bpe


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_tokens) of every row's whole text; vocabulary is the path of a tokenizers .json file on every worker."""

    def count(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = word_bpe(vocabulary).encode(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64())],
                [id_col, "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
