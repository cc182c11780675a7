"""Binned range joins: exact overlap joins as equi-joins on (key, bin)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlap_join(a: DataFrame, b: DataFrame, on: tuple[str, ...] = ("contig",), width: int = 64, strict: bool = False) -> DataFrame:
    """Pairs of a row and an overlapping row of b with equal `on` columns; b's other columns get the prefix b_.

    Each interval stands in every bin it touches; a pair is given out only by the bin of the later of the two left
    ends, so no distinct is needed. width should be near the usual interval length: bins bound how much of a
    crowded key meets in one place, and AQE splits bins that stay large. Null ends and keys never match.
    """
    bins = lambda d: d.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("lend") / width), F.floor(F.col("rend") / width))))
    right = b.select(*on, *[F.col(c).alias(f"b_{c}") for c in b.columns if c not in on])
    right = right.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("b_lend") / width), F.floor(F.col("b_rend") / width))))
    meets = (F.col("lend") < F.col("b_rend")) & (F.col("rend") > F.col("b_lend")) if strict else (F.col("lend") <= F.col("b_rend")) & (F.col("rend") >= F.col("b_lend"))
    left = bins(a)
    same = left["__bin"] == right["__bin"]
    for c in on:
        same = same & (left[c] == right[c])
    joined = left.join(right, same & meets & (left["__bin"] == F.floor(F.greatest("lend", "b_lend") / width)))
    return joined.select(*[left[c] for c in a.columns], *[right[f"b_{c}"] for c in b.columns if c not in on])
