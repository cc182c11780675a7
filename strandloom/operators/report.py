"""Reporting operators: numbering, histograms, running totals, label sets and both-sided support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, order: tuple[str, ...], residue: Column, residues: int, start: int = 0, name: str = "number") -> DataFrame:
    """Adds unique, repeatable numbers: the rank within a residue class, times the classes, plus the class."""
    rank = F.row_number().over(Window.partitionBy(residue).orderBy(*order)).cast("long")
    return rows.withColumn(name, (rank + start) * residues + residue)


def bin_of(x: Column, width: int) -> Column:
    """The bin of an integer: 1 for 1..width, -1 for -width..-1, 0 for 0."""
    up = F.floor((x - 1) / width) + 1
    down = -(F.floor((-x - 1) / width) + 1)
    return F.when(x > 0, up).when(x < 0, down).otherwise(F.lit(0)).cast("long")


def histogram(rows: DataFrame, value: str, width: int) -> DataFrame:
    """(bin, n, share, total, total_share): how many values, and what sum of values, fall in each bin."""
    got = rows.groupBy(bin_of(F.col(value), width).alias("bin")).agg(F.count("*").alias("n"), F.sum(value).cast("long").alias("total"))
    whole = got.agg(F.sum("n").alias("__n"), F.sum("total").alias("__total"))
    got = got.crossJoin(F.broadcast(whole))  # one row
    return got.select("bin", "n", F.round(100 * F.col("n") / F.col("__n"), 6).alias("share"), "total", F.round(100 * F.col("total") / F.col("__total"), 6).alias("total_share"))


def n50(rows: DataFrame, size: str) -> DataFrame:
    """(n50, total): the size at which the running sum, largest first, reaches half of the total.

    Sizes are counted first, so the ordered sum runs over distinct sizes only.
    """
    sizes = rows.where(F.col(size) > 0).groupBy(F.col(size).cast("long").alias("size")).count()
    run = sizes.withColumn("run", F.sum(F.col("size") * F.col("count")).over(Window.orderBy(F.desc("size"))))
    total = sizes.agg(F.sum(F.col("size") * F.col("count")).alias("total"))
    return run.crossJoin(F.broadcast(total)).where("run * 2 >= total").groupBy("total").agg(F.max("size").alias("n50")).select("n50", "total")


def labels(rows: DataFrame, by: tuple[str, ...], label: str, name: str = "labels") -> DataFrame:
    """The sorted distinct labels of each group, joined by ', '."""
    return rows.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(label)), ", ").alias(name))


def dictionary(rows: DataFrame, value: str, name: str = "token_id") -> DataFrame:
    """(name, value): distinct values numbered from 1 in their order; the dictionary is as small as the set of values."""
    return rows.select(value).distinct().withColumn(name, F.row_number().over(Window.orderBy(value)).cast("long"))
