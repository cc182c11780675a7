"""Stages that a run may take up again: finished output is read, the rest is worked out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to path has ended: Spark leaves _SUCCESS behind it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def resumed(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet rows at path; make() writes them first unless an earlier run has finished doing so."""
    if not finished(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def resumed_by(spark: SparkSession, path: str, rows: DataFrame, by: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work(rows) at path, one folder for each value of `by`; values that an earlier run has written are left as they are.

    `work` must keep `by`; null is a value like any other.
    """
    if finished(spark, path):
        done = spark.read.parquet(path).select(F.col(by).alias("__done")).distinct()
        rows = rows.join(done, F.col(by).eqNullSafe(F.col("__done")), "left_anti")
    work(rows).write.mode("append").partitionBy(by).parquet(path)
    return spark.read.parquet(path)
