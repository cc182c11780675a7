"""Cutting lineage through the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that a task sorts or groups at once, about: some hundred bytes each.
ROWS = 1_000_000


class _Made(threading.local):
    """Folders that stored() has written in this thread and that release() hasn't deleted."""

    def __init__(self) -> None:
        self.folders: list[str] = []


_MADE = _Made()


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder only in a local session that sets none (tests)."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir()
    if at is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="strandloom-"))
        at = sc.getCheckpointDir()
    return at


def stored(df: DataFrame) -> DataFrame:
    """df written as compressed Parquet in the shared folder and read again: columns prune, sizes are known to AQE,
    and a lost executor costs no more than the tasks behind it. Zstandard makes bases and texts smaller than Parquet's own choice."""
    at = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    _MADE.folders.append(at)
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def mark() -> int:
    """A point in the order of stored tables, for release()."""
    return len(_MADE.folders)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Deletes the tables stored after `since`, but for the `keep` last ones; returns how many. What they fed must not be read any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = _MADE.folders[since : len(_MADE.folders) - keep]
    for at in gone:
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(conf).delete(path, True)
        _MADE.folders.remove(at)
    return len(gone)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """make()'s rows stored, and everything that it stored on its way deleted; the driver lets go of what planning it took."""
    return settled_all(spark, lambda: (make(),))[0]


def settled_all(spark: SparkSession, make: Callable[[], tuple[DataFrame, ...]]) -> tuple[DataFrame, ...]:
    """As ``settled``, of several tables that share what is stored on the way."""
    since = mark()
    out = tuple(map(stored, make()))
    release(spark, since, keep=len(out))
    spark.sparkContext._jvm.System.gc()
    return out


def spread(df: DataFrame, *by: str | Column) -> DataFrame:
    """df dealt evenly over at least as many tasks as the session shuffles into: before a step that makes many rows of one,
    which a small table would otherwise do in a task or two."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, F.xxhash64(*by))  # of a hash: rows that an aggregation dealt by the same columns, and AQE joined into a task or two, move again


def shuffled(df: DataFrame) -> DataFrame:
    """df for a join that both sides are dealt for and neither is broadcast. Spark sizes rows behind an explode as those before it, and stored
    tables by their compressed bytes, so it may broadcast, by way of the driver, many times what its threshold allows."""
    return df.hint("merge")


def dealt(df: DataFrame, *by: str | Column) -> DataFrame:
    """df dealt by columns into tasks of about ROWS rows, however many there are: AQE, which goes by compressed bytes, makes a number that stops growing with the rows."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS))
    return df.repartition(n, *by)


@contextmanager
def tasks_for(spark: SparkSession, rows: int, size: str = "8m") -> Iterator[None]:
    """Shuffles of `rows` rows that run inside are dealt into parts of about ROWS, of which AQE joins no more than `size` compressed bytes; skewed joins are still split."""
    names = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    was = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], str(max(int(was[0]), -(-rows // ROWS))))
    spark.conf.set(names[1], size)
    try:
        yield
    finally:
        for n, value in zip(names, was):
            spark.conf.set(n, value)
