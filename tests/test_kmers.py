"""k-mers of long texts."""

import time

from pyspark.sql import functions as F

from strandloom.functions.seq import kmers


def test_kmers_take_time_by_length(spark):
    df = spark.createDataFrame([("abcde",), ("ab",), ("",), (None,), ("a\U0001f600bc",)], "s string")
    assert [r[0] for r in df.select(kmers(F.col("s"), 3)).collect()] == [["abc", "bcd", "cde"], [], [], [], ["a\U0001f600b", "\U0001f600bc"]]
    assert df.limit(1).select(kmers(F.col("s"), 2, 2)).first()[0] == ["ab", "cd"]
    long = spark.range(1).select(F.repeat(F.lit("acgt"), 100_000).alias("s"))
    begin = time.time()
    assert long.select(F.size(kmers(F.col("s"), 3))).first()[0] == 399_998
    assert time.time() - begin < 20
