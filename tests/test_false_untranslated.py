"""Pairs that false_untranslated_parts judges."""

import datetime

from strandloom.queries import QUERIES


def test_models_apart_from_each_other_are_a_pair_too(spark, tmp_path):
    day = lambda n: datetime.datetime(1992, 1, 1) + datetime.timedelta(days=n)
    spark.createDataFrame([(k, 7, day(0)) for k in (2, 4, 6)], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(2, 1, 50.0, day(100)), (4, 1, 50.0, day(105)), (6, 1, 50.0, day(900))]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES["false_untranslated_parts"](spark, str(tmp_path))
    assert sorted((r["acc"], r["other"], r["wrong"]) for r in got.collect()) == [(2, 4, False), (2, 6, False), (4, 6, False)]
