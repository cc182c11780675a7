"""Rows that are alike in every column that orders them."""

import duckdb

from strandloom.operators.intervals import piles
from strandloom.queries.registry import structures_sql


def test_segments_do_not_depend_on_the_order_of_equal_lines():
    con = duckdb.connect()
    # a line, and 300 days later two that are alike
    con.execute("CREATE TABLE orders AS SELECT CAST(i AS BIGINT) AS o_orderkey, CAST(i // 10 AS BIGINT) AS o_custkey FROM range(100000) t(i)")
    con.execute("""CREATE TABLE lineitem AS SELECT CAST(i AS BIGINT) AS l_orderkey, least(k, 1) AS l_linenumber, CAST(10 AS DOUBLE) AS l_quantity,
      TIMESTAMP '1992-03-01' + least(k, 1) * INTERVAL 300 DAY AS l_shipdate FROM range(100000) t(i), range(3) u(k)""")
    assert con.execute(f"WITH {structures_sql()} SELECT count(*), max(rend - lend) FROM seg").fetchone() == (200000, 2)


def test_equal_rows_are_of_one_pile(spark):
    rows = [("c", 1, 1, 3)] + [("c", 2, 300, 302)] * 5
    got = piles(spark.createDataFrame(rows, "contig string, id long, lend int, rend int"))
    assert sorted((r["lend"], r["pile"]) for r in got.collect()) == [(1, 1)] + [(300, 2)] * 5
