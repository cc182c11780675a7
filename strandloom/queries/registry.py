"""Where queries register: name -> callable(spark, sf_dir), and name -> DuckDB SQL."""

from __future__ import annotations

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its own name, with its SQL if SQL can express it."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


def iv_sql(contig: str) -> str:
    """The common table expression iv(contig, id, lend, rend, strand, score) over lineitem."""
    return f"""
iv AS (SELECT {contig} AS contig, l_orderkey * 10 + l_linenumber AS id,
  CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) AS lend,
  CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) + floor(l_quantity) AS INT) AS rend,
  CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_extendedprice AS score FROM lineitem)"""


def pile_sql(of: str = "iv", by: str = "contig", extend: int = 0, to: str = "piled", frame: str = "ROWS") -> str:
    """Common table expressions that end in `to`: the rows of `of` with their pile. By `frame` RANGE rows that are alike in (lend, rend, id) are of one pile in whichever order they come."""
    w = f"PARTITION BY {by} ORDER BY lend, rend, id"
    return f"""
{to}_m AS (SELECT *, CASE WHEN lend - {extend} <= max(rend) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {extend} THEN 0 ELSE 1 END AS fresh FROM {of}),
{to} AS (SELECT * EXCLUDE (fresh), CAST(sum(fresh) OVER ({w} {frame} UNBOUNDED PRECEDING) AS BIGINT) AS pile FROM {to}_m)"""


def structures_sql() -> str:
    """seg(contig, acc, strand, lend, rend): an order's lines on its customer, merged to disjoint segments."""
    return """
raw AS (SELECT o_custkey AS contig, l_orderkey AS acc, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  l_orderkey * 10 + l_linenumber AS id, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) AS lend,
  CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) + floor(l_quantity / 5) AS INT) AS rend
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),""" + pile_sql("raw", "contig, acc, strand", 0, "segp", "RANGE") + """,
seg AS (SELECT contig, acc, strand, min(lend) AS lend, max(rend) AS rend FROM segp GROUP BY contig, acc, strand, pile)"""
