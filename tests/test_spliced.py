"""Spliced alignments that are made of documents."""

import duckdb

from strandloom.queries import ORACLES, QUERIES
from strandloom.sources.tables import sequences, spliced_alignments


def _documents(spark, at, rows):
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{at}/documents.parquet")
    return str(at)


def test_letters_are_taken_once_for_a_row(spark, tmp_path):
    d = _documents(spark, tmp_path, [(1, "The caté gN"), (2, None), (3, "")])
    assert {r["contig"]: r["seq"] for r in sequences(spark, d).collect()} == {1: "TCATG", 2: "", 3: ""}
    plan = spliced_alignments(spark, d)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "mapinarrow" in plan and "regexp_replace" not in plan


def test_mismatches_where_the_gap_takes_the_odd_base(spark, tmp_path):
    # on '-', with a gap and an N: the compared bases lie before the N, and are all A
    d = _documents(spark, tmp_path, [(105, "A" * 40 + "CT" + "G" * 30 + "AC" + "A" * 40), (140, "A" * 40 + "GT" + "C" * 30 + "AG" + "A" * 40)])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet/*.parquet'")
    want = sorted(con.execute(f"SELECT contig, strand, mismatches FROM ({ORACLES['perfect_boundaries']})").fetchall())
    assert sorted(tuple(r) for r in QUERIES["perfect_boundaries"](spark, d).collect()) == want == [(105, "-", 0), (140, "+", 1)]
