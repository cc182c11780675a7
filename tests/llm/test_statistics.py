"""Statistics of texts, batch by batch."""

from strandloom.llm import quality


def test_kept_texts_go_through_once_and_in_parts(spark):
    n = 2 * quality.STEP + 7
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"word {i} A|") for i in range(n)], "doc_id long, text string").coalesce(1)
    got = quality.statistics(df, keep=("text",))
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "coalesce(text" not in plan
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == n
    for i in (0, 1, quality.STEP, n - 2):
        assert rows[i]["text"] == (None if i % 5 == 0 else f"word {i} A|")
        assert [rows[i][s] for s in quality.STATS] == quality.text_statistics("" if i % 5 == 0 else f"word {i} A|")
    assert quality.statistics(df.limit(0)).count() == 0
