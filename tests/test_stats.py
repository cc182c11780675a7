from fractions import Fraction
from math import comb, lgamma

import pytest
from pyspark.sql import functions as F

from strandloom.functions import stats


def test_binomial_tails_against_exact_sums(spark):
    rows = [(k, n, p) for n in (1, 2, 7, 40, 300) for k in sorted({-1, 0, 1, n // 3, n // 2, n - 1, n, n + 1}) for p in (0.0, 0.01, 0.3, 0.5, 0.97, 1.0)]
    df = spark.createDataFrame(rows, "k int, n int, p double").select("*", stats.binomial_upper(F.col("k"), F.col("n"), F.col("p")).alias("u"), stats.binomial_lower(F.col("k"), F.col("n"), F.col("p")).alias("l"))
    for r in df.collect():
        p = Fraction(r.p)
        chance = lambda i: comb(r.n, i) * p**i * (1 - p) ** (r.n - i)  # noqa: B023, E731
        assert r.u == pytest.approx(float(sum(chance(i) for i in range(max(r.k, 0), r.n + 1))), rel=1e-9, abs=1e-12)
        assert r.l == pytest.approx(float(sum(chance(i) for i in range(0, min(r.k, r.n) + 1))), rel=1e-9, abs=1e-12)


def test_ln_gamma_and_nulls(spark):
    xs = [0.5, 1.0, 1.5, 2.0, 10.0, 171.5, 1e5]
    df = spark.createDataFrame([(x,) for x in xs], "x double").coalesce(1)
    assert [r.y for r in df.select(stats.ln_gamma(F.col("x")).alias("y")).collect()] == pytest.approx([lgamma(x) for x in xs], rel=1e-12, abs=1e-12)
    assert spark.range(1).select(stats.beta_share(F.lit(1), F.lit(1), F.lit(2.0)).alias("y")).first().y is None
