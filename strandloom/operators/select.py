"""Filters and joins between interval tables, and token, key and both-way membership joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators.intervals import overlap_length
from strandloom.plans.ranges import overlap_join


def not_eclipsed(iv: DataFrame, on: tuple[str, ...] = ("contig",), width: int = 64) -> DataFrame:
    """Intervals that lie in no longer one; containment is transitive, so the order of dropping doesn't matter."""
    slim = iv.select(*on, "id", "lend", "rend")
    inside = overlap_join(slim, slim, on, width).where("b_lend <= lend AND b_rend >= rend AND b_rend - b_lend > rend - lend")
    return iv.join(inside.select(*on, "id").distinct(), [*on, "id"], "left_anti")


def best_overlap(iv: DataFrame, ref: DataFrame, least_percent: float, on: tuple[str, ...] = ("contig",), width: int = 64) -> DataFrame:
    """(on, id, ref_id, shared) of every interval's reference interval with most shared bases, ties to the smaller id."""
    met = overlap_join(iv.select(*on, "id", "lend", "rend"), ref.select(*on, "id", "lend", "rend"), on, width)
    shared = overlap_length(F.col("lend"), F.col("rend"), F.col("b_lend"), F.col("b_rend"))
    met = met.withColumn("shared", shared).where(F.col("shared") * 100 >= least_percent * (F.col("rend") - F.col("lend") + 1))
    best = F.max_by(F.struct("b_id", "shared"), F.struct(F.col("shared"), -F.col("b_id"))).alias("best")
    return met.groupBy(*on, "id").agg(best).select(*on, "id", F.col("best.b_id").alias("ref_id"), F.col("best.shared").alias("shared"))


def tokens(text: str) -> Column:
    return F.filter(F.split(text, r"[ \t\n]+"), lambda t: t != "")


def with_any_token(rows: DataFrame, keys: DataFrame, text: str, key: str, id_col: str, invert: bool = False) -> DataFrame:
    """Rows with (invert: without) a white-space token that is a key."""
    hits = rows.select(id_col, F.explode(F.array_distinct(tokens(text))).alias("__t")).join(keys.select(F.col(key).alias("__t")), "__t", "left_semi")
    return rows.join(hits.select(id_col).distinct(), id_col, "left_anti" if invert else "left_semi")


def membership(a: DataFrame, b: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """(on, side): 'a', 'b' or 'both' for every key of either table."""
    mark = lambda t, n: t.select(*on).distinct().withColumn(n, F.lit(1))
    both = mark(a, "__a").join(mark(b, "__b"), list(on), "full_outer")
    return both.select(*on, F.when(F.col("__b").isNull(), "a").when(F.col("__a").isNull(), "b").otherwise("both").alias("side"))


def reciprocal_best(hits: DataFrame, query: str, subject: str, score: str) -> DataFrame:
    """Pairs (a, b) where b is a's best subject and a is b's best; ties go to the smaller partner."""
    best = lambda of, other: hits.groupBy(F.col(of).alias("k")).agg(F.max_by(other, F.struct(F.col(score), -F.col(other))).alias("p"))
    a, b = best(query, subject), best(subject, query)
    return a.join(b.select(F.col("k").alias("p"), F.col("p").alias("back")), "p").where("back = k").select(F.col("k").alias("a"), F.col("p").alias("b"))
