"""Window, ranking and interval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import intervals as iv
from strandloom.queries.registry import iv_sql, pile_sql, query, structures_sql
from strandloom.sources.tables import day, genes, intervals_from_lineitem, structures, table

BY_PART, BY_SUPPLIER = iv_sql("l_partkey"), iv_sql("l_suppkey")


@query(f"WITH {BY_SUPPLIER}, {pile_sql()} SELECT contig, pile, min(lend) AS lend, max(rend) AS rend, count(*) AS members FROM piled GROUP BY contig, pile")
def pile_spans(spark, d):
    return iv.pile_spans(intervals_from_lineitem(spark, d, "l_suppkey"))


@query(f"WITH {BY_PART}, {pile_sql()} SELECT contig, id, pile FROM piled")
def pile_members(spark, d):
    return iv.piles(intervals_from_lineitem(spark, d, "l_partkey")).select("contig", "id", "pile")


@query(f"WITH {BY_PART}, {pile_sql(by='contig, strand')} SELECT contig, strand, pile, min(lend) AS lend, max(rend) AS rend, count(*) AS members FROM piled GROUP BY contig, strand, pile")
def pile_spans_by_strand(spark, d):
    return iv.pile_spans(intervals_from_lineitem(spark, d, "l_partkey"), ("contig", "strand"))


@query(f"WITH {BY_PART}, {pile_sql()} SELECT contig, min(lend) AS lend, max(rend) AS rend FROM piled GROUP BY contig, pile")
def interval_union(spark, d):
    return iv.pile_spans(intervals_from_lineitem(spark, d, "l_partkey")).select("contig", "lend", "rend")


@query(f"WITH {BY_PART}, {pile_sql(extend=15)} SELECT contig, pile, min(lend) AS lend, max(rend) AS rend, count(*) AS members FROM piled GROUP BY contig, pile")
def pile_with_termini_extension(spark, d):
    return iv.pile_spans(intervals_from_lineitem(spark, d, "l_partkey"), extend=15)


@query(f"""WITH {BY_PART}, {pile_sql()}, s AS (SELECT contig, pile, min(lend) AS lend, max(rend) AS rend FROM piled GROUP BY contig, pile),
n AS (SELECT contig, rend + 1 + 2 AS lend, lead(lend) OVER (PARTITION BY contig ORDER BY pile) - 1 - 2 AS rend FROM s)
SELECT contig, lend, rend FROM n WHERE rend >= lend""")
def interval_complement(spark, d):
    return iv.gaps(intervals_from_lineitem(spark, d, "l_partkey"), flank=2)


@query(f"""WITH ev AS (SELECT user_id AS contig, event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS lend, CAST(floor(epoch(ts)) AS BIGINT) + 1800 AS rend FROM events), {pile_sql("ev")}
SELECT contig, pile, min(lend) AS lend, max(rend) AS rend, count(*) AS members FROM piled GROUP BY contig, pile""")
def event_session_piles(spark, d):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    ev = table(spark, d, "events").select(F.col("user_id").alias("contig"), F.col("event_id").alias("id"), seconds.alias("lend"), (seconds + 1800).alias("rend"))
    return iv.pile_spans(ev)


@query(f"""WITH {BY_SUPPLIER}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY contig, strand ORDER BY score DESC, id) AS INT) AS rank FROM iv)
SELECT contig, strand, id, score FROM r WHERE rank = 1""")
def best_per_cluster(spark, d):
    best = iv.best_by(intervals_from_lineitem(spark, d, "l_suppkey"), ("contig", "strand"), F.desc("score"), F.asc("id"))
    return best.select("contig", "strand", "id", "score")


@query(f"""WITH {BY_PART}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY contig ORDER BY score DESC, id) AS INT) AS rank FROM iv)
SELECT contig, id, score, rank FROM r WHERE rank <= 3""")
def top_n_hits(spark, d):
    best = iv.best_by(intervals_from_lineitem(spark, d, "l_partkey"), ("contig",), F.desc("score"), F.asc("id"), n=3)
    return best.select("contig", "id", "score", "rank")


@query("""WITH s AS (SELECT l_orderkey, l_partkey, l_linenumber, round(4 * l_quantity - 5 * l_discount * 100 - ln(l_tax * 100 + 1), 6) AS score FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_partkey, l_linenumber) AS rank FROM s)
SELECT l_orderkey, l_partkey, score FROM r WHERE rank = 1""")
def top_hit_blocks(spark, d):
    score = F.round(4 * F.col("l_quantity") - 5 * F.col("l_discount") * 100 - F.ln(F.col("l_tax") * 100 + 1), 6)
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", score.alias("score"))
    return iv.best_by(rows, ("l_orderkey",), F.desc("score"), F.asc("l_partkey"), F.asc("l_linenumber")).select("l_orderkey", "l_partkey", "score")


@query(f"""WITH {BY_SUPPLIER}, b AS (SELECT *, CAST((lend - min(lend) OVER (PARTITION BY contig)) // 100 AS BIGINT) AS bin FROM iv),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY contig, bin ORDER BY score DESC, id) AS INT) AS round FROM b),
t AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY round, bin, id) AS taken FROM r)
SELECT contig, id, bin, round FROM t WHERE taken <= 50""")
def stratified_sample(spark, d):
    return iv.stratified_sample(intervals_from_lineitem(spark, d, "l_suppkey"), ("contig",), 50, 100).select("contig", "id", "bin", "round")


@query(f"""WITH {structures_sql()}, n AS (SELECT contig, acc, strand, CAST(row_number() OVER w AS INT) AS number, rend + 1 AS lend, lead(lend) OVER w - 1 AS rend FROM seg
WINDOW w AS (PARTITION BY contig, acc, strand ORDER BY lend, rend)) SELECT * FROM n WHERE rend >= lend""")
def introns(spark, d):
    return iv.introns(structures(spark, d), ("contig", "acc", "strand"))


_REMAP = f"""WITH {structures_sql()}, m AS (SELECT *, CAST(sum(rend - lend + 1) OVER (PARTITION BY contig, acc, strand
ORDER BY CASE WHEN strand = '-' THEN -lend ELSE lend END ROWS UNBOUNDED PRECEDING) AS BIGINT) AS mrend FROM seg)"""


@query(_REMAP + " SELECT *, mrend - (rend - lend + 1) + 1 AS mlend FROM m")
def transcript_coords(spark, d):
    return iv.transcript_coords(structures(spark, d), ("contig", "acc", "strand"))


@query(_REMAP + " SELECT contig, acc, strand, lend, rend, CAST((mrend - (rend - lend + 1)) % 3 AS INT) AS phase FROM m")
def cds_phase(spark, d):
    return iv.phases(structures(spark, d), ("contig", "acc", "strand"))


@query(f"""WITH h AS (SELECT l_suppkey AS contig, l_orderkey * 10 + l_linenumber AS id, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) AS lend,
  CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) + 2 AS INT) AS rend, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
  CAST(l_partkey AS INT) AS qlend, CAST(l_partkey + floor(l_quantity) AS INT) AS qrend FROM lineitem),
m AS (SELECT *, CASE WHEN strand = lag(strand) OVER w AND CASE WHEN strand = '-' THEN qrend < lag(qrend) OVER w ELSE qrend > lag(qrend) OVER w END
  AND greatest(0, least(qrend, lag(qrend) OVER w) - greatest(qlend, lag(qlend) OVER w) + 1) <= 10 AND lend - lag(rend) OVER w - 1 <= 40 THEN 0 ELSE 1 END AS fresh
  FROM h WINDOW w AS (PARTITION BY contig ORDER BY lend, rend, id))
SELECT contig, id, CAST(sum(fresh) OVER (PARTITION BY contig ORDER BY lend, rend, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS chain FROM m""")
def greedy_chain(spark, d):
    part = F.col("l_partkey")
    h = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("contig"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        day("l_shipdate").alias("lend"),
        (day("l_shipdate") + 2).alias("rend"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        part.cast("int").alias("qlend"),
        (part + F.floor("l_quantity")).cast("int").alias("qrend"),
    )
    return iv.chain_hits(h, ("contig",), 10, 40).select("contig", "id", "chain")


@query(f"""WITH {BY_SUPPLIER}, e AS (SELECT contig, lend AS p, 1 AS d FROM iv UNION ALL SELECT contig, rend + 1, -1 FROM iv),
s AS (SELECT contig, p AS lend, sum(d) AS d FROM e GROUP BY contig, p HAVING sum(d) <> 0),
r AS (SELECT contig, lend, lead(lend) OVER w - 1 AS rend, CAST(sum(d) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM s WINDOW w AS (PARTITION BY contig ORDER BY lend))
SELECT * FROM r WHERE depth > 0""")
def depth_profile(spark, d):
    return iv.depth(intervals_from_lineitem(spark, d, "l_suppkey"))


@query(f"""WITH {BY_PART}, p AS (SELECT * FROM iv WHERE strand = '+'), q AS (SELECT * FROM iv WHERE strand = '-'), {pile_sql("p", to="pp")}, {pile_sql("q", to="qq")},
a AS (SELECT contig, min(lend) AS lend, max(rend) AS rend FROM pp GROUP BY contig, pile), b AS (SELECT contig, min(lend) AS lend, max(rend) AS rend FROM qq GROUP BY contig, pile),
s AS (SELECT a.contig, sum(least(a.rend, b.rend) - greatest(a.lend, b.lend) + 1) AS shared FROM a JOIN b ON a.contig = b.contig AND a.lend <= b.rend AND a.rend >= b.lend GROUP BY a.contig),
t AS (SELECT contig, sum(rend - lend + 1) AS size FROM a GROUP BY contig)
SELECT t.contig, CAST(size AS BIGINT) AS size, CAST(coalesce(shared, 0) AS BIGINT) AS shared FROM t LEFT JOIN s ON t.contig = s.contig""")
def merged_coverage(spark, d):
    rows = intervals_from_lineitem(spark, d, "l_partkey")
    return iv.covered(rows.where("strand = '+'"), rows.where("strand = '-'"))


@query(f"""WITH {structures_sql()}, t AS (SELECT contig, acc, strand, CAST(sum(rend - lend + 1) AS BIGINT) AS size FROM seg GROUP BY contig, acc, strand),
r AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY size DESC, acc) AS rank FROM t) SELECT contig, acc, size FROM r WHERE rank = 1""")
def longest_isoform(spark, d):
    sizes = structures(spark, d).groupBy("contig", "acc", "strand").agg(F.sum(F.col("rend") - F.col("lend") + 1).alias("size"))
    return iv.best_by(sizes, ("contig",), F.desc("size"), F.asc("acc")).select("contig", "acc", "size")


@query("SELECT o_custkey, arg_max(o_orderkey, o_totalprice * 1000000 - o_orderkey / 1000000.0) AS template, max(o_totalprice) AS best FROM orders GROUP BY o_custkey")
def longest_template(spark, d):
    o = table(spark, d, "orders")
    order = F.col("o_totalprice") * 1000000 - F.col("o_orderkey") / 1000000.0
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", order).alias("template"), F.max("o_totalprice").alias("best"))


@query(f"WITH {BY_PART}, {pile_sql()}, k AS (SELECT DISTINCT contig, pile FROM piled) SELECT contig, pile, CAST(1000 + row_number() OVER (PARTITION BY contig % 16 ORDER BY contig, pile) AS BIGINT) * 16 + contig % 16 AS number FROM k")
def surrogate_ids(spark, d):
    """Numbers that are dense within each of 16 residues of the contig: unique, repeatable, and no single task orders all rows."""
    from strandloom.operators.report import numbered

    return numbered(iv.piles(intervals_from_lineitem(spark, d, "l_partkey")).select("contig", "pile").distinct(), ("contig", "pile"), F.col("contig") % 16, 16, 1000)


def _greedy(by: str, step: str) -> str:
    """g(by, pile, row): each pile's rows by score, folded by `step` from the list `a` of what is placed and the next row `x`."""
    return f"""WITH {BY_PART}, {pile_sql(by=by)}, l AS (SELECT {by}, pile, list([{{'id': id, 'a': lend, 'b': rend, 's': CAST(score AS DOUBLE), 't': 1}}] ORDER BY score DESC, lend, rend, id) AS xs FROM piled GROUP BY {by}, pile),
g AS (SELECT {by}, unnest(list_reduce(xs, lambda a, x: {step})) AS row FROM l)"""


# the first tier in which nothing placed overlaps
_TIER = """list_append(a, {'id': x[1].id, 'a': x[1].a, 'b': x[1].b, 's': x[1].s, 't': CAST(list_min(list_filter(range(1, len(a) + 2),
  lambda t: len(list_filter(a, lambda p: p.t = t AND p.a <= x[1].b AND p.b >= x[1].a)) = 0)) AS INT)})"""


@query(_greedy("contig", _TIER) + " SELECT contig, row.id AS id, row.t AS tier FROM g")
def tiers(spark, d):
    return iv.tiers(intervals_from_lineitem(spark, d, "l_partkey")).select("contig", "id", "tier")


@query(_greedy("contig, strand", _TIER) + " SELECT contig, strand, row.id AS id, row.t AS tier FROM g WHERE row.t <= 2")
def tiered_hits(spark, d):
    return iv.tiers(intervals_from_lineitem(spark, d, "l_partkey"), ("contig", "strand"), most=2).select("contig", "strand", "id", "tier")


@query(_greedy("contig, strand", """CASE WHEN len(list_filter(a, lambda p: p.a <= x[1].b AND p.b >= x[1].a AND 100 * x[1].s < 10.0 * p.s
  AND 100 * (least(p.b, x[1].b) - greatest(p.a, x[1].a) + 1) >= 10.0 * (least(p.b - p.a, x[1].b - x[1].a) + 1))) > 0 THEN a ELSE list_concat(a, x) END""") + " SELECT contig, strand, row.id AS id, row.s AS score FROM g")
def artifact_filter(spark, d):
    return iv.drop_artifacts(intervals_from_lineitem(spark, d, "l_partkey")).select("contig", "strand", "id", "score")


@query("""WITH g AS (SELECT o_custkey AS contig, o_orderkey AS id, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS INT) AS lend,
  CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) + 10 + o_orderkey % 50 AS INT) AS rend FROM orders)
SELECT contig, id FROM g a WHERE NOT EXISTS (SELECT 1 FROM g b WHERE a.contig = b.contig AND b.lend <= a.lend AND b.rend >= a.rend AND b.rend - b.lend > a.rend - a.lend)""")
def eclipsed_filter(spark, d):
    from strandloom.operators.select import not_eclipsed

    return not_eclipsed(genes(spark, d)).select("contig", "id")
