"""Join and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import intervals as iv
from strandloom.operators import select as sel
from strandloom.plans.ranges import overlap_join
from strandloom.queries.registry import iv_sql, query
from strandloom.sources.tables import genes, intervals_from_lineitem, table, transcripts

BY_PART = iv_sql("l_partkey")
GENES = """g AS (SELECT o_custkey AS contig, o_orderkey AS id, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS INT) AS lend,
  CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) + 10 + o_orderkey % 50 AS INT) AS rend, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM orders)"""
TRANSCRIPTS = iv_sql("l_orderkey") + ", t AS (SELECT o_custkey AS contig, id, lend, rend, strand, score FROM iv JOIN orders ON iv.contig = o_orderkey)"
SHARED = "least(a.rend, b.rend) - greatest(a.lend, b.lend) + 1"


@query("""SELECT n_name, o_orderpriority, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' GROUP BY n_name, o_orderpriority""")
def equi_join_five(spark, d):
    t = lambda n: table(spark, d, n)
    joined = (
        t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.groupBy("n_name", "o_orderpriority").agg(F.count("*").alias("lines"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("""WITH v AS (SELECT DISTINCT l_orderkey AS link, l_partkey AS id, l_returnflag AS type FROM lineitem)
SELECT a.link, a.id AS a, b.id AS b, a.type AS type_a, b.type AS type_b FROM v a JOIN v b ON a.link = b.link AND a.id < b.id AND a.type <> b.type""")
def linked_pairs(spark, d):
    v = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("link"), F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("type")).distinct()
    a, b = v.alias("a"), v.alias("b")
    pairs = a.join(b, F.expr("a.link = b.link AND a.id < b.id AND a.type <> b.type"))
    return pairs.select("a.link", F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.type").alias("type_a"), F.col("b.type").alias("type_b"))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def anti_join_unaligned(spark, d):
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(urgent, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("""SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
AND NOT EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey AND l_returnflag = 'R')""")
def anti_two_hops(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem").where("l_returnflag = 'R'")
    returned = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select(F.col("o_custkey").alias("c_custkey"))
    c = table(spark, d, "customer").select("c_custkey")
    return c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").join(returned, "c_custkey", "left_anti")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 5)")
def semi_join_keys(spark, d):
    keys = table(spark, d, "part").where("p_size <= 5").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, d, "lineitem").join(keys, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


_TOKENS = """WITH k AS (SELECT DISTINCT unnest(list_filter(string_split_regex(text, '[ \\t\\n]+'), lambda t: t <> '')) AS w FROM benchmark),
t AS (SELECT DISTINCT doc_id, unnest(list_filter(string_split_regex(text, '[ \\t\\n]+'), lambda t: t <> '')) AS w FROM documents),
h AS (SELECT DISTINCT doc_id FROM t JOIN k USING (w)) """


def _any_token(spark, d, invert):
    keys = table(spark, d, "benchmark").select(F.explode(sel.tokens("text")).alias("w")).distinct()
    return sel.with_any_token(table(spark, d, "documents"), keys, "text", "w", "doc_id", invert).select("doc_id")


@query(_TOKENS + "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM h)")
def any_token_semi(spark, d):
    return _any_token(spark, d, False)


@query(_TOKENS + "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM h)")
def any_token_anti(spark, d):
    return _any_token(spark, d, True)


@query(f"WITH {TRANSCRIPTS}, {GENES} SELECT a.contig, a.id, b.id AS gene, CAST({SHARED} AS INT) AS shared FROM t a JOIN g b ON a.contig = b.contig AND a.lend <= b.rend AND a.rend >= b.lend")
def range_join_genes(spark, d):
    met = overlap_join(transcripts(spark, d), genes(spark, d))
    return met.select("contig", "id", F.col("b_id").alias("gene"), iv.overlap_length(F.col("lend"), F.col("rend"), F.col("b_lend"), F.col("b_rend")).alias("shared"))


@query(f"""WITH {BY_PART} SELECT a.contig, a.id AS a, b.id AS b, CAST({SHARED} AS INT) AS shared, ({SHARED}) * 100.0 / (least(a.rend - a.lend, b.rend - b.lend) + 1) AS percent
FROM iv a JOIN iv b ON a.contig = b.contig AND a.id < b.id AND a.lend < b.rend AND a.rend > b.lend""".replace("* 100.0 /", "* CAST(100 AS DOUBLE) /"))
def overlap_pairs(spark, d):
    return iv.overlap_pairs(intervals_from_lineitem(spark, d, "l_partkey"))


@query(f"""WITH {BY_PART}, p AS (SELECT a.contig, a.strand, a.id AS a, b.id AS b, CAST({SHARED} AS INT) AS shared, ({SHARED}) * CAST(100 AS DOUBLE) / (least(a.rend - a.lend, b.rend - b.lend) + 1) AS percent
FROM iv a JOIN iv b ON a.contig = b.contig AND a.strand = b.strand AND a.id < b.id AND a.lend < b.rend AND a.rend > b.lend) SELECT * FROM p WHERE percent >= 50""")
def overlap_pairs_pct(spark, d):
    return iv.overlap_pairs(intervals_from_lineitem(spark, d, "l_partkey"), ("contig", "strand"), least_percent=50)


@query(f"""WITH {TRANSCRIPTS}, {GENES}, m AS (SELECT a.contig, a.id, b.id AS ref_id, CAST({SHARED} AS INT) AS shared FROM t a JOIN g b ON a.contig = b.contig AND a.lend <= b.rend AND a.rend >= b.lend
  WHERE ({SHARED}) * 100 >= 50 * (a.rend - a.lend + 1)), r AS (SELECT *, row_number() OVER (PARTITION BY contig, id ORDER BY shared DESC, ref_id) AS k FROM m)
SELECT contig, id, ref_id, shared FROM r WHERE k = 1""")
def gene_best_overlap(spark, d):
    return sel.best_overlap(transcripts(spark, d), genes(spark, d), 50)


@query("""WITH h AS (SELECT l_partkey AS q, l_suppkey AS s, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS score FROM lineitem GROUP BY q, s),
a AS (SELECT q, s FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, s) AS k FROM h) WHERE k = 1),
b AS (SELECT q, s FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY score DESC, q) AS k FROM h) WHERE k = 1)
SELECT a.q AS a, a.s AS b FROM a JOIN b ON a.q = b.q AND a.s = b.s""")
def reciprocal_best(spark, d):
    h = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("q"), F.col("l_suppkey").alias("s")).agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("score"))
    return sel.reciprocal_best(h, "q", "s", "score")


@query("""WITH a AS (SELECT DISTINCT l_partkey AS part FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'), b AS (SELECT DISTINCT l_partkey AS part FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 40)
SELECT coalesce(a.part, b.part) AS part, CASE WHEN b.part IS NULL THEN 'a' WHEN a.part IS NULL THEN 'b' ELSE 'both' END AS side FROM a FULL OUTER JOIN b ON a.part = b.part""")
def full_outer_membership(spark, d):
    part = table(spark, d, "lineitem").withColumn("part", F.col("l_partkey"))
    return sel.membership(part.where("l_returnflag = 'R' AND l_linestatus = 'F'"), part.where("l_returnflag = 'N' AND l_quantity > 40"), ("part",))


@query("""WITH s AS (SELECT l_orderkey AS id, CAST(date_diff('day', DATE '1992-01-01', CAST(min(l_shipdate) AS DATE)) AS INT) AS lend, CAST(date_diff('day', DATE '1992-01-01', CAST(max(l_shipdate) AS DATE)) AS INT) AS rend FROM lineitem GROUP BY l_orderkey),
g AS (SELECT o_orderkey AS id, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS INT) AS lend, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) + 60 AS INT) AS rend FROM orders)
SELECT g.id, greatest(0, g.lend - s.lend) AS left_extension, greatest(0, s.rend - g.rend) AS right_extension FROM g JOIN s ON g.id = s.id""")
def before_after(spark, d):
    from strandloom.sources.tables import day

    s = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.min(day("l_shipdate")).alias("l2"), F.max(day("l_shipdate")).alias("r2"))
    g = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), day("o_orderdate").alias("l1"), (day("o_orderdate") + 60).alias("r1"))
    return g.join(s, "id").select("id", F.greatest(F.lit(0), F.expr("l1 - l2")).alias("left_extension"), F.greatest(F.lit(0), F.expr("r2 - r1")).alias("right_extension"))


@query(f"""WITH {TRANSCRIPTS}, {GENES} SELECT a.contig, a.id, max(CASE WHEN b.lend <= a.lend AND b.rend >= a.rend THEN 1 ELSE 0 END) AS contained, count(*) AS met
FROM t a JOIN g b ON a.contig = b.contig AND a.lend <= b.rend AND a.rend >= b.lend GROUP BY a.contig, a.id""")
def contained_pairs(spark, d):
    met = overlap_join(transcripts(spark, d), genes(spark, d))
    inside = F.when(iv.contains(F.col("b_lend"), F.col("b_rend"), F.col("lend"), F.col("rend")), 1).otherwise(0)
    return met.groupBy("contig", "id").agg(F.max(inside).alias("contained"), F.count("*").alias("met"))


@query(f"""WITH {TRANSCRIPTS}, {GENES} SELECT a.contig, a.id, b.id AS gene FROM t a JOIN g b ON a.contig = b.contig AND a.strand <> b.strand AND a.lend <= b.rend AND a.rend >= b.lend
WHERE ({SHARED}) * 100 >= 50 * (a.rend - a.lend + 1)""")
def antisense_pairs(spark, d):
    flipped = genes(spark, d).withColumn("strand", F.translate("strand", "+-", "-+"))
    met = overlap_join(transcripts(spark, d), flipped, ("contig", "strand"))
    shared = iv.overlap_length(F.col("lend"), F.col("rend"), F.col("b_lend"), F.col("b_rend"))
    return met.where(shared * 100 >= 50 * (F.col("rend") - F.col("lend") + 1)).select("contig", "id", F.col("b_id").alias("gene"))


@query("SELECT DISTINCT c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def distinct_values(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_mktsegment", "n_name").distinct()


@query("""SELECT 'big' AS class, o_orderkey AS id FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT 'urgent', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'returned', l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def union_tagged(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    tag = lambda df, name, c: df.select(F.lit(name).alias("class"), F.col(c).alias("id"))
    returned = li.where("l_returnflag = 'R'").select("l_orderkey").distinct()
    return tag(o.where("o_totalprice > 300000"), "big", "o_orderkey").unionByName(tag(o.where("o_orderpriority = '1-URGENT'"), "urgent", "o_orderkey")).unionByName(tag(returned, "returned", "l_orderkey"))


@query("""WITH a AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_quantity > 49), b AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_discount > 0.09)
SELECT k, 'both' AS side FROM (FROM a INTERSECT FROM b) UNION ALL SELECT k, 'a' FROM (FROM a EXCEPT FROM b) UNION ALL SELECT k, 'b' FROM (FROM b EXCEPT FROM a)""")
def set_sides(spark, d):
    li = table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "k")
    a, b = li.where("l_quantity > 49").select("k"), li.where("l_discount > 0.09").select("k")
    tag = lambda df, s: df.withColumn("side", F.lit(s))
    return tag(a.intersect(b), "both").unionByName(tag(a.distinct().join(b, "k", "left_anti"), "a")).unionByName(tag(b.distinct().join(a, "k", "left_anti"), "b"))


@query("""WITH m AS (SELECT l_orderkey AS id, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag, ',' ORDER BY CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag) AS shape FROM lineitem GROUP BY l_orderkey)
SELECT shape, count(*) AS n, min(id) AS first_id FROM m GROUP BY shape""")
def coordset_equality(spark, d):
    shape = F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("l_returnflag")))), ",")
    m = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(shape.alias("shape"))
    return m.groupBy("shape").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
