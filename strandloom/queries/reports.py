"""Aggregation, histogram, top-k and status queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandloom.operators import report
from strandloom.operators.intervals import pile_spans, piles
from strandloom.queries.registry import iv_sql, pile_sql, query, structures_sql
from strandloom.sources.tables import day, intervals_from_lineitem, structures, table


@query("SELECT count(*) AS lines, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem")
def count_distinct(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("lines"), F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"))


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type ORDER BY users DESC, event_type")
def group_count_desc(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users")).orderBy(F.desc("users"), "event_type")


@query("SELECT l_orderkey, count(*) AS members FROM lineitem GROUP BY l_orderkey HAVING count(*) > 5")
def having_members(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("members")).where("members > 5")


@query("SELECT c_custkey, count(DISTINCT l_suppkey) AS suppliers FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'A' GROUP BY c_custkey HAVING count(DISTINCT l_suppkey) > 1")
def multi_subcluster_genes(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "lineitem").where("l_returnflag = 'A'"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_custkey").agg(F.countDistinct("l_suppkey").alias("suppliers")).where("suppliers > 1")


@query(f"WITH {structures_sql()} SELECT contig, acc, min(lend) AS lend, max(rend) AS rend, count(*) AS segments FROM seg GROUP BY contig, acc")
def gene_spans(spark, d):
    return structures(spark, d).groupBy("contig", "acc").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.count("*").alias("segments"))


@query("""SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS aligned, round(sum(l_quantity * (1 - l_discount)) / sum(l_quantity) * 100, 6) AS identity,
round(sum(l_quantity * (1 - l_discount)), 6) AS score FROM lineitem GROUP BY l_orderkey""")
def alignment_attributes(spark, d):
    good = F.sum(F.col("l_quantity") * (1 - F.col("l_discount")))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("aligned"), F.round(good / F.sum("l_quantity") * 100, 6).alias("identity"), F.round(good, 6).alias("score"))


@query("SELECT l_suppkey, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) AS day, string_agg(DISTINCT CAST(l_orderkey AS VARCHAR), ',' ORDER BY CAST(l_orderkey AS VARCHAR)) AS orders FROM lineitem GROUP BY 1, 2")
def collect_keys(spark, d):
    keys = F.array_join(F.array_sort(F.collect_set(F.col("l_orderkey").cast("string"))), ",")
    return table(spark, d, "lineitem").groupBy("l_suppkey", day("l_shipdate").alias("day")).agg(keys.alias("orders"))


@query("SELECT l_partkey, l_returnflag, max(l_quantity) AS most, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_partkey, l_returnflag")
def max_per_key(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey", "l_returnflag").agg(F.max("l_quantity").alias("most"), F.countDistinct("l_suppkey").alias("suppliers"))


_LABELS = "l AS (SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS labels FROM events GROUP BY user_id)"


@query(f"""WITH {_LABELS}, t AS (SELECT labels, row_number() OVER (ORDER BY labels) AS token_id FROM (SELECT DISTINCT labels FROM l))
SELECT token_id, labels, count(*) AS users FROM l JOIN t USING (labels) GROUP BY token_id, labels""")
def label_tokens(spark, d):
    per = report.labels(table(spark, d, "events"), ("user_id",), "event_type")
    return per.groupBy("labels").agg(F.count("*").alias("users")).join(report.dictionary(per, "labels"), "labels").select("token_id", "labels", "users")


@query("""WITH s AS (SELECT l_partkey AS ev, l_suppkey AS who, bool_or(l_returnflag = 'R') AS pro, bool_or(l_returnflag = 'N') AS con FROM lineitem GROUP BY ALL)
SELECT ev, count(*) FILTER (pro AND NOT con) AS pro, count(*) FILTER (con AND NOT pro) AS con, count(*) FILTER (pro AND con) AS both FROM s GROUP BY ev""")
def event_support(spark, d):
    s = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("ev"), F.col("l_suppkey").alias("who")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("p"), F.bool_or(F.col("l_returnflag") == "N").alias("c"))
    return s.groupBy("ev").agg(F.expr("count_if(p AND NOT c)").alias("pro"), F.expr("count_if(c AND NOT p)").alias("con"), F.expr("count_if(p AND c)").alias("both"))


@query("""WITH c AS (SELECT l_suppkey AS k, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY k, s), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, s) AS i FROM c)
SELECT k, s AS strand, n FROM r WHERE i = 1""")
def majority_vote(spark, d):
    c = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("k"), F.col("l_linestatus").alias("s")).count()
    best = c.withColumn("i", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("count"), "s"))).where("i = 1")
    return best.select("k", F.col("s").alias("strand"), F.col("count").alias("n"))


@query("SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned, bool_and(l_linestatus = 'F') AS all_final FROM lineitem GROUP BY l_orderkey")
def any_flag(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"), F.bool_and(F.col("l_linestatus") == "F").alias("all_final"))


@query("""WITH b AS (SELECT CAST(CASE WHEN v > 0 THEN (v - 1) // 250 + 1 WHEN v < 0 THEN -((-v - 1) // 250 + 1) ELSE 0 END AS BIGINT) AS bin, v FROM (SELECT CAST(round(c_acctbal) AS BIGINT) AS v FROM customer)),
g AS (SELECT bin, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM b GROUP BY bin)
SELECT bin, n, round(100 * n / sum(n) OVER (), 6) AS share, total, round(100 * total / sum(total) OVER (), 6) AS total_share FROM g""")
def histogram_1d(spark, d):
    return report.histogram(table(spark, d, "customer").select(F.round("c_acctbal").cast("long").alias("v")), "v", 250)


@query("SELECT CAST(ceil(l_quantity / 10) AS BIGINT) AS bin_a, CAST(ceil(l_extendedprice / 10000) AS BIGINT) AS bin_b, count(*) AS n FROM lineitem GROUP BY bin_a, bin_b")
def histogram_2d(spark, d):
    return table(spark, d, "lineitem").groupBy(F.ceil(F.col("l_quantity") / 10).alias("bin_a"), F.ceil(F.col("l_extendedprice") / 10000).alias("bin_b")).agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT n_chars, sum(n_chars) OVER (ORDER BY n_chars DESC RANGE UNBOUNDED PRECEDING) AS run, sum(n_chars) OVER () AS total FROM documents)
SELECT max(n_chars) AS n50, CAST(any_value(total) AS BIGINT) AS total FROM r WHERE run * 2 >= total""")
def n50(spark, d):
    return report.n50(table(spark, d, "documents"), "n_chars")


@query(f"""WITH {iv_sql("l_suppkey")}, {pile_sql()}, s AS (SELECT contig, pile, min(lend) + max(rend) AS mid2 FROM piled GROUP BY contig, pile),
n AS (SELECT mid2 - lag(mid2) OVER (PARTITION BY contig ORDER BY pile) AS gap2 FROM s), k AS (SELECT CAST(gap2 AS BIGINT) AS gap2, count(*) AS n FROM n WHERE gap2 IS NOT NULL GROUP BY gap2)
SELECT gap2, n, CAST(sum(n) OVER (ORDER BY gap2) AS BIGINT) AS upto FROM k""")
def neighbour_gaps(spark, d):
    s = pile_spans(intervals_from_lineitem(spark, d, "l_suppkey")).withColumn("mid2", (F.col("lend") + F.col("rend")).cast("long"))
    gap = (F.col("mid2") - F.lag("mid2").over(Window.partitionBy("contig").orderBy("pile"))).alias("gap2")
    k = s.select(gap).where("gap2 IS NOT NULL").groupBy("gap2").agg(F.count("*").alias("n"))
    return k.withColumn("upto", F.sum("n").over(Window.orderBy("gap2")))


@query("SELECT w, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \\t\\n]+')) AS w FROM documents) WHERE w <> '' GROUP BY w")
def token_count(spark, d):
    return table(spark, d, "documents").select(F.explode(F.split("text", r"[ \t\n]+")).alias("w")).where("w <> ''").groupBy("w").agg(F.count("*").alias("n"))


@query(f"""WITH {structures_sql()}, t AS (SELECT acc, count(*) AS n, sum(rend - lend + 1) AS size FROM seg GROUP BY acc)
SELECT count(*) AS structures, CAST(sum(n) AS BIGINT) AS segments, round(avg(n), 6) AS mean_segments, round(avg(size), 6) AS mean_size, count(*) FILTER (n = 1) AS single FROM t""")
def exon_stats(spark, d):
    t = structures(spark, d).groupBy("acc").agg(F.count("*").alias("n"), F.sum(F.col("rend") - F.col("lend") + 1).alias("size"))
    return t.agg(F.count("*").alias("structures"), F.sum("n").alias("segments"), F.round(F.avg("n"), 6).alias("mean_segments"), F.round(F.avg("size"), 6).alias("mean_size"), F.count_if(F.col("n") == 1).alias("single"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS sets FROM events GROUP BY user_id")
def venn_membership(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("sets"))


@query("""SELECT user_id, CAST(bool_or(event_type = 'click') AS INT) AS click, CAST(bool_or(event_type = 'error') AS INT) AS error, CAST(bool_or(event_type = 'purchase') AS INT) AS purchase,
CAST(bool_or(event_type = 'signup') AS INT) AS signup, CAST(bool_or(event_type = 'view') AS INT) AS view FROM events GROUP BY user_id""")
def venn_matrix(spark, d):
    kinds = ["click", "error", "purchase", "signup", "view"]
    p = table(spark, d, "events").groupBy("user_id").pivot("event_type", kinds).agg(F.count(F.lit(1)))
    return p.select("user_id", *[F.coalesce(F.col(k) > 0, F.lit(False)).cast("int").alias(k) for k in kinds])


@query("""WITH s AS (SELECT DISTINCT l_orderkey AS link, l_returnflag AS type, l_partkey AS pos FROM lineitem)
SELECT a.type, CAST(ceil(abs(a.pos - b.pos) / 20.0) AS BIGINT) AS bin, count(*) AS n FROM s a JOIN s b ON a.link = b.link AND a.type = b.type AND a.pos < b.pos GROUP BY a.type, bin""")
def site_deltas(spark, d):
    s = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("link"), F.col("l_returnflag").alias("type"), F.col("l_partkey").alias("pos")).distinct()
    pairs = s.join(s.withColumnRenamed("pos", "other"), ["link", "type"]).where("pos < other")
    return pairs.groupBy("type", F.ceil((F.col("other") - F.col("pos")) / 20).alias("bin")).agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT l_partkey AS k, count(*) FILTER (l_returnflag = 'R') AS a, count(*) FILTER (l_returnflag = 'N') AS b FROM lineitem GROUP BY k)
SELECT CAST(floor(10 * least(a, b) / greatest(a, b)) AS BIGINT) AS bin, count(*) AS n FROM s WHERE a > 0 AND b > 0 GROUP BY bin""")
def support_ratio(spark, d):
    s = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("a"), F.count_if(F.col("l_returnflag") == "N").alias("b"))
    return s.where("a > 0 AND b > 0").groupBy(F.floor(10 * F.least("a", "b") / F.greatest("a", "b")).alias("bin")).agg(F.count("*").alias("n"))


@query("""SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS sd, round(stddev_samp(l_quantity) / sqrt(count(*)), 6) AS se,
median(l_quantity) AS med, round(corr(l_quantity, l_extendedprice), 6) AS r, round(exp(avg(ln(l_quantity))), 6) AS geo FROM lineitem GROUP BY l_returnflag""")
def descriptive_stats(spark, d):
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.avg(q), 6).alias("mean"), F.round(F.stddev_samp(q), 6).alias("sd"), F.round(F.stddev_samp(q) / F.sqrt(F.count("*")), 6).alias("se"),
        F.median(q).alias("med"), F.round(F.corr(q, "l_extendedprice"), 6).alias("r"), F.round(F.exp(F.avg(F.ln(q))), 6).alias("geo"))


@query(f"WITH {iv_sql('l_partkey')}, {pile_sql()}, s AS (SELECT contig, pile, count(*) AS size FROM piled GROUP BY contig, pile) SELECT size, count(*) AS clusters FROM s GROUP BY size")
def cluster_sizes(spark, d):
    s = piles(intervals_from_lineitem(spark, d, "l_partkey")).groupBy("contig", "pile").agg(F.count("*").alias("size"))
    return s.groupBy("size").agg(F.count("*").alias("clusters"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def top_longest(spark, d):
    return table(spark, d, "documents").orderBy(F.desc("n_chars"), "doc_id").limit(25).select("doc_id", "n_chars")


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_totalprice DESC, o_orderkey LIMIT 40")
def unknown_last(spark, d):
    rank = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    return table(spark, d, "orders").orderBy(rank, F.desc("o_totalprice"), "o_orderkey").limit(40).select("o_orderkey", "o_orderstatus")


@query("SELECT l_suppkey, arg_min(l_linestatus, (l_orderkey * 100 + l_linenumber) * 2 + CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END) AS strand FROM lineitem GROUP BY l_suppkey")
def first_value(spark, d):
    key = (F.col("l_orderkey") * 100 + F.col("l_linenumber")) * 2 + F.when(F.col("l_linestatus") == "O", 1).otherwise(0)
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.min_by("l_linestatus", key).alias("strand"))


@query("""WITH y AS (SELECT o_custkey AS k, year(o_orderdate) AS y, arg_max(o_orderstatus, epoch(o_orderdate) * 1000000 + o_orderkey) AS s FROM orders GROUP BY k, y)
SELECT a.s AS before, count(*) FILTER (b.s = 'F') AS F, count(*) FILTER (b.s = 'O') AS O, count(*) FILTER (b.s = 'P') AS P FROM y a JOIN y b ON a.k = b.k AND b.y = a.y + 1 GROUP BY a.s""")
def status_diff_matrix(spark, d):
    when = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * 1000000 + F.col("o_orderkey")
    y = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y")).agg(F.max_by("o_orderstatus", when).alias("s"))
    later = y.select("k", (F.col("y") - 1).alias("y"), F.col("s").alias("after"))
    m = y.join(later, ["k", "y"]).groupBy(F.col("s").alias("before")).pivot("after", ["F", "O", "P"]).count()
    return m.na.fill(0)


@query("""WITH s AS (SELECT l_suppkey AS supplier, count(*) AS n, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS k FROM lineitem GROUP BY l_suppkey),
p AS (SELECT CAST(sum(k) AS DOUBLE) / sum(n) AS p FROM s),
t AS (SELECT supplier, n, k, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p))) AS upper FROM s, p, range(0, 100000) AS r(i) WHERE i BETWEEN k AND n GROUP BY supplier, n, k)
SELECT supplier, n, k, round(CASE WHEN k = 0 THEN 1.0 ELSE upper END, 6) AS upper FROM t""")
def binomial_tails(spark, d):
    """How likely a supplier would have as many returned lines as it has, or more, if all suppliers were alike."""
    from strandloom.functions.stats import binomial_upper

    s = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("supplier")).agg(F.count("*").alias("n"), F.sum((F.col("l_returnflag") == "R").cast("long")).alias("k"))
    p = s.agg((F.sum("k") / F.sum("n")).alias("p"))
    return s.crossJoin(F.broadcast(p)).select("supplier", "n", "k", F.round(binomial_upper(F.col("k"), F.col("n"), F.col("p")), 6).alias("upper"))
