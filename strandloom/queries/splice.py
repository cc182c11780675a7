"""Pairwise structure comparison queries over orders as multi-segment structures."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import splice as sp
from strandloom.queries.registry import query, structures_sql
from strandloom.sources.tables import structures

BASE = f"""WITH {structures_sql()}, e AS (SELECT *, CAST(row_number() OVER (PARTITION BY contig, acc, strand ORDER BY lend) AS INT) AS k, count(*) OVER (PARTITION BY contig, acc, strand) AS n FROM seg),
i AS (SELECT * FROM (SELECT contig, acc, strand, rend + 1 AS lend, lead(lend) OVER (PARTITION BY contig, acc, strand ORDER BY lend) - 1 AS rend FROM seg) WHERE rend >= lend)"""
PAIR = "a.contig = b.contig AND a.strand = b.strand AND a.acc <> b.acc"
STRICT = "a.lend < b.rend AND a.rend > b.lend"


@query(f"{BASE} SELECT DISTINCT a.contig, a.strand, a.acc, b.acc AS other, b.lend, b.rend FROM e a JOIN i b ON {PAIR} AND a.lend < b.lend AND a.rend > b.rend")
def retained_intron(spark, d):
    return sp.retained_introns(structures(spark, d))


@query(f"""{BASE}, m AS (SELECT a.contig, a.strand, a.acc, b.acc AS other, a.lend, a.rend, a.k, a.n, b.lend AS bl, b.rend AS br, b.k AS bk, b.n AS bn, count(*) OVER (PARTITION BY a.contig, a.strand, a.acc, b.acc, a.k) AS x,
  count(*) OVER (PARTITION BY a.contig, a.strand, a.acc, b.acc, b.k) AS y FROM e a JOIN e b ON {PAIR} AND {STRICT}), o AS (SELECT * FROM m WHERE x = 1 AND y = 1 AND acc < other)
SELECT contig, strand, acc, other, CASE strand WHEN '-' THEN 'donor' ELSE 'acceptor' END AS type, lend AS site, bl AS other_site FROM o WHERE k > 1 AND bk > 1 AND lend <> bl
UNION ALL SELECT contig, strand, acc, other, CASE strand WHEN '-' THEN 'acceptor' ELSE 'donor' END, rend, br FROM o WHERE k < n AND bk < bn AND rend <> br""")
def alt_boundaries(spark, d):
    return sp.alternate_boundaries(structures(spark, d))


@query(f"""{BASE}, r AS (SELECT a.contig, a.strand, a.acc, b.acc AS other, b.lend AS il, b.rend AS ir, min(a.lend) AS lend, max(a.rend) AS rend, count(*) AS exons FROM e a JOIN i b ON {PAIR} AND a.lend >= b.lend AND a.rend <= b.rend GROUP BY ALL)
SELECT contig, strand, acc, other, lend, rend, exons FROM r WHERE EXISTS (SELECT 1 FROM e a JOIN e b ON {PAIR} AND {STRICT} WHERE a.contig = r.contig AND a.strand = r.strand AND a.acc = r.acc AND b.acc = r.other AND b.lend < il)
AND EXISTS (SELECT 1 FROM e a JOIN e b ON {PAIR} AND {STRICT} WHERE a.contig = r.contig AND a.strand = r.strand AND a.acc = r.acc AND b.acc = r.other AND b.rend > ir)""")
def skipped_exon(spark, d):
    return sp.skipped_exons(structures(spark, d))


@query(f"""{BASE} SELECT DISTINCT a.contig, a.strand, a.acc, b.acc AS other, CASE a.strand WHEN '-' THEN 'ends' ELSE 'starts' END AS type, a.lend AS site FROM e a JOIN i b ON {PAIR} AND a.k = 1 AND a.lend BETWEEN b.lend AND b.rend AND a.rend > b.rend AND b.rend - a.lend + 1 > 2
UNION SELECT DISTINCT a.contig, a.strand, a.acc, b.acc, CASE a.strand WHEN '-' THEN 'starts' ELSE 'ends' END, a.rend FROM e a JOIN i b ON {PAIR} AND a.k = a.n AND a.rend BETWEEN b.lend AND b.rend AND a.lend < b.lend AND a.rend - b.lend + 1 > 2""")
def boundary_in_intron(spark, d):
    return sp.ends_in_introns(structures(spark, d), fuzz=2)


@query(f"""{BASE}, m AS (SELECT a.contig, a.strand, a.acc, b.acc AS other, min(a.k) - 1 AS "left", min(b.k) - 1 AS other_left, min(a.n - a.k) AS "right", min(b.n - b.k) AS other_right FROM e a JOIN e b ON {PAIR} AND {STRICT} GROUP BY a.contig, a.strand, a.acc, b.acc)
SELECT * FROM m WHERE acc < other AND ("left" > 0 AND other_left > 0 OR "right" > 0 AND other_right > 0)""")
def alt_terminal_exon(spark, d):
    return sp.alternate_terminal_exons(structures(spark, d))


@query(f"{BASE} SELECT a.contig, a.strand, a.acc, b.acc AS other, count(*) AS equal FROM e a JOIN e b ON {PAIR} AND a.lend = b.lend AND a.rend = b.rend AND a.acc < b.acc GROUP BY a.contig, a.strand, a.acc, b.acc")
def equal_exons(spark, d):
    return sp.equal_exons(structures(spark, d))


@query(f"""{BASE}, h AS (SELECT contig, strand, lend, rend, count(DISTINCT acc) AS having_ FROM i GROUP BY ALL)
SELECT h.contig, h.strand, h.lend, h.rend, h.having_ AS "having", (SELECT count(DISTINCT acc) FROM e WHERE e.contig = h.contig AND e.strand = h.strand AND e.lend < h.lend AND e.rend > h.rend) AS spanning FROM h""")
def intron_support(spark, d):
    return sp.intron_support(structures(spark, d))


_CDS = "s AS (SELECT contig, acc, strand, min(lend) AS sl, max(rend) AS sr, min(lend) + (max(rend) - min(lend)) // 4 AS cl, max(rend) - (max(rend) - min(lend)) // 4 AS cr FROM seg GROUP BY contig, acc, strand)"


@query(f"""{BASE}, {_CDS}, l AS (SELECT e.contig, e.acc, e.lend, e.rend, [CASE WHEN e.lend <= cr AND e.rend >= cl THEN CASE WHEN e.lend >= cl AND e.rend <= cr THEN 'cds_contained' ELSE 'cds_overlap' END END,
  CASE WHEN sl <= cl - 1 AND e.lend <= cl - 1 THEN CASE e.strand WHEN '-' THEN 'utr_3prime' ELSE 'utr_5prime' END || CASE WHEN e.rend <= cl - 1 THEN '_contained' ELSE '_overlap' END END,
  CASE WHEN cr + 1 <= sr AND e.rend >= cr + 1 THEN CASE e.strand WHEN '-' THEN 'utr_5prime' ELSE 'utr_3prime' END || CASE WHEN e.lend >= cr + 1 THEN '_contained' ELSE '_overlap' END END] AS labels FROM e JOIN s USING (contig, acc, strand))
SELECT contig, acc, lend, rend, list_aggregate(list_sort(list_filter(labels, lambda x: x IS NOT NULL)), 'string_agg', ',') AS class FROM l""")
def range_classes(spark, d):
    seg = structures(spark, d)
    quarter = F.floor((F.max("rend") - F.min("lend")) / 4).cast("int")
    s = seg.groupBy("contig", "acc", "strand").agg(F.min("lend").alias("sl"), F.max("rend").alias("sr"), (F.min("lend") + quarter).alias("cl"), (F.max("rend") - quarter).alias("cr"))
    c = F.col
    return seg.join(s, ["contig", "acc", "strand"]).select("contig", "acc", "lend", "rend", sp.range_class(c("lend"), c("rend"), c("cl"), c("cr"), c("sl"), c("sr"), c("strand")).alias("class"))


@query(f"""{BASE}, f AS (SELECT *, (coalesce(sum(rend - lend + 1) OVER (PARTITION BY contig, acc, strand ORDER BY lend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - lend) AS g FROM e),
h AS (SELECT *, ((g % 3) + 3) % 3 AS f FROM f)
SELECT a.contig, a.strand, a.acc, b.acc AS other, CAST(sum(CASE WHEN a.f = b.f THEN least(a.rend, b.rend) - greatest(a.lend, b.lend) + 1 ELSE 0 END) AS BIGINT) AS same,
CAST(sum(CASE WHEN a.f <> b.f THEN least(a.rend, b.rend) - greatest(a.lend, b.lend) + 1 ELSE 0 END) AS BIGINT) AS different FROM h a JOIN h b ON {PAIR} AND a.acc < b.acc AND a.lend <= b.rend AND a.rend >= b.lend GROUP BY a.contig, a.strand, a.acc, b.acc""")
def frame_change(spark, d):
    return sp.frame_overlap(structures(spark, d))


@query(f"""{BASE}, r AS (SELECT DISTINCT a.acc FROM e a JOIN i b ON {PAIR} AND a.lend < b.lend AND a.rend > b.rend), q AS (SELECT DISTINCT a.acc FROM e a JOIN e b ON {PAIR} AND a.lend = b.lend AND a.rend = b.rend),
v AS (SELECT acc, 'retained_intron' AS type FROM r UNION ALL SELECT acc, 'equal_exon' FROM q), l AS (SELECT acc, string_agg(DISTINCT type, ', ' ORDER BY type) AS labels FROM v GROUP BY acc)
SELECT labels, count(*) AS n, min(acc) AS first_acc FROM l GROUP BY labels""")
def variation_tokens(spark, d):
    from strandloom.operators.report import labels

    seg = structures(spark, d)
    eq = sp.equal_exons(seg)
    both = eq.select("acc").unionByName(eq.select(F.col("other").alias("acc")))
    v = sp.retained_introns(seg).select("acc", F.lit("retained_intron").alias("type")).unionByName(both.select("acc", F.lit("equal_exon").alias("type")))
    return labels(v, ("acc",), "type").groupBy("labels").agg(F.count("*").alias("n"), F.min("acc").alias("first_acc"))


@query(f"""{BASE}, x AS (SELECT contig, acc, strand, lend AS x, rend AS y, lag(lend) OVER w AS pl, lag(rend) OVER w AS pr, lead(lend) OVER w AS nl, lead(rend) OVER w AS nr FROM seg WINDOW w AS (PARTITION BY contig, acc, strand ORDER BY lend))
SELECT a.contig, a.strand, a.acc, b.acc AS other, a.x AS lend, a.y AS rend, b.x AS other_lend, b.y AS other_rend FROM x a JOIN x b ON a.contig = b.contig AND a.strand = b.strand AND a.acc < b.acc AND (a.y < b.x OR a.x > b.y)
AND a.pl <= b.pr AND a.pr >= b.pl AND a.nl <= b.nr AND a.nr >= b.nl AND a.pr < b.nl AND a.nl > b.pr AND CASE WHEN a.y < b.x THEN a.x > b.pr AND b.y < a.nl ELSE b.x > a.pr AND a.y < b.nl END
WHERE a.pl IS NOT NULL AND a.nl IS NOT NULL AND b.pl IS NOT NULL AND b.nl IS NOT NULL""")
def alternate_internal_exons(spark, d):
    return sp.alternate_internal_exons(structures(spark, d))


@query(f"""{BASE}, m AS (SELECT a.contig, a.strand, a.acc, b.acc AS other, a.lend, a.rend, a.k, a.n, b.lend AS bl, b.rend AS br, b.k AS bk, b.n AS bn, count(*) OVER (PARTITION BY a.contig, a.strand, a.acc, b.acc, a.k) AS x,
  count(*) OVER (PARTITION BY a.contig, a.strand, a.acc, b.acc, b.k) AS y FROM e a JOIN e b ON {PAIR} AND {STRICT}), o AS (SELECT * FROM m WHERE x = 1 AND y = 1 AND acc < other),
v AS (SELECT contig, strand, acc, other, CASE strand WHEN '-' THEN 'donor' ELSE 'acceptor' END AS type, least(lend, bl) AS s1, greatest(lend, bl) AS s2 FROM o WHERE k > 1 AND bk > 1 AND lend <> bl
  UNION ALL SELECT contig, strand, acc, other, CASE strand WHEN '-' THEN 'acceptor' ELSE 'donor' END, least(rend, br), greatest(rend, br) FROM o WHERE k < n AND bk < bn AND rend <> br),
u AS (SELECT contig, strand, type, s1, s2, acc AS a FROM v UNION ALL SELECT contig, strand, type, s1, s2, other FROM v)
SELECT contig, strand, type, s1 AS first_site, s2 AS second_site, CAST(count(*) // 2 AS BIGINT) AS pairs, count(DISTINCT a) AS structures FROM u GROUP BY ALL""")
def splicing_events(spark, d):
    return sp.boundary_events(sp.alternate_boundaries(structures(spark, d)))


@query(f"""{BASE}, s AS (SELECT contig, strand, acc, string_agg(lend || '-' || rend, ',' ORDER BY lend) AS shape FROM seg GROUP BY contig, strand, acc)
SELECT contig, strand, shape, count(*) AS structures, min(acc) AS first FROM s GROUP BY contig, strand, shape""")
def identical_structures(spark, d):
    return sp.identical_structures(structures(spark, d))


@query(f"""{BASE}, n AS (SELECT *, CASE WHEN lend - max(rend) OVER (PARTITION BY contig, acc, strand ORDER BY lend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 < 15 THEN 0 ELSE 1 END AS fresh FROM seg),
p AS (SELECT *, sum(fresh) OVER (PARTITION BY contig, acc, strand ORDER BY lend ROWS UNBOUNDED PRECEDING) AS pile FROM n)
SELECT contig, acc, strand, min(lend) AS lend, max(rend) AS rend FROM p GROUP BY contig, acc, strand, pile""")
def short_intron_collapse(spark, d):
    from strandloom.operators.graph import collapse_short_introns

    return collapse_short_introns(structures(spark, d).withColumn("id", F.col("acc")), ("contig", "acc", "strand"), 15)
