"""Splice validation and gene model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import seq
from strandloom.operators import gene, validate
from strandloom.plans.lineage import stored
from strandloom.queries.registry import query, structures_sql
from strandloom.sources import formats as fm
from strandloom.sources.tables import contig_sequences, gene_models, sequences, spliced_alignments, table

ALIGNED = """q AS (SELECT doc_id AS contig, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS s FROM documents),
k AS (SELECT *, length(s) AS n, CASE WHEN contig % 4 IN (1, 2) THEN '-' ELSE '+' END AS strand, CASE contig % 4 WHEN 1 THEN 'CT' WHEN 3 THEN 'TT' ELSE 'GT' END AS p1,
  CASE contig % 4 WHEN 1 THEN 'AC' WHEN 3 THEN 'TT' ELSE 'AG' END AS p2, CASE WHEN contig % 7 = 0 THEN 1 ELSE 0 END AS gap FROM q WHERE length(s) >= 80),
x AS (SELECT *, instr(substr(s, n // 4 + 1), p1) AS x, instr(reverse(substr(s, 1, 3 * n // 4)), reverse(p2)) AS y FROM k),
al AS (SELECT *, CAST(n // 4 + x AS INT) AS a, CAST(3 * n // 4 - y + 1 AS INT) AS b FROM x WHERE x > 0 AND y > 0 AND 3 * n // 4 - y + 1 >= n // 4 + x + 3),
j AS (SELECT *, substr(s, a, 2) AS l, substr(s, b - 1, 2) AS r FROM al),
o AS (SELECT *, (l, r) IN (('GT', 'AG'), ('GC', 'AG'), ('AT', 'AC')) AS fwd, (l, r) IN (('CT', 'AC'), ('CT', 'GC'), ('GT', 'AT')) AS rev FROM j)"""


def _tiled(spark, d):
    return validate.tiles(sequences(spark, d))


@query(f"""WITH {ALIGNED} SELECT contig, strand, a AS lend, b AS rend, l AS left_site, r AS right_site, CASE strand WHEN '-' THEN rev ELSE fwd END AS pair,
CASE strand WHEN '-' THEN l IN ('CT', 'GT') ELSE l IN ('GT', 'GC', 'AT') END AS left_ok, CASE strand WHEN '-' THEN r IN ('AC', 'GC', 'AT') ELSE r IN ('AG', 'AC') END AS right_ok FROM o""")
def splice_junctions(spark, d):
    got = validate.junctions(spliced_alignments(spark, d), _tiled(spark, d))
    return got.select("contig", "strand", "lend", "rend", "left_site", "right_site", F.col("own_pair").alias("pair"), F.col("own_left").alias("left_ok"), F.col("own_right").alias("right_ok"))


_SPLICED = "CASE WHEN CASE strand WHEN '-' THEN rev ELSE fwd END THEN strand WHEN fwd THEN '+' WHEN rev THEN '-' ELSE '?' END"


@query(f"WITH {ALIGNED} SELECT contig, strand, {_SPLICED} AS spliced_strand, CASE WHEN NOT fwd AND NOT rev THEN 'splice sites' END AS error FROM o")
def spliced_orientation(spark, d):
    alignments = spliced_alignments(spark, d)
    return validate.spliced_orientation(alignments, validate.junctions(alignments, _tiled(spark, d))).select("contig", "strand", "spliced_strand", "error")


# where the transcript has a gap, its second side is compared one base further on; on '-' that is the left one, and the N of every fifth falls into the gap
_BAD = """CAST((CASE WHEN strand = '-' AND gap = 1 THEN CASE WHEN substr(s, a - 3, 3) <> substr(s, a - 4, 3) THEN 1 ELSE 0 END WHEN contig % 5 = 0 THEN 1 ELSE 0 END)
 + (CASE WHEN strand = '+' AND gap = 1 THEN CASE WHEN substr(s, b + 1, 3) <> substr(s, b + 2, 3) THEN 1 ELSE 0 END ELSE 0 END) AS BIGINT)"""


@query(f"WITH {ALIGNED} SELECT contig, strand, {_BAD} AS mismatches FROM al")
def perfect_boundaries(spark, d):
    alignments = spliced_alignments(spark, d)
    found = validate.boundary_mismatches(alignments, validate.junctions(alignments, _tiled(spark, d), 3), alignments.select("acc", "seq"), 3)
    return found.select("contig", "strand", "mismatches")


@query(f"""WITH {ALIGNED} SELECT contig, strand, CASE WHEN gap = 1 THEN 'incontiguous' WHEN NOT fwd AND NOT rev THEN 'splice sites' WHEN b - a + 1 > 400 THEN 'intron too long' WHEN b - a + 1 < 20 THEN 'intron too short'
WHEN {_BAD} > 0 THEN 'splice boundary' WHEN 85 + contig % 16 < 90 THEN 'too little aligned' WHEN 100 - contig % 9 < 95 THEN 'too little identity' END AS error FROM o""")
def validation_cascade(spark, d):
    alignments = spliced_alignments(spark, d)
    junction = validate.junctions(alignments, _tiled(spark, d), 3)
    key = ["contig", "acc", "strand"]
    rows = alignments.join(validate.spliced_orientation(alignments, junction), key).join(validate.boundary_mismatches(alignments, junction, alignments.select("acc", "seq"), 3), key)
    c = F.col
    shortest, longest = validate.intron_lengths(c("segments"))
    error = validate.cascade(c("error"), validate.contiguous(c("segments"), c("strand")), c("mismatches"), shortest, longest, 85 + c("contig") % 16, 100 - c("contig") % 9, 20, 400)
    return rows.select("contig", "strand", error.alias("error"))


@query(f"""WITH {structures_sql()}, s AS (SELECT acc, count(*) AS n FROM seg GROUP BY acc), f AS (SELECT DISTINCT l_orderkey AS acc FROM lineitem WHERE l_quantity > 40)
SELECT acc, CAST(n AS INT) AS n, acc % 3 <> 0 AND NOT (n = 1 AND acc NOT IN (SELECT acc FROM f)) AS valid FROM s""")
def lone_segment_invalidation(spark, d):
    models = gene_models(spark, d).select(F.substring("model_id", 2, 20).cast("long").alias("acc"), F.col("exons").alias("segments")).withColumn("valid", F.col("acc") % 3 != 0)
    full = table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("acc"))
    return validate.without_lone_segments(models, full).select("acc", F.size("segments").alias("n"), "valid")


@query(f"""WITH {structures_sql()}, s AS (SELECT contig, acc, CASE WHEN count(*) = 1 THEN '?' ELSE any_value(strand) END AS strand FROM seg GROUP BY contig, acc),
t AS (SELECT l_orderkey AS acc, min(l_linestatus) AS lo, max(l_linestatus) AS hi FROM lineitem WHERE l_quantity > 25 GROUP BY l_orderkey)
SELECT contig, s.acc, CASE WHEN strand = '?' AND lo = hi THEN CASE lo WHEN 'O' THEN '+' ELSE '-' END ELSE strand END AS strand FROM s LEFT JOIN t ON s.acc = t.acc""")
def strand_from_tails(spark, d):
    models = gene_models(spark, d).select("contig", F.substring("model_id", 2, 20).cast("long").alias("acc"), F.when(F.size("exons") == 1, "?").otherwise(F.col("strand")).alias("strand"))
    sites = table(spark, d, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("acc"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"))
    return validate.strand_from_tails(models, sites)


MODELS = f"""{structures_sql()}, sp AS (SELECT contig, acc, strand, min(lend) AS lo, max(rend) AS hi FROM seg GROUP BY contig, acc, strand),
half AS (SELECT *, lo + (hi - lo) // 4 AS cl, hi - (hi - lo) // 4 AS cr FROM sp),
cds AS (SELECT s.contig, s.acc, s.strand, greatest(s.lend, cl) AS lend, least(s.rend, cr) AS rend FROM seg s JOIN half h USING (contig, acc, strand) WHERE s.lend <= cr AND s.rend >= cl),
ex AS (SELECT contig, acc, strand, string_agg(lend || '-' || rend, ',' ORDER BY lend) AS exons FROM seg GROUP BY contig, acc, strand),
cd AS (SELECT contig, acc, strand, string_agg(lend || '-' || rend, ',' ORDER BY lend) AS cds, sum(rend - lend + 1) AS bases FROM cds GROUP BY contig, acc, strand)"""


def _text(parts):
    return F.array_join(F.transform(parts, lambda e: F.concat_ws("-", e["lend"].cast("string"), e["rend"].cast("string"))), ",")


@query(f"""WITH {MODELS}, ph AS (SELECT contig, acc, strand, lend, CAST(coalesce(sum(rend - lend + 1) OVER (PARTITION BY contig, acc, strand ORDER BY CASE strand WHEN '-' THEN -lend ELSE lend END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM cds),
pt AS (SELECT contig, acc, strand, string_agg((3 - before % 3) % 3, ',' ORDER BY lend) AS phases FROM ph GROUP BY contig, acc, strand)
SELECT CAST(e.contig AS VARCHAR) AS contig, 'g' || e.acc // 2 || '.' || e.contig || e.strand AS gene_id, 'm' || e.acc AS model_id, e.strand, exons, coalesce(cds, '') AS cds, coalesce(phases, '') AS phases
FROM ex e LEFT JOIN cd USING (contig, acc, strand) LEFT JOIN pt USING (contig, acc, strand)""")
def gene_gff3_round_trip(spark, d):
    got = fm.gff3_genes(gene.gff3_lines(gene_models(spark, d)).select("value"))
    phases = F.array_join(F.transform("cds", lambda e: e["phase"].cast("string")), ",")
    return got.select("contig", "gene_id", "model_id", "strand", _text("exons").alias("exons"), _text("cds").alias("cds"), phases.alias("phases"))


@query(f"""WITH {MODELS}, u AS (SELECT contig, strand, lend, least(rend, cl - 1) AS rend, 'left' AS side, acc FROM seg JOIN half USING (contig, acc, strand) WHERE lend <= cl - 1 AND (contig, acc, strand) IN (SELECT (contig, acc, strand) FROM cd)
  UNION ALL SELECT contig, strand, greatest(lend, cr + 1), rend, 'right', acc FROM seg JOIN half USING (contig, acc, strand) WHERE rend >= cr + 1 AND (contig, acc, strand) IN (SELECT (contig, acc, strand) FROM cd))
SELECT 'm' || h.acc AS model_id, h.strand, CAST(coalesce(sum(u.rend - u.lend + 1) FILTER ((side = 'left') = (h.strand <> '-')), 0) AS INT) AS five, CAST(coalesce(sum(u.rend - u.lend + 1) FILTER ((side = 'right') = (h.strand <> '-')), 0) AS INT) AS three
FROM half h LEFT JOIN u ON u.contig = h.contig AND u.acc = h.acc AND u.strand = h.strand GROUP BY h.acc, h.contig, h.strand""".replace("cl - 1", "greatest(cl, cf) - 1").replace("cr + 1", "least(cr, ct) + 1").replace(
    "half AS (SELECT *, lo + (hi - lo) // 4 AS cl, hi - (hi - lo) // 4 AS cr FROM sp)", "half0 AS (SELECT *, lo + (hi - lo) // 4 AS cl, hi - (hi - lo) // 4 AS cr FROM sp), cf0 AS (SELECT s.contig, s.acc, s.strand, min(greatest(s.lend, cl)) AS cf, max(least(s.rend, cr)) AS ct FROM seg s JOIN half0 h USING (contig, acc, strand) WHERE s.lend <= cr AND s.rend >= cl GROUP BY s.contig, s.acc, s.strand),\nhalf AS (SELECT h.*, cf, ct FROM half0 h LEFT JOIN cf0 USING (contig, acc, strand))"))
def untranslated_parts(spark, d):
    five, three = gene.untranslated(F.col("exons"), F.col("cds"), F.col("strand"))
    return gene_models(spark, d).select("model_id", "strand", gene.size(five).alias("five"), gene.size(three).alias("three"))


CONTIGS = """dq AS (SELECT doc_id, coalesce(nullif(regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g'), ''), 'ACGT') AS q FROM documents),
cq AS (SELECT c_custkey AS contig, repeat(q, 4000 // length(q) + 1) AS seq FROM customer JOIN dq ON c_custkey % (SELECT count(*) FROM documents) = doc_id),
parts AS (SELECT contig, acc, strand, string_agg(substr(seq, lend, rend - lend + 1), '' ORDER BY lend) AS p, any_value(seq) AS seq FROM cds JOIN cq USING (contig) GROUP BY contig, acc, strand),
coding AS (SELECT contig, acc, strand, CASE strand WHEN '-' THEN reverse(translate(p, 'ACGT', 'TGCA')) ELSE p END AS coding FROM parts)"""


@query(f"""WITH {MODELS}, {CONTIGS} SELECT 'm' || acc AS model_id, coding,
list_aggregate(list_transform(range(0, length(coding) // 3), lambda i: substr('{seq.STANDARD}', 16 * (instr('TCAG', substr(coding, 3 * i + 1, 1)) - 1) + 4 * (instr('TCAG', substr(coding, 3 * i + 2, 1)) - 1) + instr('TCAG', substr(coding, 3 * i + 3, 1)), 1)), 'string_agg', '') AS protein
FROM coding WHERE length(coding) >= 3""")
def gene_sequences(spark, d):
    got = gene.with_sequences(gene_models(spark, d), contig_sequences(spark, d))
    return got.where(F.length("coding") >= 3).select("model_id", "coding", "protein")


@query(f"""WITH {MODELS}, {CONTIGS}, t AS (SELECT *, CASE WHEN length(coding) >= 3 AND length(coding) % 3 = 0 AND right(coding, 3) IN ('TAA', 'TAG', 'TGA') THEN 3 ELSE 0 END AS stop, CASE WHEN left(coding, 3) = 'ATG' THEN 3 ELSE 0 END AS start FROM coding)
SELECT CAST(e.contig AS VARCHAR) AS contig, 'm' || e.acc AS model_id, e.exons, CAST(coalesce(length(t.coding) - t.stop, 0) AS INT) AS cds_bases, CAST(coalesce(t.start, 0) AS INT) AS start_bases, CAST(coalesce(t.stop, 0) AS INT) AS stop_bases FROM ex e LEFT JOIN t USING (contig, acc, strand)""")
def gene_gtf_round_trip(spark, d):
    models = stored(gene_models(spark, d))  # read twice
    lines = gene.gtf_lines(gene.with_sequences(models, contig_sequences(spark, d))).select("value")
    got = fm.gtf_genes(lines)
    return got.select("contig", "model_id", _text("exons").alias("exons"), gene.size("cds").alias("cds_bases"), gene.size("start_codon").alias("start_bases"), gene.size("stop_codon").alias("stop_bases"))


@query(f"""WITH {MODELS}, b AS (SELECT contig, acc, strand, unnest(range(lend, rend + 1)) AS p FROM cds), r AS (SELECT *, row_number() OVER (PARTITION BY contig, acc, strand ORDER BY CASE strand WHEN '-' THEN -p ELSE p END) AS k FROM b)
SELECT 'm' || acc AS model_id, CAST((k + 2) // 3 AS INT) AS codon, CAST(min(p) AS INT) AS lend, CAST(max(p) AS INT) AS rend, CAST(count(*) AS INT) AS bases FROM r GROUP BY contig, acc, strand, (k + 2) // 3 HAVING count(*) = 3""")
def codon_positions(spark, d):
    """Every whole codon's place in the genome."""
    m = gene_models(spark, d).withColumn("n", F.floor(gene.size(F.col("cds")) / 3).cast("int")).where("n > 0")
    each = m.select("model_id", "strand", "cds", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("codon"))
    each = each.withColumn("parts", gene.codon(F.col("cds"), F.col("strand"), F.col("codon")))
    return each.select("model_id", "codon", F.get("parts", F.lit(0))["lend"].alias("lend"), F.element_at("parts", -1)["rend"].alias("rend"), gene.size(F.col("parts")).alias("bases"))


@query(f"""WITH {structures_sql()}, n AS (SELECT contig, acc, strand, sum(rend - lend + 1) AS n FROM seg GROUP BY contig, acc, strand),
b AS (SELECT contig, acc, strand, unnest(range(lend, rend + 1)) AS p FROM seg), r AS (SELECT *, row_number() OVER (PARTITION BY contig, acc, strand ORDER BY CASE strand WHEN '-' THEN -p ELSE p END) AS k FROM b)
SELECT 'm' || r.acc AS model_id, CASE WHEN r.acc % 3 = 0 THEN translate(r.strand, '+-', '-+') ELSE r.strand END AS strand, CAST(min(p) AS INT) AS lend, CAST(max(p) AS INT) AS rend, CAST(count(*) AS INT) AS bases
FROM r JOIN n USING (contig, acc, strand) WHERE k BETWEEN n // 5 + 1 AND 4 * n // 5 GROUP BY r.contig, r.acc, r.strand""")
def orf_projection(spark, d):
    n = gene.size(F.col("exons"))
    m = gene_models(spark, d).drop("cds").withColumns({"o_lend": (F.floor(n / 5) + 1).cast("int"), "o_rend": F.floor(4 * n / 5).cast("int"), "o_strand": F.when(F.substring("model_id", 2, 20).cast("long") % 3 == 0, "-").otherwise("+")})
    got = gene.project(m).where(F.size("cds") > 0)
    return got.select("model_id", "strand", F.get("cds", F.lit(0))["lend"].alias("lend"), F.element_at("cds", -1)["rend"].alias("rend"), gene.size(F.col("cds")).alias("bases"))


@query(f"""WITH {structures_sql()}, k AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY contig, acc, strand) AS n, lag(rend) OVER w + 1 AS l, lead(lend) OVER w - 1 AS r FROM seg WINDOW w AS (PARTITION BY contig, acc, strand ORDER BY lend))
SELECT 'm' || acc AS model_id, lend, rend, CASE WHEN k > 1 AND k < n THEN l END AS inner_lend, CASE WHEN k > 1 AND k < n THEN r END AS inner_rend,
CASE WHEN n > 1 AND k = 1 THEN lend WHEN n > 1 AND k = n THEN l END AS end_lend, CASE WHEN n > 1 AND k = 1 THEN r WHEN n > 1 AND k = n THEN rend END AS end_rend FROM k""")
def extended_regions(spark, d):
    """Every exon widened over the introns next to it: inner ones on both sides, terminal ones on the inner side."""
    e = gene_models(spark, d).select("model_id", "exons", F.explode("exons").alias("e")).select("model_id", "exons", "e.*")
    inner, end = gene.between_introns(F.col("exons"), F.col("lend"), F.col("rend")), gene.to_neighbour(F.col("exons"), F.col("lend"), F.col("rend"))
    return e.select("model_id", "lend", "rend", inner["lend"].alias("inner_lend"), inner["rend"].alias("inner_rend"), end["lend"].alias("end_lend"), end["rend"].alias("end_rend"))


@query(f"""WITH {structures_sql()}, sc AS (SELECT DISTINCT doc_id AS by_id, unnest([1, 2, 3, 4, 5, 6]) AS frame FROM documents), f AS (SELECT by_id, frame, CAST((by_id * 7 + frame * 13) % 29 - 9 AS DOUBLE) AS score, by_id % 400 AS length, by_id % 11 = 0 AS hit FROM sc),
g AS (SELECT by_id, max(score) FILTER (frame = 1) AS own, max(score) FILTER (frame > 1) AS other, max(length) AS length, bool_or(hit) AS hit FROM f GROUP BY by_id)
SELECT by_id, own, other, length FROM g WHERE hit OR length >= 300 OR own > 0 AND own > other""")
def orf_selection(spark, d):
    ids = table(spark, d, "documents").select(F.col("doc_id").alias("by_id")).distinct()
    rows = ids.select("by_id", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("frame")).withColumn("score", ((F.col("by_id") * 7 + F.col("frame") * 13) % 29 - 9).cast("double"))
    return gene.selected_orfs(rows, "by_id", F.col("by_id") % 400, 300, F.col("by_id") % 11 == 0)
