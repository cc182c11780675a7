"""Format queries: tables written as text lines and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strandloom.plans.lineage import shared_dir
from strandloom.queries.registry import query, structures_sql
from strandloom.sources import formats as fm
from strandloom.sources.tables import structures, table

SEG = f"WITH {structures_sql()}"


def _nested(spark, d):
    piece = F.struct("lend", "rend", F.lit(1).alias("mlend"), (F.col("rend") - F.col("lend") + 1).alias("mrend"), F.lit(97.5).alias("per_id"))
    s = structures(spark, d).groupBy("contig", "acc", "strand").agg(F.array_sort(F.collect_list(piece)).alias("segments"))
    return s.withColumn("id", F.concat(F.lit("m"), F.col("acc").cast("string"))).withColumn("contig", F.concat(F.lit("c"), F.col("contig").cast("string")))


_SPANS = "SELECT 'c' || contig AS contig, acc, strand, min(lend) AS lend, max(rend) AS rend, count(*) AS n FROM seg GROUP BY contig, acc, strand"


@query(f"{SEG} SELECT contig, 'm' || acc AS id, CAST(acc AS VARCHAR) AS acc, strand, lend, rend, n AS num_segments, CAST(97.5 AS DOUBLE) AS avg_per_id FROM ({_SPANS})")
def gff3_round_trip(spark, d):
    got = fm.gff3_alignments(fm.to_gff3(_nested(spark, d)))
    return got.select("contig", "id", "acc", "strand", "lend", "rend", "num_segments", "avg_per_id")


@query(f"{SEG} SELECT contig, 'g' || acc AS gene_id, CAST(acc AS VARCHAR) AS transcript_id, strand, lend, rend, CAST(n AS INT) AS n FROM ({_SPANS})")
def gtf_round_trip(spark, d):
    t = _nested(spark, d).select("contig", F.concat(F.lit("g"), F.col("acc").cast("string")).alias("gene_id"), F.col("acc").alias("transcript_id"), "strand", F.get("segments", F.lit(0))["lend"].alias("lend"), F.element_at("segments", -1)["rend"].alias("rend"), "segments")
    return fm.gtf_transcripts(fm.to_gtf(t)).select("contig", "gene_id", "transcript_id", "strand", "lend", "rend", F.size("segments").alias("n"))


@query(f"{SEG} SELECT contig, CAST(acc AS VARCHAR) AS name, strand, lend, rend, CAST(n AS INT) AS n, total FROM (SELECT 'c' || contig AS contig, acc, strand, min(lend) AS lend, max(rend) AS rend, count(*) AS n, CAST(sum(rend - lend + 1) AS BIGINT) AS total FROM seg GROUP BY contig, acc, strand)")
def bed_round_trip(spark, d):
    t = _nested(spark, d).select("contig", F.col("acc").alias("name"), F.lit(0).alias("score"), "strand", F.lit(None).cast("int").alias("cds_lend"), F.lit(None).cast("int").alias("cds_rend"), "segments")
    total = F.aggregate("segments", F.lit(0).cast("long"), lambda a, s: a + s["rend"] - s["lend"] + 1)
    return fm.bed12(fm.to_bed12(t)).select("contig", "name", "strand", "lend", "rend", F.size("segments").alias("n"), total.alias("total"))


@query("SELECT CAST(doc_id AS VARCHAR) AS acc, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS seq FROM documents")
def fasta_round_trip(spark, d):
    from strandloom.functions.seq import bases_of

    s = table(spark, d, "documents").select(F.col("doc_id").alias("acc"), bases_of(F.col("text")).alias("seq"))
    return fm.fasta_records(fm.to_fasta(s)).select("acc", "seq")


@query("""WITH r AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS name, l_partkey AS pos, CAST(l_quantity AS INT) AS a, CAST(l_suppkey % 40 + 20 AS INT) AS gap, CAST(l_linenumber AS INT) AS b FROM lineitem)
SELECT name, pos, pos + a - 1 AS rend1, pos + a + gap AS lend2, pos + a + gap + b - 1 AS rend2, a + 1 AS mlend2, CAST(a AS VARCHAR) || 'M' || CAST(gap AS VARCHAR) || 'N' || CAST(b AS VARCHAR) || 'M' AS cigar FROM r""")
def cigar_blocks(spark, d):
    from strandloom.functions.seq import cigar_blocks as blocks

    s = lambda c: F.col(c).cast("int").cast("string")
    gap = (F.col("l_suppkey") % 40 + 20).cast("int").cast("string")
    cigar = F.concat(s("l_quantity"), F.lit("M"), gap, F.lit("N"), s("l_linenumber"), F.lit("M"))
    r = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("name"), F.col("l_partkey").alias("pos"), cigar.alias("cigar")).distinct()
    b = r.withColumn("s", blocks(F.col("cigar"), F.col("pos")))
    one = lambda i, f: F.get("s", F.lit(i))[f]
    return b.select("name", "pos", one(0, "rend").cast("long").alias("rend1"), one(1, "lend").cast("long").alias("lend2"), one(1, "rend").cast("long").alias("rend2"), one(1, "mlend").alias("mlend2"), fm.cigar_of(F.col("s")).alias("cigar"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, event_type FROM events")
def attribute_maps(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.concat(F.lit("type="), F.col("event_type"), F.lit(";k="), F.get_json_object("props", "$.k")).alias("info"))
    m = F.str_to_map("info", F.lit(";"), F.lit("="))
    return e.select("event_id", F.try_element_at(m, F.lit("k")).cast("int").alias("k"), F.try_element_at(m, F.lit("type")).alias("event_type"))


@query("""WITH s AS (SELECT DISTINCT l_orderkey, l_linestatus, l_partkey, l_quantity FROM lineitem) SELECT 'orient(s' || CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END || ') align: ' || CAST(l_partkey AS VARCHAR) || '(1)-' || CAST(l_partkey + CAST(l_quantity AS INT) - 1 AS VARCHAR) || '(' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || ')' AS token, count(*) AS n FROM s GROUP BY token""")
def alignment_tokens(spark, d):
    q = F.col("l_quantity").cast("int")
    part = F.col("l_partkey").cast("int")
    segments = F.array(F.struct(part.alias("lend"), (part + q - 1).alias("rend"), F.lit(1).alias("mlend"), q.alias("mrend")))
    s = table(spark, d, "lineitem").select("l_orderkey", "l_linestatus", "l_partkey", "l_quantity").distinct()
    token = fm.alignment_token(F.when(F.col("l_linestatus") == "O", "+").otherwise("-"), segments)
    return s.groupBy(token.alias("token")).agg(F.count("*").alias("n"))


def _written(rows, spark):
    """The folder in the shared one that the lines of rows are written to."""
    at = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    rows.write.text(at)
    return at


@query("SELECT 'r' || doc_id AS name, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS seq, repeat('I', length(regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g'))) AS quality FROM documents")
def fastq_round_trip(spark, d):
    """The documents' bases as reads, written as files and read again split by split."""
    from strandloom.functions.seq import bases_of

    reads = table(spark, d, "documents").select(F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("name"), bases_of(F.col("text")).alias("seq"))
    return fm.fastq(spark, _written(fm.to_fastq(reads.withColumn("quality", F.expr("repeat('I', length(seq))"))), spark))


@query("SELECT 'o' || l_orderkey AS contig, CAST(10 + 5 * (i - 1) AS INT) AS pos, v AS value FROM (SELECT l_orderkey, l_extendedprice AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_linenumber) AS i FROM lineitem)")
def wiggle_round_trip(spark, d):
    """An order's prices as a track of fixed steps, written as files and read again split by split."""
    values = F.array_join(F.transform(F.array_sort(F.collect_list("l_extendedprice")), lambda v: v.cast("string")), "\n")
    tracks = table(spark, d, "lineitem").groupBy("l_orderkey").agg(values.alias("v"))
    lines = tracks.select(F.concat(F.lit("fixedStep chrom=o"), F.col("l_orderkey").cast("string"), F.lit(" start=10 step=5\n"), F.col("v")).alias("value"))
    return fm.wiggle(fm.split_lines(spark, _written(lines, spark)))


@query(f"""{SEG}, p AS (SELECT *, CASE WHEN lend % 4 < 3 THEN lend % 4 END AS phase, CASE WHEN strand = '-' THEN -lend ELSE lend END AS along FROM seg),
q AS (SELECT *, first_value(phase) OVER w AS first, coalesce(sum(rend - lend + 1) OVER (PARTITION BY contig, acc, strand ORDER BY along ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  lead(lend) OVER (PARTITION BY contig, acc, strand ORDER BY lend) - rend - 1 AS gap FROM p WINDOW w AS (PARTITION BY contig, acc, strand ORDER BY along)),
b AS (SELECT contig, acc, bool_or(phase IS NULL) AS none, coalesce(bool_or(phase <> ((coalesce(first, 0) - before) % 3 + 3) % 3), false) AS off, coalesce(bool_or(gap = 0), false) AS zero, coalesce(bool_or(gap BETWEEN 1 AND 19), false) AS short FROM q GROUP BY contig, acc, strand)
SELECT 'c' || contig AS contig, CAST(acc AS VARCHAR) AS transcript_id, '17,19' || CASE WHEN none THEN ',40' ELSE '' END || CASE WHEN off THEN ',42' ELSE '' END || CASE WHEN zero THEN ',48' ELSE '' END || CASE WHEN short THEN ',49' ELSE '' END AS codes FROM b""")
def gtf_transcript_errors(spark, d):
    """The orders' structures as coding parts without codons, with phases that are right now and then: what is wrong with each."""
    from strandloom.sources.gtf_checks import transcript_errors

    phase = F.when(F.col("lend") % 4 < 3, (F.col("lend") % 4).cast("string")).otherwise(".")
    text = F.format_string('gene_id "%s"; transcript_id "%s";', F.col("acc").cast("string"), F.col("acc").cast("string"))
    lines = structures(spark, d).select(F.concat_ws("\t", F.concat(F.lit("c"), F.col("contig").cast("string")), F.lit("s"), F.lit("CDS"), F.col("lend").cast("string"), F.col("rend").cast("string"), F.lit("."), F.col("strand"), phase, text).alias("value"))
    return transcript_errors(lines).select("contig", "transcript_id", F.array_join(F.col("codes").cast("array<string>"), ",").alias("codes"))
