"""Sequence queries: the letters A, C, G, T of the documents' whole texts stand in for sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import seq
from strandloom.operators.intervals import best_by
from strandloom.queries.registry import query
from strandloom.sources.tables import table

SEQ = "s AS (SELECT doc_id, lang, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS q FROM documents)"


def sequences(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", seq.bases_of(F.col("text")).alias("q"))


@query(f"WITH {SEQ} SELECT doc_id, reverse(translate(q, 'ACGT', 'TGCA')) AS r FROM s")
def revcomp(spark, d):
    return sequences(spark, d).select("doc_id", seq.reverse_complement(F.col("q")).alias("r"))


_AA = f"""substr('{seq.STANDARD}', 16 * (instr('TCAG', substr(c, 1, 1)) - 1) + 4 * (instr('TCAG', substr(c, 2, 1)) - 1) + instr('TCAG', substr(c, 3, 1)), 1)"""


@query(f"""WITH {SEQ}, c AS (SELECT doc_id, q, range(0, CAST((length(q) - 1) // 3 AS BIGINT)) AS pos FROM s)
SELECT doc_id, CASE WHEN length(q) >= 4 THEN list_aggregate(list_transform(list_transform(pos, lambda i: substr(q, 3 * i + 2, 3)), lambda c: {_AA}), 'string_agg', '') ELSE '' END AS protein FROM c""")
def translate(spark, d):
    return sequences(spark, d).select("doc_id", seq.translate(F.col("q"), 2).alias("protein"))


@query(f"""WITH {SEQ}, n AS (SELECT CAST(sum(length(q)) AS BIGINT) AS n, CAST(sum(length(q) - length(replace(replace(q, 'A', ''), 'T', ''))) AS BIGINT) AS a_t, CAST(sum(length(q) - length(replace(replace(q, 'C', ''), 'G', ''))) AS BIGINT) AS c_g FROM s)
SELECT 'A' AS base, round(a_t / (2.0 * n), 9) AS share FROM n UNION ALL SELECT 'T', round(a_t / (2.0 * n), 9) FROM n UNION ALL SELECT 'C', round(c_g / (2.0 * n), 9) FROM n UNION ALL SELECT 'G', round(c_g / (2.0 * n), 9) FROM n""")
def base_composition(spark, d):
    """Shares over both strands, so of A and T, and of C and G, alike."""
    q, out = F.col("q"), lambda x: F.sum(F.length("q") - F.length(F.translate(F.col("q"), x, ""))).alias(x)
    n = sequences(spark, d).agg(F.sum(F.length(q)).alias("n"), out("AT"), out("CG"))
    share = lambda c: F.round(F.col(c) / (2.0 * F.col("n")), 9).alias("share")
    rows = F.explode(F.array(*[F.struct(F.lit(b).alias("base"), share(c)) for b, c in (("A", "AT"), ("T", "AT"), ("C", "CG"), ("G", "CG"))]))
    return n.select(rows.alias("r")).select("r.base", "r.share")


@query(f"""WITH {SEQ}, k AS (SELECT q, unnest(range(1, length(q) - 3)) AS p FROM s WHERE length(q) >= 5) SELECT CAST((p - 1) % 3 AS INT) AS frame, substr(q, p, 5) AS kmer, count(*) AS n FROM k GROUP BY frame, kmer""")
def kmer_counts(spark, d):
    return seq.framed_kmers(sequences(spark, d), "q", 5)


@query(f"""WITH {SEQ}, k AS (SELECT lang, q, unnest(range(1, length(q) - 1)) AS p FROM s WHERE length(q) >= 3), f AS (SELECT lang = 'en' AS en, CAST((p - 1) % 3 AS INT) AS frame, substr(q, p, 3) AS kmer, count(*) AS n FROM k GROUP BY ALL),
c AS (SELECT frame, kmer, n, substr(kmer, 1, 2) AS head FROM f WHERE en), ch AS (SELECT frame, head, sum(n) AS nh FROM c GROUP BY frame, head),
b AS (SELECT kmer, substr(kmer, 1, 2) AS head, sum(n) AS bn FROM f WHERE NOT en GROUP BY kmer), bh AS (SELECT head, sum(bn) AS bh FROM b GROUP BY head)
SELECT c.frame, c.kmer, round(ln(((n + 1) / (nh + 1)) / ((coalesce(bn, 0) + 1) / (coalesce(bh, 0) + 1))), 6) AS ratio FROM c JOIN ch USING (frame, head) LEFT JOIN b ON b.kmer = c.kmer LEFT JOIN bh ON bh.head = c.head""")
def kmer_llr(spark, d):
    s = sequences(spark, d)
    ratios = seq.log_ratios(seq.framed_kmers(s.where("lang = 'en'"), "q", 3), seq.framed_kmers(s.where("lang <> 'en'"), "q", 3), 3)
    return ratios.select("frame", "kmer", F.round("ratio", 6).alias("ratio"))


@query("""WITH t AS (SELECT item_id, lower(text) AS q FROM benchmark), k AS (SELECT item_id, substr(q, p, 8) AS m FROM (SELECT item_id, q, unnest(range(1, length(q) - 6)) AS p FROM t WHERE length(q) >= 8)),
u AS (SELECT item_id, m FROM k GROUP BY item_id, m HAVING count(*) = 1), n AS (SELECT item_id, count(*) AS n FROM u GROUP BY item_id),
c AS (SELECT a.item_id AS a, b.item_id AS b, count(*) AS c FROM u a JOIN u b ON a.m = b.m AND a.item_id <> b.item_id GROUP BY a.item_id, b.item_id),
j AS (SELECT a, b, round(c / (x.n + y.n - c), 9) AS similarity FROM c JOIN n x ON x.item_id = a JOIN n y ON y.item_id = b)
SELECT a, b, similarity, CAST(row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS INT) AS rank FROM j QUALIFY rank <= 3""")
def kmer_similarity_topk(spark, d):
    t = table(spark, d, "benchmark").select("item_id", F.explode(seq.kmers(F.lower("text"), 8)).alias("m"))
    u = t.groupBy("item_id", "m").count().where("count = 1").select("item_id", "m")
    n = u.groupBy("item_id").agg(F.count("*").alias("n"))
    c = u.select(F.col("item_id").alias("a"), "m").join(u.select(F.col("item_id").alias("b"), "m"), "m").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("c"))
    j = c.join(n.select(F.col("item_id").alias("a"), F.col("n").alias("x")), "a").join(n.select(F.col("item_id").alias("b"), F.col("n").alias("y")), "b")
    return best_by(j.select("a", "b", F.round(F.expr("c / (x + y - c)"), 9).alias("similarity")), ("a",), F.desc("similarity"), F.asc("b"), n=3)


@query(f"WITH {SEQ} SELECT doc_id, round(100.0 * (length(q) - length(replace(q, 'A', ''))) / length(q), 6) AS percent_a FROM s WHERE length(q) > 0")
def poly_a_percent(spark, d):
    return sequences(spark, d).where("length(q) > 0").select("doc_id", F.round(seq.percent_of(F.col("q"), "A"), 6).alias("percent_a"))


@query(f"""WITH {SEQ}, p AS (SELECT doc_id, q, unnest(range(1, length(q) + 1)) AS n FROM s WHERE q LIKE '%A'),
h AS (SELECT doc_id, n, substr(q, length(q) - n + 1, 1) = 'A' AS hit FROM p), c AS (SELECT *, sum(hit::INT) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS hits FROM h),
f AS (SELECT doc_id, max(n) AS n FROM c WHERE hit AND n >= 3 AND 100 * hits >= 60.0 * n GROUP BY doc_id)
SELECT s.doc_id, CAST(coalesce(f.n, 0) AS INT) AS tail FROM s LEFT JOIN f USING (doc_id)""")
def poly_a_tail(spark, d):
    return sequences(spark, d).select("doc_id", seq.tail_trim(F.col("q"), "A", 3, 60.0).alias("tail"))


@query()
def poly_tails(spark, d):
    return sequences(spark, d).select("doc_id", seq.poly_tails(F.col("q"), 3, 4).alias("t")).select("doc_id", "t.left", "t.right")


_PIECES = "substr(q, length(q) // 10 + 1, 3 * length(q) // 10 - length(q) // 10) || substr(q, length(q) // 2 + 1, 4 * length(q) // 5 - length(q) // 2)"


@query(f"""WITH {SEQ} SELECT doc_id, {_PIECES} AS plus, reverse(translate({_PIECES}, 'ACGT', 'TGCA')) AS minus FROM s""")
def spliced_sequences(spark, d):
    """Two segments of every sequence, at shares of its own length."""
    n = F.length("q")
    part = lambda a, b: F.struct((F.floor(a) + 1).cast("int").alias("lend"), F.floor(b).cast("int").alias("rend"))
    segments = F.array(part(n / 10, 3 * n / 10), part(n / 2, 4 * n / 5))
    return sequences(spark, d).select("doc_id", seq.spliced(F.col("q"), segments, F.lit("+")).alias("plus"), seq.spliced(F.col("q"), segments, F.lit("-")).alias("minus"))


@query()
def longest_orfs(spark, d):
    found = sequences(spark, d).select("doc_id", F.get(seq.orfs(F.col("q"), 30), F.lit(0)).alias("o"))
    return found.select("doc_id", "o.lend", "o.rend", "o.strand", "o.frame", "o.complete").where("lend IS NOT NULL")


@query()
def low_complexity_mask(spark, d):
    masked = sequences(spark, d).select("doc_id", F.length("q").alias("n"), seq.low_complexity(F.col("q")).alias("m"))
    return masked.select("doc_id", "n", F.length(F.regexp_replace("m", "[^N]", "")).alias("masked"))


@query(f"""WITH {SEQ}, f AS (SELECT doc_id, unnest([1, 2, 3]) AS frame, q FROM s), o AS (SELECT doc_id, frame, len(list_filter(list_transform(range(0, greatest(0, CAST((length(q) - frame + 1) // 3 AS BIGINT))), lambda i: substr(q, 3 * i + frame, 3)), lambda c: c IN ('TAA', 'TAG', 'TGA'))) AS stops FROM f)
SELECT doc_id, CAST(frame AS INT) AS frame, CAST(stops AS INT) AS stops FROM o""")
def stop_counts(spark, d):
    s = sequences(spark, d)
    each = [F.struct(F.lit(f).alias("frame"), F.length(F.regexp_replace(seq.translate(F.col("q"), f), "[^*]", "")).alias("stops")) for f in (1, 2, 3)]
    return s.select("doc_id", F.explode(F.array(*each)).alias("x")).select("doc_id", "x.frame", "x.stops")


@query()
def polycistronic_sequences(spark, d):
    return sequences(spark, d).select("doc_id", seq.polycistronic(F.col("q"), 60).alias("polycistronic"))


@query(f"""WITH {SEQ}, k AS (SELECT doc_id, lang, q, unnest(range(1, length(q) - 1)) AS p FROM s WHERE length(q) >= 3), x AS (SELECT doc_id, lang = 'en' AS en, p - 1 AS pos, substr(q, p, 3) AS kmer FROM k),
f AS (SELECT en, CAST(pos % 3 AS INT) AS frame, kmer, count(*) AS n FROM x GROUP BY ALL), c AS (SELECT frame, kmer, n, substr(kmer, 1, 2) AS head FROM f WHERE en), ch AS (SELECT frame, head, sum(n) AS nh FROM c GROUP BY frame, head),
b AS (SELECT kmer, substr(kmer, 1, 2) AS head, sum(n) AS bn FROM f WHERE NOT en GROUP BY kmer), bh AS (SELECT head, sum(bn) AS bh FROM b GROUP BY head),
r AS (SELECT c.frame, c.kmer, ln(((n + 1) / (nh + 1)) / ((coalesce(bn, 0) + 1) / (coalesce(bh, 0) + 1))) AS ratio FROM c JOIN ch USING (frame, head) LEFT JOIN b ON b.kmer = c.kmer LEFT JOIN bh ON bh.head = c.head),
y AS (SELECT doc_id, kmer, pos, unnest([0, 1, 2]) AS shift FROM x)
SELECT doc_id, CAST(shift + 1 AS INT) AS frame, round(sum(ratio), 5) AS score FROM y JOIN r ON r.kmer = y.kmer AND r.frame = (y.pos - y.shift) % 3 WHERE pos >= shift GROUP BY doc_id, shift""")
def frame_scores(spark, d):
    s = sequences(spark, d)
    ratios = seq.log_ratios(seq.framed_kmers(s.where("lang = 'en'"), "q", 3), seq.framed_kmers(s.where("lang <> 'en'"), "q", 3), 3)
    return seq.frame_scores(s, ratios, "doc_id", "q", 3).select("doc_id", "frame", F.round("score", 5).alias("score"))
