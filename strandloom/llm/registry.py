"""Training-data queries by name, each over its whole table, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.llm import likelihood
from strandloom.llm.chunks import substring_dedup
from strandloom.llm.lines import line_dedup
from strandloom.llm.merkle import folded, leaf, manifest, siblings
from strandloom.llm.packing import pack, token_pieces
from strandloom.llm.phrases import collocations
from strandloom.llm.pieces import encode
from strandloom.llm.quality import fit, is_held_out, predict
from strandloom.llm.simhash import near_groups
from strandloom.llm.suffixes import repeated_spans
from strandloom.llm.token_counts import token_counts
from strandloom.llm.topk import topk
from strandloom.llm.vectors import near_vectors

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def op1_packing(spark, d):
    docs = table(spark, d, "documents")
    pieces = token_pieces(docs, vocabulary("word_bpe_49k.json"), end_id=2, capacity=4096)
    pieces = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(pieces, 4096)


@query
def op7_token_counts(spark, d):
    counts = token_counts(table(spark, d, "documents"), vocabulary("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op2_simhash(spark, d):
    groups = near_groups(table(spark, d, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_pieces(spark, d):
    coded = encode(table(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_quality(spark, d):
    docs = table(spark, d, "documents")
    model = fit(docs, table(spark, d, "labels"), "quality", learn=~is_held_out())
    return predict(docs, model).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


@query
def op5_topk(spark, d):
    return topk(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLES["op5_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op3_line_dedup(spark, d):
    out = line_dedup(table(spark, d, "documents"))
    return out.select("doc_id", "text", F.col("__lines").cast("long").alias("n_lines"), F.col("__removed").cast("long").alias("n_removed"))


ORACLES["op3_line_dedup"] = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
raw AS (SELECT doc_id, unnest(parts) AS piece, generate_subscripts(parts, 1) AS i FROM split),
occ AS (SELECT doc_id, i, trim(piece) AS line FROM raw WHERE length(trim(piece)) >= 20),
ranked AS (SELECT *, row_number() OVER (ORDER BY doc_id, i) AS pos FROM occ),
firsts AS (SELECT line, min(pos) AS pos FROM ranked GROUP BY line),
variants AS (SELECT pos, place, hash(left(line, place - 1) || substr(line, place + 1)) AS rest
  FROM (SELECT pos, line, unnest(range(1, length(line) + 1)) AS place FROM firsts)),
swapped AS (SELECT pos, min(pos) OVER (PARTITION BY place, rest) AS other FROM variants),
grown AS (SELECT v.pos AS pos, w.pos AS other FROM variants v JOIN firsts w ON v.rest = hash(w.line)),
near AS (SELECT DISTINCT greatest(pos, other) AS pos FROM (FROM swapped UNION ALL FROM grown) WHERE pos <> other),
gone AS (SELECT r.doc_id, r.i FROM ranked r JOIN firsts f ON r.line = f.line WHERE r.pos <> f.pos OR f.pos IN (SELECT pos FROM near)),
kept AS (SELECT r.doc_id, string_agg(r.piece, chr(10) ORDER BY r.i) AS text FROM raw r ANTI JOIN gone g ON r.doc_id = g.doc_id AND r.i = g.i GROUP BY r.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN l.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text, CAST(len(s.parts) AS BIGINT) AS n_lines,
  CAST(coalesce(l.n, 0) AS BIGINT) AS n_removed
FROM documents d JOIN split s USING (doc_id) LEFT JOIN kept k USING (doc_id) LEFT JOIN lost l USING (doc_id)"""


@query
def op10_substring_dedup(spark, d):
    out = substring_dedup(table(spark, d, "documents"))
    return out.select("doc_id", "text", F.col("__bytes").alias("n_bytes"), F.col("__removed").alias("n_removed"))


@query
def op4_near_vectors(spark, d):
    return near_vectors(table(spark, d, "embeddings"))


ORACLES["op4_near_vectors"] = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(low.low, vec_id) AS component_id, coalesce(low.low, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id"""


@query
def op9_repeated_spans(spark, d):
    out = repeated_spans(table(spark, d, "documents"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("__kept")).alias("n_removed"),
        F.size("__spans").cast("long").alias("n_spans"),
        F.sha2("__kept", 256).alias("kept_sha256"),
        # what stays, as text: a run may begin or end inside a character, whose other bytes then read as U+FFFD
        F.when(F.size("__spans") == 0, F.col("text")).otherwise(F.make_valid_utf8(F.col("__kept").cast("string"))).alias("text"),
    )


@query
def op12_manifest(spark, d):
    docs = table(spark, d, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = F.when(tampered, leaf(*[lowered if c == "text" else F.col(c) for c in fields]))
    rows = manifest(docs, fields, carry={"changed": changed}).withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("steps")))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op13_quality_rules(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    third = F.crc32(F.col("doc_id").cast("string")) % 3  # 0 makes the target, 2 the threshold, 1 neither
    mark = F.when((third == 0) & (F.col("quality") == 1), likelihood.TARGET).when(third == 2, F.when(F.col("quality") == 1, likelihood.CLEAN).when(F.col("quality") == 0, likelihood.JUNK))
    model = likelihood.fit(docs, labels.select("doc_id", mark.alias("mark")))
    return likelihood.judged(docs, model).select("doc_id", *likelihood.COUNTS, "base_failed", "kept", "score")


def _manifest_sql(lower: int = 7, upper: int = 2) -> str:
    """Levels written out: enough for 8 ** lower rows of a group and 8 ** upper groups."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    crc = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::UBIGINT)),
      lambda a, c: list_reduce(list_prepend(xor(a, c), [k::UBIGINT FOR k IN range(8)]), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END::UBIGINT)))"""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [f"""rows AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS h, CASE WHEN xor({crc}, 4294967295::UBIGINT) % 3 = 0 THEN {leaf(lowered)} END AS t FROM documents)""",
           "langs AS (SELECT lang, CAST(count(*) AS BIGINT) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM rows GROUP BY lang)",
           "d AS MATERIALIZED (SELECT doc_id, h, t, g, n, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM rows JOIN langs ON rows.lang IS NOT DISTINCT FROM langs.lang)"]
    def levels(name: str, count: int) -> None:
        for k in range(count):
            near = lambda way: f"coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN {way}), '')"
            out.append(f"{name}{k}s AS (SELECT g, pos, n > 1 AS j, {near('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS b, {near('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS a FROM {name}{k})")
            out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT g, pos // 8 AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h FROM {name}{k} GROUP BY g, pos // 8, n)")
    out.append("l0 AS (SELECT g, pos, n, h FROM d)")
    levels("l", lower)
    out.append(f"u0 AS (SELECT 0 AS g, g AS pos, (SELECT count(*) FROM langs) AS n, h FROM l{lower})")
    levels("u", upper)
    steps = [(f"l{k}s", f"{{0}}.g = d.g AND {{0}}.pos = d.pos // {8**k}") for k in range(lower)] + [(f"u{k}s", f"{{0}}.pos = d.g // {8**k}") for k in range(upper)]
    joins = " ".join(f"JOIN {t} ON {on.format(t)}" for t, on in steps)
    path = "[" + ", ".join(f"{{'b': {t}.b, 'a': {t}.a, 'j': {t}.j}}" for t, _ in steps) + "]"
    out.append(f"p AS (SELECT d.doc_id, d.h AS leaf, coalesce(d.t, d.h) AS t, top.h AS subroot, {path} AS path FROM d {joins} JOIN l{lower} top ON top.g = d.g)")
    fold = "t"
    cols = []
    for i in range(len(steps)):
        cols.append(f"f{i} AS (SELECT *, CASE WHEN path[{i + 1}].j THEN sha256(path[{i + 1}].b || {fold} || path[{i + 1}].a) ELSE {fold} END AS t{i} FROM {'p' if not i else f'f{i - 1}'})")
        fold = f"t{i}"
    out += cols
    root = f"(SELECT h FROM u{upper})"
    return f"""WITH {', '.join(out)}
SELECT doc_id, leaf, subroot, {root} AS root, sha256(list_reduce(list_prepend('', list_transform(path, lambda s: s.b || s.a)), lambda x, y: x || y)) AS proof_sha256,
  {fold} AS folded_root, {fold} = {root} AS verified FROM f{len(steps) - 1}"""


ORACLES["op12_manifest"] = _manifest_sql()


@query
def op11_collocations(spark, d):
    return collocations(table(spark, d, "documents"))


ORACLES["op11_collocations"] = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda w: w <> '') AS w FROM texts),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM pieces, range(1, 4) AS t(m)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 10),
cuts AS (SELECT lang, phrase, a, w, unnest(range(1, len(w))) AS k FROM cand),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:len(c.w)], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE len(w) = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE len(w) = 3),
longer AS (SELECT lang, phrase, max(a) AS a FROM inside GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase WHERE g.a IS NULL OR 100 * g.a < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n.n AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
