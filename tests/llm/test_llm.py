"""Training-data operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strandloom.llm import chunks, hnsw, lines, merges, packing, pieces, quality, registry, simhash, suffixes, token_counts, topk, vectors, wordbpe

D = "/root/testdata/sf0.001"
WORDS, PIECES = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, fp string, at int, `__odd name` int"
LONG = "A long line of words that goes on and on. " * 3000
LINE = "this line is shared by many of the documents here"
ODD = [
    (1, None, "x", 1, 1), (2, "", "x", 1, 1), (3, LONG, "y", 2, 2), (4, f"{LINE}\nown words of four", "y", 2, 2), (5, f"{LINE}!\nown words of five", None, None, None),
    (5, f"{LINE}!\nown words of five", None, None, None), (None, LINE, "z", 3, 3), (6, " \n\t ", "z", 3, 3), (7, "ééé 日本語 <|endoftext|> \U0001f600", "z", 3, 3), (8, LONG, "w", 4, 4),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{D}/documents.parquet").to_pylist()}


def union_find(ids, links):
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def one_by_one(symbols, pairs):
    """The leftmost of the lowest-ranked pairs, again and again."""
    out = list(symbols)
    while True:
        found = [(pairs[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in pairs]
        if not found:
            return out
        i = min(found)[1]
        out[i : i + 2] = [pairs[tuple(out[i : i + 2])][1]]


@pytest.mark.parametrize("ranks", [[3, 1, 2, 0, 4], [0, 1, 2, 3, 4]])
def test_merging_equals_one_pair_at_a_time(ranks):
    rng = random.Random(1)
    left, right, merged = [0, 1, 3, 0, 4], [1, 0, 2, 0, 3], [3, 4, 5, 6, 7]
    table = merges.PairTable(left, right, ranks, merged)
    pairs = {(a, b): (r, m) for a, b, r, m in zip(left, right, ranks, merged)}
    assert table.safe[table.find(np.array([0]), np.array([1]))[0]] == (ranks[0] == 0)
    words = [[rng.randrange(3) for _ in range(rng.randrange(1, 40))] for _ in range(300)]
    want = [one_by_one(w, pairs) for w in words]
    flat = np.array([s for w in words for s in w])
    starts = np.cumsum([0] + [len(w) for w in words[:-1]])
    for long in (10, 10_000):
        sym, at = merges.merge_ragged(flat, starts, table, batch=200, long=long)
        assert [x.tolist() for x in np.split(sym, at[1:])] == want


def test_words_equal_library(texts):
    coder = wordbpe.WordBpe(WORDS)
    odd = [r[1] or "" for r in ODD] + ["ΣΑΣ İ", "a\x1cb\x85c\xa0d", "x" * 5000, "it's WE'LL 12½", "\x00", "J̌ é"]
    for t in [*texts.values(), *odd]:
        assert np.frombuffer(coder.encode([t])[0], "<u4").tolist() == coder.library.encode(t, add_special_tokens=False).ids


def test_token_counts(spark, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    got = sorted(map(tuple, token_counts.token_counts(odd, WORDS).collect()), key=repr)
    assert got == sorted(((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in ODD), key=repr)
    assert token_counts.token_counts(none, WORDS).count() == 0


def test_best_fit_decreasing():
    rng = random.Random(3)
    for capacity in (7, 64, 100):
        sizes = np.array([rng.randrange(1, capacity + 1) for _ in range(300)])
        window, offset = packing.best_fit_decreasing(sizes, capacity)
        room, want = [], np.zeros(len(sizes), int)
        for i in np.argsort(-sizes, kind="stable"):
            fits = [r for r in room if r >= sizes[i]]
            if fits:
                room[room.index(min(fits))] -= sizes[i]
            else:
                room.append(capacity - sizes[i])
        del want
        assert sorted(capacity - np.bincount(window, weights=sizes).astype(int)) == sorted(room)
        for w in range(window.max() + 1):
            at = np.flatnonzero(window == w)
            at = at[np.argsort(offset[at])]
            assert offset[at].tolist() == (np.cumsum(sizes[at]) - sizes[at]).tolist()


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        ids = [*library.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            raw = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(raw))
            at += r["length"]
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096


def test_packing(spark, odd, none, texts):
    check_packing(registry.op1_packing(spark, D).collect(), texts)
    p = packing.pack(packing.token_pieces(odd, WORDS, 2)).collect()
    assert sum(r["length"] for r in p if r["start"] == 0 and r["doc_id"] is None) > 0 and len({(r["sequence_id"], r["offset"]) for r in p}) == len(p)
    assert packing.pack(packing.token_pieces(none, WORDS, 2)).count() == 0


def test_packing_of_one_id(spark, monkeypatch):
    """Rests of null ids are dealt like any others, and a document of many windows needs no packing."""
    monkeypatch.setattr(packing, "GROUP_ROWS", 16)
    df = spark.range(200).selectExpr("cast(null as long) AS doc_id", "concat('w', id) AS text")
    df = df.unionByName(spark.createDataFrame([(7, "a b c " * 20000)], "doc_id long, text string"))
    rows = packing.pack(packing.token_pieces(df, WORDS, 2)).collect()
    assert len({r.sequence_id for r in rows if r.length == 4096}) == sum(r.length == 4096 for r in rows) > 10
    assert len({r.sequence_id >> 32 for r in rows if r.doc_id is None}) > 8
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_simhash(spark, odd, none, texts):
    import re

    import xxhash

    def brute(s):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = {i: brute(t) for i, t in texts.items()}
    ids = sorted(fps)
    comp = union_find(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.op2_simhash(spark, D).collect()}
    assert got == {i: (f"{fps[i]:016x}", comp[i]) for i in ids}
    rows = simhash.near_groups(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 6)} == {1}  # no words: fingerprint 0
    assert {r.component_id for r in rows if r.doc_id in (3, 8)} == {3}
    assert simhash.near_groups(none).count() == 0


def test_simhash_links_lose_nothing(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    some = set(base)
    for b in base:
        for _ in range(6):
            x = b
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << bit
            some.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in some], "fp long")
    got = [tuple(r) for r in simhash.links(df).collect()]
    want = {(a, b) for a in map(signed, some) for b in map(signed, some) if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert len(got) == len(set(got)) and set(got) == want


def word_sets(text):
    words = text.lower().split()
    k = min(5, len(words))
    return {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


def test_similar_groups_keep_to_exact_similarity(spark):
    rng = random.Random(9)
    rows, i = [(0, None), (1, " ")], 2
    for _ in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        rows.append((i, " ".join(words)))
        for changed in (2, 5, 7, 12):  # five shingles each: similarity about 0.95, 0.88, 0.84 and 0.74
            copy = list(words)
            for k in range(changed):
                copy[10 + 30 * k] = f"x{rng.randrange(10**6)}"
            rows.append((i + changed, " ".join(copy)))
        i += 20
    rows += [(5000 + k, f"{' '.join(f'hot{j}' for j in range(200))} end{k}") for k in range(60)]
    sets = {k: word_sets(t or "") for k, t in rows}
    similar = lambda a, b: (len(a & b) >= 0.8 * len(a | b))
    want = union_find(sorted(sets), [(a, b) for a in sets for b in sets if a < b and similar(sets[a], sets[b])])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.similar_groups(df).collect()} == want
    assert {r.doc_id: r.component_id for r in simhash.near_groups(df).collect()} != want
    assert simhash.similar_groups(df.where("doc_id < 0")).count() == 0


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_lines(rows, min_chars=20):
    """rows of (id, text) in order; the texts without their later lines."""
    seen, out = [], {}
    for i, text in rows:
        kept, all_ = [], (text or "").split("\n")
        for x in all_:
            t = x.strip(" ")
            if len(t) >= min_chars:
                if any(within_one(t, s) for s in seen):
                    seen.append(t)
                    continue
                seen.append(t)
            kept.append(x)
        out[i] = text if len(kept) == len(all_) else "\n".join(kept)
    return out


def test_lines(spark, odd, none):
    rng = random.Random(7)
    alphabet = "abcde é"
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(19, 45))) for _ in range(25)]

    def vary(x):
        k, c = rng.randrange(len(x)), rng.choice(alphabet)
        return rng.choice([x, x[:k] + c + x[k:], x[:k] + x[k + 1 :], x[:k] + c + x[k + 1 :], x[:k] + c + c + x[k + 2 :], "short"])

    rows = [(i, "\n".join(vary(rng.choice(pool)) for _ in range(rng.randrange(1, 6)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.line_dedup(docs).collect()} == brute_lines(rows)
    got = lines.line_dedup(odd).collect()
    assert len(got) == len(ODD) and got[0].asDict().keys() >= {"fp", "at", "__odd name"}
    by = {r.doc_id: r for r in got}
    assert by[None].text == LINE and by[4].text == "own words of four" and by[5].text == "own words of five" and by[1].text is None
    assert sum(r.doc_id == 5 and r["__removed"] == 1 for r in got) == 2
    assert by[8].text == "" and by[3].text == LONG
    assert lines.line_dedup(none).count() == 0


CLASHING = ("__k", "__th", "__gone", "__lines", "__removed", "__bytes", "__spans", "__kept", "k", "th", "at", "text_", "gone", "c0", "id")


@pytest.mark.parametrize("operator", [lines.line_dedup, chunks.substring_dedup, suffixes.repeated_spans])
def test_columns_of_any_name_and_type_stay(spark, operator):
    long = "some words that repeat in both of these documents and go on " * 20
    extra = ", ".join(f"`{c}` long" for c in CLASHING)
    rows = [(i, f"line number {i} of its own in here\n{long}", *range(7, 7 + len(CLASHING)), {"a": i}, [{"b": None}]) for i in (1, 2)]
    df = spark.createDataFrame(rows, f"doc_id long, text string, {extra}, m map<string, long>, n array<map<string, long>>")
    got = operator(df)
    assert got.columns[: len(df.columns)] == df.columns and len({c.lower() for c in got.columns}) == len(got.columns) == len(df.columns) + 2
    kept = [c for c in df.columns if c != "text"]
    assert sorted(got.select(*kept).collect(), key=repr) == sorted(df.select(*kept).collect(), key=repr)


@pytest.mark.parametrize("operator", [lines.line_dedup, chunks.substring_dedup, suffixes.repeated_spans])
def test_many_null_ids(spark, operator):
    """12,000 rows of one (null) id are told apart like any others: no list of a row holds what belongs to another."""
    text = F.concat(F.lit("a line that they all share, long enough for every operator " * 8 + "\n"), F.sha2(F.col("id").cast("string"), 256))
    df = spark.range(12_000).select(F.lit(None).cast("long").alias("doc_id"), text.alias("text"), F.col("id").alias("n"))
    more = [c for c in operator(df.limit(0)).columns if c not in df.columns]
    got = {r.n: tuple(r)[1:] for r in operator(df).select("n", "text", *more).collect()}
    assert len(got) == 12_000
    named = {r.n: tuple(r)[1:] for r in operator(df.withColumn("doc_id", F.xxhash64("text"))).select("n", "text", *more).collect()}
    differ = [n for n in got if got[n] != named[n]]
    # the first by its order keeps its copy: another one without ids; of chunks that reach into the digests a few repeat as well
    assert len(differ) <= (600 if operator is chunks.substring_dedup else 2)


def test_lines_of_a_megabyte(spark):
    rng = random.Random(12)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_000_000)) + "x"
    at = 123_456
    rows = [(1, long), (2, f"kept\n{long[:at]}#{long[at + 1 :]}"), (3, f"{long[:at]}{long[at + 1 :]}\nalso kept"), (4, long[: 2 * at] + "##" + long[2 * at + 2 :])]
    got = {r.doc_id: r.text for r in lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: long, 2: "kept", 3: "also kept", 4: rows[3][1]}


def test_registered_text_queries(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    n = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in texts.items()}
    assert {tuple(r) for r in registry.op7_token_counts(spark, D).collect()} == {(i, len((t or "").encode()), n[i], n[i] > 2048) for i, t in texts.items()}
    want = brute_repeats([(t or "").encode() for _, t in sorted(texts.items())], 400)
    for r in registry.op9_repeated_spans(spark, D).collect():
        kept, spans = want[sorted(texts).index(r.doc_id)]
        size = len((texts[r.doc_id] or "").encode())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (size, size - len(kept), spans, hashlib.sha256(kept).hexdigest())
        assert r.text == (texts[r.doc_id] if not spans else r.text) and (spans == 0 or "\ufffd" in r.text or r.text.encode() == kept)
    rows = {r.doc_id: r for r in registry.op8_quality(spark, D).collect()}
    assert set(rows) == set(texts) and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for i, r in rows.items())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    df = registry.QUERIES[name](spark, D)
    cols = sorted(df.columns)
    rel = con.execute(registry.ORACLES[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == cols
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=repr) == want


def test_boundaries_follow_content():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh é") for _ in range(6000)).encode()
    cuts = chunks.boundaries(text)
    assert cuts[0] == 0 and cuts[-1] == len(text) and all(b - a <= chunks.MOST + 3 for a, b in zip(cuts, cuts[1:]))
    assert all(text[a:b].decode() for a, b in zip(cuts, cuts[1:]))
    shifted = chunks.boundaries(b"inserted " + text)
    assert len({c - 9 for c in shifted} & set(cuts)) > 0.8 * len(cuts)
    assert chunks.boundaries(b"") == [0] and chunks.boundaries(b"abc") == [0, 3]
    h = np.frombuffer(text, np.uint8)
    slow = []
    for i in range(32, len(text) + 1):
        v = 0
        for b in text[i - 32 : i]:
            v = ((v << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        if v >> 27 == 0:
            slow.append(i)
    assert chunks.gear_hits(h).tolist() == slow


def test_chunks_agree_where_no_hash_ends_one(spark):
    rng = random.Random(3)
    plain = []
    while len(plain) < 12:  # passages of 51 words without a gear hit
        t = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(51))
        for _ in range(2000):
            found = chunks.gear_hits(np.frombuffer(t.encode(), np.uint8))
            if not len(found):
                break
            i = int(found[0]) - 2
            t = t[:i] + (rng.choice("abcdefgh") if t[i] != " " else " ") + t[i + 1 :]
            i = max(0, i - rng.randrange(12))
            t = t[:i] + (rng.choice("abcdefgh") if t[i] != " " else " ") + t[i + 1 :]
        else:
            continue
        plain.append(t)
    plain.append(" ".join(["be"] * 80))
    word = lambda: "".join(rng.choice("klmnopqrst") for _ in range(7))
    rows = []
    for k, t in enumerate(plain):
        for copy in range(2):
            around = [" ".join(word() for _ in range(rng.randrange(10, 40))) for _ in range(2)]
            rows.append((2 * k + copy, f"{around[0]} {t} {around[1]}"))
    out = chunks.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = {r.doc_id: r.text for r in out}
    assert [k for k, t in enumerate(plain) if t in left[2 * k + 1]] == []


def brute_chunks(rows):
    seen, out = set(), {}
    for i, text in rows:
        data = (text or "").encode()
        cuts = chunks.boundaries(data)
        again = [(a, b) for a, b in zip(cuts, cuts[1:]) if data[a:b] in seen or seen.add(data[a:b])]
        for a, b in chunks.runs([a for a, _ in again], [b for _, b in again], chunks.MIN_RUN)[::-1]:
            data = data[:a] + data[b:]
        out[i] = text and data.decode()
    return out


def test_chunks(spark, odd, none, texts):
    got = {r.doc_id: r.text for r in registry.op10_substring_dedup(spark, D).collect()}
    assert got == brute_chunks(sorted(texts.items()))
    rows = chunks.substring_dedup(odd).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and by[1].text is None and by[8].text == "" and by[8]["__removed"] == len(LONG)
    assert chunks.substring_dedup(none).count() == 0


def test_suffix_array():
    rng = random.Random(3)
    for k in range(300):
        b = bytes(rng.choice(b"ab" if k % 2 else b"abcdef\0") for _ in range(rng.randrange(1, 200)))
        assert suffixes.two_stage(np.frombuffer(b, np.uint8), 1000).tolist() == sorted(range(len(b)), key=lambda i: b[i:])


def brute_repeats(data, width):
    starts = Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        gone, upto = bytearray(len(b)), 0
        for i in range(len(b) - width + 1):
            if starts[b[i : i + width]] > 1:
                gone[max(i, upto) : i + width] = b"\1" * (i + width - max(i, upto))
                upto = i + width
        out.append((bytes(x for x, g in zip(b, gone) if not g), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))))
    return out


@pytest.mark.parametrize("largest", [1 << 22, 1])
def test_repeated_spans(spark, none, largest, monkeypatch):
    rng = random.Random(largest)
    monkeypatch.setattr(suffixes, "LARGEST", largest)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    passage = [" ".join(word() for _ in range(rng.randrange(60, 200))) for _ in range(4)]
    rows = [(None, None), (0, ""), (1, "ab" * 900), (2, "c" * 399), (3, "c" * 400), (4, "c" * 401), (5, passage[0])]
    for i in range(6, 40):
        rows.append((i, " ".join([word() for _ in range(rng.randrange(80))] + [rng.choice(passage)] * (i % 3) + [word() for _ in range(rng.randrange(80))])))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, at int")
    got = {r.doc_id: (bytes(r["__kept"]), len(r["__spans"])) for r in suffixes.repeated_spans(docs).collect()}
    want = brute_repeats([(t or "").encode() for _, t in rows], 400)
    assert got == {i: w for (i, _), w in zip(rows, want)}
    assert suffixes.repeated_spans(none).count() == 0


def test_repeated_spans_odd(spark, odd):
    got = suffixes.repeated_spans(odd).collect()
    want = brute_repeats([(r[1] or "").encode() for r in ODD], 400)
    assert got[0].asDict().keys() >= {"doc_id", "text", "fp", "at", "__odd name", "__kept", "__spans"}
    assert sorted(((r["doc_id"], bytes(r["__kept"]), len(r["__spans"])) for r in got), key=repr) == sorted(((r[0], *w) for r, w in zip(ODD, want)), key=repr)


def test_unbroken_words(spark):
    """Texts of one long word, and of a megabyte, through the coders in Spark."""
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["x" * 200_000, "ab" * 60_000, "日本" * 20_000, "words and more words. " * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library, piece = Tokenizer.from_file(WORDS), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, WORDS).collect()} == {i: len(x) for i, x in ids.items()}
    assert {r["doc_id"]: list(r["ids"]) for r in pieces.encode(docs, PIECES).collect()} == {i: piece.encode(t) for i, t in enumerate(texts)}
    held = {}
    for r in packing.token_pieces(docs, WORDS, end_id=2, capacity=4096).collect():
        held.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    assert {i: [x for _, part in sorted(p) for x in part] for i, p in held.items()} == {i: [*x, 2] for i, x in ids.items()}


def test_pieces_equal_library(texts):
    import sentencepiece

    coder, library = pieces.PieceBpe(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    odd = ["", " ", "  x  y\t\n\n  ", "<s> </s>", "日本語 \U0001f600", "a▁b ▁▁ c", "x" * 5000, "    " * 30, "a\0b", "word▁"]
    for t in [*texts.values(), *odd]:
        ids, starts, ends = coder.encode([t])[0]
        assert ids.tolist() == library.encode(t) and coder.decode(ids) == library.decode(ids.tolist())
        assert (starts[1:] >= starts[:-1]).all() and (not len(ends) or ends[-1] == len(t.encode()))
        if t.isascii():
            assert list(zip(starts.tolist(), ends.tolist())) == [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]


def test_character_map_finds_the_longest_prefix():
    """A double array of the keys a -> x and ab -> yz, laid out by hand."""
    import struct

    units = [0] * 600
    root, end = 256, 300
    put = lambda at, label, offset, leaf: units.__setitem__(at, label | leaf << 8 | (at ^ offset) << 10)
    units[0] = root << 10
    put(root ^ ord("a"), ord("a"), 400, 1)
    units[400] = 0 | 1 << 31
    put(400 ^ ord("b"), ord("b"), 516, 1)
    units[516] = 2 | 1 << 31
    del end
    trie = struct.pack("<600I", *units)
    m = pieces.CharacterMap(struct.pack("<I", len(trie)) + trie + b"x\0yz\0")
    assert m.longest(b"abc", 0) == (b"yz", 2) and m.longest(b"ac", 0) == (b"x", 1) and m.longest(b"ca", 0) is None and m.longest(b"ca", 1) == (b"x", 1)
    coder = pieces.PieceBpe(PIECES)
    coder.map = m
    text, source = coder.normalise("abca")
    assert text == "▁yzcx" and source.tolist() == [0, 0, 0, 0, 0, 2, 3, 4]


def test_pieces(spark, odd, none, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in registry.op6_pieces(spark, D).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert {(r.doc_id, len(r.ids)) for r in pieces.encode(odd, PIECES).collect()} == {(r[0], len(library.encode(r[1] or ""))) for r in ODD}
    assert pieces.encode(none, PIECES).count() == 0


def test_quality(spark, odd, none):
    big = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels, "quality", learn=~quality.is_held_out())
    judged = quality.predict(docs, model).join(labels, "doc_id").where(quality.is_held_out())
    right, n = judged.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 50 and right >= 0.95
    rows = quality.predict(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality.predict(none, model).count() == 0
    assert quality.fit(none, labels, "quality").rules == ()
    assert len(quality.text_statistics("")) == len(quality.STATS)


def test_quality_learns_from_no_held_out_label(spark):
    docs, labels = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r.doc_id: r.score for r in quality.predict(docs, quality.fit(docs, x, "quality", learn=~quality.is_held_out())).collect()} for x in (labels, flipped)]
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 1


VECS = "vec_id long, embedding array<double>, score int"


def test_topk(spark):
    rng = np.random.default_rng(4)
    v = np.floor(rng.normal(size=(150, 6)) * 2) / 4
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    odd_rows = [(150, None, 0), (200, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (250, [float("nan")] * 6, 0), (None, [1.0] * 6, 0), (301, [1.0, 2.0], 0), (302, [], 0)]
    df = spark.createDataFrame(rows + odd_rows, VECS)
    q = np.floor(v * 256).astype(int)
    want = set()
    for i in range(0, 150, 50):
        best = sorted((-int(q[i] @ q[j]), j) for j in range(150) if j != i)[:5]
        want |= {(i, r, j, -s) for r, (s, j) in enumerate(best, 1)}
    for n in (None, 3, 40):
        assert {tuple(r) for r in topk.topk(df, F.col("vec_id") % 50 == 0, 5, shards=n).collect()} == want
    assert topk.topk(df.where("vec_id < 0"), F.lit(True), 5).count() == 0
    few = topk.topk(df.where("vec_id < 3"), F.col("vec_id") == 0, 5).collect()
    assert [r.rank for r in few] == [1, 2]
    huge = np.array([[2**31, 2**31 - 1]])
    assert topk.tile_topk(np.array([0]), huge, np.array([1]), huge - 1, 1)[2].tolist() == [int(huge[0, 0]) * (2**31 - 1) + (2**31 - 1) * (2**31 - 2)]


def test_hnsw_recall():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 24))
    x = np.concatenate([base + rng.normal(size=base.shape) * 0.05 for _ in range(8)] + [base[:1] + rng.normal(size=(400, 24)) * 0.03])
    x = vectors.unit(x).astype(np.float32)
    index = hnsw.Hnsw.load(hnsw.Hnsw(x).dump())
    a, b = hnsw.above(index, x, 0.9)
    want = np.argwhere(x @ x.T >= 0.9)
    assert len(set(zip(a.tolist(), b.tolist())) & set(map(tuple, want.tolist()))) >= 0.95 * len(want)


def brute_links(v):
    u = vectors.unit(v)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    comp = union_find(range(len(v)), [(int(a), int(b)) for a, b in np.argwhere(link) if a < b])
    return {i: (int(link[i].sum()), comp[i], comp[i] == i) for i in range(len(v))}


@pytest.mark.parametrize("shards", [None, 3])
def test_near_vectors(spark, shards):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    v = np.concatenate([base, base + rng.normal(size=base.shape) * 0.15, base[:5]])
    rows = [(i, x.tolist(), 7) for i, x in enumerate(v)]
    odd_rows = [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("inf")] * 8, 0), (903, [], 0), (904, [None] * 8, 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame(rows + odd_rows, VECS)
    got = {r.vec_id: tuple(r)[1:] for r in vectors.near_vectors(df, shards=shards).collect()}
    assert {i: got[i] for i in range(len(v))} == brute_links(v)
    assert all(got[i] == (0, i, True) for i in range(900, 905)) and got[None] == (0, None, False)
    assert vectors.near_vectors(df.where("vec_id < 0")).count() == 0


def test_near_vectors_of_a_hot_group(spark):
    """Half of the rows are near each other; many shards; every link of every vector is asked for in graphs."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 16))
    v = np.concatenate([base[i : i + 1] + rng.normal(size=(5, 16)) * 0.05 for i in range(300)] + [base[:1] + rng.normal(size=(1500, 16)) * 0.05])
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], VECS)
    want = brute_links(v)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df, shards=2).collect()}
    assert sum(got[i][0] for i in want) >= 0.99 * sum(w[0] for w in want.values()) and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_near_vectors_emits_no_pair_per_link(spark):
    v = np.random.default_rng(3).normal(size=(1, 8)) + np.random.default_rng(4).normal(size=(600, 8)) * 0.01
    df = spark.createDataFrame([(i, 1, x.tolist()) for i, x in enumerate(v)], "id long, n long, v array<double>")
    assert vectors.links(df.coalesce(1), shards=1, streams=1).count() <= 3 * 600  # two blocks; of 359,400 half-links


def test_registered_vector_queries(spark):
    t = pq.read_table(f"{D}/embeddings.parquet").to_pydict()
    v = np.array(t["embedding"], np.float64)
    assert t["vec_id"] == list(range(len(v)))
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in registry.op4_near_vectors(spark, D).collect()} == brute_links(v)
    q = np.floor(v * 256).astype(int)
    want = {(i, r, j, -s) for i in range(0, len(v), 50) for r, (s, j) in enumerate(sorted((-int(q[i] @ q[j]), j) for j in range(len(v)) if j != i)[:5], 1)}
    assert {tuple(r) for r in registry.op5_topk(spark, D).collect()} == want


def test_pipeline_against_brute_force(spark, texts):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{D}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{D}/labels.parquet"), "quality", learn=~quality.is_held_out())

    def good(t):
        s = quality.text_statistics(t or "")
        total = model.intercept + sum(w for w, r in model.rules if all(lo < s[f] <= hi for f, lo, hi in r))
        return total >= 0

    kept = [(i, t) for i, t in sorted(texts.items()) if good(t)]
    kept = list(brute_lines(kept).items())
    sets = {i: word_sets(t or "") for i, t in kept}
    comp = union_find(sorted(sets), [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    kept = [(i, t) for i, t in kept if comp[i] == i]
    want = brute_chunks(kept)
    got = docs
    for _, stage in cp.STAGES[:-1]:
        got = stage(spark, got, D)
        assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == want
    check_packing(cp.run(spark, D).collect(), want)


def test_pipeline_stages_on_odd_rows(spark, odd, none):
    import corpus_pipeline as cp

    for df in (odd, none):
        for _, stage in cp.STAGES[1:]:
            out = stage(spark, df, D)
            assert out.count() >= 0
            if stage is not cp.packing:
                assert out.columns == df.columns
        assert cp.quality(spark, df, D).columns == df.columns
    assert sum(r.doc_id is None for r in cp.near_duplicates(spark, odd, D).collect()) == 1
