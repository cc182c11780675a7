"""Collocations, Merkle manifests and likelihood rules against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strandloom.llm import likelihood, merkle, phrases, registry, transducers
from tests.llm.test_llm import LONG, ODD

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, at int, `__odd name` int"


@pytest.fixture(scope="module")
def odd(spark):
    langs = [None, "und", "a", "a", "b", "b", "a", "a", "c", "b"]
    return spark.createDataFrame([(r[0], r[1], lang, r[3], r[4]) for r, lang in zip(ODD, langs)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# collocations


def grams_of(text, longest):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
        words = [w for w in re.split(r"[\x20\x09]", piece) if w]
        for n in range(1, longest + 1):
            for i in range(len(words) - n + 1):
                yield tuple(words[i : i + n])


def collocations_by_hand(rows, longest, least, share, top):
    f = {}
    for lang, text in rows:
        f.setdefault(lang or "und", Counter()).update(grams_of(text or "", longest))
    out = []
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        candidates = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in candidates.items():
            score, _, left, right = min((1000000 * a * a // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            inside = any(len(h) > len(g) and 100 * b >= share * a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in candidates.items())
            if not inside:
                found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def made_texts(rng, n):
    words = ["a", "b", "Bb", "c", "é", "d\x01", "\x1cx", "日本", "to", "be"]
    return [(rng.choice(["x", "y", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", "  "]) for _ in range(rng.randrange(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize(("longest", "batch", "held", "asked"), [(3, 4 << 20, 1_500_000, 50_000), (3, 50, 40, 3), (4, 300, 100, 5), (2, 50, 10, 1)])
def test_collocations(spark, monkeypatch, longest, batch, held, asked):
    # shards of a few words, ranges of a few hundred bytes: the same result
    for name, value in (("BATCH", batch), ("HELD", held), ("ASKED", asked), ("EVERY", 7)):
        monkeypatch.setattr(phrases, name, value)
    rows = made_texts(random.Random(longest), 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrases.collocations(docs, max_words=longest, min_count=4, top=30, range_bytes=1000 if batch < 1000 else 8 << 20)
    assert sorted(map(tuple, got.collect())) == collocations_by_hand(rows, longest, 4, 50, 30)


def test_collocations_odd(spark, odd, none):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert sorted(map(tuple, phrases.collocations(odd, min_count=2).collect())) == collocations_by_hand(rows, 3, 2, 50, 2000)
    assert phrases.collocations(none).count() == 0
    long = spark.createDataFrame([("x", "one two three. " * 200_000), ("x", "z" * 1_000_000)], "lang string, text string")
    assert sorted(map(tuple, phrases.collocations(long).collect())) == [("x", 1, "one two three", 200_000, 200_000, 200_000, 600_001, 1_000_000)]


def test_registered_collocations(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    got = registry.op11_collocations(spark, D)
    want = con.execute(registry.ORACLES["op11_collocations"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_transducers():
    rng = random.Random(5)
    words = [b"a", b"b", b"c", b"d"]
    counts = [Counter(tuple(rng.randrange(1, 5) for _ in range(rng.randrange(1, 4))) for _ in range(200)) for _ in range(3)]
    parts = []
    for c in counts:
        grams = sorted(c)
        columns = [np.array([g[k] if k < len(g) else 0 for g in grams], np.int32) for k in range(3)]
        t = transducers.built(words, columns, np.array([c[g] for g in grams]))
        parts.append(transducers.Transducer.unpacked(*t.packed()))
        states = [t.arcs[a:b].tobytes() for a, b in zip(t.begin, t.begin[1:])]
        assert len(set(states)) == len(states)  # the least automaton: no two states are alike
        # block by block gives the same
        builder = transducers.Builder(words)
        for first in (1, 2, 3, 4):
            at = columns[0] == first
            builder.add([x[at] for x in columns], np.array([c[g] for g in grams])[at])
        other = builder.finish()
        as_set = lambda x: {(*g, w) for *g, w in zip(*x.ngrams(3)[0], x.ngrams(3)[1])}
        assert len(other.begin) == len(t.begin) and as_set(other) == as_set(t) == {(*(g + (0, 0))[:3], w) for g, w in c.items()}
    total = sum(counts, Counter())
    columns, weights = transducers.union(parts, 3, 2).ngrams(3)
    assert {tuple(i for i in g if i): w for *g, w in zip(*columns, weights)} == {g: w for g, w in total.items() if w >= 2}
    asked = [np.array([1, 1, 3]), np.array([0, 2, 3]), np.array([0, 4, 0])]
    questions = transducers.built([b"a", b"b", b"zz", b"d"], [a.astype(np.int32) for a in asked], np.ones(3, np.int64))
    columns, weights = transducers.compose(questions, transducers.union(parts, 3), 3)
    named = {tuple(questions.words[i - 1] for i in g if i): w for *g, w in zip(*columns, weights)}
    assert named == {g: total[tuple(words.index(w) + 1 for w in g)] for g in [(b"a",), (b"a", b"b", b"d")] if total[tuple(words.index(w) + 1 for w in g)]}


# manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def proof(levels, i):
    for level in levels[:-1]:
        run = level[i - i % 8 : i - i % 8 + 8]
        yield run[: i % 8], run[i % 8 + 1 :]
        i //= 8


def leaf_of(row, fields):
    return digest(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in fields))


def check_manifest(rows, got, fields, changed=lambda r: r):
    """Of rows that differ in their order column within a group."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, fields)))
        trees[g] = tree([leaf_of(r, fields) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    want = []
    for at, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = [*proof(trees[g], i), *proof(top, at)]
            h = leaf_of(changed(r), fields)
            for before, after in steps:
                h = digest(*before, h, *after)
            want.append((r["doc_id"], leaf_of(r, fields), trees[g][-1][0], top[-1][0], digest(*(x for b, a in steps for x in b + a)), h, h == top[-1][0]))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_registered_manifest(spark):
    rows = pq.read_table(f"{D}/documents.parquet").to_pylist()

    def changed(r):
        if r["text"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 3:
            return r
        return r | {"text": re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])}

    got = [tuple(r) for r in registry.op12_manifest(spark, D).collect()]
    check_manifest(rows, got, ["doc_id", "source", "lang", "n_chars", "text"], changed)


def test_registered_manifest_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    want = con.execute(registry.ORACLES["op12_manifest"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, registry.op12_manifest(spark, D).select(*names).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 2, 3, 1, 1, 1, 1, 1, 1], [600, 513, 1], [4097]])
def test_manifest(spark, sizes):
    # groups at and beyond a run, a block and a block's blocks
    rows = [{"lang": f"l{g}" if g else None, "doc_id": i * 7 % 10007 if i else None, "text": f"t{i}" if i % 5 else None} for g, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(r["lang"], r["doc_id"], r["text"]) for r in rows], "lang string, doc_id long, text string")
    out = merkle.manifest(df, ["doc_id", "text"], carry={"folded_root": F.lit(1)})
    got = out.select("id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("steps")), 256), merkle.folded(F.col("leaf"), F.col("steps")).alias("f"), F.col("root") == merkle.folded(F.col("leaf"), F.col("steps")))
    check_manifest(rows, [tuple(r) for r in got.collect()], ["doc_id", "text"])


def test_manifest_odd(spark, odd, none):
    fields = ["doc_id", "text", "at", "__odd name"]
    out = merkle.manifest(odd, fields)
    got = out.select("id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("steps")), 256), merkle.folded(F.col("leaf"), F.col("steps")).alias("f"), F.lit(True))
    check_manifest([r.asDict() for r in odd.collect()], [tuple(r) for r in got.collect()], fields)
    assert merkle.manifest(none, fields).count() == 0


# likelihood


def counts_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_text_counts():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab #\n\t\v\x1c\x85 é|\r") for _ in range(rng.randrange(150))) for _ in range(800)]
    texts += [r[1] or "" for r in ODD] + ["x" * 1_000_000, "a b c d e " * 100_000]
    for t in texts:
        assert likelihood.text_counts(t) == counts_by_hand(t)


def test_ratios_and_verdicts_by_hand(spark):
    rows = pq.read_table(f"{D}/documents.parquet").to_pylist()
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string").repartition(3)
    marks = {r["doc_id"]: r["doc_id"] % 4 for r in rows}
    df = spark.createDataFrame([(i, m) for i, m in marks.items() if m] + [(None, 1)], "doc_id long, mark int")
    model = likelihood.fit(docs, df, bits=10)
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(likelihood.ngrams(r["text"], 10).tolist())
        if marks[r["doc_id"]] == likelihood.TARGET:
            target.update(likelihood.ngrams(r["text"], 10).tolist())
    ratios = [math.log((target[b] + 1) / (target.total() + 1024)) - math.log((raw[b] + 1) / (raw.total() + 1024)) for b in range(1024)]
    assert np.allclose(model.ratios, ratios, atol=1e-5)
    bins, scores = {}, {}
    for r in rows:
        at = likelihood.ngrams(r["text"], 10)
        scores[r["doc_id"]] = s = float(model.ratios[at].mean(dtype=np.float64)) if len(at) else 0.0
        n, *_, again = counts_by_hand(r["text"])
        if n >= 10 and 100 * again <= 20 * n and marks[r["doc_id"]] > 1:
            bins.setdefault(math.floor(s * 256), Counter())[marks[r["doc_id"]]] += 1
    gain = lambda cut: 4.0 * sum(c[2] for b, c in bins.items() if b >= cut) / sum(c[2] for c in bins.values()) - sum(c[3] for b, c in bins.items() if b >= cut) / sum(c[3] for c in bins.values())
    assert gain(model.cut) == pytest.approx(max(gain(c) for c in range(min(bins), max(bins) + 2)))
    for r in likelihood.judged(docs, model).collect():
        text = next(x["text"] for x in rows if x["doc_id"] == r["doc_id"])
        c = counts_by_hand(text)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        assert tuple(r)[1:6] == c and r["base_failed"] == failed
        assert r["kept"] == (not failed and math.floor(scores[r["doc_id"]] * 256) >= model.cut)


def test_marks_beyond_a_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    marks = docs.select("doc_id", (F.col("doc_id") % 4).cast("int").alias("mark")).where("mark > 0")
    one = likelihood.fit(docs, marks)
    monkeypatch.setattr(likelihood, "MARKED", 3)
    other = likelihood.fit(docs, marks)
    assert (one.bits, one.cut) == (other.bits, other.cut) and np.array_equal(one.ratios, other.ratios)


def test_registered_quality_rules_hold_out(spark):
    at = D.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{at}/labels.parquet").to_pylist()}
    rows = [r for r in registry.op13_quality_rules(spark, at).collect() if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and not r["base_failed"]]
    assert sum(r["kept"] == bool(labels[r["doc_id"]]) for r in rows) >= 0.93 * len(rows)


def test_rules_odd(spark, odd, none):
    marks = spark.createDataFrame([(3, 1), (4, 2), (8, 3)], "doc_id long, mark int")
    model = likelihood.fit(odd, marks)
    got = likelihood.judged(odd.withColumnRenamed("at", "n_words"), model, keep=("doc_id", "n_words"))
    assert got.columns == ["doc_id", "n_words", "_n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    want = sorted(((r["doc_id"], r["at"], *counts_by_hand(r["text"] or "")) for r in odd.collect()), key=repr)
    assert sorted((tuple(r)[:7] for r in got.collect()), key=repr) == want
    assert all(not r["kept"] for r in got.collect() if r["base_failed"])
    assert likelihood.judged(none, likelihood.fit(none, marks)).count() == 0
    # nothing marked: what passes the rules stays
    free = likelihood.judged(odd, likelihood.fit(odd, marks.where("false")))
    assert all(r["kept"] != r["base_failed"] for r in free.collect())
    assert LONG


def test_best_cut():
    assert likelihood._best_cut([], 4.0) == 0
    assert likelihood._best_cut([(5, 3, 0), (9, 1, 0)], 4.0) == 5
    assert likelihood._best_cut([(-7, 0, 2)], 4.0) == -6
    assert likelihood._best_cut([(-20, 0, 5), (-10, 8, 0)], 4.0) == -15  # the middle of the gap
