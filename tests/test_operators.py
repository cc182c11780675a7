"""Operators against brute force and hand-made edge cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from strandloom.functions import seq
from strandloom.operators import annotate, assemble, graph
from strandloom.operators import intervals as iv
from strandloom.plans.components import connected_components
from strandloom.plans.ranges import overlap_join
from strandloom.sources import formats as fm

SCHEMA = "contig int, id long, lend int, rend int, strand string, score double"


def rows(spark, spans, contig=1):
    return spark.createDataFrame([(contig, i, a, b, "+", float(i)) for i, (a, b) in enumerate(spans)], SCHEMA)


@pytest.mark.parametrize(
    ("spans", "want"),
    [([(1, 10), (10, 20)], 1), ([(1, 10), (11, 20)], 2), ([(1, 100), (20, 30), (90, 120)], 1), ([(5, 9)] * 3, 1), ([(7, 7), (7, 7)], 1), ([], 0)],
)
def test_pile_edges(spark, spans, want):
    assert iv.pile_spans(rows(spark, spans)).count() == want


def test_piles_across_bins_equal_one_sweep(spark):
    rng = random.Random(5)
    spans = [(a := rng.randrange(2000), a + rng.choice([1, 3, 40, 700])) for _ in range(300)]
    spans = [(a, b) for a, b in spans]
    got = {tuple(r) for r in iv.pile_spans(iv.piles(rows(spark, spans), width=50).drop("pile")).select("lend", "rend", "members").collect()}
    small = {tuple(r) for r in iv.piles(rows(spark, spans), width=50).groupBy("pile").agg(F.min("lend"), F.max("rend"), F.count("*")).drop("pile").collect()}
    want, top = [], -1
    for a, b in sorted(spans):
        if a > top:
            want.append([a, b, 0])
        top = max(top, b)
        want[-1][1], want[-1][2] = top, want[-1][2] + 1
    assert small == got == {tuple(w) for w in want}


@pytest.mark.parametrize("strict", [True, False])
def test_overlap_join_is_exact(spark, strict):
    rng = random.Random(8)
    a, b = ([(x := rng.randrange(500), x + rng.choice([0, 5, 63, 64, 200])) for _ in range(120)] for _ in range(2))
    got = sorted(tuple(r) for r in overlap_join(rows(spark, a), rows(spark, b), width=64, strict=strict).select("id", "b_id").collect())
    ok = (lambda p, q: p[0] < q[1] and p[1] > q[0]) if strict else (lambda p, q: p[0] <= q[1] and p[1] >= q[0])
    assert got == sorted((i, j) for i, p in enumerate(a) for j, q in enumerate(b) if ok(p, q))


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (6, 6), (None, 3)], "a int, b int")
    assert sorted(map(tuple, connected_components(e, "a", "b").collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a int, b int")
    assert {r.component for r in connected_components(chain, "a", "b").collect()} == {0}
    assert connected_components(e.where("a > 100"), "a", "b").count() == 0


def test_singletons_stay(spark):
    e = spark.createDataFrame([(1, 2)], "a long, b long")
    assert sorted(map(tuple, graph.clusters(rows(spark, [(1, 2)] * 4), e).collect())) == [(0, 0), (1, 1), (2, 1), (3, 3)]


def brute_best(structures):
    """The largest number of structures that one chain of compatible, uncontained neighbours brings in, by all subsets."""
    n = len(structures)
    span = [(s[0][0], s[-1][1]) for s in structures]
    mate = [[i == j or assemble.compatible(structures[i], structures[j]) for j in range(n)] for i in range(n)]
    inside = lambda i, j: mate[i][j] and span[i][0] <= span[j][0] and span[j][1] <= span[i][1]
    held = [{j for j in range(n) if inside(i, j)} for i in range(n)]
    best = 0
    for k in range(1, n + 1):
        for some in itertools.combinations(range(n), k):
            if all(mate[a][b] and b not in held[a] and a not in held[b] for a, b in zip(some, some[1:])):
                score = len(held[some[0]]) + sum(len(held[b] - held[a]) for a, b in zip(some, some[1:]))
                best = max(best, score)
    return best


def test_assembly_against_all_chains():
    rng = random.Random(11)
    for _ in range(60):
        structures = []
        for _ in range(rng.randrange(2, 8)):
            at, out = rng.randrange(0, 60), []
            for _ in range(rng.randrange(1, 4)):
                out.append((at, at + rng.choice([20, 30])))
                at = out[-1][1] + rng.choice([20, 30])
            structures.append(out)
        structures.sort(key=lambda s: (s[0][0], s[-1][1]))
        got = assemble.assemble(structures)
        assert set().union(*got) == set(range(len(structures)))
        import numpy as np

        n = len(structures)
        span = [(s[0][0], s[-1][1]) for s in structures]
        mate = np.array([[i == j or assemble.compatible(structures[i], structures[j]) for j in range(n)] for i in range(n)])
        held = np.array([[mate[i, j] and span[i][0] <= span[j][0] and span[j][1] <= span[i][1] for j in range(n)] for i in range(n)])
        assert assemble.scan(mate & ~held & ~held.T, held, range(n))[0].max() == brute_best(structures)


def test_assemblies_of_piles(spark):
    """Whole piles one at a time, by the function on all of a strand's structures, against the join and its components."""
    rng = random.Random(3)
    rows = []
    for contig in range(12):
        for acc in range(rng.choice([1, 4, 30])):
            at, out = rng.choice([0, 5, 30, 50, 60, 110, 200, 260]), []
            for _ in range(rng.randrange(1, 5)):
                out.append((at, at + rng.choice([20, 30])))
                at = out[-1][1] + rng.choice([20, 30])
            rows.append((contig, acc, rng.choice("++--?"), out, 1.0))
    want = []
    for contig in range(12):
        own = sorted((r for r in rows if r[0] == contig), key=lambda r: (r[3][0][0], r[3][-1][1], r[1]))
        piles, reach = [], None
        for r in own:
            if reach is None or r[3][0][0] > reach:
                piles.append([])
            reach = r[3][-1][1] if not piles[-1] else max(reach, r[3][-1][1])
            piles[-1].append(r)
        for number, pile in enumerate(piles, 1):
            found = []
            for strand in "+-":
                at = [i for i, r in enumerate(pile) if r[2] in (strand, "?")]
                if at and (strand == "+" or any(pile[i][2] == "-" for i in at)):
                    found += [(strand, [at[k] for k in got]) for got in assemble.assemble([pile[i][3] for i in at])]
            seen, n = set(), 0
            for strand, got in sorted(found, key=lambda f: (-len(f[1]), f[0], f[1])):
                if not seen.issuperset(got):
                    seen.update(got)
                    n += 1
                    text = ",".join(f"{l}-{r}" for l, r in assemble.union([pile[i][3] for i in got]))
                    want.append((contig, number, strand, n, ",".join(str(a) for a in sorted(pile[i][1] for i in got)), len(got), text))
    df = spark.createDataFrame(rows, "contig int, acc int, strand string, segments array<struct<lend:int,rend:int>>, score double")
    for crowd in (500, 1):
        assert sorted(map(tuple, assemble.assemblies(df, crowd=crowd).collect())) == sorted(want)
    assert assemble.assemblies(df.where("false")).count() == 0


def test_assembly_of_a_crowded_pile():
    # 5,000 structures over forty shared exons: rows of bits, not loops over members
    import time

    import numpy as np

    rng = random.Random(5)
    structures = []
    for _ in range(5000):
        first = rng.randrange(40)
        out = [[200 * k, 200 * k + 100] for k in range(first, first + rng.randrange(1, 6))]
        out[0][0] += rng.randrange(60)
        structures.append([tuple(s) for s in out])
    structures.sort(key=lambda s: (s[0][0], s[-1][1]))
    pairs = np.array([(i, j) for i in range(5000) for j in range(i + 1, 5000) if structures[j][0][0] <= structures[i][-1][1]])  # all exons are whole at their inner ends, so all that meet fit
    begin = time.time()
    got = assemble.assemble(structures, pairs=pairs)
    assert set().union(*got) == set(range(5000)) and time.time() - begin < 60


def test_compatibility_boundaries():
    a = [(100, 200), (300, 400)]
    assert assemble.compatible(a, [(150, 200), (300, 350)])
    assert not assemble.compatible(a, [(150, 210), (300, 350)])  # another splice site
    assert assemble.compatible(a, [(150, 220)])  # a free end may pass a site by 20
    assert not assemble.compatible(a, [(150, 221)])
    assert not assemble.compatible(a, [(500, 600)])
    assert assemble.union([a, [(150, 220)], [(50, 200), (300, 320)]]) == [(50, 200), (300, 400)]


def test_stitch():
    t = [(1, 10), (20, 30), (40, 50), (60, 70)]
    assert assemble.stitch(t, [(25, 30), (40, 45)]) == [(1, 10), (20, 30), (40, 50), (60, 70)]
    assert assemble.stitch(t, [(100, 110)]) is None


def test_chain_is_best_set():
    rng = random.Random(2)
    for _ in range(40):
        items = sorted((a := rng.randrange(30), a + rng.randrange(8), rng.randrange(1, 9)) for _ in range(8))
        got = assemble.best_chain(items, lambda r: r[2], lambda p, q: p[1] < q[0])
        best = max(sum(items[i][2] for i in s) for k in range(9) for s in itertools.combinations(range(8), k) if all(items[i][1] < items[j][0] for i, j in zip(s, s[1:])))
        assert sum(items[i][2] for i in got) == best
    assert assemble.best_chain([(1, 2, -5)], lambda r: r[2], lambda p, q: True) == []


def test_best_set_against_all_sets():
    rng = random.Random(6)
    for _ in range(60):
        items = sorted(((a := rng.randrange(30), a + rng.randrange(8), float(rng.randrange(-2, 9))) for _ in range(8)), key=lambda x: (x[1], x[0]))
        got = assemble.best_set(*map(list, zip(*items)))
        assert all(items[i][1] < items[j][0] for i, j in itertools.pairwise(got))
        fits = [s for k in range(9) for s in itertools.combinations(range(8), k) if all(items[i][1] < items[j][0] for i, j in itertools.pairwise(s))]
        assert sum(items[i][2] for i in got) == max(sum(items[i][2] for i in s) for s in fits)


def test_artifacts_against_all_pairs(spark):
    rng = random.Random(7)
    spans = [(a := rng.randrange(300), a + rng.choice([0, 4, 30, 120])) for _ in range(150)]
    data = [(1, i, a, b, "+", rng.choice([1.0, 5.0, 60.0, 700.0])) for i, (a, b) in enumerate(spans)]
    kept = []
    for r in sorted(data, key=lambda r: (-r[5], r[2], r[3], r[1])):
        over = lambda k, r=r: min(r[3], k[3]) - max(r[2], k[2]) + 1
        if not any(over(k) > 0 and 100 * over(k) >= 10 * (min(r[3] - r[2], k[3] - k[2]) + 1) and 100 * r[5] < 10 * k[5] for k in kept):
            kept.append(r)
    got = {r.id for r in iv.drop_artifacts(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {r[1] for r in kept} and len(got) < 150


def test_low_complexity_against_its_rule(spark):
    rng = random.Random(8)
    texts = ["A" * 70, "ACGT" * 40, "".join(rng.choice("ACGT") for _ in range(300)), "ACACACACAC" * 9 + "".join(rng.choice("ACGT") for _ in range(90)), "", "AC"]
    for t, r in zip(texts, spark.createDataFrame([(t,) for t in texts], "s string").select(seq.low_complexity(F.col("s")).alias("m")).collect()):
        hidden = set()
        for a in range(0, max(1, len(t) - 2), 32):
            triplets = [t[i : i + 3] for i in range(a, min(a + 64, len(t)) - 2)]
            if len(triplets) > 1 and 10 * sum(triplets.count(x) * (triplets.count(x) - 1) / 2 for x in set(triplets)) / (len(triplets) - 1) > 20:
                hidden |= set(range(a, min(a + 64, len(t))))
        assert r.m == "".join("N" if i in hidden else c for i, c in enumerate(t))


def test_tiers_never_overlap(spark):
    rng = random.Random(4)
    spans = [(a := rng.randrange(80), a + rng.randrange(15)) for _ in range(60)]
    got = iv.tiers(rows(spark, spans)).collect()
    assert len(got) == 60
    for p, q in itertools.combinations(got, 2):
        assert p.tier != q.tier or p.rend < q.lend or q.rend < p.lend


def test_sequence_functions(spark):
    df = spark.createDataFrame([("ATGAAATAG",), ("",), ("ATGCCNTTTTAA",)], "s string")
    got = df.select(seq.translate(F.col("s")).alias("p"), seq.reverse_complement(F.col("s")).alias("r"), seq.translate(F.col("s"), 1, "ciliate").alias("c")).collect()
    assert [tuple(r) for r in got] == [("MK*", "CTATTTCAT", "MKQ"), ("", "", ""), ("MXF*", "TTAAAANGGCAT", "MXFQ")]
    found = spark.createDataFrame([("CCATGAAATTTTAGCC",)], "s string").select(seq.orfs(F.col("s"), 6).alias("o")).first().o
    assert [(o.lend, o.rend, o.strand, o.complete) for o in found][0] == (3, 14, "+", True)
    assert set(seq.stop_codons()) == {"TAA", "TAG", "TGA"} and seq.stop_codons("euplotid") == ["TAA", "TAG"]
    assert seq.protein_identity("MKV", "MKV") == 100 and seq.protein_identity("", "M") == 0


def test_cigar(spark):
    df = spark.createDataFrame([("5S10M2I3M100N4M1D6M", 11)], "c string, p int").select(seq.cigar_blocks(F.col("c"), F.col("p")).alias("b"))
    assert [tuple(x) for x in df.first().b] == [(11, 20, 6, 15), (21, 23, 18, 20), (124, 127, 21, 24), (129, 134, 25, 30)]
    assert df.select(fm.cigar_of(F.col("b")).alias("c")).first().c == "10M2I3M100N4M1D6M"


def test_formats(spark):
    text = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    g = fm.gff3_genes(text("##gff-version 3", "", "c1\ts\tgene\t1\t90\t.\t+\t.\tID=g1", "c1\ts\tmRNA\t1\t90\t.\t+\t.\tID=m1;Parent=g1", "c1\ts\texon\t1\t30\t.\t+\t.\tID=e1;Parent=m1", "c1\ts\texon\t60\t90\t.\t+\t.\tParent=m1", "c1\ts\tCDS\t10\t30\t.\t+\t0\tParent=m1"))
    r = g.first()
    assert (r.gene_id, r.model_id, [tuple(x)[:2] for x in r.exons], [tuple(x) for x in r.cds]) == ("g1", "m1", [(1, 30), (60, 90)], [(10, 30, 0)])
    p = fm.psl(text("90\t10\t0\t0\t0\t0\t1\t50\t-\tq1\t120\t0\t100\tt1\t999\t100\t250\t2\t60,40,\t0,60,\t100,210,")).first()
    assert (p.per_id, [tuple(x) for x in p.segments]) == (90.0, [(101, 160, 61, 120), (211, 250, 21, 60)])
    v = fm.vcf(text("#h", "c\t5\t.\tA\tC,G\t9.5\tPASS\tDP=3;AF=0.5")).first()
    assert (v.pos, v.alts, v.info["DP"]) == (5, ["C", "G"], "3")
    f = fm.fasta_records(text(">a one\nACG\nT", "b two\nGG")).collect()
    assert [tuple(x) for x in f] == [("a", "a one", "ACGT"), ("b", "b two", "GG")]
    q = fm.fastq_records(text("@r1 x\nACGT\n+\nIIII")).first()
    assert tuple(q) == ("r1", "ACGT", "IIII")
    w = fm.wiggle(spark.createDataFrame([(1, "f", "variableStep chrom=c9"), (2, "f", "5 1.5"), (3, "f", "6 2")], "number int, file string, value string")).collect()
    assert [tuple(x) for x in w] == [("c9", 5, 1.5), ("c9", 6, 2.0)]
    assert [tuple(x) for x in fm.config(text("# c", "A=1", "run.pl:--X=<v>")).collect()] == [(None, "A", "1"), ("run.pl", "--X", "<v>")]
    assert fm.sam(text("@HD", "r\t16\tc\t7\t60\t4M\t*\t0\t0\tACGT\tIIII")).first().strand == "-"
    assert fm.gff3(text("c\ts\texon\tx\t9\t.\t+\t.\tID=a%20b")).select("lend", "id").first() == (None, "a b")


def test_annotation_rules(spark):
    df = spark.createDataFrame([(1, 99, 10, 60, "+", "MA*"), (1, 99, 10, 61, "?", "A*A")], "lend int, rend int, a int, b int, strand string, p string")
    c = F.col
    got = [r.e for r in df.select(annotate.gene_errors(c("lend"), c("rend"), c("a"), c("b"), c("strand"), c("p")).alias("e")).collect()]
    assert got == [[], ["unknown strand", "coding length not a multiple of three", "no start codon", "no stop codon"]]


def test_more_formats(spark):
    text = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    t = spark.createDataFrame([(1, "f", ">Feature c1"), (2, "f", "1\t>20\tgene"), (3, "f", "\t\t\tlocus_tag\tx"), (4, "f", "9\t3\tCDS"), (5, "f", "2\t1"), (6, "f", ">Feature c2"), (7, "f", "5\t6\tgene")], "number int, file string, value string")
    got = [tuple(r) for r in fm.feature_table(t).orderBy("contig", "feature", F.desc("lend")).collect()]
    assert got == [("c1", 1, "gene", 1, 20, "+", True), ("c1", 2, "CDS", 3, 9, "-", False), ("c1", 2, "CDS", 1, 2, "-", False), ("c2", 3, "gene", 5, 6, "+", False)]
    x = spark.createDataFrame([(1, "> 1:5-9 + a.fa\nAC-GT\n> 2:1-4 - b.fa\nACGT\n")], "number int, value string")
    assert [tuple(r) for r in fm.xmfa(x).collect()] == [(1, 1, 5, 9, "+", "a.fa", "AC-GT"), (1, 2, 1, 4, "-", "b.fa", "ACGT")]
    b = fm.btab(text("q\t\t\tblat\t\ts1\t90\t10\t1\t81\t99.5\t\t\t2")).first()
    assert (b.query, b.subject, b.lend, b.rend, b.strand, b.chain) == ("q", "s1", 10, 90, "-", 2)
    assert fm.accessions(text("a", " a ", "", "b")).count() == 2
    r = fm.trim_report(text("t1\t0\t1\t90\t100\t\ttrimpoly[+0, -12]", "t2\t0\t1\t90\t100\t\ttrimpoly[+3, -12]")).collect()
    assert [tuple(x) for x in r] == [("t1", 100, 0, 12)]


def test_polycistron(spark):
    orf = "ATG" + "GCA" * 30 + "TAA"
    df = spark.createDataFrame([(orf + "CC" + orf,), (orf,), ("",)], "s string")
    assert [r.p for r in df.select(seq.polycistronic(F.col("s"), 60).alias("p")).collect()] == [True, False, False]
