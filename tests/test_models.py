"""Gene models, validation, events, updates, hooks and stages on hand-made cases."""

import random

import pytest
from pyspark.sql import functions as F

from strandloom.functions import hooks, seq
from strandloom.operators import events, gene, graph, update, validate
from strandloom.plans import lineage, stages

MODEL = "contig string, gene_id string, model_id string, strand string, exons array<struct<lend:int,rend:int>>, cds array<struct<lend:int,rend:int>>"
COMPLEMENT = str.maketrans("ACGT", "TGCA")


def plain(parts):
    return [tuple(p)[:2] for p in parts]


def bases(genome, parts, strand):
    s = "".join(genome[a - 1 : b] for a, b in parts)
    return s if strand == "+" else s.translate(COMPLEMENT)[::-1]


@pytest.fixture(scope="module")
def annotated(spark):
    """A genome with two genes of one coding sequence, on either strand, its codons cut by introns."""
    rng = random.Random(4)
    coding = "ATG" + "".join(rng.choice(["GCA", "CTG", "AAC"]) for _ in range(20)) + "TAA"
    cuts = [0, 4, 31, 65, len(coding)]  # introns inside the second, eleventh and last but one codon
    plus, genome, at = [], "CCCCC", 6
    for a, b in zip(cuts, cuts[1:]):
        genome += coding[a:b] + "GTCCCCCCCCAG"
        plus.append((at, at + b - a - 1))
        at += b - a + 12
    n = len(genome)
    minus = [(2 * n + 1 - b, 2 * n + 1 - a) for a, b in reversed(plus)]
    genome += genome.translate(COMPLEMENT)[::-1]
    widen = lambda parts: [(parts[0][0] - 3, parts[0][1]), *parts[1:-1], (parts[-1][0], parts[-1][1] + 2)]
    rows = [("c", "g1", "m1", "+", widen(plus), plus), ("c", "g2", "m2", "-", widen(minus), minus), ("c", "g3", "m3", "+", [(1, 4)], [])]
    return spark.createDataFrame(rows, MODEL), spark.createDataFrame([("c", genome)], "contig string, seq string"), genome, coding, plus, minus


def test_gene_parts(spark, annotated):
    models, sequences, genome, coding, plus, minus = annotated
    rows = {r.model_id: r for r in gene.with_sequences(models, sequences).collect()}
    assert rows["m1"].coding == rows["m2"].coding == coding and rows["m1"].protein == rows["m2"].protein and rows["m1"].protein[0] + rows["m1"].protein[-1] == "M*"
    five, three = gene.untranslated(F.col("exons"), F.col("cds"), F.col("strand"))
    got = {r.model_id: r for r in models.select("model_id", five.alias("five"), three.alias("three"), gene.trimmed_stop(F.col("cds"), F.col("strand")).alias("t"), gene.phased(F.col("cds"), F.col("strand"), F.lit(1)).alias("p")).collect()}
    assert [sum(b - a + 1 for a, b in plain(x)) for x in (got["m1"].five, got["m1"].three, got["m2"].five, got["m2"].three)] == [3, 2, 2, 3]
    assert bases(genome, plain(got["m2"].t), "-") == coding[:-3] and got["m3"].five == got["m3"].t == []
    assert [p.phase for p in got["m1"].p] == [1, (4 + 1) % 3, (31 + 1) % 3, (65 + 1) % 3] and [p.phase for p in got["m2"].p] == [p.phase for p in got["m1"].p][::-1]
    for k in (2, 11, 22):
        parts = {r.model_id: plain(r.c) for r in models.where("model_id <> 'm3'").select("model_id", gene.codon(F.col("cds"), F.col("strand"), F.lit(k)).alias("c")).collect()}
        assert bases(genome, parts["m1"], "+") == bases(genome, parts["m2"], "-") == coding[3 * k - 3 : 3 * k]
    assert len(parts["m1"]) == 2


@pytest.mark.parametrize("kind", ["gff3", "gtf"])
def test_adapters_write_what_they_read(spark, annotated, kind, tmp_path):
    models, sequences, *_ = annotated
    make = hooks.resolve(kind)
    writer = make("", f"{tmp_path}/x") if kind == "gff3" else make("", f"{tmp_path}/x", sequences)
    writer.write(models)
    got = {r.model_id: (r.gene_id, r.strand, plain(r.exons), plain(r.cds)) for r in make(f"{tmp_path}/x").models(spark).collect()}
    assert got == {r.model_id: (r.gene_id, r.strand, plain(r.exons), plain(r.cds)) for r in models.collect()}
    with pytest.raises(TypeError):
        hooks.AnnotationAdapter()


def test_gtf_codons_are_cut_by_introns(spark, annotated):
    from strandloom.sources.formats import gtf_genes

    models, sequences, genome, coding, plus, minus = annotated
    got = {r.model_id: r for r in gtf_genes(gene.gtf_lines(gene.with_sequences(models, sequences)).select("value")).collect()}
    for m, strand in (("m1", "+"), ("m2", "-")):
        assert bases(genome, plain(got[m].start_codon), strand) == "ATG" and bases(genome, plain(got[m].stop_codon), strand) == "TAA"
        assert len(got[m].stop_codon) == 2 and sum(b - a + 1 for a, b in plain(got[m].cds)) == len(coding) - 3
    assert got["m3"].cds == got["m3"].start_codon == []


def test_projection_turns_a_model_around(spark, annotated):
    models, sequences, genome, coding, plus, _ = annotated
    found = gene.with_sequences(models.where("model_id = 'm1'"), sequences).withColumn("o", F.get(seq.orfs(F.col("cdna"), 30), F.lit(0)))
    got = gene.project(found.select("*", F.col("o.lend").alias("o_lend"), F.col("o.rend").alias("o_rend"), F.col("o.strand").alias("o_strand"))).first()
    assert (got.strand, plain(got.cds)) == ("+", plus)


def test_regions(spark):
    df = spark.createDataFrame([([(1, 10), (20, 30), (40, 50)],)], "e array<struct<lend:int,rend:int>>")
    e = F.col("e")
    got = df.select(gene.between_introns(e, F.lit(20), F.lit(30)), gene.between_introns(e, F.lit(1), F.lit(10)), gene.to_neighbour(e, F.lit(40), F.lit(50)), gene.to_neighbour(e, F.lit(1), F.lit(30)), gene.to_neighbour(e, F.lit(20), F.lit(30))).first()
    assert [x and tuple(x) for x in got] == [(11, 39), None, (31, 50), (1, 39), None]


ALIGNED = "contig string, acc string, strand string, segments array<struct<lend:int,rend:int,mlend:int,mrend:int>>"


def test_validation_of_alignments(spark):
    exon = ["ACGTACGTAC", "TTGACCTTGA", "CAGTTCAGTT"]
    genome = "NNNNN" + exon[0] + "GTAAAAAAAG" + exon[1] + "GCAAAAAAAG" + exon[2] + "NN" + exon[0] + "AAAAAAAAAA" + exon[1]
    spots, at = [], 0
    for e in (exon[0], exon[1], exon[2], exon[0], exon[1]):
        at = genome.index(e, at)
        spots.append((at + 1, at + 10))
        at += 10
    good = [(*spots[0], 1, 10), (*spots[1], 11, 20), (*spots[2], 21, 30)]
    turned = [(a, b, 31 - x, 31 - y) for a, b, x, y in good]
    rows = [
        ("c", "good", "+", good), ("c", "turned", "-", turned), ("c", "gap", "+", [good[0], (*good[1][:2], 12, 21)]), ("c", "bad", "+", [(*spots[3], 1, 10), (*spots[4], 11, 20)]),
        ("c", "one", "+", [good[0]]), ("c", "off", "+", good), ("d", "other", "+", good),
    ]
    cdna = "".join(exon)
    texts = {"good": cdna, "turned": cdna.translate(COMPLEMENT)[::-1], "gap": cdna, "bad": cdna[:20], "one": cdna, "off": cdna[:9] + "A" + cdna[10:], "other": cdna}
    al = spark.createDataFrame(rows, ALIGNED)
    tr = spark.createDataFrame(list(texts.items()), "acc string, seq string")
    sequences = spark.createDataFrame([("c", genome)], "contig string, seq string")
    for width in (4096, 8):
        tiled = validate.tiles(sequences, width, 8)
        j = validate.with_bases(spark.createDataFrame([("c", -1), ("c", 7), ("c", len(genome)), ("d", 3)], "contig string, at int"), tiled, "at", 4, "b", width, 8)
        assert {(r.contig, r["at"]): r.b for r in j.collect()} == {("c", -1): genome[:2], ("c", 7): genome[6:10], ("c", len(genome)): genome[-1], ("d", 3): None}
    j = validate.junctions(al, validate.tiles(sequences), 3)
    spliced = {r.acc: (r.spliced_strand, r.error) for r in validate.spliced_orientation(al, j).collect()}
    assert spliced == {"good": ("+", None), "turned": ("+", None), "gap": ("+", None), "bad": ("?", "splice sites"), "one": ("?", None), "off": ("+", None), "other": ("?", "splice sites")}
    assert {r.acc: r.c for r in al.select("acc", validate.contiguous(F.col("segments"), F.col("strand")).alias("c")).collect()} == {a: a != "gap" for a in texts}
    wrong = {r.acc: r.mismatches for r in validate.boundary_mismatches(al, j, tr, 3).collect()}
    assert (wrong["good"], wrong["turned"], wrong["one"], wrong["off"]) == (0, 0, 0, 1)


def test_cascade_order(spark):
    df = spark.createDataFrame([(None, True, 0, 30, 50, 99.0, 99.0), ("splice sites", True, 1, 1, 1, 1.0, 1.0), (None, False, 1, 1, 1, 1.0, 1.0), (None, True, 1, 5, 9, 1.0, 1.0), (None, True, 2, 30, 30, 1.0, 1.0), (None, True, 0, None, None, 89.0, 1.0), (None, True, 0, 30, 5000, 99.0, 99.0), (None, True, 0, 30, 30, 99.0, 94.0)],
                               "e string, ok boolean, m int, s int, l int, p double, i double")
    c = F.col
    got = [r.x for r in df.select(validate.cascade(c("e"), c("ok"), c("m"), c("s"), c("l"), c("p"), c("i")).alias("x")).collect()]
    assert got == [None, "splice sites", "incontiguous", "intron too short", "splice boundary", "too little aligned", "intron too long", "too little identity"]


def test_poly_tails(spark):
    body = "GCGCTCGCGGCTCGCGCGTCGGCTCGCGGCGCTCGGCGCTCGCGGCGCTCGCGCGCTCG"
    rows = [(body + "A" * 12,), (body + "AAAAAACAAAAAA",), ("T" * 9 + body,), (body,), ("",), (None,), (body + "A" * 12 + "GGGGGGGGGGGGGGGGGGGGGGGGGGGG",), (body + "AAAAAAAAGC",)]
    got = [tuple(r.t) for r in spark.createDataFrame(rows, "s string").select(seq.poly_tails(F.col("s")).alias("t")).collect()]
    assert got == [(0, 12), (0, 13), (9, 0), (0, 0), (0, 0), (0, 0), (0, 0), (0, 10)]
    df = spark.createDataFrame([("CCAAAAACAAAA",), ("A" * 5000,), ("AAAC",), ("",)], "s string")
    assert [r.n for r in df.select(seq.tail_trim(F.col("s")).alias("n")).collect()] == [10, 5000, 0, 0]


def test_jaccard_links_count_common_neighbours(spark):
    rng = random.Random(3)
    links = {(a, b) for a in range(25) for b in range(a) if rng.random() < 0.3} | {(0, k) for k in range(1, 25)}
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    pairs = {(min(p), max(p)) for p in links}
    want = {(a, b) for a, b in pairs if (len(near[a] & near[b]) + 2) / (len(near[a]) + len(near[b]) - len(near[a] & near[b])) >= 0.4}
    assert {tuple(r) for r in graph.jaccard_links(spark.createDataFrame(sorted(links), "a int, b int"), 0.4).collect()} == want and want


def test_disjoint_sets_are_asserted(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "k int") for xs in ((1, 2), (2, 3)))
    assert events.disjoint(a, b.where("k > 2"), ["k"]).count() == 2
    with pytest.raises(Exception, match="in both sets: 2"):
        events.disjoint(a, b, ["k"]).collect()


def test_updates(spark, annotated):
    models = annotated[0]
    new = [(1, "c", 7, 4, "g1", "m1", True, False, False, [(1, 9)], []), (1, "c", 8, 9, "g2", "m2", True, True, False, [(2, 9)], []), (1, "c", 9, 10, None, None, True, False, True, [(3, 9)], []),
           (1, "c", 10, 21, "g3", "m3", False, False, False, [(4, 9)], []), (2, "c", 11, 4, "g3", "m3", True, False, False, [(5, 9)], [])]
    out = spark.createDataFrame(new, "compare_id int, contig string, acc int, status int, gene_id string, model_id string, valid boolean, alt boolean, novel boolean, exons array<struct<lend:int,rend:int>>, cds array<struct<lend:int,rend:int>>")
    status, links, updates = update.status_rows(out)
    assert (status.count(), links.count(), updates.count()) == (5, 4, 4)
    got = update.retrieved(status, updates, 1).withColumn("strand", F.lit("+"))
    assert sorted(r.acc for r in got.collect()) == [7, 8, 9] and update.retrieved(status, updates, 1, F.col("status") == 9).count() == 1
    rows = {r.model_id: (r.gene_id, r.origin, plain(r.exons)[0]) for r in update.applied(models, got).collect()}
    assert rows["m1"] == ("g1", "updated", (1, 9)) and rows["g2.8"] == ("g2", "isoform", (2, 9)) and rows["novel.9.1"][1] == "novel" and rows["m3"][1] == "kept" and len(rows) == 5


def test_stages_resume(spark, tmp_path):
    calls = []

    def make(df, n=None):
        calls.append(1)
        return df

    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "contig string, x int")
    for _ in range(2):
        assert stages.resumed(spark, f"{tmp_path}/one", lambda: make(df)).count() == 3
    assert len(calls) == 1
    stages.resumed_by(spark, f"{tmp_path}/two", df.where("contig = 'a'"), "contig", lambda d: d.withColumn("y", F.lit(1)))
    got = stages.resumed_by(spark, f"{tmp_path}/two", df, "contig", lambda d: d.withColumn("y", F.lit(2)))
    assert sorted(map(tuple, got.select("contig", "x", "y").collect()), key=repr) == [("a", 1, 1), ("b", 2, 2), (None, 3, 2)]
    assert stages.resumed_by(spark, f"{tmp_path}/two", df, "contig", lambda d: d.withColumn("y", F.lit(3))).count() == 3


def test_settled_keeps_one_table(spark):
    since = lineage.mark()
    got = lineage.settled(spark, lambda: lineage.stored(lineage.stored(spark.range(5)).where("id > 1")).where("id > 2"))
    assert lineage.mark() == since + 1 and got.count() == 2


def test_strand_and_lone_segments(spark):
    rows = [("c", "a", "?", [(1, 9, 1, 9)], True), ("c", "b", "?", [(1, 9, 1, 9)], True), ("c", "f", "+", [(1, 9, 1, 9)], True)]
    al = spark.createDataFrame([r[:4] + (r[4],) for r in rows], ALIGNED + ", valid boolean")
    sites = spark.createDataFrame([("a", "-"), ("b", "-"), ("b", "+")], "acc string, strand string")
    assert {r.acc: r.strand for r in validate.strand_from_tails(al, sites).collect()} == {"a": "-", "b": "?", "f": "+"}
    full = spark.createDataFrame([("f",), ("f",)], "acc string")
    assert {r.acc: r.valid for r in validate.without_lone_segments(al, full).collect()} == {"a": False, "b": False, "f": True}


def test_tiers_take_a_rule_of_their_own(spark):
    from strandloom.operators import intervals

    rows = [(1, 0, 1, 10, 9.0), (1, 1, 8, 20, 8.0), (1, 2, 9, 11, 7.0)]
    df = spark.createDataFrame(rows, "contig int, id long, lend int, rend int, score double")
    loose = intervals.tiers(df, overlaps=lambda a, b: min(a[1], b[1]) - max(a[0], b[0]) + 1 > 3)
    assert {r.id: r.tier for r in loose.collect()} == {0: 1, 1: 1, 2: 1}
    assert {r.id: r.tier for r in intervals.tiers(df).collect()} == {0: 1, 1: 2, 2: 3}


def test_training_set(spark):
    good, bad = "ATG" + "GCA" * 30 + "TAA", "ATGCC"
    df = spark.createDataFrame([(1, good), (2, bad)], "acc int, coding string")
    ratios = spark.createDataFrame([(0, "GCA", 1.0), (1, "CAG", -0.5), (2, "AGC", -0.5)], "frame int, kmer string, ratio double")
    got = {r.acc: (r.own, r.other) for r in gene.training_set(df, ratios, 3, 1000).collect()}
    assert list(got) == [1] and got[1][0] > 0 >= (got[1][1] or 0)
