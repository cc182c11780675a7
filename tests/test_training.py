"""Counts of k-mers, open frames, and contigs that are made in many tasks."""

import random
from collections import Counter

from pyspark.sql import functions as F

from strandloom.functions import seq
from strandloom.plans.lineage import stored
from strandloom.operators import contig, gene
from strandloom.operators.validate import tiles
from strandloom.sources.tables import contig_kinds, contig_sequences, locus_sequences, locus_transcripts, table
from tests.llm.test_broadcasts import exploded_broadcasts

D = "/root/testdata/sf0.01"


def brute(text, k):
    return Counter((i % 3, text[i : i + k]) for i in range(len(text) - k + 1))


def test_counted_kmers(monkeypatch):
    r = random.Random(1)
    for piece in (3, 30, 3 << 18):
        monkeypatch.setattr(seq, "PIECE", piece)
        for letters in ("ACGT", "a\U0001f600\u0416\x00", "".join(map(chr, range(40, 120)))):
            for n in (0, 1, 4, 5, 6, 100, 301):
                text = "".join(r.choice(letters) for _ in range(n))
                for k in (1, 3, 5, 40):
                    assert seq.counted_kmers(text, k) == brute(text, k), (piece, text, k)


def test_framed_kmers_count_a_sequence_as_often_as_it_is_there(spark):
    rows = [("ACGTACGTA", 3), ("ACG", 2), ("AC", 9), ("", 1), (None, 4)]
    want = Counter()
    for text, times in rows:
        for key, m in brute(text or "", 3).items():
            want[key] += m * times
    df = spark.createDataFrame(rows, "s string, times bigint")
    assert {(r.frame, r.kmer): r.n for r in seq.framed_kmers(df, "s", 3, "times").collect()} == want
    assert dict(seq.framed_kmers(df, "s", 3).dtypes) == {"frame": "int", "kmer": "string", "n": "bigint"}


def test_contigs_are_made_in_many_tasks(spark):
    """All documents may be one task; contigs are made of them by the dozen."""
    contigs = contig_sequences(spark, D)
    tasks = contigs.select(F.spark_partition_id().alias("p"), "contig").groupBy("p").count().collect()
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 0.5 * table(spark, D, "customer").count()
    kinds = stored(contig_kinds(spark, D))
    each = contigs.groupBy("seq").agg(F.count("*").alias("n"))
    both = kinds.groupBy("seq").agg(F.sum("times").alias("n"))
    assert each.exceptAll(both).isEmpty() and both.exceptAll(each).isEmpty()


def test_scores_broadcast_no_occurrences(spark):
    """Spark sizes occurrences as the sequences that they are taken from."""
    rows = stored(spark.createDataFrame([(1, "ACGTACGTA")], "id bigint, s string"))
    ratios = stored(spark.createDataFrame([(0, "ACG", 1.0), (1, "CGT", 0.5)], "frame int, kmer string, ratio double"))
    scores = seq.frame_scores(rows, ratios, "id", "s", 3)
    assert not exploded_broadcasts(scores)
    assert {r.frame: r.score for r in scores.collect()} == {1: 1.5, 2: 1.5}


def test_closed_frames_as_by_codons():
    r, stops = random.Random(2), frozenset(seq.stop_codons())
    for n in range(2000):
        text = "".join(r.choice("ATGN" if n % 2 else "ACGT") for _ in range(r.randrange(120)))
        for least in (0, 6, 7, 30):
            want = []
            for frame in range(3):
                start = None
                for i in range(frame, len(text) - 2, 3):
                    codon = text[i : i + 3]
                    start = i if start is None and codon == "ATG" else start
                    if codon in stops:
                        if start is not None and i + 3 - start >= least:
                            want.append((start + 1, i + 3, frame + 1))
                        start = None
            got = seq.open_frames(text, least, stops, strands="+")
            assert [(o["lend"], o["rend"], o["frame"]) for o in got] == sorted(want, key=lambda w: (w[0] - w[1], w[0])) and all(o["complete"] for o in got)


def test_frames_of_structures_as_by_columns(spark):
    """As column functions say it, structures that begin before their contig included."""
    d = "/root/testdata/sf0.001"
    seqs = stored(locus_sequences(spark, d))
    rows = stored(locus_transcripts(spark, d))
    c = F.col
    held = gene.with_sequences(rows.withColumn("cds", gene.none()), seqs).drop("cds", "coding", "protein")
    held = held.withColumn("o", F.get(F.filter(seq.orfs(c("cdna"), 30), lambda o: o["strand"] == "+"), F.lit(0)))
    coding = F.substring("cdna", c("o.lend"), c("o.rend") - c("o.lend") + 1)
    none = c("o").isNull()
    want = held.withColumns({"cds": F.when(~none, gene.within(c("exons"), c("strand"), c("o.lend"), c("o.rend"))), "protein": F.when(~none, seq.translate(coding))}).drop("o")
    got = contig.with_frames(rows, None, tiled=tiles(seqs))
    assert got.columns == want.columns and got.dtypes == want.dtypes
    shown = lambda df: sorted(map(str, df.collect()))
    found = shown(got)
    assert found == shown(want) and sum("cds=None" in x for x in found) < len(found)
    assert rows.where("exons[0].lend < 1").count()


def test_contigs_of_loci_are_made_in_many_tasks(spark):
    seqs = locus_sequences(spark, D)
    tasks = seqs.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 4
    letters = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]", "")
    docs = table(spark, D, "documents").select("doc_id", F.translate(letters, "abcdefghijklmnopqrstuvwxyz", ("ACGT" * 7)[:26]).alias("seq"))
    docs = {r.doc_id: r.seq or "ACGT" for r in docs.collect()}
    orders = {r[0]: r[1] for r in table(spark, D, "orders").groupBy("o_custkey").count().collect()}
    want = {k: (docs[k % len(docs)] * (2000 * (n + 1) // len(docs[k % len(docs)]) + 1))[: 2000 * (n + 1)] for k, n in orders.items()}
    assert {r.contig: r.seq for r in seqs.collect()} == want
