"""A valid transcript of either strand, and one for each error."""

import pytest
from pyspark.sql import functions as F

from strandloom.sources import gtf_checks as gc


def line(kind, lend, rend, phase=".", strand="+", gene="g", acc="t", contig="c"):
    return f'{contig}\ts\t{kind}\t{lend}\t{rend}\t.\t{strand}\t{phase}\tgene_id "{gene}"; transcript_id "{acc}";'


# exons 101-200, 301-400, 501-600; 36 + 100 + 23 coding bases (159), then the stop
VALID = [("exon", 101, 200), ("exon", 301, 400), ("exon", 501, 600), ("start_codon", 165, 167), ("CDS", 165, 200, "0"), ("CDS", 301, 400, "0"), ("CDS", 501, 523, "2"), ("stop_codon", 524, 526)]
BACK = [("exon", 101, 200), ("exon", 301, 400), ("stop_codon", 178, 180), ("CDS", 181, 200, "2"), ("CDS", 301, 340, "0"), ("start_codon", 338, 340)]


def errors(spark, rows, strand="+", sequences=None):
    df = spark.createDataFrame([(r if isinstance(r, str) else line(*r, strand=strand) if len(r) > 3 else line(*r, strand=strand),) for r in rows], "value string")
    got = gc.transcript_errors(df, sequences).collect()
    return {r["transcript_id"]: r["codes"] for r in got}["t"]


def without(kind, rows=VALID):
    return [r for r in rows if r[0] != kind]


def changed(old, new, rows=VALID):
    return [new if r == old else r for r in rows]


CASES = {
    15: without("CDS"), 16: changed(("start_codon", 165, 167), ("start_codon", 165, 168)), 17: without("start_codon"), 18: changed(("stop_codon", 524, 526), ("stop_codon", 524, 525)), 19: without("stop_codon"),
    20: [*VALID, line("exon", 900, 950, strand="-", acc="u")], 21: changed(("CDS", 165, 200, "0"), ("CDS", 162, 200, "0")), 22: changed(("stop_codon", 524, 526), ("stop_codon", 391, 393)), 23: [*VALID, line("exon", 301, 400, gene="h")],
    33: changed(("CDS", 165, 200, "0"), ("CDS", 168, 200, "0")), 34: changed(("stop_codon", 524, 526), ("stop_codon", 530, 532)), 39: changed(("CDS", 165, 200, "0"), ("CDS", 165, 200, "1")), 40: changed(("CDS", 301, 400, "0"), ("CDS", 301, 400, ".")),
    41: changed(("CDS", 501, 523, "2"), ("CDS", 501, 522, "2")), 42: changed(("CDS", 501, 523, "2"), ("CDS", 501, 523, "1")), 45: [*VALID, ("CDS", 390, 400, "0")], 46: changed(("stop_codon", 524, 526), ("stop_codon", 521, 523)),
    47: changed(("start_codon", 165, 167), ("start_codon", 250, 252)), 48: [*VALID, ("exon", 601, 650)], 49: [*VALID, ("exon", 615, 650)],
}


def test_valid(spark):
    assert errors(spark, VALID) == []
    assert errors(spark, BACK, "-") == []


@pytest.mark.parametrize("code", sorted(CASES))
def test_error(spark, code):
    got = errors(spark, CASES[code])
    assert code in got
    # what else follows from the same change
    assert set(got) - {code} <= {15: {40}, 21: {41, 42}, 22: {46}, 23: set(), 33: {41, 42}, 34: {41}, 39: {42}, 41: {34}, 45: {41, 42}, 46: {41}, 47: {21}, 18: set()}.get(code, set())


def test_codons_are_read(spark):
    seq = list("C" * 700)
    seq[164:167], seq[523:526] = "ATG", "TAA"
    whole = spark.createDataFrame([("c", "".join(seq))], "contig string, seq string")
    assert errors(spark, VALID, sequences=whole) == []
    seq[164], seq[525] = "C", "C"
    seq[306:309] = "TAG"  # the 43rd coding base and on: in frame
    assert errors(spark, VALID, sequences=spark.createDataFrame([("c", "".join(seq))], "contig string, seq string")) == [24, 25, 28]


def test_lines(spark):
    good = line("exon", 1, 5)
    bad = {
        0: "c\ts\texon", 2: line("thing", 1, 5), 3: line("exon", "x", 5), 4: line("exon", 1, "y"), 5: good.replace("\t.\t+", "\tz\t+"), 6: good.replace("\t+\t", "\t*\t"), 7: line("exon", 1, 5, "3"), 10: good[:-1],
        11: good.replace('"g"', "g"), 13: good.replace("gene_id", "gen"), 14: good.replace("transcript_id", "trans"), 38: line("exon", 6, 5),
    }
    rows = [(v,) for v in [*bad.values(), good, "# comment", ""]]
    got = {r["value"]: r["codes"] for r in gc.line_errors(spark.createDataFrame(rows, "value string")).collect()}
    assert got == {v: ([k] if k != 11 else [11, 13]) for k, v in bad.items()} or {k: got.get(v) for k, v in bad.items()} == {k: [k] for k in bad}


def test_phases_put_right(spark):
    rows = [line(*r) for r in changed(("CDS", 501, 523, "2"), ("CDS", 501, 526, "0"))]
    parts = gc.transcript_parts(spark.createDataFrame([(r,) for r in rows], "value string"))
    r = gc.with_phases(parts).first()
    assert [tuple(e) for e in r["cds"]] == [(165, 200), (301, 400), (501, 523)] and r["phases"] == [0, 0, 2]
    back = gc.transcript_parts(spark.createDataFrame([(line(*x[:3], strand="-"),) for x in BACK], "value string"))
    assert gc.with_phases(back).select(F.col("phases")).first()["phases"] == [2, 0]
