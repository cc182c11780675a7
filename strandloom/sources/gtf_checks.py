"""What is wrong with GTF files: lines by their fields, transcripts by their codons, coding parts and phases, and phases put right.

All of it is column functions over lines and over each transcript's gathered parts; codes are numbers, listed in ``MEANS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators.gene import along, clipped, none, size
from strandloom.plans.lineage import stored
from strandloom.sources.formats import gtf, gtf_attribute

# The numbers of the errors, and what they stand for.
MEANS = {
    0: "fewer than nine fields", 2: "unknown feature", 3: "start isn't a number", 4: "end isn't a number", 5: "score isn't a number or a dot", 6: "strand isn't +, - or a dot", 7: "phase isn't 0, 1, 2 or a dot",
    10: "attributes don't end in a semicolon", 11: "attribute values without quotes", 13: "no gene_id", 14: "no transcript_id", 38: "start beyond the end",
    15: "no coding part", 16: "start codon isn't three bases", 17: "no start codon", 18: "stop codon isn't three bases", 19: "no stop codon", 20: "a gene of two strands", 21: "coding part before the start codon",
    22: "coding part behind the stop codon", 23: "a transcript of several genes", 24: "start codon isn't ATG", 25: "stop codon is no stop", 28: "stop inside the coding part", 33: "coding part doesn't begin with the start codon",
    34: "stop codon doesn't follow the coding part", 39: "phase isn't 0 at a start codon", 40: "no phase", 41: "complete, but not a multiple of three", 42: "phases don't follow each other", 45: "coding parts overlap",
    46: "stop codon inside the coding part", 47: "start codon outside of exons", 48: "intron of no base", 49: "intron of fewer than 20 bases",
}
FEATURES = ("CDS", "exon", "start_codon", "stop_codon", "5UTR", "3UTR", "transcript", "gene", "inter", "inter_CNS", "UTR", "Selenocysteine")
SHORT = 20


def _codes(tests: list[tuple[int, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(code)) for code, t in tests]))


def line_errors(rows: DataFrame) -> DataFrame:
    """(value, codes) of lines (value) with errors; comment and blank lines are left out."""
    kept = rows.where((F.trim("value") != "") & ~F.startswith("value", F.lit("#"))).withColumn("c", F.split("value", "\t", -1))
    cell = lambda i: F.coalesce(F.get("c", F.lit(i)), F.lit(""))
    whole = F.size("c") >= 9
    number = lambda i: cell(i).rlike(r"^\d+$")
    attributes = F.trim(cell(8))
    tests = [
        (0, ~whole), (2, whole & ~cell(2).isin(*FEATURES)), (3, whole & ~number(3)), (4, whole & ~number(4)), (5, whole & (cell(5) != ".") & cell(5).try_cast("double").isNull()),
        (6, whole & ~cell(6).isin("+", "-", ".")), (7, whole & ~cell(7).isin("0", "1", "2", ".")), (10, whole & ~F.endswith(attributes, F.lit(";"))),
        (11, whole & attributes.rlike(r"(^|;)\s*[\w.]+\s+[^\s\";]")), (13, whole & gtf_attribute("gene_id", cell(8)).isNull()),
        (14, whole & (cell(2) != "gene") & gtf_attribute("transcript_id", cell(8)).isNull()), (38, whole & number(3) & number(4) & (cell(3).try_cast("long") > cell(4).try_cast("long"))),
    ]
    return kept.select("value", _codes(tests).alias("codes")).where(F.size("codes") > 0)


def transcript_parts(rows: DataFrame) -> DataFrame:
    """(contig, transcript_id, gene_ids, strands, strand, exons, cds, phases, start, stop): each transcript's parts in genome order; exons are the coding parts where there are none."""
    return _gathered(gtf(rows))


def _gathered(g: DataFrame) -> DataFrame:
    g = g.where("transcript_id IS NOT NULL AND lend <= rend")
    of = lambda kind, name: F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct("lend", "rend")))).alias(name)
    phased = F.array_sort(F.collect_list(F.when(F.col("type") == "CDS", F.struct("lend", "rend", "phase"))))
    t = g.groupBy("contig", "transcript_id").agg(F.array_sort(F.collect_set("gene_id")).alias("gene_ids"), F.array_sort(F.collect_set("strand")).alias("strands"), F.min("strand").alias("strand"),
                                                  of("exon", "exons"), of("CDS", "cds"), F.transform(phased, lambda p: p["phase"]).alias("phases"), of("start_codon", "start"), of("stop_codon", "stop"))
    return t.withColumn("exons", F.when(F.size("exons") > 0, F.col("exons")).otherwise(F.array_sort(F.concat("cds", "stop"))))


def _expected(cds: Column, strand: Column, first: Column) -> Column:
    """Phases in the transcript's direction, if its first coding part has `first`: bases before the next codon begins."""
    def step(a: Column, e: Column) -> Column:
        return F.struct((a["n"] + e["rend"] - e["lend"] + 1).alias("n"), F.concat(a["out"], F.array(F.pmod(-a["n"], F.lit(3)).cast("int"))).alias("out"))

    start = F.struct((-first).cast("int").alias("n"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(along(cds, strand), start, step, lambda a: a["out"])


def transcript_errors(rows: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """(contig, transcript_id, codes): what is wrong with each transcript, none if nothing is; with sequences (contig, seq) codons are read, too."""
    c = F.col
    g = stored(gtf(rows).select("contig", "gene_id", "transcript_id", "type", "lend", "rend", "strand", "phase"))  # lines are parsed once; what follows reads them three times
    t = _gathered(g)
    flips = g.where("gene_id IS NOT NULL").groupBy("contig", "gene_id").agg(F.min("strand").alias("low"), F.max("strand").alias("high")).where("low <> high").select("contig", "gene_id")
    mixed = g.where("transcript_id IS NOT NULL AND lend <= rend").join(flips, ["contig", "gene_id"]).select("contig", "transcript_id", F.lit(True).alias("mixed")).distinct()
    t = t.join(mixed, ["contig", "transcript_id"], "left")
    back, coding = c("strand") == "-", F.size("cds") > 0
    low = lambda x: F.get(x, F.lit(0))["lend"]
    high = lambda x: F.array_max(F.transform(x, lambda e: e["rend"]))
    has_start, has_stop = F.size("start") > 0, F.size("stop") > 0
    # positions in the transcript's direction: first and last bases
    begin = lambda x: F.when(back, -high(x)).otherwise(low(x))
    end = lambda x: F.when(back, -low(x)).otherwise(high(x))
    between = F.when(back, size(clipped(c("exons"), high("stop") + 1, low("cds") - 1))).otherwise(size(clipped(c("exons"), high("cds") + 1, low("stop") - 1)))
    phases = along(c("phases"), c("strand"))
    first = F.get(phases, F.lit(0))
    follow = F.zip_with(phases, _expected(c("cds"), c("strand"), F.coalesce(first, F.lit(0))), lambda a, b: a.isNotNull() & (a != b))
    gaps = lambda x: F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: F.get(x, i)["lend"] - F.get(x, i - 1)["rend"] - 1)
    inner = lambda x: F.filter(gaps(x), lambda g: g.isNotNull())
    outside = F.exists("start", lambda s: ~F.exists("exons", lambda e: (e["lend"] <= s["lend"]) & (e["rend"] >= s["rend"])))
    shared = F.exists("stop", lambda s: F.exists("cds", lambda e: (e["lend"] <= s["rend"]) & (e["rend"] >= s["lend"])))
    exons = F.when(F.size("exons") > 0, c("exons")).otherwise(none())
    tests = [
        (15, ~coding), (16, has_start & (size(c("start")) != 3)), (17, ~has_start), (18, has_stop & (size(c("stop")) != 3)), (19, ~has_stop), (20, (F.size("strands") > 1) | c("mixed")),
        (21, coding & has_start & (begin("cds") < begin("start"))), (22, coding & has_stop & (end("cds") > end("stop"))), (23, F.size("gene_ids") > 1), (33, coding & has_start & (begin("cds") > begin("start"))),
        (34, coding & has_stop & ~shared & (begin("stop") > end("cds")) & (between > 0)), (39, coding & has_start & (first != 0)), (40, F.exists("phases", lambda p: p.isNull()) | (F.size("phases") < F.size("cds"))),
        (41, coding & has_start & has_stop & (size(c("cds")) % 3 != 0)), (42, F.exists(follow, lambda x: x)), (45, F.exists(inner(c("cds")), lambda g: g < 0)), (46, shared), (47, has_start & (F.size("exons") > 0) & outside),
        (48, F.exists(inner(exons), lambda g: g == 0)), (49, F.exists(inner(exons), lambda g: (g > 0) & (g < SHORT))),
    ]
    found = t.withColumn("codes", _codes(tests))
    if sequences is None:
        return found.select("contig", "transcript_id", "codes")
    from strandloom.functions.seq import stop_codons
    from strandloom.operators.gene import with_sequences

    read = lambda parts: with_sequences(found.where(F.size(parts) > 0).select("contig", "transcript_id", "strand", c(parts).alias("exons"), c(parts).alias("cds")), sequences)
    key = ["contig", "transcript_id"]
    for name in ("start", "stop", "cds"):
        found = found.join(read(name).select(*key, F.upper("coding").alias(f"of_{name}"), c("protein").alias(f"as_{name}")), key, "left")
    after = F.substring("of_cds", F.coalesce(first, F.lit(0)) + 1, F.length("of_cds"))
    from strandloom.functions.seq import translate

    more = [(24, (F.length("of_start") == 3) & (c("of_start") != "ATG")), (25, (F.length("of_stop") == 3) & ~c("of_stop").isin(*stop_codons())), (28, F.contains(translate(after), F.lit("*")))]
    return found.select(*key, F.array_sort(F.concat("codes", _codes(more))).alias("codes"))


def with_phases(parts: DataFrame) -> DataFrame:
    """transcript_parts with phases put right: from the first one's, or 0 where there is none or a start codon says so; one of the stop's bases goes from the coding part where it holds them."""
    c = F.col
    kept = F.filter(F.flatten(F.transform("cds", lambda e: F.array(*[F.struct(x.cast("int").alias("lend"), y.cast("int").alias("rend")) for x, y in (
        (e["lend"], F.least(e["rend"], F.coalesce(F.get("stop", F.lit(0))["lend"] - 1, e["rend"]))), (F.greatest(e["lend"], F.coalesce(F.array_max(F.transform("stop", lambda s: s["rend"])) + 1, e["rend"] + 1)), e["rend"]))]))), lambda e: e["lend"] <= e["rend"])
    first = F.when(F.size("start") > 0, 0).otherwise(F.coalesce(F.get(along(c("phases"), c("strand")), F.lit(0)), F.lit(0)))
    out = parts.withColumn("cds", F.array_sort(kept))
    return out.withColumn("phases", along(_expected(c("cds"), c("strand"), first), c("strand")))
