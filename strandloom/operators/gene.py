"""Gene models: coding parts, phases, untranslated parts, codons, sequences and coordinates.

A model is a row (contig, gene_id, model_id, strand, exons, cds): exons and cds are arrays of struct<lend, rend> in genome order,
cds the coding parts of the exons, empty for a model that codes nothing. All of it is array arithmetic inside a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.seq import spliced, stop_codons, translate
from strandloom.plans.lineage import shuffled

PAIR = "array<struct<lend:int,rend:int>>"


def _pair(lend: Column, rend: Column) -> Column:
    return F.struct(lend.cast("int").alias("lend"), rend.cast("int").alias("rend"))


def none() -> Column:
    return F.array().cast(PAIR)


def clipped(exons: Column, lend: Column, rend: Column) -> Column:
    """The parts of exons that lie in lend..rend."""
    parts = F.transform(exons, lambda e: _pair(F.greatest(e["lend"], lend), F.least(e["rend"], rend)))
    return F.coalesce(F.filter(parts, lambda e: e["lend"] <= e["rend"]), none())


def joined(parts: Column) -> Column:
    """parts in genome order, those that touch or overlap as one."""
    def step(a: Column, e: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        grown = F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(_pair(last["lend"], F.greatest(last["rend"], e["rend"]))))
        return F.when(F.coalesce(e["lend"] <= last["rend"] + 1, F.lit(False)), grown).otherwise(F.concat(a, F.array(_pair(e["lend"], e["rend"]))))

    return F.aggregate(F.array_sort(parts), none(), step)


def size(parts: Column) -> Column:
    """Bases in all parts."""
    return F.aggregate(parts, F.lit(0), lambda a, e: a + e["rend"] - e["lend"] + 1)


def along(parts: Column, strand: Column) -> Column:
    """Parts in the model's direction."""
    return F.when(strand == "-", F.reverse(parts)).otherwise(parts)


def untranslated(exons: Column, cds: Column, strand: Column) -> tuple[Column, Column]:
    """The exon parts before and behind the coding part in the model's direction; empty for a model that codes nothing."""
    first, last = F.get(cds, F.lit(0))["lend"], F.try_element_at(cds, F.lit(-1))["rend"]
    left, right = clipped(exons, F.lit(-(2**31) + 1), first - 1), clipped(exons, last + 1, F.lit(2**31 - 1))
    coding = F.size(cds) > 0
    pick = lambda a, b: F.when(coding, F.when(strand == "-", b).otherwise(a)).otherwise(none())
    return pick(left, right), pick(right, left)


def phased(cds: Column, strand: Column, first: Column | None = None) -> Column:
    """array<struct<lend, rend, phase>> in genome order: coded bases before each part, with `first` bases before the first, modulo 3."""
    start = F.struct(F.coalesce(first, F.lit(0)).cast("int").alias("n") if first is not None else F.lit(0).alias("n"), F.array().cast("array<struct<lend:int,rend:int,phase:int>>").alias("out"))

    def step(a: Column, e: Column) -> Column:
        one = F.struct(e["lend"].alias("lend"), e["rend"].alias("rend"), (a["n"] % 3).alias("phase"))
        return F.struct((a["n"] + e["rend"] - e["lend"] + 1).alias("n"), F.concat(a["out"], F.array(one)).alias("out"))

    return F.aggregate(along(cds, strand), start, step, lambda a: along(a["out"], strand))


def within(parts: Column, strand: Column, begin: Column, end: Column) -> Column:
    """The genome parts of positions begin..end (from 1, closed) of the spliced parts, in genome order."""
    start = F.struct(F.lit(0).alias("n"), none().alias("out"))

    def step(a: Column, e: Column) -> Column:
        length = e["rend"] - e["lend"] + 1
        x, y = F.greatest(begin - a["n"], F.lit(1)), F.least(end - a["n"], length)
        part = F.when(strand == "-", _pair(e["rend"] - y + 1, e["rend"] - x + 1)).otherwise(_pair(e["lend"] + x - 1, e["lend"] + y - 1))
        return F.struct((a["n"] + length).alias("n"), F.when(x <= y, F.concat(a["out"], F.array(part))).otherwise(a["out"]).alias("out"))

    return F.aggregate(along(parts, strand), start, step, lambda a: F.array_sort(a["out"]))


def codon(cds: Column, strand: Column, number: Column) -> Column:
    """The genome parts of the number-th codon, two or three where introns cut it: amino acid to nucleotide coordinates."""
    return within(cds, strand, 3 * number - 2, 3 * number)


def trimmed_stop(cds: Column, strand: Column) -> Column:
    """cds without its last three bases."""
    return within(cds, strand, F.lit(1), size(cds) - 3)


def with_region(models: DataFrame, sequences: DataFrame, width: int = 4096, tiled: DataFrame | None = None) -> DataFrame:
    """models with __lend, __rend and bases: what their contig holds between their ends, from (contig, seq) sequences or their tiles of `width`."""
    from strandloom.operators.events import region_sequences
    from strandloom.operators.validate import tiles

    ends = {"lend": F.get("exons", F.lit(0))["lend"], "rend": F.element_at("exons", -1)["rend"]}
    spans = models.select("contig", *[c.alias(n) for n, c in ends.items()]).distinct().withColumn("strand", F.lit("+"))
    held = region_sequences(spans, tiles(sequences, width) if tiled is None else tiled, width).select(F.col("contig").alias("__contig"), F.col("lend").alias("__lend"), F.col("rend").alias("__rend"), "bases")
    return shuffled(models).join(held, (F.col("contig") == F.col("__contig")) & (ends["lend"] == F.col("__lend")) & (ends["rend"] == F.col("__rend"))).drop("__contig")


def with_sequences(models: DataFrame, sequences: DataFrame, code: str = "universal", width: int = 4096, tiled: DataFrame | None = None) -> DataFrame:
    """models with cdna, coding and protein, from (contig, seq) sequences or their tiles of `width`; a row holds what lies between a model's ends, not a contig."""
    held = with_region(models, sequences, width, tiled)
    moved = lambda parts: F.transform(parts, lambda e: _pair(e["lend"] - F.col("__lend") + 1, e["rend"] - F.col("__lend") + 1))
    held = held.withColumns({"cdna": spliced(F.col("bases"), moved(F.col("exons")), F.col("strand")), "coding": spliced(F.col("bases"), moved(F.col("cds")), F.col("strand"))})
    return held.drop("bases", "__lend", "__rend").withColumn("protein", translate(F.col("coding"), 1, code))


def project(orfs: DataFrame, exons: str = "exons", strand: str = "strand") -> DataFrame:
    """orfs with cds: the genome parts of the open frame at o_lend..o_rend (on the transcript, o_strand its direction there), and the model's own strand.

    A frame on the transcript's other strand turns the model around.
    """
    flipped = F.translate(F.col(strand), "+-", "-+")
    cds = within(F.col(exons), F.col(strand), F.col("o_lend"), F.col("o_rend"))
    return orfs.withColumn("cds", cds).withColumn(strand, F.when(F.col("o_strand") == "-", flipped).otherwise(F.col(strand)))


def between_introns(exons: Column, lend: Column, rend: Column) -> Column:
    """The region lend..rend widened to the next exons before and behind it; null where either is missing."""
    left = F.array_max(F.transform(F.filter(exons, lambda e: e["rend"] < lend), lambda e: e["rend"])) + 1
    right = F.array_min(F.transform(F.filter(exons, lambda e: e["lend"] > rend), lambda e: e["lend"])) - 1
    return F.when(left.isNotNull() & right.isNotNull(), _pair(left, right))


def to_neighbour(exons: Column, lend: Column, rend: Column) -> Column:
    """A terminal region widened over the intron next to it, up to the exons that don't lie in it; null if those are on both of its sides or meet it."""
    others = F.filter(exons, lambda e: ~((e["lend"] >= lend) & (e["rend"] <= rend)))
    first, last = F.array_min(F.transform(others, lambda e: e["lend"])), F.array_max(F.transform(others, lambda e: e["rend"]))
    return F.when(last < lend, _pair(last + 1, rend)).when(first > rend, _pair(lend, first - 1))


def false_untranslated(old_cds: Column, old_exons: Column, new_exons: Column, new_cds: Column, evidence: Column) -> Column:
    """Whether a new untranslated part lies in the old model's coding part and no segment of the evidence meets it."""
    outside = F.filter(new_exons, lambda e: ~F.exists(new_cds, lambda c: (c["lend"] <= e["rend"]) & (c["rend"] >= e["lend"])))
    lost = F.filter(outside, lambda e: F.exists(old_cds, lambda c: (c["lend"] <= e["rend"]) & (c["rend"] >= e["lend"])))
    return F.exists(lost, lambda e: ~F.exists(evidence, lambda s: (s["lend"] <= e["rend"]) & (s["rend"] >= e["lend"])))


def stomps(old_lend: Column, old_rend: Column, new_lend: Column, new_rend: Column, least: float = 80.0) -> Column:
    """Whether a new model covers `least` percent of the old one's span."""
    shared = F.greatest(F.lit(0), F.least(old_rend, new_rend) - F.greatest(old_lend, new_lend) + 1)
    return 100 * shared >= least * (old_rend - old_lend + 1)


def selected_orfs(scores: DataFrame, by: str, length: Column, retain: int, supported: Column | None = None) -> DataFrame:
    """Ids kept from (by, frame 1-6, score) with length: supported, or of `retain` bases, or best in frame 1 and above zero there."""
    own = F.max(F.when(F.col("frame") == 1, F.col("score")))
    other = F.max(F.when(F.col("frame") != 1, F.col("score")))
    got = scores.groupBy(by).agg(own.alias("own"), other.alias("other"), F.max(length).alias("length"), F.max(F.lit(False) if supported is None else supported).alias("supported"))
    return got.where("supported OR length >= " + str(retain) + " OR own > 0 AND own > coalesce(other, own - 1)").select(by, "own", "other", "length")


def training_set(coded: DataFrame, ratios: DataFrame, k: int, retain: int, by: str = "acc") -> DataFrame:
    """The structures (acc, cds, cdna, coding) whose coding sequence is long enough or scores best in its own frame by the k-mer log ratios: examples to train on."""
    from strandloom.functions.seq import frame_scores

    scores = frame_scores(coded, ratios, by, "coding", k, both=True)
    lengths = coded.select(by, F.length("coding").alias("__n"))
    kept = selected_orfs(scores.join(lengths, by), by, F.col("__n"), retain)
    return coded.join(kept.select(by, "own", "other"), by)


def _attributes(**pairs: Column) -> Column:
    return F.concat_ws(";", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in pairs.items()])


def _marked(kind: str, parts: Column, phase) -> Column:
    """array<struct<kind, lend, rend, phase>>: parts of one kind, with phase(part)."""
    return F.transform(parts, lambda e: F.struct(F.lit(kind).alias("kind"), e["lend"].alias("lend"), e["rend"].alias("rend"), phase(e).cast("int").alias("phase")))


def gff3_lines(models: DataFrame, source: str = "assembly") -> DataFrame:
    """(contig, gene_id, model_id, level, lend, value): gene, mRNA, exon, CDS with phase and UTR lines; a gene has one line, over all its models.

    A phase here says how many bases of the part come before the next codon begins, as the format does.
    """
    from strandloom.sources.formats import _line

    c = F.col
    spans = models.withColumns({"lend": F.get("exons", F.lit(0))["lend"], "rend": F.element_at("exons", -1)["rend"]})
    genes = spans.groupBy("contig", "gene_id", "strand").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"))
    row = lambda kind, lend, rend, phase, text: _line(c("contig"), F.lit(source), F.lit(kind) if isinstance(kind, str) else kind, lend, rend, F.lit("."), c("strand"), phase, text)
    dot = F.lit(".")
    out = genes.select("contig", "gene_id", F.lit(None).cast("string").alias("model_id"), F.lit(0).alias("level"), "lend", row("gene", c("lend"), c("rend"), dot, _attributes(ID=c("gene_id"))))
    keys = ["contig", "gene_id", c("model_id").cast("string").alias("model_id")]
    out = out.unionByName(spans.select(*keys, F.lit(1).alias("level"), "lend", row("mRNA", c("lend"), c("rend"), dot, _attributes(ID=c("model_id"), Parent=c("gene_id")))))
    five, three = untranslated(c("exons"), c("cds"), c("strand"))
    kinds = [("exon", c("exons")), ("five_prime_UTR", five), ("three_prime_UTR", three)]
    listed = [_marked(kind, parts, lambda e: F.lit(None)) for kind, parts in kinds]
    cds = _marked("CDS", phased(c("cds"), c("strand")), lambda e: (3 - e["phase"]) % 3)
    parts = models.select(*keys, "strand", F.explode(F.concat(*listed, cds)).alias("p"))
    text = F.concat_ws(";", F.concat(F.lit("ID="), c("model_id"), F.lit("."), c("p.kind"), c("p.lend").cast("string")), F.concat(F.lit("Parent="), c("model_id")))
    return out.unionByName(parts.select("contig", "gene_id", "model_id", F.lit(2).alias("level"), c("p.lend").alias("lend"), row(c("p.kind"), c("p.lend"), c("p.rend"), c("p.phase"), text)))


def gtf_lines(models: DataFrame, source: str = "assembly", code: str = "universal") -> DataFrame:
    """(contig, gene_id, model_id, lend, value): transcript, exon, CDS and codon lines of models with their coding sequence (with_sequences).

    A start codon is given where the coding part begins with ATG, a stop codon where it ends in one in frame; CDS lines then leave the stop out.
    Codons that introns cut have a line for each part.
    """
    from strandloom.sources.formats import _line

    c = F.col
    n = F.length("coding")
    starts = F.upper(F.left(c("coding"), F.lit(3))) == "ATG"
    stops = (n % 3 == 0) & (n >= 3) & F.upper(F.right(c("coding"), F.lit(3))).isin(*stop_codons(code))
    span = F.array(_pair(F.get("exons", F.lit(0))["lend"], F.element_at("exons", -1)["rend"]))
    held = F.when(stops, trimmed_stop(c("cds"), c("strand"))).otherwise(c("cds"))
    plain, zero = lambda e: F.lit(None), lambda e: F.lit(0)
    lists = [
        _marked("transcript", span, plain), _marked("exon", c("exons"), plain), _marked("CDS", phased(held, c("strand")), lambda e: (3 - e["phase"]) % 3),
        _marked("start_codon", F.when(starts, within(c("cds"), c("strand"), F.lit(1), F.lit(3))).otherwise(none()), zero),
        _marked("stop_codon", F.when(stops, within(c("cds"), c("strand"), n - 2, n)).otherwise(none()), zero),
    ]
    text = F.concat(F.lit('gene_id "'), c("gene_id").cast("string"), F.lit('"; transcript_id "'), c("model_id").cast("string"), F.lit('";'))
    rows = models.select("contig", "gene_id", "model_id", "strand", F.explode(F.concat(*lists)).alias("p"))
    return rows.select("contig", "gene_id", "model_id", c("p.lend").alias("lend"), _line(c("contig"), F.lit(source), c("p.kind"), c("p.lend"), c("p.rend"), F.lit(0), c("strand"), c("p.phase"), text))
