"""Readers and writers of the text formats, as functions between DataFrames of lines (value string) and typed rows.

Readers of files split by Spark: ``lines(spark, path)`` for line formats, ``fasta(spark, path)`` with a record separator. Malformed
lines give nulls in the columns that don't parse; comment and blank lines are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions.seq import cigar_blocks


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value): the lines of files that Spark splits as it likes; block is the split's first byte, line counts from 0 within it.

    Lines are counted without a shuffle: a task reads its splits one after the other, so a line's place among the task's rows, less that of its split's first
    line, is its place in the split. Both readings of the files, this count and the lines, split them alike as long as the session's settings stay.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    first = raw.groupBy("file", "block").agg(F.min("at").alias("first")).select(F.col("file").alias("f"), F.col("block").alias("b"), "first")
    return raw.join(first, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).select("file", "block", (F.col("at") - F.col("first")).alias("line"), "value")


def carried(rows: DataFrame, **what: Column) -> DataFrame:
    """split_lines with each of `what` (null but where a line sets it) as the last one set up to the line, in its file.

    Windows go over single splits; what a split takes over from those before it comes from a table of one row a split.
    """
    inside = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    marked = rows.select("*", *[c.alias(f"__{n}") for n, c in what.items()])
    last = marked.groupBy("file", "block").agg(*[F.max_by(f"__{n}", F.when(F.col(f"__{n}").isNotNull(), F.col("line"))).alias(n) for n in what])
    over = last.select(F.col("file").alias("__f"), F.col("block").alias("__b"), *[F.last(n, ignorenulls=True).over(before).alias(f"__was_{n}") for n in what])
    joined = marked.join(over, (F.col("file") == F.col("__f")) & (F.col("block") == F.col("__b")))
    return joined.select(*rows.columns, *[F.coalesce(F.last(f"__{n}", ignorenulls=True).over(inside), F.col(f"__was_{n}")).alias(n) for n in what])


def counted(rows: DataFrame, name: str, which: Column) -> DataFrame:
    """split_lines with `name`: how many lines of the file up to this one are `which`; windows as in ``carried``."""
    inside = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    one = F.coalesce(which.cast("long"), F.lit(0))
    ahead = rows.groupBy("file", "block").agg(F.sum(one).alias("n"))
    ahead = ahead.select(F.col("file").alias("__f"), F.col("block").alias("__b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__ahead"))
    joined = rows.join(ahead, (F.col("file") == F.col("__f")) & (F.col("block") == F.col("__b")))
    return joined.select(*rows.columns, (F.sum(one).over(inside) + F.col("__ahead")).alias(name))


def once(value: Column) -> Column:
    """value as a generated column, worked out once for a row: the optimizer moves filters below a plain one and works it out again in each of their terms."""
    return F.explode(F.array(value))


def fields(rows: DataFrame, comment: str = "#") -> DataFrame:
    """Non-comment lines with c, their tab-separated fields."""
    line = once(F.struct("value", F.split("value", "\t", -1).alias("c")))
    cut = rows.select(*[c for c in rows.columns if c != "value"], line.alias("__line"))
    kept = cut.where((F.trim("__line.value") != "") & ~F.startswith("__line.value", F.lit(comment)))
    return kept.select(*[F.col("__line.value").alias("value") if c == "value" else c for c in rows.columns], F.col("__line.c").alias("c"))


def at(i: int, kind: str = "string") -> Column:
    """Field i (from 0) of c; null where it is missing, '.', or doesn't parse."""
    raw = F.get(F.col("c"), F.lit(i))
    return F.when(raw != ".", raw).try_cast(kind) if kind != "string" else F.when(raw != ".", raw)


def attribute(name: str, of: Column) -> Column:
    """The value of a GFF3 attribute, unescaped."""
    got = F.regexp_extract(of, rf"(?:^|;)\s*{name}=([^;]*)", 1)
    return F.when(got != "", F.url_decode(F.replace(got, F.lit("+"), F.lit("%2B"))))


def gtf_attribute(name: str, of: Column) -> Column:
    got = F.regexp_extract(of, rf'(?:^|;)\s*{name} "([^"]*)"', 1)
    return F.when(got != "", got)


def gff3(rows: DataFrame) -> DataFrame:
    a = at(8)
    return fields(rows).select(
        at(0).alias("contig"), at(1).alias("source"), at(2).alias("type"), at(3, "int").alias("lend"), at(4, "int").alias("rend"), at(5, "double").alias("score"),
        at(6).alias("strand"), at(7, "int").alias("phase"), attribute("ID", a).alias("id"), F.split(attribute("Parent", a), ",").alias("parents"),
        attribute("Name", a).alias("name"), F.split(attribute("Target", a), " ").alias("target"))


def gff3_alignments(rows: DataFrame) -> DataFrame:
    """(contig, id, acc, strand, lend, rend, num_segments, avg_per_id, segments): rows of one ID gathered."""
    g = gff3(rows).where("id IS NOT NULL")
    piece = F.struct("lend", "rend", F.get("target", F.lit(1)).try_cast("int").alias("mlend"), F.get("target", F.lit(2)).try_cast("int").alias("mrend"), F.col("score").alias("per_id"))
    size = F.col("rend") - F.col("lend") + 1
    return g.groupBy("contig", "id", F.get("target", F.lit(0)).alias("acc"), "strand").agg(
        F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.count("*").alias("num_segments"), (F.sum(F.col("score") * size) / F.sum(size)).alias("avg_per_id"),
        F.array_sort(F.collect_list(piece)).alias("segments"))


def gff3_genes(rows: DataFrame) -> DataFrame:
    """(contig, gene_id, model_id, strand, exons, cds): exons and coding parts under each model; a part may have several parents."""
    g = gff3(rows).select("contig", "type", "lend", "rend", "strand", "phase", "id", "parents")
    models = g.where(F.col("type").isin("mRNA", "transcript")).select("contig", "strand", F.col("id").alias("model_id"), F.explode("parents").alias("gene_id"))
    parts = g.where(F.col("type").isin("exon", "CDS")).select("type", "lend", "rend", "phase", F.explode("parents").alias("model_id"))
    one = F.struct("lend", "rend", "phase")
    held = parts.groupBy("model_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("type") == "exon", one))).alias("exons"), F.array_sort(F.collect_list(F.when(F.col("type") == "CDS", one))).alias("cds"))
    return models.join(held, "model_id", "left").select("contig", "gene_id", "model_id", "strand", "exons", "cds")


def gtf(rows: DataFrame) -> DataFrame:
    a = at(8)
    return fields(rows).select(
        at(0).alias("contig"), at(1).alias("source"), at(2).alias("type"), at(3, "int").alias("lend"), at(4, "int").alias("rend"), at(5, "double").alias("score"), at(6).alias("strand"),
        at(7, "int").alias("phase"), *[gtf_attribute(n, a).alias(n) for n in ("gene_id", "transcript_id")], *[gtf_attribute(n, a).try_cast("double").alias(n.lower()) for n in ("cov", "FPKM", "TPM")])


def gtf_transcripts(rows: DataFrame) -> DataFrame:
    g = gtf(rows).where("type = 'exon'")
    return g.groupBy("contig", "gene_id", "transcript_id", "strand").agg(F.min("lend").alias("lend"), F.max("rend").alias("rend"), F.array_sort(F.collect_list(F.struct("lend", "rend"))).alias("segments"))


def gtf_genes(rows: DataFrame) -> DataFrame:
    """(contig, gene_id, model_id, strand, exons, cds, start_codon, stop_codon): the parts of each transcript in genome order; cds leaves the stop codon out, as the format does."""
    g = gtf(rows).where("transcript_id IS NOT NULL")
    of = lambda kind, name: F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct("lend", "rend")))).alias(name)
    return g.groupBy("contig", "gene_id", F.col("transcript_id").alias("model_id"), "strand").agg(of("exon", "exons"), of("CDS", "cds"), of("start_codon", "start_codon"), of("stop_codon", "stop_codon"))


def bed12(rows: DataFrame) -> DataFrame:
    """Coordinates become 1-based and closed."""
    f = fields(rows).where(~F.col("value").rlike("^(track|browser)"))
    sizes, starts = (F.filter(F.split(at(i), ","), lambda x: x != "") for i in (10, 11))
    start = at(1, "int")
    blocks = F.zip_with(starts, sizes, lambda s, n: F.struct((start + s.try_cast("int") + 1).alias("lend"), (start + s.try_cast("int") + n.try_cast("int")).alias("rend")))
    return f.select(at(0).alias("contig"), (start + 1).alias("lend"), at(2, "int").alias("rend"), at(3).alias("name"), at(4, "double").alias("score"), at(5).alias("strand"),
                    (at(6, "int") + 1).alias("cds_lend"), at(7, "int").alias("cds_rend"), blocks.alias("segments"))


def psl(rows: DataFrame) -> DataFrame:
    """Hits with percent identity (two decimals) and blocks in genome and query coordinates, the query's own way round on '-'."""
    f = fields(rows).where(F.get("c", F.lit(0)).rlike("^[0-9]+$"))
    ints = lambda i: F.transform(F.filter(F.split(at(i), ","), lambda x: x != ""), lambda x: x.try_cast("int"))
    size, q, t = ints(18), ints(19), ints(20)
    n = at(10, "int")
    zipped = F.zip_with(F.arrays_zip(size.alias("n"), q.alias("q")), t, lambda a, b: F.struct((b + 1).alias("lend"), (b + a["n"]).alias("rend"),
        F.when(at(8) == "-", n - a["q"] - a["n"] + 1).otherwise(a["q"] + 1).alias("mlend"), F.when(at(8) == "-", n - a["q"]).otherwise(a["q"] + a["n"]).alias("mrend")))
    match, miss = at(0, "int"), at(1, "int")
    hit = F.struct(match.alias("matches"), miss.alias("mismatches"), at(8).alias("strand"), at(9).alias("query"), n.alias("query_size"), at(13).alias("contig"), at(15, "int").alias("t_start"), at(16, "int").alias("t_end"),
                    F.round(100 * match / (match + miss), 2).alias("per_id"), (match - miss - 4 * (at(4, "int") + at(6, "int")) - F.ln(at(7, "int") + 1)).alias("score"), zipped.alias("segments"))
    return f.select(once(hit).alias("h")).select("h.*")


def sam(rows: DataFrame) -> DataFrame:
    f = fields(rows, "@").select(at(0).alias("name"), at(1, "int").alias("flag"), at(2).alias("contig"), at(3, "int").alias("pos"), at(4, "int").alias("mapq"), at(5).alias("cigar"), at(9).alias("seq"))
    mapped = f.where("cigar IS NOT NULL AND cigar <> '*'")
    return mapped.withColumn("strand", F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")).withColumn("segments", cigar_blocks(F.col("cigar"), F.col("pos")))


def cigar_of(segments: Column) -> Column:
    """The CIGAR of blocks in genome order: N or D between them for the genome, I for the query."""
    n = F.size(segments)

    def piece(i: Column) -> Column:
        s, p = F.get(segments, i), F.get(segments, i - 1)
        gap, extra = s["lend"] - p["rend"] - 1, s["mlend"] - p["mrend"] - 1
        text = lambda x, op: F.when((i > 0) & (x > 0), F.concat(x.cast("string"), op)).otherwise("")
        return F.concat(text(extra, F.lit("I")), text(gap, F.when(gap >= 20, "N").otherwise("D")), (s["rend"] - s["lend"] + 1).cast("string"), F.lit("M"))

    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), piece), "")


def vcf(rows: DataFrame) -> DataFrame:
    return fields(rows).select(at(0).alias("contig"), at(1, "int").alias("pos"), at(2).alias("id"), at(3).alias("ref"), F.split(at(4), ",").alias("alts"), at(5, "double").alias("qual"), F.str_to_map(at(7), F.lit(";"), F.lit("=")).alias("info"))


def wiggle(rows: DataFrame) -> DataFrame:
    """(contig, pos, value) of variableStep and fixedStep data; rows are split_lines, or have number, their order within file, and a file column.

    A span of more than one base gives a row for each; track, browser, comment and malformed lines are left out.
    """
    if "number" in rows.columns:
        rows = rows.select("file", F.lit(0).alias("block"), F.col("number").alias("line"), "value")
    part = lambda name, default: F.coalesce(F.regexp_extract("value", rf"\b{name}=(\S+)", 1).try_cast("int"), F.lit(default))
    opens = F.col("value").rlike("^(variable|fixed)Step")
    data = F.col("value").rlike(r"^\s*-?[0-9.]")
    kept = counted(rows, "n", data)
    head = F.struct(F.regexp_extract("value", r"\bchrom=(\S+)", 1).alias("contig"), F.startswith("value", F.lit("fixed")).alias("fixed"), part("start", 1).alias("start"), part("step", 1).alias("step"), part("span", 1).alias("span"), F.col("n").alias("n"))
    held = carried(kept, head=F.when(opens, head)).where(data & F.col("head").isNotNull())
    got = F.split(F.trim("value"), r"\s+")
    fixed = F.col("head.fixed")
    pos = F.when(fixed, F.col("head.start") + F.col("head.step") * (F.col("n") - F.col("head.n") - 1)).otherwise(F.get(got, F.lit(0)).try_cast("int"))
    value = F.get(got, F.when(fixed, 0).otherwise(1)).try_cast("double")
    each = held.select(F.col("head.contig").alias("contig"), pos.cast("int").alias("from"), "head.span", value.alias("value"))
    return each.select("contig", F.explode(F.sequence("from", F.col("from") + F.greatest("span", F.lit(1)) - 1)).alias("pos"), "value")


def fasta_records(records: DataFrame) -> DataFrame:
    """(acc, header, seq) from records split at '\\n>' (value); the first may still hold its '>'."""
    body = F.regexp_replace("value", "^>", "")
    head = F.regexp_extract(body, r"^([^\n]*)", 1)
    out = records.select(F.regexp_extract(head, r"^(\S+)", 1).alias("acc"), head.alias("header"), F.regexp_replace(F.substring(body, F.length(head) + 1, F.length(body)), r"\s", "").alias("seq"))
    return out.where("acc <> ''")


def fasta(spark: SparkSession, path: str) -> DataFrame:
    return fasta_records(spark.read.option("lineSep", "\n>").text(path))


def fastq_records(records: DataFrame) -> DataFrame:
    """(name, seq, quality) from rows whose value is one whole record of four lines."""
    part = F.split("value", "\n")
    get = lambda i: F.get(part, F.lit(i))
    return records.where(F.startswith("value", F.lit("@"))).select(F.regexp_extract(get(0), r"^@(\S+)", 1).alias("name"), get(1).alias("seq"), get(3).alias("quality"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq, quality) of four-line FASTQ files, each split over many tasks: a record's lines are found by their number in the file."""
    rows = counted(split_lines(spark, path), "n", F.lit(True))
    place = F.pmod(F.col("n") - 1, F.lit(4))
    line = lambda i: F.max(F.when(place == i, F.col("value")))
    found = rows.groupBy("file", F.floor((F.col("n") - 1) / 4).alias("record")).agg(line(0).alias("head"), line(1).alias("seq"), line(2).alias("plus"), line(3).alias("quality"))
    good = F.startswith("head", F.lit("@")) & F.startswith("plus", F.lit("+")) & (F.length("seq") == F.length("quality"))
    return found.where(good).select(F.regexp_extract("head", r"^@(\S+)", 1).alias("name"), "seq", "quality")


def to_fastq(reads: DataFrame) -> DataFrame:
    """One row of four lines for each read (name, seq, quality)."""
    return reads.select(F.concat(F.lit("@"), F.col("name").cast("string"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("quality")).alias("value"))


def trim_report(rows: DataFrame) -> DataFrame:
    """(acc, length, left, right) of transcripts trimmed at exactly one end, once."""
    f = fields(rows).select(F.trim(at(0)).alias("acc"), F.trim(at(4)).try_cast("int").alias("length"), F.regexp_extract_all("value", F.lit(r"trimpoly\[\+?(\d+), -?(\d+)\]"), F.lit(1)).alias("l"), F.regexp_extract_all("value", F.lit(r"trimpoly\[\+?(\d+), -?(\d+)\]"), F.lit(2)).alias("r"))
    one = f.where(F.size("l") == 1).select("acc", "length", F.get("l", F.lit(0)).cast("int").alias("left"), F.get("r", F.lit(0)).cast("int").alias("right"))
    single = one.groupBy("acc").count().where("count = 1").select("acc")
    return one.where((F.col("left") > 0) != (F.col("right") > 0)).join(single, "acc", "left_semi")


def config(rows: DataFrame) -> DataFrame:
    """(script, key, value) of KEY=value and script:--option=value lines; script is null for the former."""
    f = rows.where(~F.trim("value").rlike(r"^(#|$)")).select(F.trim("value").alias("v"))
    m = lambda i: F.regexp_extract("v", r"^(?:([^:=\s]+):)?(-{0,2}[^=]+)=(.*)$", i)
    return f.select(F.when(m(1) != "", m(1)).alias("script"), m(2).alias("key"), F.trim(m(3)).alias("value")).where("key <> ''")


def _line(*cells: Column) -> Column:
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit(".")) for c in cells]).alias("value")


def to_gff3(alignments: DataFrame, source: str = "assembly", kind: str = "cDNA_match") -> DataFrame:
    """One line per segment of alignments (contig, id, acc, strand, segments with mlend, mrend and per_id)."""
    s = alignments.select("contig", "id", "acc", "strand", F.explode("segments").alias("s"))
    text = F.concat(F.lit("ID="), F.col("id").cast("string"), F.lit(";Target="), F.col("acc").cast("string"), F.lit(" "), F.col("s.mlend").cast("string"), F.lit(" "), F.col("s.mrend").cast("string"))
    return s.select(_line(F.col("contig"), F.lit(source), F.lit(kind), F.col("s.lend"), F.col("s.rend"), F.col("s.per_id"), F.col("strand"), F.lit("."), text))


def to_gtf(transcripts: DataFrame, source: str = "assembly") -> DataFrame:
    """A transcript line and a line per exon of (contig, gene_id, transcript_id, strand, lend, rend, segments)."""
    text = F.concat(F.lit('gene_id "'), F.col("gene_id").cast("string"), F.lit('"; transcript_id "'), F.col("transcript_id").cast("string"), F.lit('";'))
    row = lambda kind, a, b: _line(F.col("contig"), F.lit(source), F.lit(kind), a, b, F.lit("."), F.col("strand"), F.lit("."), text)
    whole = transcripts.select(row("transcript", F.col("lend"), F.col("rend")))
    return whole.unionByName(transcripts.withColumn("s", F.explode("segments")).select(row("exon", F.col("s.lend"), F.col("s.rend"))))


def to_bed12(transcripts: DataFrame) -> DataFrame:
    """BED lines of (contig, name, score, strand, cds_lend, cds_rend, segments in order)."""
    start = F.get("segments", F.lit(0))["lend"] - 1
    end = F.element_at("segments", -1)["rend"]
    listed = lambda f: F.array_join(F.transform("segments", lambda s: f(s).cast("string")), ",")
    cds = F.coalesce(F.col("cds_lend") - 1, start), F.coalesce(F.col("cds_rend"), end)
    return transcripts.select(_line(F.col("contig"), start, end, F.col("name"), F.coalesce("score", F.lit(0)).cast("int"), F.col("strand"), *cds, F.lit("0"), F.size("segments"),
                                    listed(lambda s: s["rend"] - s["lend"] + 1), listed(lambda s: s["lend"] - 1 - start)))


def to_fasta(sequences: DataFrame, width: int = 60) -> DataFrame:
    """One value per record (acc, seq), its sequence wrapped."""
    rows = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    return sequences.select(F.concat(F.lit(">"), F.col("acc").cast("string"), F.lit("\n"), rows).alias("value"))


def alignment_token(strand: Column, segments: Column) -> Column:
    """'orient(s) align: lend(mlend)-rend(mrend)>....<...': a structure in one line."""
    one = lambda s: F.format_string("%d(%d)-%d(%d)", s["lend"], s["mlend"], s["rend"], s["mrend"])
    return F.concat(F.lit("orient(s"), strand, F.lit(") align: "), F.array_join(F.transform(segments, one), ">....<"))


def btab(rows: DataFrame) -> DataFrame:
    """Hit rows of the tab-separated legacy report: query, program, subject, both spans, identity and strand by their order."""
    f = fields(rows)
    a, b = at(6, "int"), at(7, "int")
    return f.select(at(0).alias("query"), at(3).alias("program"), at(5).alias("subject"), F.least(a, b).alias("lend"), F.greatest(a, b).alias("rend"), at(8, "int").alias("mlend"), at(9, "int").alias("mrend"),
                    at(10, "double").alias("per_id"), at(13, "int").alias("chain"), F.when(a > b, "-").otherwise("+").alias("strand"))


def feature_table(rows: DataFrame) -> DataFrame:
    """(contig, feature, type, lend, rend, strand, partial) of '>Feature' tables; rows are split_lines, or have number, their order, and file.

    A line with a type opens a feature, lines of two numbers go on with it; qualifier lines are left out.
    """
    if "number" in rows.columns:
        rows = rows.select("file", F.lit(0).alias("block"), F.col("number").alias("line"), "value")
    c = F.split("value", "\t", -1)
    cell = lambda i: F.get(c, F.lit(i))
    opens = F.coalesce((cell(0) != "") & (F.trim(cell(2)) != ""), F.lit(False))
    head = F.regexp_extract("value", r"^>Feature\s+(\S+)", 1)
    held = carried(counted(rows, "feature", opens), contig=F.when(head != "", head), type=F.when(opens, F.trim(cell(2))))
    spans = held.where(F.col("value").rlike(r"^[<>]?\d+\t[<>]?\d+"))
    a, b = (F.regexp_replace(cell(i), "[<>]", "").try_cast("int") for i in (0, 1))
    return spans.select("contig", "feature", "type", F.least(a, b).alias("lend"), F.greatest(a, b).alias("rend"), F.when(a > b, "-").otherwise("+").alias("strand"), F.col("value").rlike("^[<>]|\t[<>]").alias("partial"))


def xmfa(records: DataFrame) -> DataFrame:
    """(block, genome, lend, rend, strand, source, seq) from blocks split at '\\n=' (value, number): one row per aligned genome."""
    entry = r">\s*(\d+):(\d+)-(\d+)\s+([+-])\s*([^\n]*)\n([^>]*)"
    parts = records.select(F.col("number").alias("block"), F.explode(F.regexp_extract_all("value", F.lit(entry), F.lit(0))).alias("e"))
    get = lambda i: F.regexp_extract("e", entry, i)
    return parts.select("block", get(1).cast("int").alias("genome"), get(2).cast("int").alias("lend"), get(3).cast("int").alias("rend"), get(4).alias("strand"), F.trim(get(5)).alias("source"), F.regexp_replace(get(6), r"[\s=]", "").alias("seq"))


def xml_rows(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """Elements of an XML file as nested rows, by Spark's own reader."""
    return spark.read.format("xml").option("rowTag", tag).load(path)


def accessions(rows: DataFrame) -> DataFrame:
    """(acc) of a list file, without blanks and repeats."""
    return rows.select(F.trim("value").alias("acc")).where("acc <> ''").distinct()
