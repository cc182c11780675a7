"""Validation of spliced alignments against contig and transcript sequences.

Alignments are rows (contig, acc, strand, segments array<struct<lend, rend, mlend, mrend>>) in genome order; mlend belongs to lend, so on
'-' the transcript's positions fall. Contig sequences are cut into tiles once; what a junction needs of them comes through an
equi-join on (contig, tile), so no row ever holds a contig.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.seq import reverse_complement
from strandloom.operators.annotate import consensus_pairs

TILE, OVER = 4096, 64


def tiles(sequences: DataFrame, width: int = TILE, over: int = OVER) -> DataFrame:
    """(contig, tile, bases) of (contig, seq): tile t begins at base t * width + 1 and reaches `over` bases into the next one.

    Strings are cut in Arrow batches: a column expression would count a long string from its start for every tile.
    """
    kind = sequences.schema["contig"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for row, seq in enumerate(batch.column(1).to_pylist()):
                for at in range(0, len(seq or ""), 256 * width):
                    starts = range(at, min(len(seq), at + 256 * width), width)
                    contig = batch.column(0).take(pa.array([row] * len(starts), pa.int32()))
                    yield pa.RecordBatch.from_arrays([contig, pa.array([s // width for s in starts], pa.int64()), pa.array([seq[s : s + width + over] for s in starts])], ["contig", "tile", "bases"])

    return sequences.select("contig", "seq").mapInArrow(cut, f"contig {kind}, tile bigint, bases string")


def with_bases(points: DataFrame, tiled: DataFrame, at: str, n: int, name: str, width: int = TILE, over: int = OVER) -> DataFrame:
    """points with `name`: the n bases of their contig from position `at` on, fewer at its ends, null beyond them."""
    if n > over:
        raise ValueError("a tile reaches no further than `over` bases into the next one")
    tile = F.floor((F.greatest(F.col(at), F.lit(1)) - 1) / width)
    found = points.withColumn("__tile", tile).join(tiled.select(F.col("contig").alias("__contig"), F.col("tile").alias("__t"), "bases"), F.expr("contig = __contig AND __tile = __t"), "left")
    begin = F.greatest(F.col(at), F.lit(1)) - F.col("__tile") * width
    length = n + F.least(F.col(at) - 1, F.lit(0))
    return found.withColumn(name, F.substring("bases", begin.cast("int"), length.cast("int"))).drop("__tile", "__contig", "__t", "bases")


def junctions(alignments: DataFrame, tiled: DataFrame, flank: int = 0, minor: bool = True) -> DataFrame:
    """(contig, acc, strand, number, lend, rend, left_site, right_site, left_flank, right_flank, and own_/flip_ pair, left, right) per intron.

    own_pair and flip_pair say whether the sites are a consensus pair on the aligned strand and on the other; _left and _right whether
    the one site alone belongs to such a pair.
    """
    step = F.transform(F.sequence(F.lit(1), F.size("segments") - 1), lambda i: F.struct(i.alias("number"), (F.get("segments", i - 1)["rend"] + 1).alias("lend"), (F.get("segments", i)["lend"] - 1).alias("rend")))
    each = alignments.where(F.size("segments") > 1).select("contig", "acc", "strand", F.explode(step).alias("i")).select("contig", "acc", "strand", "i.*")
    each = each.withColumns({"__a": F.col("lend") - flank, "__b": F.col("rend") - 1})
    each = with_bases(with_bases(each, tiled, "__a", flank + 2, "__left"), tiled, "__b", flank + 2, "__right")
    sites = {"left_site": F.upper(F.right("__left", F.lit(2))), "right_site": F.upper(F.left("__right", F.lit(2))), "left_flank": F.left("__left", F.lit(flank)), "right_flank": F.right("__right", F.lit(flank))}
    each = each.withColumns(sites).drop("__a", "__b", "__left", "__right")
    plus, minus = consensus_pairs(minor)
    tests = {}
    for name, own in (("own", True), ("flip", False)):
        first, second = (plus, minus) if own else (minus, plus)
        by = lambda f, a=first, b=second: F.coalesce(F.when(F.col("strand") == "-", f(b)).otherwise(f(a)), F.lit(False))
        tests[f"{name}_pair"] = by(lambda pairs: F.concat("left_site", "right_site").isin(*[x + y for x, y in pairs]))
        tests[f"{name}_left"] = by(lambda pairs: F.col("left_site").isin(*[x for x, _ in pairs]))
        tests[f"{name}_right"] = by(lambda pairs: F.col("right_site").isin(*[y for _, y in pairs]))
    return each.withColumns(tests)


def spliced_orientation(alignments: DataFrame, junction: DataFrame) -> DataFrame:
    """(contig, acc, strand, spliced_strand, error): the aligned strand if all junctions are consensus on it, else the other if they
    are on that, else '?' with an error; '?' without one for a single segment."""
    got = junction.groupBy("contig", "acc", "strand").agg(F.bool_and("own_pair").alias("own"), F.bool_and("flip_pair").alias("flip"))
    joined = alignments.select("contig", "acc", "strand").join(got, ["contig", "acc", "strand"], "left")
    spliced = F.when(F.col("own"), F.col("strand")).when(F.col("flip"), F.translate("strand", "+-", "-+")).otherwise("?")
    error = F.when(~F.col("own") & ~F.col("flip"), "splice sites")
    return joined.select("contig", "acc", "strand", spliced.alias("spliced_strand"), error.alias("error"))


def contiguous(segments: Column, strand: Column) -> Column:
    """Whether the transcript goes on without a gap or overlap from each segment to the next."""
    step = F.when(strand == "-", -1).otherwise(1)
    return (F.size(segments) < 2) | F.forall(F.sequence(F.lit(1), F.greatest(F.size(segments) - 1, F.lit(1))), lambda i: F.coalesce(F.get(segments, i)["mlend"] - F.get(segments, i - 1)["mrend"] == step, F.lit(True)))


def intron_lengths(segments: Column) -> tuple[Column, Column]:
    """(shortest, longest) stretch between neighbouring segments, null for one segment."""
    inner = F.filter(F.transform(segments, lambda s, i: s["lend"] - F.get(segments, i - 1)["rend"] - 1), lambda x: x.isNotNull())
    return F.array_min(inner), F.array_max(inner)


def boundary_mismatches(alignments: DataFrame, junction: DataFrame, transcripts: DataFrame, flank: int) -> DataFrame:
    """(contig, acc, strand, mismatches): sides of introns at which the `flank` bases next to them (or as many as the segment has)
    differ between contig and transcript (acc, seq). junction comes from junctions() with at least that flank."""
    n = F.size("segments")
    side = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(i.alias("number"), F.get("segments", i - 1).alias("p"), F.get("segments", i).alias("c")))
    pairs = alignments.where(n > 1).select("contig", "acc", "strand", F.explode(side).alias("s")).select("contig", "acc", "strand", "s.*")
    pairs = pairs.join(junction.select("contig", "acc", "strand", "number", "left_flank", "right_flank"), ["contig", "acc", "strand", "number"]).join(transcripts.select("acc", "seq"), "acc")
    k = lambda s: F.least(F.lit(flank), s["rend"] - s["lend"] + 1)
    p, c, plus = F.col("p"), F.col("c"), F.col("strand") != "-"
    text = lambda at, size: F.substring(F.col("seq"), at, size)
    left = F.when(plus, text(p["mrend"] - k(p) + 1, k(p))).otherwise(reverse_complement(text(p["mrend"], k(p))))
    right = F.when(plus, text(c["mlend"], k(c))).otherwise(reverse_complement(text(c["mlend"] - k(c) + 1, k(c))))
    bad = (F.upper(left) != F.upper(F.right(F.col("left_flank"), k(p)))).cast("int") + (F.upper(right) != F.upper(F.left(F.col("right_flank"), k(c)))).cast("int")
    found = pairs.groupBy("contig", "acc", "strand").agg(F.sum(bad).alias("mismatches"))
    return alignments.select("contig", "acc", "strand").join(found, ["contig", "acc", "strand"], "left").na.fill(0, ["mismatches"])


def cascade(splice_error: Column, contiguous: Column, mismatches: Column, shortest: Column, longest: Column, percent: Column, identity: Column,
            least_intron: int = 20, most_intron: int = 2000, least_percent: float = 90, least_identity: float = 95) -> Column:
    """Why an alignment is not valid, null if it is: the first failure of splice sites or contiguity, then boundaries and introns, then what is aligned, then identity."""
    return (
        F.when(~contiguous, "incontiguous").when(splice_error.isNotNull(), splice_error).when(longest > most_intron, "intron too long").when(shortest < least_intron, "intron too short")
        .when(mismatches > 0, "splice boundary").when(percent < least_percent, "too little aligned").when(identity < least_identity, "too little identity")
    )


def without_lone_segments(alignments: DataFrame, full: DataFrame) -> DataFrame:
    """alignments with valid set to false where they are valid, of one segment and not full-length (acc in `full`)."""
    marked = alignments.join(full.select("acc").distinct().withColumn("__full", F.lit(True)), "acc", "left")
    lone = F.col("valid") & (F.size("segments") == 1) & F.col("__full").isNull()
    return marked.withColumn("valid", F.when(lone, False).otherwise(F.col("valid"))).drop("__full")


def strand_from_tails(alignments: DataFrame, sites: DataFrame) -> DataFrame:
    """alignments with the strand that a poly-A site (acc, strand) of their transcript says, where theirs is unknown; the site's strands must agree."""
    known = sites.groupBy("acc").agg(F.min("strand").alias("__s"), F.countDistinct("strand").alias("__n")).where("__n = 1").drop("__n")
    return alignments.join(known, "acc", "left").withColumn("strand", F.when(F.col("strand") == "?", F.coalesce("__s", "strand")).otherwise(F.col("strand"))).drop("__s")


def with_aligned_strand(alignments: DataFrame) -> DataFrame:
    """alignments whose spliced strand is the aligned one, for transcripts that were sequenced by strand."""
    return alignments.withColumn("spliced_strand", F.col("strand"))
