"""Sequence functions over string columns: built-in expressions wherever they can say it, Arrow UDFs for ORFs and masks."""

from __future__ import annotations

import re
from collections import Counter
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.plans.lineage import shuffled

# The complements of the IUPAC base codes, and the standard genetic code in the order TCAG x TCAG x TCAG.
BASES, COMPLEMENTS = "ACGTRYMKSWBDHVNacgtrymkswbdhvn", "TGCAYRKMSWVHDBNtgcayrkmswvhdbn"
ORDER = "TCAG"
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
# Codons that other codes read differently.
VARIANTS = {
    "universal": {},
    "ciliate": {"TAA": "Q", "TAG": "Q"},
    "acetabularia": {"TAA": "Q", "TAG": "Q"},
    "euplotid": {"TGA": "C"},
    "candida": {"CTG": "S"},
    "vertebrate_mitochondrial": {"AGA": "*", "AGG": "*", "ATA": "M", "TGA": "W"},
    "yeast_mitochondrial": {"ATA": "M", "CTT": "T", "CTC": "T", "CTA": "T", "CTG": "T", "TGA": "W"},
}


def amino_acids(code: str = "universal") -> str:
    """The 64 amino acids of a code, in ORDER."""
    out = list(STANDARD)
    for codon, aa in VARIANTS[code].items():
        a, b, c = map(ORDER.index, codon)
        out[16 * a + 4 * b + c] = aa
    return "".join(out)


def stop_codons(code: str = "universal") -> list[str]:
    table = amino_acids(code)
    return [a + b + c for i, a in enumerate(ORDER) for j, b in enumerate(ORDER) for k, c in enumerate(ORDER) if table[16 * i + 4 * j + k] == "*"]


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, BASES, COMPLEMENTS))


def bases_of(text: Column) -> Column:
    """The letters A, C, G, T of a text, in upper case: how texts stand in for sequences."""
    return F.regexp_replace(F.upper(F.coalesce(text, F.lit(""))), "[^ACGT]", "")


def translate(s: Column, frame: int = 1, code: str = "universal") -> Column:
    """Amino acids of frame 1-3, or 4-6 on the other strand; a codon with another letter is X; a rest of one or two bases is left out."""
    strand = F.upper(s) if frame <= 3 else reverse_complement(F.upper(s))
    # one pass cuts the codons, so that the strand isn't worked out again for each of them
    codons = F.regexp_extract_all(F.substring(strand, F.lit((frame - 1) % 3 + 1), F.length(s)), F.lit(r"[\s\S]{3}"), F.lit(0))
    table = amino_acids(code)

    def one(codon: Column) -> Column:
        at = [F.instr(F.lit(ORDER), F.substring(codon, F.lit(k), F.lit(1))) - 1 for k in (1, 2, 3)]
        known = (at[0] >= 0) & (at[1] >= 0) & (at[2] >= 0)
        return F.when(known, F.substring(F.lit(table), 16 * at[0] + 4 * at[1] + at[2] + 1, F.lit(1))).otherwise("X")

    return F.array_join(F.transform(codons, one), "")


def percent_of(s: Column, letters: str) -> Column:
    """Share of the given letters, either case, in percent; null for an empty sequence."""
    kept = F.length(F.regexp_replace(s, f"[^{letters.upper()}{letters.lower()}]", ""))
    return F.when(F.length(s) > 0, 100 * kept / F.length(s))


def spliced(s: Column, segments: Column, strand: Column) -> Column:
    """The segments (1-based, closed) of a sequence in a row, reverse-complemented on '-'."""
    joined = F.array_join(F.transform(segments, lambda x: F.substring(s, x["lend"], x["rend"] - x["lend"] + 1)), "")
    return F.when(strand == "-", reverse_complement(joined)).otherwise(joined)


def kmers(s: Column, k: int, step: int = 1) -> Column:
    """Every stretch of k letters of a text, from each step-th letter on; the text is cut into letters once, as a substring would be counted from its start for each."""
    n = F.length(s) - k
    cut = lambda letters: F.transform(F.sequence(F.lit(1), n + 1, F.lit(step)), lambda i: F.array_join(F.slice(letters, i, F.lit(k)), ""))
    return F.when(n >= 0, F.get(F.transform(F.array(F.split(s, "")), cut), F.lit(0))).otherwise(F.array().cast("array<string>"))


#: Letters that are counted at once, a multiple of three.
PIECE = 3 << 18


def counted_kmers(text: str, k: int) -> dict[tuple[int, str], int]:
    """How often each stretch of k letters begins at a place of each remainder modulo 3."""
    out: dict[tuple[int, str], int] = {}
    for at in range(0, len(text) - k + 1, PIECE):
        piece = text[at : at + PIECE + k - 1]
        letters, places = np.unique(np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4"), return_inverse=True)
        n, base = len(piece) - k + 1, len(letters)
        if 3 * base**k >= 1 << 62:  # too many to be numbered
            got = Counter((i % 3, piece[i : i + k]) for i in range(n)).items()
        else:
            code = np.zeros(n, np.int64)
            for i in range(k):
                code = code * base + places[i : i + n]
            code = 3 * code + np.arange(n) % 3
            if 3 * base**k <= 4 * n + 1024:
                counts = np.bincount(code)
                code = np.flatnonzero(counts)
                counts = counts[code]
            else:
                code, counts = np.unique(code, return_counts=True)
            names = [chr(x) for x in letters.tolist()]
            got = []
            for c, m in zip(code.tolist(), counts.tolist()):
                c, frame = divmod(c, 3)
                word = []
                for _ in range(k):
                    c, letter = divmod(c, base)
                    word.append(names[letter])
                got.append(((frame, "".join(word[::-1])), m))
        for key, m in got:
            out[key] = out.get(key, 0) + m
    return out


def framed_kmers(rows: DataFrame, seq: str, k: int, times: str | None = None) -> DataFrame:
    """(frame, kmer, n) over all sequences, each as often as the column `times` says; frame 0-2 is the start modulo 3.

    A task counts a batch at a time and gives out counts, not occurrences.
    """

    def run(batches):
        for batch in batches:
            found: dict[tuple[int, str], int] = {}
            for text, often in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for key, m in counted_kmers(text or "", k).items():
                    found[key] = found.get(key, 0) + m * often
                if len(found) > 100_000:
                    yield _counts(found)
                    found = {}
            yield _counts(found)

    def _counts(found):
        keys = list(found)
        return pa.RecordBatch.from_arrays([pa.array([f for f, _ in keys], pa.int32()), pa.array([w for _, w in keys], pa.string()), pa.array(list(found.values()), pa.int64())], ["frame", "kmer", "n"])

    each = rows.select(F.col(seq), (F.lit(1) if times is None else F.col(times)).cast("long")).mapInArrow(run, "frame int, kmer string, n bigint")
    return each.groupBy("frame", "kmer").agg(F.sum("n").alias("n"))


def log_ratios(coding: DataFrame, background: DataFrame, k: int) -> DataFrame:
    """(frame, kmer, ratio): log of the k-mer's share among those with its first k - 1 letters in its frame, over that in the background.

    Both counts get one pseudocount; background frames are pooled.
    """
    grouped = lambda df, *by: df.groupBy(*by, "kmer").agg(F.sum("n").alias("n"))
    head = F.substring("kmer", 1, k - 1).alias("head")
    c = grouped(coding, "frame")
    ch = c.groupBy("frame", head).agg(F.sum("n").alias("nh"))
    b = grouped(background)
    bh = b.groupBy(head).agg(F.sum("n").alias("bh"))
    joined = c.select("*", head).join(ch, ["frame", "head"]).join(b.withColumnRenamed("n", "bn"), "kmer", "left").join(bh, "head", "left")
    bn, bt = F.coalesce("bn", F.lit(0)), F.coalesce("bh", F.lit(0))
    return joined.select("frame", "kmer", F.ln(((F.col("n") + 1) / (F.col("nh") + 1)) / ((bn + 1) / (bt + 1))).alias("ratio"))


@cache
def _codon_places(stops: frozenset[str]) -> re.Pattern:
    """Every place where a start or a stop begins."""
    return re.compile(f"(?={'|'.join(map(re.escape, ['ATG', *sorted(stops)]))})")


def _closed_frames(q: str, least: int, stops: frozenset[str]) -> list[tuple[int, int]]:
    """(start, end) of the longest frame from a start up to each stop: one pass over starts and stops, of all three frames at once."""
    out, starts = [], [-1, -1, -1]
    for m in _codon_places(stops).finditer(q):
        i = m.start()
        frame = i % 3
        if q.startswith("ATG", i):
            if starts[frame] < 0:
                starts[frame] = i
        else:
            if starts[frame] >= 0 and i + 3 - starts[frame] >= least:
                out.append((starts[frame], i + 3))
            starts[frame] = -1
    return out


def open_frames(seq: str, least: int, stops: frozenset[str], open_start: bool = False, open_end: bool = False, strands: str = "+-") -> list[dict]:
    """The longest open frame up to each stop, longest first, as dicts of lend, rend, strand, frame and complete; coordinates are on the given strand.

    With open_start a frame may begin at the sequence's own beginning, with open_end it may end with the sequence.
    """
    out, n = [], len(seq)
    flipped = seq.translate(str.maketrans(BASES, COMPLEMENTS))[::-1] if "-" in strands else ""
    for strand, q in (("+", seq), ("-", flipped)):
        if strand not in strands:
            continue
        if not (open_start or open_end):
            for start, end in _closed_frames(q, least, stops):
                a, b = (start + 1, end) if strand == "+" else (n - end + 1, n - start)
                out.append({"lend": a, "rend": b, "strand": strand, "frame": start % 3 + 1, "complete": True})
            continue
        for frame in range(3):
            start = frame if open_start else None
            for i in range(frame, n - 2, 3):
                codon = q[i : i + 3]
                if start is None and codon == "ATG":
                    start = i
                stop = codon in stops
                end = i + 3 if stop else (n - (n - frame) % 3 if open_end and i + 6 > n else None)
                if end is not None and start is not None:
                    if end - start >= least:
                        a, b = (start + 1, end) if strand == "+" else (n - end + 1, n - start)
                        out.append({"lend": a, "rend": b, "strand": strand, "frame": frame + 1, "complete": stop and q[start : start + 3] == "ATG"})
                if stop:
                    start = None
    return sorted(out, key=lambda o: (o["lend"] - o["rend"], o["strand"], o["lend"]))


def orfs(s: Column, least: int = 30, code: str = "universal", partial: bool = False) -> Column:
    """array<struct<lend, rend, strand, frame, complete>>: the longest open frame up to each stop, on both strands, longest first.

    Coordinates are on the given strand. With partial, frames without a start or stop at the ends count as well.
    """
    stops = frozenset(stop_codons(code))

    @F.pandas_udf("array<struct<lend: int, rend: int, strand: string, frame: int, complete: boolean>>")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: open_frames(t.upper(), least, stops, partial, partial) if t else [])

    return run(s)


def translated(coding: str, code: str = "universal") -> str:
    """The protein of a coding sequence; codons of other letters are X."""
    table = amino_acids(code)
    places = {b: i for i, b in enumerate("TCAG")}

    def one(codon: str) -> str:
        return table[16 * places[codon[0]] + 4 * places[codon[1]] + places[codon[2]]] if all(b in places for b in codon) else "X"

    return "".join(one(coding[i : i + 3]) for i in range(0, len(coding) - 2, 3))


def tail_trim(s: Column, letter: str = "A", least: int = 7, share: float = 80.0) -> Column:
    """Length of the longest ending of at least `least` bases that begins and ends in `letter` and holds `share` percent of it: one pass from the end."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("hits"), F.lit(0).alias("best"))

    def step(a: Column, c: Column) -> Column:
        n, hits = a["n"] + 1, a["hits"] + (c == letter).cast("int")
        fits = (c == letter) & (n >= least) & (100 * hits >= share * n)
        return F.struct(n.alias("n"), hits.alias("hits"), F.when(fits, n).otherwise(a["best"]).alias("best"))

    found = F.aggregate(F.split(F.reverse(s), ""), start, step, lambda a: a["best"])
    return F.when(F.endswith(s, F.lit(letter)), found).otherwise(0)


def poly_tails(s: Column, run: int = 5, least: int = 7, gap: int = 4, share: float = 0.15) -> Column:
    """struct<left, right>: bases of a poly-T head and of a poly-A tail to trim, 0 where there is none.

    A tail grows from a run of `run` letters that begins within `share` of the length from its end, to both sides, by one a letter and minus two for
    others, until `gap` others follow each other. It is trimmed, with what lies behind it, if its best score is `least` and one more for
    every ten bases between it and the end. Of several the one that reaches furthest inwards counts.
    """

    @F.pandas_udf("left int, right int")
    def find(x: pd.Series) -> pd.DataFrame:
        import re

        seeds = re.compile(f"A{{{run},}}").finditer

        def grow(q: str, i: int, step: int) -> tuple[int, int]:
            """(score, reach) of the best extension of a run from its end i."""
            score = best = misses = at = k = 0
            while 0 <= i < len(q) and misses < gap:
                k += 1
                score, misses = (score + 1, 0) if q[i] == "A" else (score - 2, misses + 1)
                if score > best:
                    best, at = score, k
                i += step
            return best, at

        def tail(q: str) -> int:
            n, done = len(q), -1
            for m in seeds(q, int(n - n * share)):
                if m.start() <= done:
                    continue
                (left, a), (right, b) = grow(q, m.start() - 1, -1), grow(q, m.end(), 1)
                done = m.end() + b
                if left + right + m.end() - m.start() >= least + (n - done) // 10:
                    return n - (m.start() - a)
            return 0

        rows = [(tail(t.upper()[::-1].replace("A", "x").replace("T", "A")), tail(t.upper())) if t else (0, 0) for t in x]
        return pd.DataFrame(rows, columns=["left", "right"], dtype="int32")

    return find(s)


def low_complexity(s: Column, window: int = 64, limit: float = 20.0) -> Column:
    """The sequence with N over every window whose repeated triplets score above limit: 10 * sum n(n-1)/2 over (triplets - 1)."""

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        def mask(t: str | None) -> str | None:
            if not t:
                return t
            out = list(t)
            for a in range(0, max(1, len(t) - 2), window // 2):
                part = t[a : a + window].upper()
                seen: dict[str, int] = {}
                score = 0
                for i in range(len(part) - 2):
                    n = seen.get(part[i : i + 3], 0)
                    score += n
                    seen[part[i : i + 3]] = n + 1
                if len(part) > 3 and 10 * score / (len(part) - 3) > limit:
                    out[a : a + window] = "N" * len(part)
            return "".join(out)

        return x.map(mask)

    return run(s)


def cigar_blocks(cigar: Column, pos: Column) -> Column:
    """array<struct<lend, rend, mlend, mrend>> of an alignment: one block per stretch without N, D or I, in genome and query coordinates."""
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(0))
    start = F.struct(pos.cast("int").alias("g"), F.lit(1).alias("q"), F.array().cast("array<struct<lend:int,rend:int,mlend:int,mrend:int>>").alias("out"))

    def step(acc: Column, op: Column) -> Column:
        n, kind = F.regexp_extract(op, r"\d+", 0).cast("int"), F.right(op, F.lit(1))
        block = F.struct(acc["g"].alias("lend"), (acc["g"] + n - 1).alias("rend"), acc["q"].alias("mlend"), (acc["q"] + n - 1).alias("mrend"))
        aligned = kind.isin("M", "=", "X")
        return F.struct(
            (acc["g"] + F.when(aligned | kind.isin("D", "N"), n).otherwise(0)).alias("g"),
            (acc["q"] + F.when(aligned | kind.isin("I", "S", "H"), n).otherwise(0)).alias("q"),
            F.when(aligned, F.concat(acc["out"], F.array(block))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(ops, start, step, lambda a: a["out"])


def protein_identity(a: str, b: str) -> float:
    """Percent of identical columns of a global alignment (match 2, mismatch -1, gap -2; of equal scores the one of most identical columns), over the longer sequence."""
    import numpy as np

    if not a or not b:
        return 0.0
    one = 1 << 24  # a score's unit, above the count of identical columns
    y = np.frombuffer(b.encode("utf-32-le"), "<u4")
    gaps = 2 * one * np.arange(len(b) + 1)
    row = -gaps
    for i, x in enumerate(a, 1):
        new = row - 2 * one
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(y == ord(x), 2 * one + 1, -one))
        row = np.maximum.accumulate(new + gaps) - gaps  # a gap in a: from the best cell on the left
    return 100 * int(row[-1] & (one - 1)) / max(len(a), len(b))


def frame_scores(rows: DataFrame, ratios: DataFrame, id_col: str, seq: str, k: int, both: bool = False) -> DataFrame:
    """(id_col, frame, score) for the frames 1-3 of the given strand, with `both` for 4-6 of the other one, too: the sum of the log ratios
    of the k-mers, each at its place modulo 3 in that frame; k-mers without a ratio count nothing."""
    each = rows.select(id_col, F.lit(0).alias("add"), F.posexplode(kmers(F.col(seq), k)).alias("at", "kmer"))
    if both:
        each = each.unionByName(rows.select(id_col, F.lit(3).alias("add"), F.posexplode(kmers(reverse_complement(F.col(seq)), k)).alias("at", "kmer")))
    # occurrences are counted by their place modulo 3 before they are taken for each frame and before the ratios come in
    counted = each.where("at < 3").select(id_col, "add", "kmer", "at", F.lit(1).alias("n")).unionByName(
        each.where("at >= 3").groupBy(id_col, "add", "kmer", (F.col("at") % 3 + 3).alias("at")).agg(F.count("*").cast("int").alias("n")))
    shifted = counted.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("shift")).where("at >= shift")
    placed = shifted.select(id_col, "kmer", "n", (F.col("add") + F.col("shift") + 1).alias("f"), ((F.col("at") - F.col("shift")) % 3).alias("frame"))
    scored = shuffled(placed).join(ratios, ["frame", "kmer"]).groupBy(id_col, F.col("f").alias("frame")).agg(F.sum(F.col("n") * F.col("ratio")).alias("score"))
    return scored


def polycistronic(s: Column, least: int, most_overlap: float = 10.0) -> Column:
    """Whether the two longest open frames are both of `least` bases and share at most `most_overlap` percent of the shorter."""
    found = orfs(s, least)
    a, b = F.get(found, F.lit(0)), F.get(found, F.lit(1))
    shared = F.greatest(F.lit(0), F.least(a["rend"], b["rend"]) - F.greatest(a["lend"], b["lend"]) + 1)
    return F.coalesce((F.size(found) > 1) & (100 * shared <= most_overlap * (b["rend"] - b["lend"] + 1)), F.lit(False))
