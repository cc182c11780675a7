"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only (operator 3).

A line is compared in its trimmed form and only if that has at least min_chars characters. Of equal lines the earliest
stays, in order of (id, row, line number); a line goes as well if an earlier one is within one edit of it. Whether the
earlier one itself stays doesn't matter, so the result needs no order of work.

Two lines within one edit share a deletion variant: they are equal but for the character at one place, or one of them
is the other with a character deleted. Variants are hashed keys, so

* substitutions meet in a bucket (place, rest), where every member is within one edit of every other: each is paired
  with the bucket's earliest member only, never with all;
* insertions pair the whole line with those that have it as a variant.

Pairs are then verified: equal before and behind the window, and within one edit inside it by ``levenshtein``. Variants are only emitted for lines that can have a partner at all: of two
lines within one edit, with m characters in the shorter, either the first or the last m div 2 characters are equal
(the edit lies beyond the one or the other half), so a distinct line that shares none of its four keys (side, m, half),
with m its own length or one less, has no partner. What is left is within one edit as well, so the same holds again inside
it: lines that pass are asked for keys of all but a 16th in common, and again in what is left until no more than WINDOW
characters may differ, and variants delete characters of that window only. No pair is lost by any of it, and a line of n characters costs
in proportion to n, however long it is.

Nulls: a null text counts as empty and stays null. Rows with a null id come first. Equal rows (all columns) are one row
for the order: they lose the same lines. Extra columns are kept, whatever their names and types; ``__lines`` and ``__removed`` get
further underscores where docs has columns of these names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.rows import Rows
from strandloom.plans.lineage import shuffled, spread, stored

#: How often a round halves the part of a line that may differ, and how many characters of it variants may delete from.
DEPTH, WINDOW = 4, 32


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _occurrences(rows: Rows, min_chars: int, *more: Column) -> DataFrame:
    """One row per line of min_chars or more: (k, th, id, i, line), then `more` over line."""
    exploded = rows.df.select("k", "th", F.col(rows.id).alias("id"), F.posexplode(_lines(rows.text)).alias("i", "raw"))
    return exploded.withColumn("line", F.trim("raw")).where(F.length("line") >= min_chars).select("k", "th", "id", "i", "line", *more)


def _digest() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), F.col("line")).alias("h2")]


def _half_keys() -> list[Column]:
    """Four keys of a line: the first and last halves for pairs whose shorter line has n or n - 1 characters."""
    out = []
    for less in (0, 1):
        m = F.length("line") - less
        half = F.floor(m / 2).cast("int")
        out.append(F.xxhash64(F.lit("first"), m, F.left(F.col("line"), half)))
        out.append(F.xxhash64(F.lit("last"), m, F.right(F.col("line"), half)))
    return out


def _deep_parts() -> Column:
    """array<struct<key, m, a, b, window>>: every way to halve DEPTH times what a window and its partner need not share.

    m is what the shorter of the two windows holds; so many characters of the line as a and b say are in common at the front and the back,
    which key says together with what the rounds before found; what is left is the next window.
    """
    def cut(c: Column) -> Column:
        halves, left = [], F.col("m")
        for _ in range(DEPTH):
            halves.append(F.floor(left / 2).cast("int"))
            left = left - halves[-1]
        front = [F.shiftrightunsigned(c, bit).bitwiseAND(F.lit(1)) == 0 for bit in range(DEPTH)]
        add = lambda which: sum((F.when(w, h).otherwise(0) for w, h in zip(which, halves)), F.lit(0))
        return F.struct(add(front).alias("a"), add([~f for f in front]).alias("b"))

    # the numbers first, so that they are worked out once for each use
    def part(n: Column) -> Column:
        key = F.xxhash64("key", "m", n["a"], F.left(F.col("window"), n["a"]), n["b"], F.right(F.col("window"), n["b"]))
        rest = F.substring(F.col("window"), n["a"] + 1, F.length("window") - n["a"] - n["b"])
        ends = [(F.col(c) + n[c]).cast("int").alias(c) for c in "ab"]
        return F.struct(key.alias("key"), (F.col("m") - n["a"] - n["b"]).cast("int").alias("m"), *ends, rest.alias("window"))

    return F.transform(F.transform(F.sequence(F.lit(0), F.lit(2**DEPTH - 1)), cut), part)


def _sharing(keyed: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that share one of their keys with another."""
    rows = keyed.select("h1", "h2", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("key")
    return rows.join(shared, "key", "left_semi").select("h1", "h2").distinct()


def _narrowed(texts: DataFrame) -> DataFrame:
    """(me, key, a, b, window): the parts of lines, behind a characters and before b, that may differ from a partner's, of at most WINDOW characters and one."""
    me = F.struct("pos", "h1", "h2").alias("me")
    lengths = F.explode(F.array(F.length("line"), F.length("line") - 1)).alias("m")
    todo = spread(texts, "h1", "h2").select(me, F.lit(0).cast("long").alias("key"), lengths, F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("line").alias("window"))
    done = None
    while True:
        parts = todo.select("me", F.explode(_deep_parts()).alias("p")).select("me", "p.*")
        shared = parts.groupBy("key").agg(F.min("me.h1").alias("lo"), F.max("me.h1").alias("hi")).where("lo <> hi").select("key")
        near = stored(parts.join(shared, "key", "left_semi"))
        small = near.where(F.col("m") <= WINDOW).select("me", "key", "a", "b", "window")
        done = small if done is None else done.unionByName(small)
        todo = near.where(F.col("m") > WINDOW)  # m is in the key, so partners go on together
        if todo.isEmpty():
            return done


def _near_earlier(first: DataFrame, rows: Rows) -> DataFrame:
    """(h1, h2) of distinct lines that have an earlier line within one edit."""
    suspects = _sharing(first).join(first.select("h1", "h2", "pos"), ["h1", "h2"])
    # the lines themselves come from the rows that hold them first
    wanted = suspects.groupBy(F.col("pos.k").alias("k"), F.col("pos.th").alias("th")).agg(F.collect_list(F.struct("h1", "h2", "pos")).alias("want"))
    held = rows.df.join(wanted, ["k", "th"]).select(_lines(rows.text).alias("lines"), F.explode("want").alias("w"))
    # equal rows hold the same lines; one copy is enough
    texts = stored(held.select("w.h1", "w.h2", "w.pos", F.trim(F.element_at("lines", F.col("w.pos.i") + 1)).alias("line")).dropDuplicates(["h1", "h2"]))
    near = _narrowed(texts)
    rest = F.transform(
        F.sequence(F.lit(1), F.length("window")),
        lambda p: F.struct(p.alias("place"), F.xxhash64("key", F.concat(F.substring(F.col("window"), F.lit(1), p - 1), F.substring(F.col("window"), p + 1, F.length("window")))).alias("rest")),
    )
    place = F.struct("a", "b").alias("at")
    variants = near.where("window <> ''").select("me", place, F.explode(rest).alias("v")).select("me", "at", "v.place", "v.rest")
    earliest = variants.groupBy("place", "rest").agg(F.min("me").alias("other"), F.count("*").alias("n")).where("n > 1").drop("n")
    swapped = shuffled(variants).join(earliest, ["place", "rest"]).where(F.col("me.pos") > F.col("other.pos")).select("me", "other", "at")
    whole = near.select(F.col("me").alias("other"), F.xxhash64("key", "window").alias("rest"))
    grown = shuffled(variants).join(whole, "rest")
    grown = grown.select(F.greatest("me", "other").alias("me"), F.least("me", "other").alias("other"), "at")
    # partners have their window at one place, which their key holds
    pairs = swapped.unionByName(grown).where("me.pos > other.pos").groupBy("me", "other").agg(F.min("at").alias("at"))
    a = texts.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line").alias("later"))
    b = texts.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("earlier"))
    front, back = F.col("at.a"), F.col("at.b")
    inner = lambda c: F.substring(F.col(c), front + 1, F.length(c) - front - back)
    equal = (F.left(F.col("later"), front) == F.left(F.col("earlier"), front)) & (F.right(F.col("later"), back) == F.right(F.col("earlier"), back))
    verified = (
        pairs.select("me.h1", "me.h2", F.col("other.h1").alias("b1"), F.col("other.h2").alias("b2"), "at")
        .join(shuffled(a), (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2")))
        .join(shuffled(b), ["b1", "b2"])
        .where(equal & (F.levenshtein(inner("later"), inner("earlier"), 1) >= 0))
    )
    return verified.select("h1", "h2").distinct()


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20) -> DataFrame:
    """docs with the lines removed from text_col, and __lines, __removed: how many lines the text had and lost."""
    rows = Rows(docs, id_col, text_col)
    occurrences = _occurrences(rows, min_chars, *_digest(), F.array(*_half_keys()).alias("keys"))
    pos = F.struct("id", "th", "i", "k")
    first = stored(occurrences.select("h1", "h2", "keys", pos.alias("pos")).groupBy("h1", "h2").agg(F.min("pos").alias("pos"), F.first("keys").alias("keys"), F.count("*").alias("n")))
    near = stored(_near_earlier(first, rows)).withColumn("near", F.lit(True))
    judged = first.select("h1", "h2", "pos", "n").join(near, ["h1", "h2"], "left").where("n > 1 OR near")
    judged = judged.select("h1", "h2", F.col("pos.th").alias("first_th"), F.col("pos.i").alias("first_i"), F.coalesce("near", F.lit(False)).alias("near"))
    places = _occurrences(rows, min_chars, *_digest()).select("k", "th", "i", "h1", "h2")
    gone = places.join(judged, ["h1", "h2"]).where("near OR NOT (first_th = th AND first_i = i)")
    gone = gone.groupBy("k", "th").agg(F.collect_set("i").alias("gone"))  # of one row, or of equal ones
    found = rows.df.join(gone, ["k", "th"], "left")
    at, all_ = F.coalesce("gone", F.array().cast("array<int>")), _lines(rows.text)
    found = found.withColumns({"at": at, "all": all_})
    stay = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("at"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("all", i)), "\n")
    text = F.when(F.size("at") == 0, F.col(rows.text)).otherwise(kept)
    return rows.back(found, text, __lines=F.size("all"), __removed=F.size("at"))
