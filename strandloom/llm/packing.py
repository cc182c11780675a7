"""Packing token pieces into windows by best-fit decreasing (operator 1).

Overlong documents are first cut into full windows, which need no packing: they are numbered where they are. What is left of every
document is placed, longest first, into the open window with the least room that still holds it. A segment tree over
the possible rooms finds that window. Rests are dealt by their number in the stored table into groups of about GROUP_ROWS, as many as
there are rests, and each group is packed by itself, so no task sees more whatever the skew of ids (nulls, repeats, one
document of most of the tokens).

Nulls: a null text counts as empty and gives the end token alone; null ids are kept. Repeated rows and ids are packed
each for itself; ties in length keep the order of (id, start). Very long texts are many full windows. Other columns are left out by
token_pieces; pack keeps those of its pieces. An empty table gives an empty one.
Words that hold one of the vocabulary's special strings are coded by the library itself, and words beyond Latin letters pass its normaliser and pre-tokeniser before they are merged here.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.rows import free_name
from strandloom.llm.wordbpe import word_bpe
from strandloom.plans.lineage import stored

GROUP_ROWS = 16_384


class RoomTree:
    """How many open windows there are of each room 0..capacity; finds the least room of at least a size."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, room: int, n: int) -> None:
        at = room + self.width
        while at:
            self.count[at] += n
            at >>= 1

    def least(self, size: int) -> int:
        """The least room >= size with an open window, or -1."""
        count, at = self.count, size + self.width
        if count[at]:
            return size
        while at > 1:  # up until a right sibling holds something, then down its leftmost path
            if not at & 1 and count[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if count[2 * at] else 2 * at + 1
                return at - self.width
            at >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each piece; windows count from 0. Equal lengths keep their order; a full window is closed."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, open_, n = RoomTree(capacity), [[] for _ in range(capacity + 1)], 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        room = tree.least(size)
        if room < 0:
            w, room, n = n, capacity, n + 1
        else:
            w = open_[room].pop()
            tree.add(room, -1)
        window[i], offset[i] = w, capacity - room
        if room - size:
            open_[room - size].append(w)
            tree.add(room - size, 1)
    return window, offset


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, length, ids, doc_tokens): each text's ids and end_id, cut into full windows and a rest.

    ids are little-endian uint32. Null and empty texts give one piece that holds end_id alone.
    """

    def cut(batches):
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            at, start, length, raw, total = [], [], [], [], []
            for k, ids in enumerate(word_bpe(vocabulary).encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                for s in range(0, n, capacity):
                    at.append(k)
                    start.append(s)
                    length.append(min(capacity, n - s))
                    raw.append(ids[4 * s : 4 * (s + capacity)])
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(raw, pa.binary()), pa.array(total, pa.int64())],
                [id_col, "start", "length", "ids", "doc_tokens"],
            )

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(cut, f"`{id_col}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint")


def pack(pieces: DataFrame, capacity: int = 4096, id_col: str = "doc_id") -> DataFrame:
    """pieces with (sequence_id, offset): windows of at most capacity tokens, gapless from offset 0.

    The pieces are stored first: they are tokenised once, and a row's number there is the same whenever a task runs again.
    sequence_id is the group times 2^32 plus the window's number there; full windows count on from behind the last group.
    """
    names = pieces.columns
    row = free_name("__row", names)
    held = stored(pieces)
    rest = held.where(F.col("length") < capacity).withColumn(row, F.monotonically_increasing_id())
    groups = max(1, -(-rest.count() // GROUP_ROWS))
    group = free_name("__group", names)

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([id_col, "start", row], kind="stable", ignore_index=True)
        window, offset = best_fit_decreasing(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = (pdf[group].to_numpy() << 32) + window
        pdf["offset"] = offset
        return pdf[[*names, "sequence_id", "offset"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id bigint, offset bigint"
    packed = rest.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups))).groupBy(group).applyInPandas(place, schema)
    number = F.lit(groups << 32).cast("long") + F.monotonically_increasing_id()
    full = held.where(F.col("length") >= capacity).withColumns({"sequence_id": number, "offset": F.lit(0).cast("long")})
    return packed.unionByName(full)
