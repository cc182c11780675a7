"""SentencePiece BPE with byte fallback, offset-preserving (operator 6).

A text is normalised by the longest prefix that the model's compiled character map knows (a double-array trie
over UTF-8), each normalised character keeping the source bytes it came from; white space is escaped and a
prefix added as the model says. The normalised text is cut where no piece can cross (before an escape that
follows another character, and around line feeds), a worker merges each distinct part once (``merges``), and the
ids are projected to spans of source bytes. Spans of one text lie in a row: a character that the map drops, or
white space that is removed, belongs to no piece.

Null texts count as empty and give no ids. Ids may be null or repeat; other columns are left out. Pairs of one score merge from the
left. A text is one row whatever its length: its parts are merged in batches, an unbroken part of more than 2,000 characters by
itself, rank by rank. An empty table gives an empty one.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.merges import PairTable, merge_ragged

SPACE = "▁"
#: Parts a worker remembers before it starts afresh, the longest such part, and characters handled at a time.
KNOWN, KNOWN_CHARS, SLICE = 200_000, 64, 2_000_000
#: Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def wire(data: bytes):
    """The (field, value) pairs of one protocol-buffer message."""
    i = 0

    def varint():
        nonlocal i
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while i < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 2:
            n = varint()
            yield tag >> 3, data[i : i + n]
            i += n
        elif tag & 7 == 5:
            yield tag >> 3, struct.unpack_from("<f", data, i)[0]
            i += 4
        else:
            yield tag >> 3, data[i : i + 8]
            i += 8


class CharacterMap:
    """The compiled map: a length, a double-array trie of so many bytes, then zero-ended replacements."""

    def __init__(self, blob: bytes):
        self.units, self.text = None, b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.text = blob[4 + size :]
            self.known: dict[bytes, int] = {}

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement of, and bytes in, the longest known prefix of data[at:]."""
        units = self.units
        best, node, i = None, 0, at
        offset = units[0] >> 10 << ((units[0] & 512) >> 6)
        while i < len(data):
            node ^= offset ^ data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            i += 1
            offset = unit >> 10 << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                best = (units[node ^ offset] & 0x7FFFFFFF, i - at)
        if best is None:
            return None
        begin = best[0]
        return self.text[begin : self.text.index(b"\0", begin)], best[1]


class PieceBpe:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(wire(f.read()))
        pieces = [dict(wire(v)) for k, v in model if k == 1]
        trainer = dict(wire(next((v for k, v in model if k == 2), b"")))
        norm = dict(wire(next((v for k, v in model if k == 3), b"")))
        if trainer.get(3, 1) != 2:
            raise ValueError("only BPE models are read")
        self.map = CharacterMap(norm.get(2, b""))
        self.prefix, self.squeeze, self.escape = bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1))
        self.suffix = bool(trainer.get(24, 0))
        text = [p[1].decode() for p in pieces]
        kind = [p.get(3, NORMAL) for p in pieces]
        if USER_DEFINED in kind:
            raise ValueError("models with user-defined pieces are not read")
        usable = {t: i for i, t in enumerate(text) if kind[i] == NORMAL}
        self.unknown = kind.index(UNKNOWN)
        self.bytes = {int(t[3:5], 16): i for i, t in enumerate(text) if kind[i] == BYTE}
        # symbols: ids of pieces first, then characters that are no piece but begin one
        symbol = dict(usable)
        for t in usable:
            for c in t:
                symbol.setdefault(c, len(text) + len(symbol))
        self.symbol = symbol
        scores = np.array([p.get(2, 0.0) for p in pieces], np.float32)
        rank = np.unique(-scores, return_inverse=True)[1]
        pairs = [(symbol[t[:k]], symbol[t[k:]], rank[i], i) for t, i in usable.items() for k in range(1, len(t)) if t[:k] in symbol and t[k:] in symbol]
        self.table = PairTable(*(np.array(c, np.int64) for c in zip(*pairs)))
        inside = {c for t in usable if len(t) > 1 for c in t}
        crossing = [t for t in usable if SPACE in t.lstrip(SPACE)]
        if crossing or "\n" in inside:
            raise ValueError("pieces cross white space: texts can't be cut into parts")
        self.parts = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        #: Normalised bytes that a piece stands for; unknowns differ and are kept apart.
        self.size = np.array([1 if k == BYTE else len(p[1]) for p, k in zip(pieces, kind)], np.int64)
        self.code_symbol = np.full(0x110000, -1, np.int64)
        for c, k in symbol.items():
            if len(c) == 1:
                self.code_symbol[ord(c)] = k
        self.blank = (1 << self.table.shift) - 1
        self.text, self.kind = text, kind
        self.known: dict[str, bytes] = {}
        self.widths: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text, and where each of its bytes begins in the source (one more entry: the end).

        None stands for the plain case: no map and nothing squeezed, so only white space is replaced.
        """
        if self.map.units is None and not self.squeeze and self.escape and not self.suffix:
            if not text:
                return "", None
            return SPACE * self.prefix + text.replace(" ", SPACE), None
        data, i, chunks, begins = text.encode(), 0, [], []
        while i < len(data):
            hit = self.map.longest(data, i) if self.map.units is not None else None
            if hit is None:
                n = 1 + (data[i] >= 0xC0) + (data[i] >= 0xE0) + (data[i] >= 0xF0)
                hit = data[i : i + n], n
            chunks.append(hit[0])
            begins.append((i, hit[1]))
            i += hit[1]
        space = (SPACE if self.escape else " ").encode()
        if self.squeeze:
            while chunks and chunks[0] == b" ":
                chunks.pop(0)
                begins.pop(0)
        if not chunks:
            return "", np.zeros(1, np.int64)
        out, source = [], []
        mark = lambda raw, at: (out.append(raw), source.extend([at] * len(raw)))
        if self.prefix and not self.suffix:
            mark(space, begins[0][0])
        blank = self.squeeze
        for raw, (at, _) in zip(chunks, begins):
            while blank and raw.startswith(b" "):
                raw = raw[1:]
            if raw:
                blank = raw.endswith(b" ")
                mark(raw.replace(b" ", space), at)
                blank = blank and self.squeeze
        end = begins[-1][0] + begins[-1][1]
        joined = b"".join(out)
        if self.squeeze:
            while joined.endswith(space):
                joined = joined[: -len(space)]
                end = source[len(joined)]
                del source[len(joined) :]
        if self.prefix and self.suffix:
            joined += space
            source += [end] * len(space)
        return joined.decode(), np.array([*source, end], np.int64)

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        """Each part's ids as little-endian int32 bytes."""
        code = self.code_symbol[np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        # characters that begin no piece merge with nothing: one unused symbol stands for all of them
        merged, at = merge_ragged(np.where(code < 0, self.blank, code), np.cumsum(sizes) - sizes, self.table)
        limit = len(self.text)
        raw = merged.astype("<i4").tobytes()
        ends = np.append(at[1:], len(merged))
        cuts = (ends * 4).tolist()
        out, begin = {}, 0
        for p, end in zip(parts, cuts):
            out[p] = raw[begin:end]
            begin = end
        for k in np.flatnonzero(np.logical_or.reduceat(merged >= limit, at)).tolist():
            got, width, i, p = [], [], 0, parts[k]
            for s in merged[at[k] : ends[k]].tolist():
                if s < limit:
                    got.append(s)
                    width.append(int(self.size[s]))
                    i += len(self.text[s])
                    continue
                char = p[i].encode()
                i += 1
                if self.bytes:
                    got += [self.bytes[x] for x in char]
                elif got and got[-1] == self.unknown:
                    width[-1] += len(char)
                else:
                    got.append(self.unknown)
                    width.append(len(char))
            out[p] = np.array(got, "<i4").tobytes()
            if not self.bytes:
                self.widths[p] = np.array(width, "<i4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, starts, ends) of each text; starts and ends are source bytes.

        The pieces of one character, or of one replacement of the map, each get its whole source.
        """
        out, i = [], 0
        while i < len(texts):
            if len(self.known) > KNOWN:
                self.known, self.widths = {}, {}
            split, maps, raws, size = [], [], [], 0
            while i < len(texts) and size < SLICE:
                text, source = self.normalise(texts[i])
                split.append(self.parts(text))
                maps.append(source)
                raws.append(texts[i])
                size += len(text)
                i += 1
            known = self.known
            new = list(set().union(*split).difference(known))
            if new:
                known.update(self.learn(new))
            for parts, source, raw in zip(split, maps, raws):
                ids = np.frombuffer(b"".join(map(known.__getitem__, parts)), "<i4")
                if self.bytes or not self.widths:
                    width = self.size[ids]
                else:
                    width = np.concatenate([np.frombuffer(self.widths[p], "<i4") if p in self.widths else self.size[np.frombuffer(known[p], "<i4")] for p in parts] or [ids])
                ends = np.cumsum(width)
                if source is None:
                    out.append((ids, *self.plain_spans(raw, ends)))
                else:
                    out.append((ids, source[ends - width].astype(np.int32), self.after(source, ends)))
            for p in new:
                if len(p) > KNOWN_CHARS:
                    del known[p]
                    self.widths.pop(p, None)
        return out

    def plain_spans(self, raw: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans where only spaces grew, from one byte to three: a normalised offset loses two for each escape before it."""
        if not len(ends):
            return ends.astype(np.int32), ends.astype(np.int32)
        data = np.frombuffer(raw.encode(), np.uint8)
        width = np.where(data == 32, 3, 1)
        upto = np.append(0, np.cumsum(width)) + 3 * self.prefix
        source = np.repeat(np.arange(len(upto), dtype=np.int32), np.diff(np.append(-1, upto)))
        at = source[ends]  # the first source offset whose normalised offset is not before the end
        return np.append(np.int32(0), at[:-1]), at

    @staticmethod
    def after(source: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The source end of pieces: where the next other source character begins."""
        last = source[ends - 1] if len(ends) else ends
        return source[np.minimum(np.searchsorted(source, last, side="right"), len(source) - 1)].astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: escapes become spaces, the prefix goes, bytes join, a broken byte is U+FFFD, unknowns are marked."""
        out, first = [], True
        raw: list[int] = []

        def flush():
            if raw:
                out.append(repaired(bytes(raw)))
                raw.clear()

        if not len(ids):
            return ""
        if self.raw_piece is None:
            self.raw_piece = [t.replace(SPACE, " ").encode() if k == NORMAL else bytes([int(t[3:5], 16)]) if k == BYTE else None for t, k in zip(self.text, self.kind)]
        plain = [self.raw_piece[i] for i in ids.tolist()]
        if None not in plain:
            joined = b"".join(plain)
            try:
                text = joined.decode()
                return text[1:] if self.kind[int(ids[0])] == NORMAL and self.prefix and text.startswith(" ") else text
            except UnicodeDecodeError:
                pass
        for i in ids.tolist():
            k = self.kind[i]
            if k == BYTE:
                raw.append(int(self.text[i][3:5], 16))
                first = False
                continue
            flush()
            if k == UNKNOWN:
                out.append(" ⁇ ")
            elif k == NORMAL:
                t = self.text[i]
                if first and self.prefix and t.startswith(SPACE):
                    t = t[1:]
                out.append(t.replace(SPACE, " "))
            first = first and k == CONTROL
        flush()
        return "".join(out)

    raw_piece: list[bytes | None] | None = None


def repaired(raw: bytes) -> str:
    """UTF-8 text of raw, every byte that is part of no whole character as U+FFFD."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


@lru_cache(maxsize=2)
def piece_bpe(path: str) -> PieceBpe:
    """One per Python worker and model."""
    return PieceBpe(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, starts, ends, decoded) of every row's whole text; model is a path that every worker has."""

    def run(batches):
        coder = piece_bpe(model)
        for batch in batches:
            # parts of a batch, as three lists of numbers are many times the text
            sizes = np.cumsum([len(t) for t in batch.column(1).to_pylist()]) // SLICE
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                part = batch.slice(i, j - i)
                got = coder.encode(part.column(1).to_pylist())
                upto = np.cumsum([0] + [len(g[0]) for g in got]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(upto), pa.array(np.concatenate([g[k] for g in got] or [np.empty(0)]).astype(np.int32))) for k in range(3)]
                text = pa.array([coder.decode(g[0]) for g in got], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *lists, text], [id_col, "ids", "starts", "ends", "decoded"])

    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, starts array<int>, ends array<int>, decoded string")
