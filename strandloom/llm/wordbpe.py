"""Word-piece BPE of a tokenizers .json file, one distinct white-space word at a time.

The vocabulary's pre-tokenizer drops white space, so a text's ids are those of its words in a row. Words
repeat: a worker keeps the ids of the words it has met, and merges only new ones, in numpy batches.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from itertools import accumulate

import numpy as np

from strandloom.llm.merges import PairTable, merge_ragged

#: Words a worker remembers before it starts afresh, and the longest such word.
KNOWN, KNOWN_CHARS = 350_000, 64
#: Characters of text that are split into words at a time.
SLICE = 2_000_000
#: Beyond these the library itself normalises and splits: what counts as a letter or as white space may differ.
ODD = re.compile("[^\n!-~¡-ɏ]").search


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte: printable ones stand for themselves, the rest follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.find = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + r"|\n").findall
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.table = PairTable(
            [vocab[a] for a, _ in merges], [vocab[b] for _, b in merges], range(len(merges)), [vocab[a + b] for a, b in merges]
        )
        letters = byte_letters()
        self.byte_of = {c: b for b, c in letters.items()}
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def pretokens(self, word: str) -> bytes:
        """A word's pre-tokens in bytes, each with a line feed behind it, by the library's own steps."""
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
        return b"".join(bytes(map(self.byte_of.__getitem__, t)) + b"\n" for t, _ in found)

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, as little-endian uint32 bytes. No word holds a line feed."""
        out = {}
        joined = "\n".join(words)
        if ODD(joined) or any(s in joined for s in self.special):
            for w in words:
                if any(s in w for s in self.special):
                    out[w] = np.array(self.library.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
            odd = [w for w in words if w not in out and ODD(w)]
            for w in odd:
                flat = np.frombuffer(self.pretokens(w), np.uint8)
                ends = np.flatnonzero(flat == 10)
                ids, _ = self.merge(flat, np.append(0, ends[:-1] + 1)[: len(ends)], ends)
                out[w] = ids.astype("<u4").tobytes()
            words = [w for w in words if w not in out]
            joined = "\n".join(words)
        if not words:
            return out
        # plain words: one pass over all of them, with the line feeds as tokens between words
        text = unicodedata.normalize("NFC", joined).lower() + "\n"
        tokens = self.find(text)
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        at_byte = np.append(0, np.cumsum(1 + (code >= 0x80).astype(np.int64) + (code >= 0x800)))
        at_char = np.fromiter(accumulate(map(len, tokens), initial=0), np.int64, len(tokens) + 1)
        starts, ends = at_byte[at_char[:-1]], at_byte[at_char[1:]]
        flat = np.frombuffer(text.encode(), np.uint8)
        breaks = flat[starts] == 10
        # each distinct pre-token is merged once
        number: dict[str, int] = {}
        which = np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int64, len(tokens))
        first = np.full(len(number), -1, np.int64)
        first[which[::-1]] = np.arange(len(tokens))[::-1]
        ids, at = self.merge(flat, starts[first], ends[first])
        sizes = np.diff(np.append(at, len(ids)))
        if "\n" in number:
            sizes[number["\n"]] = 0
        upto = np.cumsum(sizes[which])
        total = int(upto[-1])
        ids = ids[np.arange(total) + np.repeat(at[which] - upto + sizes[which], sizes[which])]
        upto = upto[breaks] * 4
        raw = ids.astype("<u4").tobytes()
        begin = 0
        for w, end in zip(words, upto.tolist()):
            out[w] = raw[begin:end]
            begin = end
        return out

    def merge(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged ids of the pre-tokens flat[starts:ends], and where each begins among the ids."""
        sizes = ends - starts
        at = np.cumsum(sizes) - sizes
        flat = flat[np.arange(int(sizes.sum())) + np.repeat(starts - at, sizes)]
        symbols = self.inner[flat]
        symbols[at + sizes - 1] = self.last[flat[at + sizes - 1]]
        return merge_ragged(symbols, at, self.table)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian uint32 bytes."""
        out, i = [], 0
        while i < len(texts):
            if len(self.known) > KNOWN:
                self.known, self.older = {"": b""}, self.known
            split, size = [], 0
            while i < len(texts) and size < SLICE:
                text = texts[i].replace("\n", " ")
                if not ODD(text.replace(" ", "")):
                    text = text if any(s in text for s in self.special) else text.lower()
                split.append(text.split(" "))
                size += len(texts[i])
                i += 1
            known, older = self.known, self.older
            new = set().union(*split).difference(known)
            known.update((w, older[w]) for w in new if w in older)
            new = [w for w in new if w not in known]
            known.update(self.learn(new))
            out += [b"".join(map(known.__getitem__, words)) for words in split]
            for w in new:
                if len(w) > KNOWN_CHARS:
                    del known[w]
        return out


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One per Python worker and vocabulary."""
    return WordBpe(path)
