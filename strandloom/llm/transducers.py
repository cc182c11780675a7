"""Weighted acyclic automata over words: n-grams with counts, states of equal continuations held once.

An arc carries a word, the count of the n-gram that ends with it (0: only a prefix) and the state behind it. ``Builder`` takes n-grams in sorted
order, block after block: a state whose last n-gram has gone by is looked up by its arcs in a register and made only if no state has the
same, so the automaton is the least one for its counts as soon as it is finished. ``union`` sums the counts of several; ``compose`` walks an automaton of
questions and one of counts together and gives each question's count.

N-grams are columns of word numbers, one from 1 in order of the words' bytes, 0 behind an n-gram's end; so n-grams sort before their extensions.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import count

import numpy as np

ARC = np.dtype([("label", "<i4"), ("target", "<i4"), ("weight", "<i8")])


def _codes(columns: list[np.ndarray], base: int) -> np.ndarray | None:
    """One number for each n-gram, ascending as they do; None where 63 bits don't hold it."""
    if base ** len(columns) >= 2**63:
        return None
    out = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        out = out * base + c
    return out


def summed(columns: list[np.ndarray], weights: np.ndarray, base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Different n-grams in order and their weights' sums; base is above all numbers."""
    if not len(weights):
        return columns, weights
    codes = _codes(columns, base)
    order = np.lexsort(columns[::-1]) if codes is None else np.argsort(codes, kind="stable")
    columns = [c[order] for c in columns]
    first = np.ones(len(order), bool)
    first[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(first)
    return [c[at] for c in columns], np.add.reduceat(weights[order], at)


def _packed(a: np.ndarray) -> bytes:
    kind = np.min_scalar_type(int(a.max()) if len(a) else 0)
    return kind.char.encode() + a.astype(kind).tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b[1:], chr(b[0])).astype(np.int64) if len(b) > 1 else np.empty(0, np.int64)


@dataclass
class Transducer:
    """words in order of bytes; begin: state s has the arcs begin[s] to begin[s + 1], by label; the last state is the root."""

    words: list[bytes]
    begin: np.ndarray
    arcs: np.ndarray

    def packed(self) -> tuple[bytes, ...]:
        a = self.arcs
        return b"\n".join(self.words), _packed(np.diff(self.begin)), _packed(a["label"]), _packed(a["target"] + 1), _packed(a["weight"])

    @staticmethod
    def unpacked(words: bytes, lengths: bytes, label: bytes, target: bytes, weight: bytes) -> Transducer:
        arcs = np.empty(len(w := _unpacked(weight)), ARC)
        arcs["label"], arcs["target"], arcs["weight"] = _unpacked(label), _unpacked(target) - 1, w
        return Transducer(words.split(b"\n") if words else [], np.concatenate([[0], np.cumsum(_unpacked(lengths))]), arcs)

    def _children(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the states, arc) for all arcs of the states."""
        lengths = self.begin[states + 1] - self.begin[states]
        owner = np.repeat(np.arange(len(states)), lengths)
        return owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(self.begin[states], lengths)

    def ngrams(self, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
        """All n-grams with a count, up to `longest` words, in no order."""
        columns: list[np.ndarray] = []
        states = np.array([len(self.begin) - 2])
        found, weights = [], []
        for depth in range(longest):
            owner, arc = self._children(states)
            own = self.arcs[arc]
            columns = [c[owner] for c in columns] + [own["label"] + 1]
            counted = own["weight"] > 0
            none = np.zeros(int(counted.sum()), np.int32)
            found.append([c[counted] for c in columns] + [none] * (longest - depth - 1))
            weights.append(own["weight"][counted])
            on = own["target"] >= 0
            columns, states = [c[on] for c in columns], own["target"][on].astype(np.int64)
        return [np.concatenate(c) for c in zip(*found)], np.concatenate(weights)


class Builder:
    """Makes a Transducer of n-grams that come in order; a block ends where the first word changes."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.register: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.root: list[np.ndarray] = []

    def _frozen(self, arcs: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The states of arcs begin to end; -1 without arcs."""
        raw, size = arcs.tobytes(), ARC.itemsize
        out = np.full(len(begin), -1, np.int64)
        some = np.flatnonzero(end > begin)
        spans = zip((begin[some] * size).tolist(), (end[some] * size).tolist())
        out[some] = np.fromiter((self.register[raw[b:e]] for b, e in spans), np.int64, len(some))
        return out

    def add(self, columns: list[np.ndarray], weights: np.ndarray) -> None:
        n = len(weights)
        new, heads = np.zeros(n, bool), []
        for c in columns:
            new[:1] = True
            new[1:] |= c[1:] != c[:-1]
            heads.append(np.flatnonzero(new & (c > 0)))
        target: np.ndarray | int = -1
        for depth in range(len(columns) - 1, -1, -1):
            at = heads[depth]
            arcs = np.empty(len(at), ARC)
            ends = columns[depth + 1][at] == 0 if depth + 1 < len(columns) else True
            arcs["label"], arcs["target"], arcs["weight"] = columns[depth][at] - 1, target, np.where(ends, weights[at], 0)
            if depth:
                begin = np.searchsorted(at, heads[depth - 1])
                target = self._frozen(arcs, begin, np.append(begin[1:], len(at)))
            else:
                self.root.append(arcs)

    def finish(self) -> Transducer:
        arcs = np.concatenate(self.root) if self.root else np.empty(0, ARC)
        states = [*self.register, arcs.tobytes()]
        lengths = np.array([len(s) // ARC.itemsize for s in states], np.int64)
        raw = b"".join(states)
        return Transducer(self.words, np.concatenate([[0], np.cumsum(lengths)]), np.frombuffer(raw, ARC) if raw else np.empty(0, ARC))


def built(words: list[bytes], columns: list[np.ndarray], weights: np.ndarray) -> Transducer:
    """Of n-grams in order; words that none of them uses are left out."""
    used = np.zeros(len(words) + 1, bool)
    for c in columns:
        used[c] = True
    used[0] = False
    number = np.cumsum(used).astype(np.int32)
    number[0] = 0
    builder = Builder([words[i - 1] for i in np.flatnonzero(used).tolist()])
    builder.add([number[c] for c in columns], weights)
    return builder.finish()


def union(parts: Iterable[Transducer], longest: int, least: int = 1) -> Transducer:
    """The n-grams of all parts with their counts' sums, those of `least` and more."""
    parts = list(parts)
    words = sorted(set().union(*(p.words for p in parts)))
    number = {w: i + 1 for i, w in enumerate(words)}
    columns, weights = [], []
    for p in parts:
        own = np.array([0, *map(number.__getitem__, p.words)], np.int32)
        c, w = p.ngrams(longest)
        columns.append([own[x] for x in c])
        weights.append(w)
    columns, weights = summed([np.concatenate(c) for c in zip(*columns)], np.concatenate(weights), len(words) + 1)
    often = weights >= least
    return built(words, [c[often] for c in columns], weights[often])


def compose(questions: Transducer, counts: Transducer, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The questions that counts has, as columns over questions.words, and their counts."""
    place = {w: i for i, w in enumerate(counts.words)}
    label = np.array([place.get(w, -1) for w in questions.words], np.int64)
    width = max(len(counts.words), 1)
    state = np.repeat(np.arange(len(counts.begin) - 1), np.diff(counts.begin))
    key = state * width + counts.arcs["label"]  # ascending: by state, then by label
    columns: list[np.ndarray] = []
    asked, answers = np.array([len(questions.begin) - 2]), np.array([len(counts.begin) - 2])
    found, weights = [], []
    for depth in range(longest):
        owner, arc = questions._children(asked)
        own = questions.arcs[arc]
        seek = answers[owner] * width + label[own["label"]]
        at = np.minimum(np.searchsorted(key, seek), max(len(key) - 1, 0))
        met = (label[own["label"]] >= 0) & (key[at] == seek) if len(key) else np.zeros(len(seek), bool)
        other = counts.arcs[at[met]] if len(key) else counts.arcs[:0]
        columns = [c[owner][met] for c in columns] + [own["label"][met] + 1]
        end = (own["weight"][met] > 0) & (other["weight"] > 0)
        found.append([c[end] for c in columns] + [np.zeros(int(end.sum()), np.int32)] * (longest - depth - 1))
        weights.append(other["weight"][end])
        on = (own["target"][met] >= 0) & (other["target"] >= 0)
        columns = [c[on] for c in columns]
        asked, answers = own["target"][met][on].astype(np.int64), other["target"][on].astype(np.int64)
    return [np.concatenate(c) for c in zip(*found)], np.concatenate(weights)


def place_of(words: list[bytes], key: tuple[bytes, ...], longest: int) -> int:
    """The code (as of _codes) of the first n-gram over words that is not below key."""
    base, out = len(words) + 1, 0
    for i in range(longest):
        at = bisect_left(words, key[i]) if i < len(key) else -1
        out = out * base + at + 1
        if i < len(key) and (at == len(words) or words[at] != key[i]):
            return out * base ** (longest - i - 1)
    return out
