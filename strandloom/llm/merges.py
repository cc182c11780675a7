"""Rank-synchronous pair merging over batches of symbol sequences, in numpy.

A batch is one flat symbol array cut into sequences. In every round each sequence merges its own
lowest-ranked adjacent pair (the leftmost on ties), all sequences at once, until none has a pair left.
That is the order in which a priority queue over one sequence would merge, so results are the same.

A long sequence would need as many rounds over all of itself as it has merges. It is merged by itself, rank by rank: a round takes all places of
its lowest-ranked pair at once and looks at these places and their neighbours only. Where its merge can give a pair of a lower rank
than its own (there may be two ways to one symbol), a round ends with the first place where it does.
"""

from __future__ import annotations

import numpy as np

NONE = np.int64(1) << 40


class PairTable:
    """(left, right) -> (rank, merged), in a power-of-two hash of bounded probes; safe says that no pair with the merged symbol has a lower rank."""

    def __init__(self, left, right, rank, merged):
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        self.shift = max(1, int(max(left.max(initial=0), right.max(initial=0))).bit_length())
        keys = (left << self.shift) | right
        bits = max(4, int(len(keys) * 4).bit_length())
        self.bits = bits
        size = 1 << bits
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NONE, np.int64)
        self.merged = np.zeros(size, np.int64)
        rank, merged = np.asarray(rank, np.int64), np.asarray(merged, np.int64)
        used = np.full(max(1 << self.shift, int(merged.max(initial=0)) + 1), NONE)  # the lowest rank that uses a symbol
        np.minimum.at(used, left, rank)
        np.minimum.at(used, right, rank)
        self.safe = np.zeros(size, bool)
        todo, at, self.probes = np.arange(len(keys)), self._home(keys), 1
        while len(todo):
            free = self.keys[at[todo]] < 0
            slots, first = np.unique(at[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[slots], self.rank[slots], self.merged[slots] = keys[won], rank[won], merged[won]
            self.safe[slots] = used[merged[won]] > rank[won]
            todo = np.setdiff1d(todo, won)
            at[todo] = (at[todo] + 1) & (size - 1)
            self.probes += bool(len(todo))

    def _home(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left, right):
        """Slots of the pairs; a slot of another key means no such pair and has its rank hidden."""
        keys = (left << self.shift) | right
        at = self._home(keys)
        found = self.keys[at] == keys
        slot = np.where(found, at, -1)
        open_ = np.flatnonzero(~found & (self.keys[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            hit = self.keys[at[open_]] == keys[open_]
            slot[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (self.keys[at[open_]] >= 0)]
        return slot

    def rank_of(self, left, right):
        """The pairs' ranks, NONE where there is no such pair; a symbol below zero is none."""
        slot = np.where((left >= 0) & (right >= 0), self.find(np.maximum(left, 0), np.maximum(right, 0)), -1)
        return np.where(slot >= 0, self.rank[slot], NONE)


def merge_all(symbols: np.ndarray, starts: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merged (symbols, starts) of a ragged batch; starts has one entry per sequence, none of them empty."""
    n = len(starts)
    if not n:
        return symbols, starts
    seq = np.repeat(np.arange(n), np.diff(np.append(starts, len(symbols))))
    symbols = symbols.astype(np.int64)
    out_sym, out_seq = [], []
    slot = np.full(len(symbols), -1, np.int64)
    pairs = np.flatnonzero(seq[:-1] == seq[1:])
    slot[pairs] = table.find(symbols[pairs], symbols[pairs + 1])
    # rank and position in one number: the minimum of a sequence is its lowest rank, leftmost on ties
    rank = np.where(slot >= 0, table.rank[slot], NONE)
    while True:
        first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        best = np.minimum.reduceat((rank << 22) | np.arange(len(rank)) if len(rank) < 1 << 22 else rank, first)
        if len(rank) >= 1 << 22:
            raise ValueError("a batch holds at most 4,194,304 symbols")
        alive = (best >> 22) < NONE
        if not alive.all():  # sequences that are done leave the batch
            size = np.diff(np.append(first, len(seq)))
            keep = np.repeat(alive, size)
            out_sym.append(symbols[~keep])
            out_seq.append(seq[~keep])
            if not alive.any():
                break
            moved = np.cumsum(keep) - 1
            best = moved[best[alive] & ((1 << 22) - 1)]
            symbols, seq, slot, rank = symbols[keep], seq[keep], slot[keep], rank[keep]
        else:
            best = best & ((1 << 22) - 1)
        symbols[best] = table.merged[slot[best]]
        keep = np.ones(len(symbols), bool)
        keep[best + 1] = False
        moved = np.cumsum(keep) - 1
        symbols, seq, slot, rank = symbols[keep], seq[keep], slot[keep], rank[keep]
        at = moved[best]
        redo = np.concatenate([at, at[at > 0] - 1])
        redo = redo[(redo + 1 < len(seq))]
        last = at[at + 1 >= len(seq)]
        slot[last], rank[last] = -1, NONE
        same = seq[redo] == seq[redo + 1]
        cut = redo[~same]
        slot[cut], rank[cut] = -1, NONE
        redo = redo[same]
        slot[redo] = table.find(symbols[redo], symbols[redo + 1])
        rank[redo] = np.where(slot[redo] >= 0, table.rank[slot[redo]], NONE)
    sym, sq = np.concatenate(out_sym), np.concatenate(out_seq)
    order = np.argsort(sq, kind="stable")
    sym, sq = sym[order], sq[order]
    return sym, np.searchsorted(sq, np.arange(n))


def merge_ragged(symbols: np.ndarray, starts: np.ndarray, table: PairTable, batch: int = 1 << 20, long: int = 2000):
    """merge_all in batches of bounded size; a sequence longer than `long` is merged by itself."""
    if not len(starts):
        return symbols.astype(np.int64), starts
    ends = np.append(starts[1:], len(symbols))
    parts, i = [], 0
    cuts = np.flatnonzero(ends - starts > long).tolist() + [len(starts)]
    for c in cuts:
        while i < c:
            j = max(i + 1, int(np.searchsorted(ends[i:c], starts[i] + batch, side="right")) + i)
            sym, at = merge_all(symbols[starts[i] : ends[j - 1]], starts[i:j] - starts[i], table)
            parts.append((sym, np.diff(np.append(at, len(sym)))))
            i = j
        if c < len(starts):
            sym = merge_long(symbols[starts[c] : ends[c]].astype(np.int64), table)
            parts.append((sym, np.array([len(sym)])))
            i = c + 1
    sizes = np.concatenate([p[1] for p in parts])
    return np.concatenate([p[0] for p in parts]), np.cumsum(sizes) - sizes


def merge_long(symbols: np.ndarray, table: PairTable) -> np.ndarray:
    """One long sequence: its symbols linked to their neighbours, and the places of each rank's pair in wait."""
    import heapq

    n = len(symbols)
    sym = np.append(symbols.astype(np.int64), -1)
    right, left = np.arange(1, n + 2), np.arange(-1, n)
    waiting: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def wait(at: np.ndarray) -> None:
        """Puts the pairs that begin at these places in wait."""
        at = at[(at >= 0) & (right[at] < n)]
        slot = table.find(sym[at], sym[right[at]])
        at, rank = at[slot >= 0], table.rank[slot[slot >= 0]]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, some in zip(rank[np.append(0, cuts)].tolist() if len(rank) else [], np.split(at, cuts)):
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(ranks, r)
            waiting[r].append(some)

    wait(np.arange(n - 1))
    while ranks:
        r = heapq.heappop(ranks)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[(sym[at] >= 0) & (right[at] < n)]
        slot = table.find(sym[at], sym[right[at]])
        same = slot >= 0
        same[same] = table.rank[slot[same]] == r
        at, slot = at[same], slot[same]
        if not len(at):
            continue
        if len(at) > 1 and (right[at[:-1]] == at[1:]).any():  # where places share a symbol every other one of them
            joined = np.append(False, right[at[:-1]] == at[1:])
            first = np.flatnonzero(~joined)
            inside = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            at, slot = at[inside % 2 == 0], slot[inside % 2 == 0]
        if not table.safe[slot].all():
            new = table.merged[slot]
            before, behind = sym[left[at]], sym[right[right[at]]]
            before[1:] = np.where(right[right[at[:-1]]] == at[1:], new[:-1], before[1:])
            low = np.minimum(table.rank_of(before, new), table.rank_of(new, behind))
            upto = int(np.argmax(low <= r)) + 1 if (low <= r).any() else len(at)
            if upto < len(at):
                waiting[r] = [at[upto:]]
                heapq.heappush(ranks, r)
                at, slot = at[:upto], slot[:upto]
        gone = right[at]
        sym[at] = table.merged[slot]
        sym[gone] = -1
        right[at] = right[gone]
        left[right[at]] = at
        wait(np.unique(np.concatenate([at, left[at]])))
    sym = sym[:-1]
    return sym[sym >= 0]
