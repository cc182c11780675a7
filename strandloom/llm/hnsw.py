"""A navigable small-world hierarchy over unit vectors, searched for many queries in step (numpy).

Nodes come in batches: a batch is searched in the graph so far, compared within itself, and each node is linked to a
diverse choice of what was found; the neighbours link back and keep a diverse choice again.
"""

from __future__ import annotations

import numpy as np

LINKS, LINKS_0, BUILD_BEAM, BATCH = 12, 32, 64, 512


def levels(n: int, seed: int) -> np.ndarray:
    u = np.random.default_rng(seed).random(n)
    return np.floor(-np.log(np.maximum(u, 1e-12)) / np.log(LINKS)).astype(np.int64)


def beam_search(x: np.ndarray, graph: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int, step: int = 4):
    """(ids, similarities), each (queries, beam) and unordered, -1 where there are fewer; entry is (queries, k) node ids."""
    n, room = len(x), max(1, (32 << 20) // max(1, len(x)))
    if len(q) > room:
        parts = [beam_search(x, graph, q[i : i + room], entry[i : i + room], beam, step) for i in range(0, len(q), room)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    b, step = len(q), max(step, beam // 16)
    ids = np.full((b, beam), -1, np.int64)
    sim = np.full((b, beam), -np.inf, np.float32)
    done = np.zeros((b, beam), bool)
    met = np.zeros((b, n), bool)
    rows = np.arange(b)[:, None]
    k = min(beam, entry.shape[1])
    ids[:, :k] = entry[:, :k]
    first = np.where(ids[:, :k] >= 0, ids[:, :k], 0)
    sim[:, :k] = np.where(ids[:, :k] >= 0, np.einsum("bd,bkd->bk", q, x[first]), -np.inf)
    met[rows, first] |= ids[:, :k] >= 0
    active = np.arange(b)
    while len(active):
        open_ = np.where(done[active] | (ids[active] < 0), -np.inf, sim[active])
        take = min(step, beam)
        pick = np.argpartition(-open_, take - 1, axis=1)[:, :take] if take < beam else np.tile(np.arange(beam), (len(active), 1))
        some = np.take_along_axis(open_, pick, 1) > -np.inf
        live = some.any(1)
        active, pick, some = active[live], pick[live], some[live]
        if not len(active):
            break
        done[active[:, None], pick] |= some
        at = np.where(some, ids[active[:, None], pick], 0)
        near = np.where(some[:, :, None], graph[at], -1).reshape(len(active), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        node = near[r, c]
        new = ~met[active[r], node]
        r, c, node = r[new], c[new], node[new]
        met[active[r], node] = True
        got = np.full(near.shape, -np.inf, np.float32)
        got[r, c] = np.einsum("nd,nd->n", q[active[r]], x[node])
        all_sim = np.concatenate([sim[active], got], 1)
        all_ids = np.concatenate([ids[active], near], 1)
        all_done = np.concatenate([done[active], np.zeros(near.shape, bool)], 1)
        top = np.argpartition(-all_sim, beam - 1, axis=1)[:, :beam]
        sim[active] = np.take_along_axis(all_sim, top, 1)
        kept = np.take_along_axis(all_ids, top, 1)
        kept[~np.isfinite(sim[active])] = -1
        ids[active] = kept
        done[active] = np.take_along_axis(all_done, top, 1)
    return ids, sim


def diverse(x: np.ndarray, ids: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
    """(rows, most) ids, -1 where there are fewer: of each row's candidates, best first, those first that are nearer to the node than to any one chosen before."""
    order = np.argsort(-sim, axis=1, kind="stable")
    ids, sim = np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)
    ok = np.isfinite(sim) & (ids >= 0)
    v = x[np.where(ok, ids, 0)]
    between = np.matmul(v, v.transpose(0, 2, 1))
    chosen = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        nearest = np.where(chosen[:, :c], between[:, c, :c], -np.inf).max(1, initial=-np.inf)
        chosen[:, c] = ok[:, c] & (nearest < sim[:, c]) & (chosen[:, :c].sum(1) < most)
    rank = np.where(chosen, 0, np.where(ok, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    best = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.full((len(ids), most), -1, np.int64)
    out[:, : best.shape[1]] = np.where(np.take_along_axis(ok, best, 1), np.take_along_axis(ids, best, 1), -1)
    return out


class Hnsw:
    def __init__(self, x: np.ndarray, seed: int = 1):
        self.x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        self.level = np.minimum(levels(n, seed), 8)
        self.graphs = [np.full((n, LINKS_0 if k == 0 else LINKS), -1, np.int64) for k in range(int(self.level.max(initial=0)) + 1)]
        self.tops: list[np.ndarray] = []
        at = 0
        while at < n:
            size = min(BATCH, max(32, at // 2), n - at)
            self._add(np.arange(at, at + size))
            at += size
        self._close()

    def _close(self):
        self.tops = [np.flatnonzero(self.level >= k)[:1] for k in range(len(self.graphs))]

    def _descend(self, q: np.ndarray, upto: int, known: int) -> np.ndarray:
        """Entries for layer `upto`, found from the top of the nodes before `known`."""
        level = self.level[:known]
        top = int(level.max())
        entry = np.tile(np.flatnonzero(level == top)[:1], (len(q), 1))
        for k in range(top, upto, -1):
            entry, _ = beam_search(self.x, self.graphs[k], q, entry, 4)
        return entry

    def _add(self, new: np.ndarray):
        x, start = self.x, int(new[0])
        own = x[new] @ x[new].T
        np.fill_diagonal(own, -np.inf)
        for k, graph in enumerate(self.graphs):
            mine = new[self.level[new] >= k]
            if not len(mine):
                continue
            width = graph.shape[1]
            inside = own[np.ix_(mine - start, mine - start)]
            m = min(BUILD_BEAM, len(mine))
            near = np.argpartition(-inside, m - 1, axis=1)[:, :m]
            cand, sims = mine[near], np.take_along_axis(inside, near, 1)
            if start and (self.level[:start] >= k).any():
                found, fs = beam_search(x, graph, x[mine], self._descend(x[mine], k, start), BUILD_BEAM)
                cand, sims = np.concatenate([found, cand], 1), np.concatenate([fs, sims], 1)
            graph[mine] = diverse(x, cand, sims, width)
            src = np.repeat(mine, width)
            dst = graph[mine].ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            order = np.argsort(dst, kind="stable")
            src, dst = src[order], dst[order]
            targets, first, count = np.unique(dst, return_index=True, return_counts=True)
            for i in range(0, len(targets), BATCH):
                t, c, f = targets[i : i + BATCH], count[i : i + BATCH], first[i : i + BATCH]
                back = np.full((len(t), min(int(c.max()), 4 * width)), -1, np.int64)
                for j in range(back.shape[1]):
                    has = c > j
                    back[has, j] = src[f[has] + j]
                both = np.concatenate([graph[t], back], 1)
                both.sort(axis=1)
                both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
                both[both == t[:, None]] = -1
                s = np.einsum("bd,bkd->bk", x[t], x[np.where(both >= 0, both, 0)])
                graph[t] = diverse(x, both, np.where(both >= 0, s, -np.inf).astype(np.float32), width)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        return beam_search(self.x, self.graphs[0], q, self._descend(q, 0, len(self.x)), min(beam, len(self.x)))

    def dump(self) -> bytes:
        import io

        out = io.BytesIO()
        np.savez(out, x=self.x, level=self.level, **{f"g{k}": g.astype(np.int32) for k, g in enumerate(self.graphs)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Hnsw:
        import io

        held = np.load(io.BytesIO(data))
        out = cls.__new__(cls)
        out.x, out.level = held["x"], held["level"]
        out.graphs = [held[f"g{k}"].astype(np.int64) for k in range(sum(n.startswith("g") for n in held.files))]
        out._close()
        return out


def above(index: Hnsw, q: np.ndarray, least: float, beam: int = 48, audit: int = 32, recall: float = 0.97, many: int = 8, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) numbers of pairs with similarity of about least or more.

    Every query is searched in the graph first. One whose whole beam is above least is asked again with twice the beam; once
    a beam would be a quarter of the nodes, the product with all of them is as cheap and exact. Then queries are audited by class, those
    with at least `many` links and those with fewer: a sample of each is held against all nodes, and while the mean of its
    queries' recalls is below the one wanted, the whole class is asked again with twice the beam.
    """
    n, rng = len(index.x), np.random.default_rng(seed)

    def ask(todo: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        r_out, n_out, again = [], [], width > beam
        while len(todo):
            if again and 4 * width >= n:
                r, c = np.nonzero(q[todo] @ index.x.T >= least)
                r_out.append(todo[r])
                n_out.append(c)
                break
            ids, sim = index.search(q[todo], width)
            hit = (ids >= 0) & (sim >= least)
            full = hit.all(1) & (ids.shape[1] < n)
            r, c = np.nonzero(hit & ~full[:, None])
            r_out.append(todo[r])
            n_out.append(ids[r, c])
            todo, width, again = todo[full], 2 * width, True
        empty = np.empty(0, np.int64)
        return np.concatenate([empty, *r_out]), np.concatenate([empty, *n_out])

    found_q, found_n = ask(np.arange(len(q)), beam)
    count = np.bincount(found_q, minlength=len(q))
    for todo in (np.flatnonzero(count < many), np.flatnonzero(count >= many)):
        some = rng.permutation(todo)[:audit]
        true = (q[some] @ index.x.T >= least).sum(1)
        width = beam
        while len(some) and width < n and np.where(true > 0, count[some] / np.maximum(true, 1), 1.0).mean() < recall:
            width *= 2
            stay = ~np.isin(found_q, todo)
            more_q, more_n = ask(todo, width)
            found_q, found_n = np.concatenate([found_q[stay], more_q]), np.concatenate([found_n[stay], more_n])
            count = np.bincount(found_q, minlength=len(q))
    return found_q, found_n
