"""Exact top-k inner products over tiles (operator 5).

Candidates are dealt into shards and packed into tiles of bounded rows; queries are packed into blocks, and every
block streams past every shard's tiles, which a task holds. One matrix product per meeting, a partial selection of k per query,
then the lists are merged as a tree: over the tiles of a shard in its task, then over FAN shards at a time until one list is left.

A shard holds at most about SHARD_BYTES of vectors, so the number of shards follows from the table; a smaller table is cut into as
many as the session has tasks for, but not below a tile each. Nothing is sent to the driver or broadcast. Products run in
double precision, which is exact while dimension times the largest squared component stays below 2^53; beyond that a
tile falls back to Python integers, and a score beyond 64 bits is an error.

Vectors that are null, empty, or hold null or non-finite components take no part, as query or as candidate. Vectors of
different lengths don't meet. Ids should be unique: of rows with one id, each is a candidate by itself, except to a
query of that id. Rows with a null id take no part. Ties go to the smaller id. Extra columns are left out. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Candidates of a tile, queries of a block, bytes of a shard's candidates (about), and lists that are merged at a time.
TILE, BLOCK, SHARD_BYTES, FAN = 2048, 512, 64 << 20, 16


def quantised(vec: str = "embedding", scale: int = 256) -> Column:
    """floor(scale * x) of every component, as longs."""
    return F.transform(F.col(vec), lambda x: F.floor(x.cast("double") * scale))


def usable(vec: str = "embedding") -> Column:
    finite = F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(F.col(vec).isNotNull() & (F.size(vec) > 0) & finite, F.lit(False))


def _packed(rows: DataFrame, group: Column, per: int, prefix: str) -> DataFrame:
    """rows (id, v) as tiles of at most `per` vectors of one length: (group, <prefix>ids, <prefix>flat)."""
    tiles = rows.withColumn("g", group).withColumn("dim", F.size("v"))

    def pack(batches):
        held: dict[tuple[int, int], tuple[list, list]] = {}

        def tile(key):
            ids, flats = held.pop(key)
            ids = pa.array(ids, pa.int64())
            flat = pa.array(np.concatenate(flats), pa.int64())
            one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), one(ids), one(flat)], ["g", f"{prefix}ids", f"{prefix}flat"])

        for batch in batches:
            g, dim = batch.column("g").to_numpy(), batch.column("dim").to_numpy()
            ids, vs = batch.column("id").to_numpy(), batch.column("v")
            for key in sorted(set(zip(g.tolist(), dim.tolist()))):
                at = np.flatnonzero((g == key[0]) & (dim == key[1]))
                for part in np.split(at, range(per, len(at), per)):
                    have = held.setdefault(key, ([], []))
                    have[0].extend(ids[part].tolist())
                    have[1].append(vs.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False))
                    if len(have[0]) >= per:
                        yield tile(key)
        for key in list(held):
            yield tile(key)

    return tiles.select("g", "dim", "id", "v").mapInArrow(pack, f"g int, {prefix}ids array<bigint>, {prefix}flat array<bigint>")


def tile_topk(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[np.ndarray]:
    """[query id, candidate id, score] columns of the k best of one tile for every query of one block."""
    dim = q.shape[1]
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0))
    if dim * most < 2**53:
        score = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        exact = q.astype(object) @ c.astype(object).T
        if any(abs(x) >= 2**63 for x in exact.ravel()):
            raise OverflowError("a score doesn't fit 64 bits")
        score = exact.astype(np.int64)
    order = np.argsort(c_ids, kind="stable")
    score, c_ids = score[:, order], c_ids[order]
    out_q, out_c, out_s = [], [], []
    own = q_ids[:, None] == c_ids[None, :]
    for i in range(len(q_ids)):
        row, at = score[i], np.flatnonzero(~own[i])
        if len(at) > k:
            least = np.partition(row[at], len(at) - k)[len(at) - k]
            at = at[row[at] >= least]  # all ties of the last place, then the smaller ids of them
        at = at[np.argsort(-row[at], kind="stable")][:k]
        out_q.append(np.full(len(at), q_ids[i]))
        out_c.append(c_ids[at])
        out_s.append(row[at])
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_q, out_c, out_s)]


def cut_best(parts: list[list[np.ndarray]], k: int) -> list[np.ndarray]:
    """Of [query id, candidate id, score] columns, the k best of every query."""
    q, c, s = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return [x[rank < k] for x in (q, c, s)]


def shards_for(rows: DataFrame) -> int:
    """How many shards to deal rows (v) into."""
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(8 * F.size("v")), F.lit(0))).first()
    return max(1, -(-size // SHARD_BYTES), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // TILE)))


def topk(rows: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec: Column | None = None, where: Column | None = None, shards: int | None = None) -> DataFrame:
    """(query_id, rank, <id_col>, score): for each query row the k other rows of the largest inner product.

    vec gives integer components (quantised by default), where says which rows take part (usable by default).
    """
    vec = quantised() if vec is None else vec
    where = usable() if where is None else where
    all_ = rows.where(where & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vec.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    shards = shards or shards_for(all_)
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    tiles = _packed(all_.select("id", "v").repartition(shards, shard), shard, TILE, "")
    blocks = _packed(all_.where("q").select("id", "v"), F.lit(0), BLOCK, "").drop("g")
    asks = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("g"), F.lit(1).alias("kind"), "ids", "flat")
    # every shard's tiles first, then the blocks that stream past them
    met = tiles.select("g", F.lit(0).alias("kind"), "ids", "flat").unionByName(asks).repartition(3 * shards, "g").sortWithinPartitions("g", "kind")

    def meet(batches):
        at, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                g, kind = batch.column("g")[row].as_py(), batch.column("kind")[row].as_py()
                ids, flat = (batch.column(n)[row].values.to_numpy(zero_copy_only=False) for n in ("ids", "flat"))
                if g != at:
                    at, held = g, []
                if kind == 0:
                    held.append((ids.copy(), flat.reshape(len(ids), -1).copy()))
                    continue
                flat = flat.reshape(len(ids), -1)
                got = [tile_topk(ids, flat, c_ids, c, k) for c_ids, c in held if c.shape[1] == flat.shape[1]]
                if got:
                    best = cut_best(got, k)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best[0]), g), pa.int32()), *map(pa.array, best)], ["g", "query_id", "vec_id", "score"])

    merged = met.mapInArrow(meet, "g int, query_id bigint, vec_id bigint, score bigint")
    while True:
        merged = merged.withColumn("g", F.floor(F.col("g") / FAN).cast("int"))
        best = F.row_number().over(Window.partitionBy("query_id", "g").orderBy(F.desc("score"), "vec_id"))
        merged = merged.withColumn("rank", best).where(F.col("rank") <= k)
        shards = -(-shards // FAN)
        if shards <= 1:
            return merged.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")
        merged = merged.drop("rank")
