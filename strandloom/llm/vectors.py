"""Embedding near-duplicates by small-world indexes per shard (operator 4).

Vectors are dealt into shards by a hash of their id; every shard builds one hierarchy (``hnsw``). Every vector queries
every shard, in blocks that stream past the shard's index; beams widen for queries whose beam is full of links, and
for whole classes of queries until an audit against the full shard passes. Links found are verified by the cosine in double precision.
A shard holds at most about SHARD_ROWS vectors and SHARD_BYTES of them, so there are as many shards as the table asks for, LEAST at
least, and no task or row grows with it; as many streams read each of them as the session has tasks for. As every vector asks every shard, the
work grows with the number of vectors times that of shards: in proportion to the table up to LEAST * SHARD_ROWS vectors, with its square beyond.

No list of all pairs is made. A block of queries gives each query's number of links in the shard, and for the components the
links of each of its own small components to that component's least vector, which joins the same vectors: at most one row
a vector met. A group of n near-equal vectors makes n rows a shard and block, not n^2.

Equal vectors are one node: copies are counted, never expanded into pairs. Vectors that are null, empty, zero or hold
null or non-finite components, and rows with a null id, link with nothing. Vectors of different lengths don't meet.
Ids should be unique; rows that share an id count as one vector. Extra columns are left out. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.hnsw import Hnsw, above
from strandloom.llm.topk import usable
from strandloom.plans.components import connected_components
from strandloom.plans.lineage import stored

#: Vectors of a shard, and bytes of its vectors, at most (about: they are dealt by a hash); shards of a small table; queries of a block.
SHARD_ROWS, SHARD_BYTES, LEAST, BLOCK = 50_000, 64 << 20, 8, 512


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt(np.einsum("nd,nd->n", v, v))[:, None]


def shards_for(nodes: DataFrame) -> int:
    """How many shards hold nodes (v) within the bounds of one."""
    n, size = nodes.agg(F.count("*"), F.coalesce(F.sum(8 * F.size("v")), F.lit(0))).first()
    return max(LEAST, -(-n // SHARD_ROWS), -(-size // SHARD_BYTES))


def roots_of(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least member of each of n numbers' component by the links x-y."""
    low = np.arange(n)
    while True:  # labels sink over links, then over labels
        new = low.copy()
        least = np.minimum(low[x], low[y])
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        np.minimum.at(new, low, new.copy())
        new = new[new]
        if (new == low).all():
            return low
        low = new


def links(nodes: DataFrame, least: float = 0.9, shards: int | None = None, streams: int | None = None, beam: int = 48) -> DataFrame:
    """(src, dst, n) among nodes (id, n, v array<double>), n being copies, for pairs found of cosine least or more.

    Rows with a dst join the components; rows without say that src has links to n vectors of a shard.
    """
    shards = shards or shards_for(nodes)
    streams = streams or max(1, -(-2 * nodes.sparkSession.sparkContext.defaultParallelism // shards))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    rows = nodes.select(shard.alias("shard"), F.size("v").alias("dim"), "id", "n", "v")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        v = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        raw = Hnsw(unit(v).astype(np.float32)).dump()
        one = {"shard": pdf["shard"][:1], "dim": pdf["dim"][:1], "ids": [pdf["id"].to_numpy().tobytes()], "flat": [v.tobytes()], "copies": [pdf["n"].to_numpy(np.int64).tobytes()], "graph": [raw]}
        return pd.DataFrame(one)

    index = stored(rows.groupBy("shard", "dim").applyInPandas(build, "shard int, dim int, ids binary, flat binary, copies binary, graph binary"))

    def pack(batches):
        for batch in batches:
            dim, ids, vs = batch.column("dim").to_numpy(), batch.column("id").to_numpy(), batch.column("v")
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                for i in range(0, len(at), BLOCK):
                    part = at[i : i + BLOCK]
                    flat = vs.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([ids[part].tobytes()], pa.binary()), pa.array([flat.tobytes()], pa.binary())], ["dim", "ids", "flat"])

    blocks = rows.select("dim", "id", "v").mapInArrow(pack, "dim int, ids binary, flat binary")
    # one stream per (shard, dim, number): its index first, then blocks of queries
    number = F.explode(F.sequence(F.lit(0), F.lit(streams - 1)))
    heads = index.withColumn("stream", number).withColumn("kind", F.lit(0))
    asks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("stream", F.pmod(F.xxhash64("ids"), F.lit(streams)).cast("int"))
    asks = asks.withColumns({"copies": F.lit(None).cast("binary"), "graph": F.lit(None).cast("binary"), "kind": F.lit(1)})
    columns = ["shard", "dim", "stream", "kind", "ids", "flat", "copies", "graph"]
    stream = heads.select(columns).unionByName(asks.select(columns)).repartition(3 * shards * streams, "shard", "dim", "stream")
    stream = stream.sortWithinPartitions("shard", "dim", "stream", "kind")

    def ask(batches):
        held, ids, v, norm, copies, index_ = None, None, None, None, None, None
        for batch in batches:
            for row in range(batch.num_rows):
                shard, dim, number, kind = (batch.column(k)[row].as_py() for k in range(4))
                some = np.frombuffer(batch.column(4)[row].as_buffer(), np.int64)
                flat = np.frombuffer(batch.column(5)[row].as_buffer(), np.float64).reshape(len(some), dim)
                if kind == 0:
                    held, ids, v = (shard, dim, number), some.copy(), flat.copy()
                    norm = np.sqrt(np.einsum("nd,nd->n", v, v))
                    copies = np.frombuffer(batch.column(6)[row].as_buffer(), np.int64).copy()
                    index_ = Hnsw.load(batch.column(7)[row].as_py())
                elif held == (shard, dim, number):
                    own = np.sqrt(np.einsum("nd,nd->n", flat, flat))
                    a, b = above(index_, (flat / own[:, None]).astype(np.float32), least - 1e-4, beam)
                    ok = np.zeros(len(a), bool)
                    for i in range(0, len(a), 200_000):
                        x, y = a[i : i + 200_000], b[i : i + 200_000]
                        ok[i : i + 200_000] = (np.einsum("nd,nd->n", flat[x], v[y]) / (own[x] * norm[y]) >= least) & (some[x] != ids[y])
                    a, b = a[ok], b[ok]
                    count = np.zeros(len(some), np.int64)
                    np.add.at(count, a, copies[b])
                    everyone = np.union1d(ids, some)  # in order, so the least number is the least id
                    root = roots_of(len(everyone), np.searchsorted(everyone, some)[a], np.searchsorted(everyone, ids)[b])
                    member, met = np.flatnonzero(root != np.arange(len(root))), np.flatnonzero(count)
                    src = pa.array(np.concatenate([everyone[member], some[met]]))
                    dst = pa.array(np.concatenate([everyone[root[member]], some[met]]), mask=np.arange(len(src)) >= len(member))
                    yield pa.RecordBatch.from_arrays([src, dst, pa.array(np.concatenate([np.zeros(len(member), np.int64), count[met]]))], ["src", "dst", "n"])

    return stream.mapInArrow(ask, "src bigint, dst bigint, n bigint")


def near_vectors(rows: DataFrame, least: float = 0.9, id_col: str = "vec_id", vec: str = "embedding", shards: int | None = None) -> DataFrame:
    """(id_col, n_links, component_id, kept), one row per row."""
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    fit = usable(vec) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)) & F.col(id_col).isNotNull()
    all_ = rows.select(F.col(id_col).alias("id"), F.when(fit, v).alias("v"))
    nodes = stored(all_.where("v IS NOT NULL").groupBy("v").agg(F.min("id").cast("long").alias("id"), F.count("*").alias("n")))
    found = stored(links(nodes, least, shards))
    roots = connected_components(found.where("dst IS NOT NULL"))
    weight = nodes.groupBy("id").agg(F.sum("n").alias("n"))
    others = found.where("dst IS NULL").groupBy(F.col("src").alias("id")).agg(F.sum("n").alias("others"))
    judged = (
        weight.join(others, "id", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(F.col("id").alias("node"), (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    of = nodes.select(F.col("v").alias("nv"), F.col("id").alias("node")).join(judged, "node").drop("node")
    out = all_.join(of, all_["v"] == of["nv"], "left")
    component = F.coalesce("component_id", F.col("id").cast("long"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
