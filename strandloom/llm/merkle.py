"""Merkle manifest of a dataset by lag and lead windows (operator 12).

A row's leaf is the digest of its fields. Within a group, leaves ascend by the order column; while more than one node
remains, each run of FANOUT consecutive nodes becomes the digest of their hex digests. What remains is the group's
subroot, and the subroots, in order of the group (null first, by bytes), become the dataset's root in the same way.

Rows are numbered by a range sort and one count per (group, partition), so no group is ever in one task. Then LEVELS
levels are worked out at once: a window holds a block of FANOUT ** LEVELS consecutive nodes, and for each level
columns of fixed offsets (1 to 7 runs back and ahead, a run being 1, 8 or 64 rows) are masked by a node's slot and its run's length: they
are its siblings, of which the run's first child makes the parent. The blocks' digests, one row of FANOUT ** LEVELS, are stored and are the
next nodes, until every group has one. On the way back each block's steps are joined onto its nodes.

``steps`` is a row's proof, level by level from the leaf to the root: (before, after, joins), the hex digests of its siblings on
either side, and whether a digest is made there at all (a group that is done has levels without one). ``folded`` makes the root of any leaf and steps.

Nulls: a null field is ``-``; a null order value comes first; a null group is a group of its own. Equal order values are ordered by leaf, and rows that
are equal in that too get their places in any order. Long texts are digested whole. Equal rows are separate leaves. An empty table gives an empty one. Columns of
docs don't appear in the result but for what `carry` names, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.plans.lineage import stored

FANOUT, LEVELS = 8, 3
BLOCK = FANOUT**LEVELS


def leaf(*fields: Column) -> Column:
    """Digest of the fields: `-` for null, else UTF-8 byte count, a colon and the value."""
    def part(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def folded(first: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of its proof make."""
    return F.aggregate(steps, first, lambda at, s: F.when(s["joins"], F.sha2(F.concat(s["before"], at, s["after"]), 256)).otherwise(at))


def siblings(steps: Column) -> Column:
    """All siblings' hex digests, from the leaf's level to the root's, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def numbered(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """df, stored, with `pos` (from 0 in the order of each `by` group) and `n` (the group's rows)."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    at = F.monotonically_increasing_id()
    rows = stored(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("at", at).withColumn("part", F.shiftright("at", 33)))
    pieces = rows.groupBy(*by, "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    group = Window.partitionBy(*by)  # one row for each partition that holds some of the group
    ahead = F.coalesce(F.sum("here").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select(*[F.col(c).alias(f"b_{c}") for c in by], F.col("part").alias("b_part"), "first", ahead.alias("ahead"), F.sum("here").over(group).alias("n"))
    same = F.col("part") == F.col("b_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    return rows.join(pieces, same).select(*df.columns, (F.col("at") - F.col("first") + F.col("ahead")).alias("pos"), "n")


def _levels(nodes: DataFrame) -> DataFrame:
    """nodes (g, pos, n, hash, ...) with `block`, the LEVELS `steps` of each, and `top`, their block's digest after these levels."""
    block = Window.partitionBy("g", "block").orderBy("pos")
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumn("h0", F.col("hash"))
    steps = []
    for k in range(LEVELS):
        wide = FANOUT**k  # rows of the block to a node of this level
        place, count = F.floor(F.col("pos") / wide), F.ceil(F.col("n") / wide)
        slot = place % FANOUT
        length = F.least(F.lit(FANOUT), count - (place - slot))
        first = F.col("pos") % wide == 0  # a node's row is that of its first leaf
        near = {f"{way}{i}": getattr(F, way)(f"h{k}", i * wide).over(block) for way in ("lag", "lead") for i in range(1, FANOUT)}
        out = out.withColumns(near)
        before = F.concat(*[F.when(slot >= i, F.col(f"lag{i}")).otherwise("") for i in range(FANOUT - 1, 0, -1)])
        after = F.concat(*[F.when(slot + i < length, F.col(f"lead{i}")).otherwise("") for i in range(1, FANOUT)])
        out = out.withColumn("step", F.when(first, F.struct(before.alias("before"), after.alias("after"), (count > 1).alias("joins"))))
        parent = F.when(count > 1, F.sha2(F.concat("step.before", F.col(f"h{k}"), "step.after"), 256)).otherwise(F.col(f"h{k}"))
        out = out.withColumn(f"h{k + 1}", F.when(F.col("pos") % (wide * FANOUT) == 0, parent)).drop(*near)
        out = out.withColumn(f"step{k}", F.last("step", ignorenulls=True).over(so_far)).drop("step")
        steps.append(f"step{k}")
    out = out.withColumn("top", F.first(f"h{LEVELS}").over(so_far))
    return out.withColumn("steps", F.array(*steps)).drop(*steps, *[f"h{k}" for k in range(LEVELS + 1)])


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, the stored digests of their blocks, of these blocks' blocks and so on, until each group has one."""
    tables = [nodes]
    while (tables[-1].agg(F.max("n")).first()[0] or 1) > 1:
        last = _levels(tables[-1]).where(F.col("pos") % BLOCK == 0)
        tables.append(stored(last.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("hash"))))
    return tables


def _descend(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first table's nodes with the steps of all levels; above: (g, steps, ...) of each group's last node."""
    below = lambda d: d.select(*[F.col(c).alias(f"up_{c}") for c in d.columns])
    more = [c for c in above.columns if c not in ("g", "steps")]
    last = tables[-1].join(below(above), F.col("g") == F.col("up_g")).select(*tables[-1].columns, F.col("up_steps").alias("steps"), *[F.col(f"up_{c}").alias(c) for c in more])
    for nodes in reversed(tables[:-1]):
        up = below(last.select("g", "pos", "steps", *more))
        here = _levels(nodes).join(up, (F.col("g") == F.col("up_g")) & (F.col("block") == F.col("up_pos")))
        last = here.select(*nodes.columns, F.concat("steps", "up_steps").alias("steps"), *[F.col(f"up_{c}").alias(c) for c in more])
    return last


def manifest(docs: DataFrame, fields: list[str], group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, steps) and the columns of `carry`, one row per row of docs; id is the order column."""
    carry = carry or {}
    leaves = docs.select(
        F.col(f"`{group}`").alias("__group"), F.col(f"`{order}`").alias("__id"), leaf(*[F.col(f"`{c}`") for c in fields]).alias("hash"),
        F.struct(F.lit(0).alias("__"), *[c.alias(k) for k, c in carry.items()]).alias("__more"),
        F.monotonically_increasing_id().alias("__salt"),
    )
    # stored before it is sorted: sampling for the ranges would digest every text once more
    rows = numbered(stored(leaves), ["__group"], ["__id", "hash", "__salt"])
    groups = numbered(rows.groupBy("__group").agg(F.first("n").alias("size")).withColumn("all", F.lit(0)), ["all"], ["__group"])
    groups = groups.select(F.col("__group").alias("its"), F.col("pos").alias("g"), F.col("n").alias("groups"))
    nodes = rows.join(groups, F.col("__group").eqNullSafe(F.col("its"))).select("g", "pos", "n", "hash", "__id", "__more", "groups")
    tables = _climb(nodes)
    tops = tables[-1] if len(tables) > 1 else nodes
    subroots = tops.select(F.lit(0).alias("g"), F.col("g").alias("pos"), "hash")
    subroots = stored(subroots.join(groups.select(F.col("g").alias("pos"), F.col("groups").alias("n")), "pos").select("g", "pos", "n", "hash"))
    upper = _climb(subroots)
    root = upper[-1].select("g", F.array().cast("array<struct<before:string,after:string,joins:boolean>>").alias("steps"), F.col("hash").alias("root"))
    above = _descend(upper, root).select(F.col("pos").alias("g"), "steps", F.col("hash").alias("subroot"), "root")
    out = _descend(tables, above)
    return out.select(F.col("__id").alias("id"), F.col("hash").alias("leaf"), "subroot", "root", "steps", *[F.col(f"__more.`{k}`").alias(k) for k in carry])
