"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws ``-ln(u) / weight`` from a hash of
its path and the row's key, and the smallest draw wins: a child gets rows in proportion to its weight, and
a changed weight moves rows only into or out of the subtree that it belongs to. A node's weight is the sum
of its shards' weights.

``layout`` makes a tree of a shard count: one full block of regions and racks, then one region of its own
for each further shard. So a shard that is added is a new child of the root, nothing else changes its
weight, and rows move only into it.

Defined cases: a null key is a key; equal keys share a shard; a null text has no bytes; repeated rows each
have a slot; an empty table gives no rows; columns other than key and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

#: (region, rack, shard number, weight)
Tree = list[tuple[str, str, int, float]]


def layout(shards: int, racks: int = 2, per_rack: int = 4, block: int = 16) -> Tree:
    """The tree of a shard count; see the module's text. All weights are 1."""
    leaves = []
    for s in range(shards):
        rack = s // per_rack
        leaves.append((f"region{rack // racks}", f"rack{rack % racks}", s, 1.0) if s < block else (f"added{s}", "rack0", s, 1.0))
    return leaves


def _children(tree: Tree, level: int) -> Iterator[tuple[str, dict[str, float]]]:
    """(parent path, child path -> weight) of one level, children in order of their names."""
    groups: dict[str, dict[str, float]] = {}
    for region, rack, shard, weight in tree:
        path = ["", region, f"{region}/{rack}", f"{region}/{rack}/{shard}"]
        if weight > 0:
            group = groups.setdefault(path[level], {})
            group[path[level + 1]] = group.get(path[level + 1], 0.0) + weight
    yield from sorted(groups.items())


def place(key: Column, tree: Tree) -> Column:
    """The shard number of a key."""

    def pick(children: dict[str, float]) -> Column:
        def draw(path: str, weight: float) -> Column:
            h = F.xxhash64(F.lit(path), key.cast("string"))
            u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
            return F.struct((-F.ln(u) / weight).alias("draw"), F.lit(path).alias("path"))

        if len(children) == 1:
            return F.lit(next(iter(children)))
        return F.array_min(F.array(*(draw(p, w) for p, w in sorted(children.items()))))["path"]

    def descend(level: int, under: str) -> Column:
        children = dict(_children(tree, level))[under]
        if level == 2:
            return F.element_at(F.split(pick(children), "/"), -1).cast("int")
        if len(children) == 1:
            return descend(level + 1, next(iter(children)))
        out = None
        chosen = pick(children)
        for child in sorted(children):
            out = F.when(chosen == child, descend(level + 1, child)) if out is None else out.when(chosen == child, descend(level + 1, child))
        return out

    return descend(0, "")


def shard(df: DataFrame, tree: Tree, grown: Tree | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) of every row; size is the text's bytes plus one.

    Slots number a shard's rows without gaps, in order of the key. Narrow rows are dealt by ranges of
    (shard, key, content) and stored once; a slot is the rows of earlier ranges plus the place in its own,
    so no task holds more than one range.
    """
    ensure_checkpoint_dir(df.sparkSession)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).alias("k"),
        (F.octet_length(content) + F.lit(1)).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("crc"),
        F.monotonically_increasing_id().alias("seen"),
    )
    rows = rows.select("*", place(F.col("k"), tree).alias("shard"), (place(F.col("k"), grown) if grown else F.lit(None).cast("int")).alias("grown"))
    rows = rows.repartitionByRange("shard", "k", "size", "crc", "seen").withColumn("part", F.spark_partition_id()).checkpoint()
    counts = rows.groupBy("shard", "part").count()
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "part").orderBy("k", "size", "crc", "seen")
    placed = rows.withColumn("nth", F.row_number().over(within)).join(offsets, ["shard", "part"])
    return placed.select(
        F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("before") + F.col("nth") - 1).alias("slot"), F.col("grown").alias("grown_shard"),
    )
