"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf, the SHA-256 of its fields. In each group the leaves ascend by key; every two
consecutive nodes become the digest of their concatenation, a last one alone the digest of itself, until one
is left: the group's subroot. The subroots, ordered by group, become the root in the same way.

A node's label is (level, place), so children come before their parents. A queue ordered by label delivers
the digests of children to their parent; a second one, in reversed order, delivers to each child what its
parent was given for the proof with the sibling in front. The queue has two tiers. Inside a block of
``1 << LEVELS`` consecutive nodes it is a heap. Beyond a block it is a sorted shuffle, which Spark spills to
disk: block roots are the leaves of the next round, and on the way back a block's message is a row that sorts
before the block's own rows. So a task holds one block, and there are log(rows) / ``LEVELS`` rounds.

A proof is two strings: ``siblings``, the digests of the siblings from leaf to root, and ``sides``, a
character for each level: ``<`` the sibling stands before the node, ``>`` after it, ``.`` there is none.
``fold`` recomputes the root from a leaf and its proof with built-in functions.

Defined cases: a null field counts as ``-``, which no value does; a null group is a group, the first; null
keys come first; rows with one key are ordered by their digests, so repeated rows each have a leaf, a place
and a result; a group of one row is its own subroot, a table of one group its own root; an empty table gives
no rows; other columns, whatever they are called, take no part.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.frames import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of the tree that a block folds at once.
LEVELS = 10
_HEX = 64


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: Iterable[Column]) -> Column:
    """The digest of a row: each field as its UTF-8 length, a colon and itself, or ``-``."""
    told = []
    for field in fields:
        value = field.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*told), 256)


def fold(start: Column, siblings: Column, sides: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(s: Column, i: Column) -> Column:
        side = F.substring(sides, i, F.lit(1))
        other = F.when(side == ".", F.lit("")).otherwise(F.substring(siblings, s["at"], F.lit(_HEX)))
        both = F.when(side == "<", F.concat(other, s["d"])).otherwise(F.concat(s["d"], other))
        after = F.struct(F.sha2(both, 256).alias("d"), (s["at"] + F.length(other)).alias("at"))
        return F.when(i == 0, s).otherwise(after)

    begin = F.struct(start.alias("d"), F.lit(1).alias("at"))
    return F.aggregate(F.sequence(F.lit(0), F.length(sides)), begin, step)["d"]


def rise(digests: Sequence[str], height: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """The digest ``height`` levels above consecutive nodes, and each inner node's children.

    Time-forward: the queue holds (label of the receiver, place of the sender, digest).
    """
    if not height:
        return digests[0], {}
    queue = [((1, k >> 1), k, d) for k, d in enumerate(digests)]
    children: dict[tuple[int, int], list[str]] = {}
    while True:
        label = queue[0][0]
        got = []
        while queue and queue[0][0] == label:
            got.append(heapq.heappop(queue)[2])
        children[label] = got
        own, (level, k) = digest(*got), label
        if level == height:
            return own, children
        heapq.heappush(queue, ((level + 1, k >> 1), k, own))


def descend(children: dict[tuple[int, int], list[str]], height: int, siblings: str, sides: str) -> list[tuple[str, str]]:
    """The proof of each node that ``rise`` began with. siblings, sides: the proof of the node it ended with."""
    proofs: list[tuple[str, str]] = []
    # labels negated: parents before their children, and of one level the last first
    queue = [(-height, 0, siblings, sides)]
    while queue:
        level, k, siblings, sides = heapq.heappop(queue)
        if not level:
            proofs.append((siblings, sides))
            continue
        pair = children[-level, -k]
        if len(pair) == 1:
            heapq.heappush(queue, (level + 1, 2 * k, siblings, "." + sides))
        else:
            heapq.heappush(queue, (level + 1, 2 * k, pair[1] + siblings, ">" + sides))
            heapq.heappush(queue, (level + 1, 2 * k - 1, pair[0] + siblings, "<" + sides))
    return proofs[::-1]


def height_of(n: int) -> int:
    """Levels that a block of a group of ``n`` nodes folds."""
    return min(LEVELS, max(n - 1, 0).bit_length())


def numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """The rows, stored, with their place ``pos`` in their group ``g`` and its size ``n``; the largest group's size.

    Rows are dealt by ranges of group and order and numbered there; a range's first place is the sum over the
    ranges before it. Equal rows may come in any order, so they spread over ranges as well.
    """
    held = stored(rows, "manifest").withColumn("_nth", F.monotonically_increasing_id())
    by = ["g", *order, "_nth"]
    dealt = held.repartitionByRange(*by).sortWithinPartitions(*by)
    here = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = stored(dealt.withColumns({"_range": F.spark_partition_id(), "_place": here}).drop("_nth"), "manifest")
    counted = ranges.groupBy("g", "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    whole = Window.partitionBy("g")
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each range and group: no more than ranges and groups together.
    offsets = stored(counted.select("g", "_range", (before - F.col("_first")).alias("_offset"), F.sum("_rows").over(whole).alias("n")), "manifest")
    placed = ranges.join(offsets, ["g", "_range"]).withColumn("pos", F.col("_place") + F.col("_offset"))
    return placed.drop("_range", "_place", "_offset"), offsets.agg(F.max("n")).first()[0] or 0


def _blocks(batches: Iterable[pa.RecordBatch], starts: str) -> Iterator[pa.RecordBatch]:
    """Whole blocks one by one; rows sorted by block. starts: what marks a block's first row."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.concat_batches(held)
        pos = rows["pos"].to_numpy()
        first = np.flatnonzero(pos < 0 if starts == "message" else pos & ((1 << LEVELS) - 1) == 0)
        for a, b in zip(first, first[1:], strict=False):
            yield rows.slice(a, b - a)
        held = [rows.slice(first[-1])]
    if held:
        yield pa.concat_batches(held)


def _risen(nodes: DataFrame) -> DataFrame:
    """The nodes ``LEVELS`` levels above (fewer where one is left before)."""
    dealt = nodes.select("g", "pos", "n", "digest").withColumn("block", F.shiftright("pos", LEVELS)).repartition("g", "block").sortWithinPartitions("g", "block", "pos")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches, "place"):
            n = part["n"][0].as_py()
            top, _ = rise(part["digest"].to_pylist(), height_of(n))
            yield pa.RecordBatch.from_arrays([part["g"].slice(0, 1), part["block"].slice(0, 1), pa.array([-(-n >> LEVELS)]), pa.array([top])], names=["g", "pos", "n", "digest"])

    return dealt.mapInArrow(run, "g string, pos long, n long, digest string")


def _delivered(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` with the proofs that the nodes ``above`` them hand down."""
    carried = [c for c in nodes.columns if c not in ("g", "pos", "n", "digest")]
    own = nodes.select("g", F.shiftright("pos", LEVELS).alias("block"), "pos", "n", "digest", *carried, *[F.lit(None).cast("string").alias(x) for x in ("subroot", "siblings", "sides")])
    kinds = {f.name: f.dataType for f in nodes.schema.fields}
    message = above.select("g", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("digest"), *[F.lit(None).cast(kinds[c]).alias(c) for c in carried], "subroot", "siblings", "sides")
    both = own.unionByName(message).repartition("g", "block").sortWithinPartitions("g", "block", "pos")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches, "message"):
            subroot, siblings, sides = (part[x][0].as_py() for x in ("subroot", "siblings", "sides"))
            rows = part.slice(1)
            height = height_of(rows["n"][0].as_py())
            proofs = descend(rise(rows["digest"].to_pylist(), height)[1], height, siblings, sides)
            told = [pa.array([subroot] * rows.num_rows), *(pa.array(list(x)) for x in zip(*proofs, strict=True))]
            yield pa.RecordBatch.from_arrays([*(rows[c] for c in kinds), *told], names=[*kinds, "subroot", "siblings", "sides"])

    sample = nodes.select(*kinds, *[F.lit("").alias(x) for x in ("subroot", "siblings", "sides")])
    return both.mapInArrow(run, sample.schema)


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The nodes and, every ``LEVELS`` levels, those above them, up to one a group."""
    tables = [nodes]
    while most > 1:
        tables.append(stored(_risen(tables[-1]), "manifest"))
        most = -(-most >> LEVELS)
    return tables


def _proven(tables: list[DataFrame], top: DataFrame) -> DataFrame:
    """The first table with proofs. top: (g, subroot, siblings, sides) of the last one's only node in each group."""
    proven = tables[-1].join(top, "g")
    for nodes in reversed(tables[:-1]):
        proven = _delivered(nodes, stored(proven.select("g", "pos", "subroot", "siblings", "sides"), "manifest"))
    return proven


def manifest(df: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", claimed: Column | None = None) -> DataFrame:
    """(key, leaf, claimed, subroot, root, siblings, sides) of each row. claimed: a digest that goes along, for ``fold``."""
    told = F.lit(None).cast("string") if claimed is None else claimed
    # The null group's name sorts before all others.
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    leaves, most = numbered(df.select(name.alias("g"), F.col(key).alias("k"), leaf(F.col(f) for f in fields).alias("digest"), told.alias("claimed")), ["k", "digest"])
    tables = _levels(leaves, most)
    subroots, groups = numbered(tables[-1].select(F.lit("").alias("g"), F.col("g").alias("k"), "digest"), ["k"])
    upper = _levels(subroots, groups)
    root = upper[-1].select("digest").first()
    empty = F.lit("")
    top = upper[-1].select("g", F.col("digest").alias("subroot"), empty.alias("siblings"), empty.alias("sides"))
    named = _proven(upper, top).select(F.col("k").alias("g"), F.col("digest").alias("subroot"), "siblings", "sides")
    proven = _proven(tables, stored(named, "manifest"))
    return proven.select(F.col("k").alias(key), F.col("digest").alias("leaf"), "claimed", "subroot", F.lit(root and root[0]).cast("string").alias("root"), "siblings", "sides")
