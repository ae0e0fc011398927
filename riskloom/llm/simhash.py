"""Near-duplicates by 64-bit SimHash fingerprints that differ in at most 3 bits.

Distinct fingerprints are dealt into 16 tables of 28-bit keys: of four blocks of 16 bits two such
fingerprints share one, and of the other 48 bits, in four parts, they share one again. So every link lies
in a bucket, and no pair outside of buckets is looked at. Inside the buckets a table of Hamming distances
to pivots decides: by the triangle inequality the distances of two linked fingerprints to any pivot differ
by at most 3, so pairs whose largest difference is more are discarded; survivors are compared bit by bit.
A bucket with more than ``DIRECT`` fingerprints is split again by the bits that it leaves free, in the
same way; one with more than ``HELD`` is not held by a task but dealt again over all tasks by such keys,
until its fingerprints differ in so few bits that a task can hold every one of them. A task gives each
fingerprint its component's smallest within the task, never the pairs.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked like any
other; a null key takes part but names no component; repeated rows are one component; an empty table gives
no rows; of rows with one fingerprint and key ``keep_one`` keeps one, and one of a component whose keys are all null.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.components import connected
from riskloom.llm.frames import free_name, slices, stored, utf8
from riskloom.session import ensure_checkpoint_dir

SHINGLE, SEED, DISTANCE = 3, 42, 3
PIVOTS, DIRECT, CHUNK = 16, 512, 1 << 18
#: Fingerprints of one bucket that a task holds, and the widest part of the free bits at each further dealing.
HELD, AGAIN = 1 << 22, (9, 7)


def fingerprint(raw: bytes) -> int:
    """The fingerprint of a text in UTF-8, unsigned."""
    words = raw.lower().split()
    n = max(len(words) - SHINGLE + 1, 1)
    if not words:
        return 0
    counts = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):  # bounds what a long text needs
        some = words[start : start + (1 << 16) + SHINGLE - 1]
        shingles = map(b" ".join, zip(*(some[k:] for k in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The same rows with the fingerprint as a signed long."""
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            found = np.array([fingerprint(x) for x in utf8(part.column(at))], np.uint64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found.view(np.int64))], names=[*part.schema.names, name])

    return df.mapInArrow(run, schema)


def _keys(f: Column) -> Column:
    """The 16 bucket keys of a fingerprint: table number, shared block, shared part of the other bits."""
    block = lambda i: F.shiftrightunsigned(f, 16 * i).bitwiseAND(F.lit(0xFFFF))
    keys = []
    for i in range(4):
        a, b, c = (block(k) for k in range(4) if k != i)
        rest = F.shiftleft(a, 32).bitwiseOR(F.shiftleft(b, 16)).bitwiseOR(c)
        for j in range(4):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((4 * i + j) << 28).bitwiseOR(F.shiftleft(block(i), 12)).bitwiseOR(part))
    return F.array(*keys)


def _parts(bits: list[int]) -> list[tuple[int, int]]:
    """Places of the parts of ``bits``, of which two linked fingerprints share one."""
    edges = [round(len(bits) * k / (DISTANCE + 1)) for k in range(DISTANCE + 2)]
    return list(zip(edges, edges[1:], strict=False))


def _free_bits(key: int, level: int = 0) -> list[int]:
    """The bits that a key leaves open; level: how often its bucket was dealt again."""
    if level:
        width = AGAIN[level - 1]
        bits = _free_bits(key >> (width + 2), level - 1)
        low, high = _parts(bits)[key >> width & 3]
        return bits[:low] + bits[high:]
    i, j = divmod(key >> 28, 4)
    others = [16 * k + b for k in reversed([k for k in range(4) if k != i]) for b in range(16)]
    return others[: 12 * j] + others[12 * (j + 1) :]


def _pivot_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to the pivots, a row for each pivot."""
    pivots = np.random.default_rng(SEED).integers(0, 1 << 64, PIVOTS, np.uint64)
    return np.stack([np.bitwise_count(prints ^ p) for p in pivots]).astype(np.int8)


class _Forest:
    """Smallest index of each component so far."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.label[self.label], self.label):
                self.label = up


def _link(prints: np.ndarray, groups: np.ndarray, ids: np.ndarray, forest: _Forest, far: np.ndarray) -> None:
    """Join what lies within ``DISTANCE`` in the same group. groups: ascending; ids: each row's place in ``forest`` and ``far``."""
    ends = np.searchsorted(groups, groups, side="right")
    a = np.arange(len(groups))
    for step in range(1, len(groups)):
        a = a[a + step < ends[a]]
        if not len(a):
            break
        x, y = ids[a], ids[a + step]
        near = forest.label[x] != forest.label[y]
        x, y = x[near], y[near]
        for row in far:  # the largest coordinate difference, one coordinate at a time
            close = np.abs(row[x] - row[y]) <= DISTANCE
            x, y = x[close], y[close]
        close = np.bitwise_count(prints[x] ^ prints[y]) <= DISTANCE
        forest.join(x[close], y[close])


def _split(prints: np.ndarray, ids: np.ndarray, bits: list[int], forest: _Forest, far: np.ndarray) -> None:
    """The same for one large group, whose fingerprints differ in ``bits`` only."""
    if len(bits) <= DISTANCE:
        forest.join(ids[:-1], ids[1:])
        return
    for low, high in _parts(bits):
        mask = np.uint64(sum(1 << b for b in bits[low:high]))
        value = prints[ids] & mask
        order = np.argsort(value, kind="stable")
        _by_size(prints, value[order], ids[order], lambda _: bits[:low] + bits[high:], forest, far)  # noqa: B023


def _by_size(prints, groups, ids, bits_of, forest, far) -> None:
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(starts, append=len(groups))
    large = sizes > DIRECT
    small = np.repeat((sizes > 1) & ~large, sizes)
    if small.any():
        _link(prints, groups[small], ids[small], forest, far)
    for start, n in zip(starts[large], sizes[large], strict=True):
        _split(prints, ids[start : start + n], bits_of(groups[start]), forest, far)


def _linked(keys: np.ndarray, prints: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(fingerprint, smallest of its component) within whole buckets, keys ascending; only where they differ."""
    alone = np.ones(len(keys), bool)
    same = keys[1:] == keys[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    keys, prints = keys[~alone], prints[~alone]
    if len(keys):
        distinct, ids = np.unique(prints, return_inverse=True)
        forest = _Forest(len(distinct))
        _by_size(distinct, keys, ids, lambda key: _free_bits(int(key), level), forest, _pivot_table(distinct))
        moved = np.flatnonzero(forest.label != np.arange(len(distinct)))
        yield distinct[moved], distinct[forest.label[moved]]


def _dealt_again(key: int, prints: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key of the next level, fingerprint) of a bucket's fingerprints, four times each."""
    bits = _free_bits(key, level)
    for part, (low, high) in enumerate(_parts(bits)):
        value = np.zeros(len(prints), np.uint64)
        for n, b in enumerate(bits[low:high]):
            value |= (prints >> np.uint64(b) & np.uint64(1)) << np.uint64(n)
        yield value.astype(np.int64) | ((key << 2 | part) << AGAIN[level]), prints


def _deal(keyed: DataFrame, level: int, held_rows: int) -> DataFrame:
    """(a, b, again) of keyed fingerprints (k, f): edges, or, with ``again``, the keys and fingerprints of what is dealt again."""
    keyed = keyed.repartition("k").sortWithinPartitions("k")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: Iterator[tuple[np.ndarray, np.ndarray]], again: bool) -> Iterator[pa.RecordBatch]:
            for a, b in found:
                flags = pa.array(np.full(len(a), again))
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), flags], names=["a", "b", "again"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows, large = 0, None  # large: the key of a bucket that isn't held
        for batch in batches:
            keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if large is not None and len(keys):
                cut = int(np.searchsorted(keys, large, side="right"))
                yield from out(_dealt_again(large, prints[:cut], level), True)
                keys, prints = keys[cut:], prints[cut:]
            if not len(keys):
                continue
            large = None
            held.append((keys, prints))
            rows += len(keys)
            if rows >= CHUNK and held[0][0][0] != keys[-1]:  # keep the last bucket, more of it may come
                keys, prints = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(keys, keys[-1]))
                yield from out(_linked(keys[:cut], prints[:cut], level), False)
                held, rows = [(keys[cut:], prints[cut:])], len(keys) - cut
            if rows >= held_rows and level < len(AGAIN) and held[0][0][0] == keys[-1]:
                large = int(keys[-1])
                for _, some in held:
                    yield from out(_dealt_again(large, some, level), True)
                held, rows = [], 0
        if held:
            yield from out(_linked(*(np.concatenate(x) for x in zip(*held, strict=True)), level), False)

    return keyed.mapInArrow(run, "a long, b long, again boolean")


def links(prints: DataFrame, name: str = "fingerprint", held_rows: int = HELD) -> DataFrame:
    """(a, b): edges whose components are those of all links between the distinct fingerprints of ``prints``."""
    keyed = prints.select(F.explode(_keys(F.col(name))).alias("k"), F.col(name).alias("f"))
    found: DataFrame | None = None
    for level in range(len(AGAIN) + 1):
        dealt = stored(_deal(keyed, level, held_rows), "links")
        edges = dealt.where("not again").select("a", "b")
        found = edges if found is None else found.unionAll(edges)
        keyed = dealt.where("again").select(F.col("a").alias("k"), F.col("b").alias("f"))
        if keyed.isEmpty():
            break
    return found


def components(prints: DataFrame, key: str = "doc_id", name: str = "fingerprint") -> DataFrame:
    """(fingerprint, component_id, root) of each distinct fingerprint; ``prints`` (key, fingerprint) is read several times, so store it."""
    ensure_checkpoint_dir(prints.sparkSession)
    distinct = prints.groupBy(name).agg(F.min(key).alias("least")).checkpoint()
    rooted = connected(links(distinct, name)).withColumnRenamed("node", name)
    named = distinct.join(rooted, name, "left").select(name, "least", F.coalesce("root", name).alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "root").select(name, "component_id", "root")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint in hex, component_id) of every row."""
    prints = stored(with_fingerprint(df.select(key, text), text).select(key, "fingerprint"), "fingerprints")
    joined = prints.join(components(prints, key), "fingerprint")
    return joined.select(key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows and columns of ``df``, one row of each component: that of the smallest key."""
    print_name, row_name = free_name(df, "fingerprint"), free_name(df, "row")
    rows = stored(with_fingerprint(df, text, print_name).withColumn(row_name, F.monotonically_increasing_id()), "fingerprinted")
    narrow = rows.select(F.col(key).alias("k"), F.col(print_name).alias("fingerprint"), F.col(row_name).alias("row"))
    # One row stands for a fingerprint before anything is joined, so copies don't meet in one task. Null keys come last.
    first = narrow.groupBy("fingerprint").agg(F.min(F.struct(F.col("k").isNull(), "k", "row")).alias("first"))
    roots = components(narrow, "k").select("fingerprint", "root")
    kept = first.join(roots, "fingerprint").groupBy("root").agg(F.min("first")["row"].alias(row_name)).select(row_name)
    return rows.join(kept, row_name, "left_semi").select(*df.columns)
