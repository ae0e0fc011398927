"""Spelling variants by pivotal grams: words one edit apart, and the frequent form that a rare one stands for.

Bigrams are ordered by how many words have them, rarest first. A word's prefix is its three first bigrams in
that order, with all others that are as rare as the third. Two of them that don't overlap are its pivots; of
all such pairs dynamic programming takes the one that the fewest words have. One edit touches at most one of
two disjoint bigrams. So of two words one edit apart, the one whose prefix ends first in the order has a pivot
that the other has in its prefix, and the edit lies to the right of it or to the left: up to the pivot's end,
or from its start on, both words are the same. That is the position limit by which pivots meet prefixes, with
lengths that differ by at most one; what meets is verified by edit distance.

Words that meet in one key are dealt to cells of at most ``CELL`` words of either side, so no task holds all
pairs of a frequent key. A word has a bounded number of words one edit away, so nothing else is hot.

Defined cases: a null or empty text has no words; a null key counts as the empty text; repeated rows count
each; ties of two forms go to the smaller in code-point order; an empty table, or one without frequent words,
gives no rows; columns other than key and text take no part.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import slices, stored, utf8

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
GRAM, EDITS = 2, 1
#: Words of one side that meet in one cell; bytes of text looked at in one go; distinct words that a task holds.
CELL, PIECE, HELD = 2000, 1 << 22, 1 << 19
_GAP = re.compile(rb"[^A-Za-z\x80-\xFF]")
#: Longer runs (bytes) are hashed one by one.
_LONG = 48


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_LOWER, _CRC = _lower(), _crc_table()


def _checksums(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of each run, carried on from the checksum of what stands before it."""
    order = np.argsort(-sizes, kind="stable")
    at, size, state = starts[order], sizes[order], begun[order] ^ np.uint32(0xFFFFFFFF)
    left = np.searchsorted(-size, -np.arange(min(_LONG, int(size[0]) if len(size) else 0)), side="left")
    for j, m in enumerate(left.tolist()):
        state[:m] = _CRC[(state[:m] ^ text[at[:m] + j]) & 0xFF] ^ (state[:m] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for k in range(int((size > _LONG).sum())):
        state[k] = zlib.crc32(text[at[k] + _LONG : at[k] + size[k]].tobytes(), int(state[k]))
    out = np.empty_like(state)
    out[order] = state
    return out


def runs(parts: list[bytes], keys: list[bytes], least: int, slip: int) -> pa.Array:
    """The runs of letters, of ``least`` code points or more, of the texts; some with a letter less (``slip``)."""
    text = _LOWER[np.frombuffer(b" ".join(parts) + b" ", np.uint8)]
    # U+00C0 to U+00FF are the two bytes C3 80 to C3 BF.
    lead = text == 0xC3
    second = np.concatenate([[False], lead[:-1]])
    letter = (text >= 97) & (text <= 122) | lead | second
    edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    upto = np.concatenate([[0], np.cumsum(second)])
    points = ends - starts - (upto[ends] - upto[starts])
    keep = points >= least
    starts, sizes, points = starts[keep], (ends - starts)[keep], points[keep]
    slipped: list[str] = []
    if slip:
        first = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
        begun = np.array([zlib.crc32(k + b":") for k in keys], np.uint32)
        h = _checksums(text, starts, sizes, begun[np.searchsorted(first, starts, side="right") - 1])
        hit = h % slip == 0
        for k in np.flatnonzero(hit).tolist():
            if points[k] > least:
                word, at = text[starts[k] : starts[k] + sizes[k]].tobytes().decode(), int(h[k]) % int(points[k])
                slipped.append(word[:at] + word[at + 1 :])
        starts, sizes = starts[~hit], sizes[~hit]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    flat = text[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    plain = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat))
    return pa.concat_arrays([plain, pa.array(slipped, pa.string())])


def _cut(raw: bytes) -> Iterator[bytes]:
    """A long text in parts, cut where no letter stands."""
    start = 0
    while start < len(raw):
        gap = _GAP.search(raw, start + PIECE)
        end = gap.start() if gap else len(raw)
        yield raw[start:end]
        start = end


def _groups(part: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """(texts or parts of them, their keys), about ``PIECE`` bytes at a time."""
    texts: list[bytes] = []
    keys: list[bytes] = []
    size = 0
    for key, raw in zip(part.column(0).to_pylist(), utf8(part.column(1)), strict=True):
        for piece in _cut(raw):
            texts.append(piece)
            keys.append((key or "").encode())
            size += len(piece)
            if size >= PIECE:
                yield texts, keys
                texts, keys, size = [], [], 0
    if texts:
        yield texts, keys


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH, slip: int = 0) -> DataFrame:
    """(word, n) of all words of at least ``least`` code points.

    slip: plants typing errors, to measure with: a run loses a code point where crc32 of ``<key>:<run>`` is a
    multiple of it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            for part in slices([batch], 1):
                for texts, keys in _groups(part):
                    found = runs(texts, keys, least, slip).value_counts()
                    held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
                    if sum(t.num_rows for t in held) >= HELD:
                        held = [summed()]
                        if held[0].num_rows >= HELD // 2:
                            yield from held[0].to_batches()
                            held = []
        if held:
            yield from summed().to_batches()

    counted = df.select(F.col(key).cast("string"), F.col(text)).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def pivots(places: list[int], cost: list[int], many: int = EDITS + 1, size: int = GRAM) -> tuple[int, ...]:
    """``many`` of the grams at ``places`` (ascending) that don't overlap and cost least together."""
    none = (float("inf"), ())
    before = [(0, ())] * (len(places) + 1)  # of the grams so far, the cheapest choice of as many as rounds
    for _ in range(many):
        here = [none]
        for k, place in enumerate(places):
            free = before[bisect_right(places, place - size)]
            here.append(min(here[-1], (free[0] + cost[k], (*free[1], place))))
        before = here
    return before[-1][1]


def prefix(word: str, count: dict[str, int], rank: dict[str, int]) -> tuple[list[int], int]:
    """(places of a word's rarest grams, rank of the last of them)."""
    ranks = [rank[word[k : k + GRAM]] for k in range(len(word) - GRAM + 1)]
    last = sorted(ranks)[GRAM * EDITS]
    return [k for k, r in enumerate(ranks) if r <= last], last


def with_grams(words: DataFrame) -> DataFrame:
    """``words`` with ``pivots`` and ``prefix`` (places of grams, from 0) and ``last``, the rank where the prefix ends."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - GRAM + 1), lambda k: F.substring(F.col("word"), k, F.lit(GRAM)))
    # Of 90 letters there are 8,100 bigrams at most.
    count = {r["g"]: r["count"] for r in words.select(F.explode(F.array_distinct(grams)).alias("g")).groupBy("g").count().collect()}
    order = sorted(count, key=lambda g: (count[g], g))
    sent = words.sparkSession.sparkContext.broadcast((count, {g: k for k, g in enumerate(order)}))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, rank = sent.value
        for part in batches:
            chosen, rarest, lasts = [], [], []
            for word in part.column(0).to_pylist():
                places, last = prefix(word, count, rank)
                rarest.append(places)
                chosen.append(pivots(places, [count[word[k : k + GRAM]] for k in places]))
                lasts.append(last)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(chosen, kind), pa.array(rarest, kind), pa.array(lasts, pa.int32())], names=[*part.schema.names, "pivots", "prefix", "last"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, pivots array<int>, prefix array<int>, last int")


def _keys(places: str, lengths: tuple[int, ...]) -> Column:
    """What words share that have a gram at one place and the edit to the right, or to the left, of it.

    Hashes of the letters up to the gram's end, or from its start on, and of the length.
    """

    def at(k: Column) -> Column:
        left, right = F.substring(F.col("word"), F.lit(1), k + GRAM), F.substring(F.col("word"), k + 1, F.length("word"))
        size = F.length("word")
        return F.array(*[F.xxhash64(F.lit(side), part, size + d) for side, part in (("left", left), ("right", right)) for d in lengths])

    return F.explode(F.array_distinct(F.flatten(F.transform(F.col(places), at)))).alias("key")


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(a, n_a, b, n_b), a < b: all pairs of ``words`` (word, n) that are one edit apart. Reads ``words`` several times."""
    grams = stored(with_grams(words), "spelling")
    index = stored(grams.select("word", "n", "last", _keys("prefix", (0,))), "spelling")
    probe = stored(grams.select("word", "n", "last", _keys("pivots", (-1, 0, 1))), "spelling")
    sizes = index.select("key", F.lit(1).alias("i"), F.lit(0).alias("p")).unionAll(probe.select("key", F.lit(0), F.lit(1))).groupBy("key").agg(F.sum("i").alias("i"), F.sum("p").alias("p"))
    # Keys where more than one cell's words meet, and the cells' rows and columns.
    parts = lambda c: F.ceil(F.col(c) / cell).cast("int")
    large = stored(sizes.where(F.greatest("i", "p") > cell).where((F.col("i") > 0) & (F.col("p") > 0)).select("key", parts("i").alias("rows"), parts("p").alias("columns")), "spelling")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("word"), F.coalesce(own, F.lit(1))).cast("int")
        rows = side.join(large, "key", "left").select(*side.columns, mine.alias("_" + own), F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)).alias("_" + other))
        return rows.select("key", F.col("_rows").alias("row"), F.col("_columns").alias("col"), *[c for c in side.columns if c != "key"])

    left = dealt(probe, "columns", "rows").withColumnsRenamed({"word": "w", "n": "w_n", "last": "w_last"})
    right = dealt(index, "rows", "columns")
    near = (F.col("w_last") <= F.col("last")) & (F.levenshtein(F.col("w"), F.col("word"), EDITS) == EDITS)
    met = left.join(right.withColumnsRenamed({c: f"i_{c}" for c in ("key", "row", "col")}), (F.col("key") == F.col("i_key")) & (F.col("row") == F.col("i_row")) & (F.col("col") == F.col("i_col")) & near)
    first = F.col("w") < F.col("word")
    swap = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    return met.select(swap("w", "word").alias("a"), swap("w_n", "n").alias("n_a"), swap("word", "w").alias("b"), swap("n", "w_n").alias("n_b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by (word, form): from words without a form down to those that stand for them.

    A form is ``RATIO`` times as frequent, so there are few levels; a word has few words near it, so no key is hot.
    """
    top = forms.select(F.col("form").alias("word")).distinct().join(forms.select("word"), "word", "left_anti")
    level = stored(top.select("word", F.col("word").alias("root")), "spelling")
    out = level
    while not level.isEmpty():
        above = level.select(F.col("word").alias("form"), "root")
        level = stored(forms.join(above, "form").select("word", "root"), "spelling")
        out = out.unionAll(level)
    return out


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of ``words`` (word, n).

    form: the most frequent word one edit away, if it is at least ``ratio`` times as frequent; root: the end of
    the way along forms.
    """
    words = stored(words, "spelling")
    pairs = stored(near_words(words), "spelling")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionAll(pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("minus"), "other")).alias("best"))
    enough = -F.col("best.minus") >= ratio * F.col("n")
    told = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")
    )
    told = stored(told, "spelling")
    rooted = _roots(told.where("form is not null").select("word", "form"))
    return told.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text", least_count: int = LEAST_COUNT, slip: int = 0) -> DataFrame:
    """``variants`` of all words of a table of texts that occur ``least_count`` times or more."""
    counted = count_words(df, key, text, slip=slip)
    return variants(counted.where(F.col("n") >= least_count))
