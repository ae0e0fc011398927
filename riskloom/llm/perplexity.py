"""Quality rules: base counts of a text and the perplexity of a modified Kneser-Ney n-gram model.

The model's n-grams are five characters as they stand, whatever the script, case included. Spark counts
in how many distinct texts each 5-gram of every text stands, less one: a text scored is no witness for itself,
nor are its copies, or whatever stands in it alone would be found likely. Lower orders are continuation counts
of the distinct ones, and all orders are joined to probabilities by shuffle. The model has every n-gram of the
corpus, grows with it without a bound and is never gathered in one place.

Texts are dealt by their hash to blocks of about 64 MB, so copies meet and count once: first in the task that
reads them, then in their block, by sorting. A block asks for its distinct n-grams, which are stored with its
counts, and is sent its own part of the model, which it keeps in arrays sorted by a 64-bit hash. An n-gram is
found there from where the hashes with the same first bits begin. What moves is each text, compressed, once to
be counted and once to be scored, and three rows per block and distinct n-gram; a task holds one block.

A document is rejected if its log perplexity lies outside the band of its language: the quartiles of the
language's documents that pass the base rules, widened by ``WIDTH`` times their distance on either side.
Each distinct text of a language counts once, so a group of copies moves no quartile. The distance is at
least what the deviations of all languages from their medians give, so a language whose scores lie close
together (near copies, few texts) has no narrower band than the corpus as a whole. That floor is taken from
the outer tenths, which a third of all rows at one score hardly moves, and scaled to quartiles.
Quartiles come from a histogram with bins of 0.001, so no language's scores are gathered in one place.

Defined cases: a null or empty text has no words, a null perplexity, fails the base rules and is not kept;
a null language is a language; a language with one score has a band around that score; repeated rows each
have a result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.frames import shuffles_freed, slices, stored, utf8
from riskloom.operators.joining import lookup

ORDER = 5
#: Stands before a text; no character of any text by the standard.
BEGIN = 0x10FFFF
#: Bytes of texts in one block, and level of the texts' compression.
BLOCK, LEVEL = 64 << 20, 3
#: Distinct n-grams of parts of a block that are held before they are added up.
HELD = 3 << 19
#: Bins of log perplexity, and how many quartile distances a band reaches beyond the quartiles.
BIN, WIDTH = 0.001, 3.0
#: The quartile distance of a normal distribution as a share of the distance of its outer tenths.
TENTHS = 0.5263
#: Distinct texts whose scores (16 bytes each) may be broadcast to the rows; more are joined by shuffle.
FEW = 100_000
#: Characters looked at in one go; few enough that what is made of them stays in a processor's cache.
PIECE = 1 << 17
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_BLANKS, _SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """(words, their code points, symbols, repeated lines, words in repeated 3-word windows) of a text in UTF-8."""
    words = raw.split()
    n = len(words)
    text = raw.decode()
    chars = len(text) - sum(text.count(c) for c in _BLANKS)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return n, chars, symbols, len(lines) - len(set(lines)), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    n = len(words)
    if n < 4:
        return 0
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    if len(number) == n:
        return 0
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 21:  # three ids don't fit in 63 bits: number the pairs first
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(windows, twice)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : k + n - 2] |= hit
    return int(covered.sum())


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of: the code points of texts or of parts of them (each after four that come before), the texts they belong to, and how many each."""
    of, parts, size = [], [], 0
    for k, text in enumerate(texts):
        for start in range(0, len(text), PIECE):
            of.append(k)
            parts.append((text[max(0, start - ORDER + 1) : start].rjust(ORDER - 1, chr(BEGIN)), text[start : start + PIECE]))
            size += len(parts[-1][1])
            if size >= PIECE:
                yield _points(parts), np.array(of), np.array([len(p) for _, p in parts])
                of, parts, size = [], [], 0
    if parts:
        yield _points(parts), np.array(of), np.array([len(p) for _, p in parts])


def _points(parts: list[tuple[str, str]]) -> np.ndarray:
    return np.frombuffer("".join(a + b for a, b in parts).encode("utf-32-le"), np.uint32)


def _ends(sizes: np.ndarray) -> np.ndarray:
    """Where, among all windows of five code points of a batch, those stand that end at a character of a part."""
    return np.arange(sizes.sum()) + (ORDER - 1) * np.repeat(np.arange(len(sizes)), sizes)


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the n-grams whose first, second, ... code points, of 21 bits each, are the columns."""
    x = _side_by_side(columns[:3])
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x += _side_by_side(columns[3:])
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x


def _side_by_side(columns: list[np.ndarray]) -> np.ndarray:
    x = columns[0].astype(np.uint64)
    for k, c in enumerate(columns[1:], 1):
        x += np.left_shift(c, np.uint64(21 * k), dtype=np.uint64)
    return x


def _windows(points: np.ndarray) -> list[np.ndarray]:
    return [points[k : len(points) - ORDER + 1 + k] for k in range(ORDER)]


def _strings(grams: np.ndarray) -> pa.Array:
    """Rows of code points as strings."""
    wide = np.array([1, 2, 3, 4])[np.searchsorted([0x80, 0x800, 0x10000], grams, side="right")].sum(axis=1)
    offsets = np.concatenate([[0], np.cumsum(wide)]).astype(np.int32)
    data = np.ascontiguousarray(grams, np.uint32).tobytes().decode("utf-32-le").encode()
    return pa.Array.from_buffers(pa.string(), len(grams), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _from_strings(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)


class _Places:
    """Finds hashes among distinct ascending ones, from where those with the same first bits begin."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.n = len(hashes)
        bits = self.n.bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(self._first(hashes), minlength=1 << bits))[:-1]])
        self.hashes = np.append(hashes, np.uint64(0xFFFFFFFFFFFFFFFF))  # ends a search beyond the last

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> self.shift).view(np.int64)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each, and whether it is there; if not, the place of the next one or n."""
        at = self.begin.take(self._first(wanted))
        there = self.hashes.take(at)
        behind = np.flatnonzero(there < wanted)
        while len(behind):
            at[behind] += 1
            there[behind] = self.hashes.take(at[behind])
            behind = behind[there[behind] < wanted[behind]]
        return at, (there == wanted) & (at < self.n)


@dataclass
class _Seen:
    """N-grams in order of their hashes: in how many texts, the first and last of these, and the code points."""

    hashes: np.ndarray
    texts: np.ndarray
    first: np.ndarray
    last: np.ndarray
    grams: np.ndarray

    @staticmethod
    def of(points: np.ndarray, ends: np.ndarray, hashes: np.ndarray, text: np.ndarray) -> _Seen:
        """Those of a batch that stand at ``ends``, with their hashes and, in ascending order, their texts."""
        order = np.argsort(hashes, kind="stable")
        hashes, text = hashes[order], text[order]
        new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        start = np.flatnonzero(new)
        texts = np.add.reduceat((new | np.concatenate([[True], text[1:] != text[:-1]])).astype(np.int64), start)
        stop = np.append(start[1:], len(hashes)) - 1
        return _Seen(hashes[start], texts, text[start], text[stop], points[ends[order[start]][:, None] + np.arange(ORDER)])

    @staticmethod
    def added(held: list[_Seen]) -> _Seen:
        """Those of several batches that follow one another; a text that two batches share counts once."""
        hashes, texts, first, last, grams = (np.concatenate([getattr(x, name) for x in held]) for name in ("hashes", "texts", "first", "last", "grams"))
        order = np.argsort(hashes, kind="stable")
        hashes, texts, first, last = hashes[order], texts[order], first[order], last[order]
        same = hashes[1:] == hashes[:-1]
        texts[1:] -= same & (first[1:] == last[:-1])
        start = np.flatnonzero(np.concatenate([[True], ~same]))
        stop = np.append(start[1:], len(hashes)) - 1
        return _Seen(hashes[start], np.add.reduceat(texts, start), first[start], last[stop], grams[order[start]])

    def count(self, at: np.ndarray, text: np.ndarray) -> None:
        """Count those at these places, which stand in these texts, in ascending order; a text counts once."""
        if not len(at):
            return
        bits = len(self.hashes).bit_length()
        pairs = np.sort(((text - text[0]) << bits) + at)
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
        at, text = pairs & ((1 << bits) - 1), (pairs >> bits) + text[0]
        fresh = self.last[at] != text
        np.add.at(self.texts, at[fresh], 1)
        self.last[at] = text  # of several, the last


def _packed(df: DataFrame, text: str) -> DataFrame:
    """(block, text_hash, packed): each distinct text that isn't empty once, compressed, in one partition with its block."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    rows = df.where(F.length(text) > 0).select(F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=LEVEL).compress, set()
        for part in slices(batches, 1):
            fresh = []
            for k, h in enumerate(part.column(0).to_pylist()):
                if h not in seen:
                    seen.add(h)
                    fresh.append(k)
            some = part.take(pa.array(fresh, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array([pack(x) for x in utf8(some.column(1))], pa.binary())], names=["text_hash", "packed"])

    moved = rows.mapInArrow(run, "text_hash long, packed binary").withColumn("block", F.pmod("text_hash", F.lit(blocks))).repartition("block")
    return moved.groupBy("block", "text_hash").agg(F.first("packed").alias("packed"))


def _unpacked(packed: pa.ChunkedArray) -> Iterator[tuple[int, list[str]]]:
    """The texts, some MB at a time, and the place of the first of each batch."""
    start, texts, size = 0, [], 0
    unpack = zstandard.ZstdDecompressor().decompress
    for k, x in enumerate(packed):
        texts.append(unpack(x.as_buffer()).decode())
        size += len(texts[-1])
        if size >= PIECE:
            yield start, texts
            start, texts, size = k + 1, [], 0
    if texts:
        yield start, texts


def count_grams(texts: DataFrame) -> DataFrame:
    """(block, gram, n): in how many texts of each block an n-gram stands."""

    def run(block: pa.Table) -> pa.Table:
        known, held = None, []
        for start, some in _unpacked(block.column("packed")):
            for points, of, sizes in _pieces(some):
                ends, text = _ends(sizes), np.repeat(of + start, sizes)
                hashes = _hash(_windows(points))[ends]
                if known:
                    at, found = places.find(hashes)
                    known.count(at[found], text[found])
                    ends, hashes, text = (x[~found] for x in (ends, hashes, text))
                if len(hashes):
                    held.append(_Seen.of(points, ends, hashes, text))
                if sum(len(h.hashes) for h in held) > min(HELD, len(known.hashes) // 4 if known else 0):
                    known, held = _Seen.added([*([known] if known else []), *held]), []
                    places = _Places(known.hashes)
        seen = _Seen.added([known, *held])
        return pa.table({"block": np.full(len(seen.texts), block.column("block")[0].as_py()), "gram": _strings(seen.grams), "n": seen.texts})

    return texts.groupBy("block").applyInArrow(run, "block long, gram string, n long")


def _discounts(level: DataFrame) -> DataFrame:
    """(order, kinds, d1, d2, d3): the number of n-grams of an order, and what is taken off a count of 1, 2, and 3 or more."""
    seen = level.groupBy("order").agg(F.count(F.lit(1)).alias("kinds"), *(F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    each = F.least("n1", "n2", "n3", "n4") > 0
    cut = [
        F.when(each, F.least(F.greatest(k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"), F.lit(0.05)), F.lit(k - 0.05))).otherwise(plain).alias(f"d{k}")
        for k, plain in ((1, 0.5), (2, 0.75), (3, 0.9))
    ]
    return seen.select("order", "kinds", *cut)


def model(counts: DataFrame) -> DataFrame:
    """(gram, p): the probability of the last character of each 5-gram after the others, from (gram, texts).

    An n-gram of one text has the count 0 and the probability that is left to the next lower order.
    """
    levels = [counts.select("gram", (F.col("n") - 1).alias("n"))]
    for k in range(ORDER - 1, 0, -1):  # distinct left neighbours of the next lower order
        levels.append(levels[-1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count_if(F.col("n") > 0).alias("n")))
    lower = None
    for k, level in enumerate(reversed(levels), 1):
        level = level.withColumn("order", F.lit(k))
        level = level.join(F.broadcast(_discounts(level)), "order").withColumn("d", F.when(F.col("n") == 0, 0.0).when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        level = level.select("gram", "n", "d", "kinds", F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("suffix"))
        whole = level.groupBy("context").agg(F.sum("n").alias("total"), F.sum("d").alias("off"))
        level = level.join(whole, "context")
        level = level.withColumn("below", 1 / F.col("kinds")) if lower is None else level.join(lower, "suffix")
        lower = level.select(
            F.col("gram").alias("suffix"),
            F.when(F.col("total") == 0, F.col("below")).otherwise((F.col("n") - F.col("d") + F.col("off") * F.col("below")) / F.nullif("total", F.lit(0))).alias("below"),
        )
    return lower.select(F.col("suffix").alias("gram"), F.col("below").alias("p"))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def log_perplexities(df: DataFrame, text: str = "text") -> DataFrame:
    """(text_hash, log_perplexity) of each distinct text that isn't empty, by a model of all of them."""
    texts = _packed(df, text)
    of_blocks = stored(count_grams(texts), "block-grams")
    counts = stored(of_blocks.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    known = stored(model(counts), "model")
    sent = of_blocks.select("block", "gram").join(known, "gram").select("block", "gram", F.log("p").cast("float").alias("log_p"))

    def run(block: pa.Table, part_of_model: pa.Table) -> pa.Table:
        hashes = _hash(list(_from_strings(part_of_model.column("gram")).T))
        order = np.argsort(hashes)
        places, logs = _Places(hashes[order]), part_of_model.column("log_p").to_numpy()[order].astype(np.float64)
        sums, lengths = np.zeros(block.num_rows), np.zeros(block.num_rows)
        for start, some in _unpacked(block.column("packed")):
            for points, of, sizes in _pieces(some):
                wanted = _hash(_windows(points))[_ends(sizes)]
                at, found = places.find(wanted)
                if not found.all():
                    raise ValueError("an n-gram of a block is missing from its part of the model")
                np.add.at(sums, start + of, np.add.reduceat(logs[at], np.cumsum(sizes) - sizes))
                np.add.at(lengths, start + of, sizes)
        return pa.table({"text_hash": block.column("text_hash"), "log_perplexity": -sums / lengths})

    return texts.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, "text_hash long, log_perplexity double")


def score(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, lang, base counts, log_perplexity, hash of the text) of every row, by a model of all texts."""
    rows = df.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            base = np.array([base_counts(x) for x in utf8(part.column(2))], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c) for c in base.T), part.column(3)], names=["key", "lang", *NAMES, "text_hash"])

    kind = rows.schema[0].dataType.simpleString()
    counted = rows.mapInArrow(run, f"key {kind}, lang string, {', '.join(f'{n} long' for n in NAMES)}, text_hash long")
    with shuffles_freed(df.sparkSession):  # the texts move twice; the first exchange needn't outlast the counts
        known = stored(log_perplexities(df, text), "log-perplexity")
    return lookup(stored(counted, "base-counts"), known, ["text_hash"], max_broadcast_rows=FEW).withColumnRenamed("key", key)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _at(bins: DataFrame, by: list[str], **shares: float) -> DataFrame:
    """For each group, the bins that hold these shares of its counts."""
    whole = Window.partitionBy(*by)
    ranked = bins.select("*", F.sum("count").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("count").over(whole).alias("all"))
    return ranked.groupBy(*by).agg(*(F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("bin"))).alias(name) for name, share in shares.items()))


def bands(scored: DataFrame, width: float = WIDTH) -> DataFrame:
    """(lang, lower, upper) of log perplexity, from the distinct texts that pass the base rules."""
    texts = scored.where(~base_failed() & F.col("log_perplexity").isNotNull())
    # copies have one score; the minimum is of what rounding left between them
    texts = texts.groupBy(F.coalesce("lang", F.lit("")).alias("lang"), "text_hash").agg(F.min(F.floor(F.col("log_perplexity") / BIN)).alias("bin"))
    bins = texts.groupBy("lang", "bin").count()
    q = _at(bins, ["lang"], q1=0.25, middle=0.5, q3=0.75)
    off = bins.join(q, "lang").groupBy((F.col("bin") - F.col("middle")).alias("bin")).agg(F.sum("count").alias("count"))
    common = _at(off.withColumn("g", F.lit(0)), ["g"], lo=0.1, hi=0.9).select((TENTHS * (F.col("hi") - F.col("lo"))).alias("common"))
    distance = (F.greatest(F.col("q3") - F.col("q1"), F.col("common")) + 1) * BIN
    q = q.crossJoin(F.broadcast(common))
    return q.select("lang", (F.col("q1") * BIN - width * distance).alias("lower"), ((F.col("q3") + 1) * BIN + width * distance).alias("upper"))


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", width: float = WIDTH) -> DataFrame:
    """(key, base counts, base_failed, kept, perplexity and its band) of every row, by a model of all its texts."""
    scored = stored(score(df, key, text, lang), "perplexity")
    joined = scored.withColumn("l", F.coalesce("lang", F.lit(""))).join(F.broadcast(bands(scored, width).withColumnRenamed("lang", "l")), "l", "left")
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return joined.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp("log_perplexity").alias("perplexity"), F.exp("lower").alias("lower"), F.exp("upper").alias("upper"), "lang",
    )
