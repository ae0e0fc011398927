"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items and texts are normalised to words: ASCII letters in lower case, ASCII digits and everything outside
ASCII. The automaton holds every run of words of every item. A text's words stream through it; at each word
it gives the longest run that ends there and occurs in an item. A run of ``WINDOW`` words (or of a whole
shorter item) is a hit, and its words are marked.

The items are known to be small beside the corpus, but nothing relies on it: an automaton holds at most
``BLOCK_WORDS`` words (about 100 bytes each), and further items make further automata, each with its own
pass. Items are collected to build automata, texts never are.

Defined cases: a null text or item has no words; an item without words hits nothing; a null item_id hits
but is not listed; an item_id that several rows share is listed once; repeated rows each have a result; an
empty table of items leaves everything clean; an empty table of texts gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.frames import free_name, slices, stored, utf8

WINDOW, BLOCK_WORDS = 10, 500_000
#: Stretches of at least so many hit words are cut out; texts with a larger share of hit words go altogether.
MIN_SPAN, MAX_COVERAGE = 1, 0.5
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BLANKED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.lower().translate(_BLANKED).split()


class Automaton:
    """Generalised suffix automaton over word numbers, with the items behind each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        rows = [[self.number.setdefault(w, len(self.number)) for w in x] for _, x in items]
        for row in rows:
            last = 0
            for w in row:
                last = self._extend(last, w)
        #: For each length that a window has: the state of that window, and the items that have it.
        self.items: dict[int, dict[int, set[str | None]]] = {}
        for (name, _), row in zip(items, rows, strict=True):
            n = min(window, len(row))
            state = length = 0
            for k, w in enumerate(row):
                state, length = self.step(state, length, w)
                if n and k + 1 >= n:
                    self.items.setdefault(n, {}).setdefault(self._suffix(state, n), set()).add(name)
        self.shortest = min(self.items, default=0)

    def _extend(self, last: int, w: int) -> int:
        """Add a word after the state ``last``; the state of the whole so far."""
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, known, w)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at != -1 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at != -1:
            to = self.next[at][w]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._clone(at, to, w)
        return new

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, at: int, to: int, w: int) -> int:
        """Split off what ``to`` shares with runs that end at ``at``."""
        copy = self._state(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while at != -1 and self.next[at].get(w) == to:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """The state and the longest matching length after one more word."""
        while state and w not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        to = self.next[state].get(w)
        return (to, length + 1) if to is not None else (0, 0)

    def _suffix(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a state that holds a longer run."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def find(self, text: list[bytes]) -> tuple[np.ndarray, set[str | None]]:
        """(which words are hit, items with a window in the text)."""
        hit = np.zeros(len(text), bool)
        named: set[str | None] = set()
        if not self.shortest or len(text) < self.shortest:
            return hit, named
        ids = np.fromiter((self.number.get(w, -1) for w in text), np.int64, len(text))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]])))
        for start, end in zip(edges[::2], edges[1::2], strict=True):  # runs of words that the items know
            if end - start < self.shortest:
                continue
            state = length = 0
            for k, w in enumerate(ids[start:end].tolist(), start + 1):
                state, length = self.step(state, length, w)
                if length >= self.shortest:
                    for n, windows in self.items.items():
                        if n <= length and (found := windows.get(self._suffix(state, n))):
                            hit[k - n : k] = True
                            named |= found
        return hit, named


def blocks(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Automaton]:
    """Automata of all items, each of at most ``block_words`` words, or of one item."""
    held: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for row in items.select(F.col(item).cast("string"), F.col(text)).toLocalIterator():
        w = words((row[1] or "").encode())
        if held and size + len(w) > block_words:
            yield Automaton(held, window)
            held, size = [], 0
        held.append((row[0], w))
        size += len(w)
    yield Automaton(held, window)


def _scan(df: DataFrame, at: int, automaton: Automaton, n: str, hits: str, named: str) -> DataFrame:
    """The rows with their number of words, the hit stretches (start, end in words) and the items."""
    sent = df.sparkSession.sparkContext.broadcast(automaton)
    pair = T.ArrayType(T.ArrayType(T.IntegerType()))
    schema = T.StructType([*df.schema.fields, T.StructField(n, T.LongType()), T.StructField(hits, pair), T.StructField(named, T.ArrayType(T.StringType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            counts, stretches, names = [], [], []
            for raw in utf8(part.column(at)):
                text = words(raw)
                hit, found = sent.value.find(text)
                counts.append(len(text))
                stretches.append(np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]))).reshape(-1, 2).tolist())
                names.append(sorted(x for x in found if x is not None))
            columns = [*part.columns, pa.array(counts, pa.int64()), pa.array(stretches, pa.list_(pa.list_(pa.int32()))), pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, n, hits, named])

    return df.mapInArrow(run, schema)


def _union(stretches: list[list[int]]) -> list[list[int]]:
    """Overlapping and touching stretches made one."""
    out: list[list[int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def scan(df: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, str, str, str]:
    """The rows of ``df`` and the names of three new columns: number of words, hit stretches, items."""
    n, hits, named = (free_name(df, x) for x in ("n_words", "hits", "items"))
    at = df.columns.index(text)
    automata = blocks(items, item, item_text, window, block_words)
    out = _scan(df, at, next(automata), n, hits, named)
    for automaton in automata:  # each further block has its own pass; what it finds is added to what is stored
        rest = _scan(stored(out, "hits"), at, automaton, m := free_name(out, "n_again"), h := free_name(out, "hits_again"), i := free_name(out, "items_again"))
        names = F.array_sort(F.array_distinct(F.concat(named, i)))
        out = rest.withColumn(hits, F.concat(hits, h)).withColumn(named, names).drop(m, h, i)
    return out, n, hits, named


def findings(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    rows, n, hits, named = scan(df.select(key, text), items, text, **how)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            hit = [sum(b - a for a, b in _union(x)) for x in part.column(2).to_pylist()]
            names = part.column(3).to_pylist()
            sums = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()), pa.array(sums, pa.string()), pa.array([x > 0 for x in hit], pa.bool_())],
                names=[key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, n, hits, named).mapInArrow(run, f"`{key}` {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def cut(text: str, stretches: list[list[int]]) -> str:
    """The text without the given stretches of words; a line break stands in their place."""
    at = [m.span() for m in _WORD.finditer(text.translate(_ASCII_LOWER))]
    out, upto = [], 0
    for start, end in stretches:
        out.append(text[upto : at[start][0]].rstrip(" "))
        upto = at[end - 1][1]
    out.append(text[upto:].lstrip(" "))
    return "\n".join(out)


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def clean(df: DataFrame, items: DataFrame, text: str = "text", length: str | None = None, min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE, **how: int) -> DataFrame:
    """The rows and columns of ``df`` without test items: texts with a larger share of hit words than ``max_coverage``
    go, in others stretches of ``min_span`` hit words or more are cut out. Runs until nothing is hit, as a cut
    may bring the two ends of an item together."""
    at = df.columns.index(text)
    automata = list(blocks(items, **how))
    sent = [df.sparkSession.sparkContext.broadcast(x) for x in automata]

    def cleaned(old: str | None) -> str | None:
        new = old
        while new:
            raw = words(new.encode())
            found = _union([s for b in sent for s in np.flatnonzero(np.diff(np.concatenate([[False], b.value.find(raw)[0], [False]]))).reshape(-1, 2).tolist()])
            long = [s for s in found if s[1] - s[0] >= min_span]
            if sum(b - a for a, b in found) > max_coverage * len(raw):
                return None
            if not long:
                break
            new = cut(new, long)
        return new

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            old = part.column(at).to_pylist()
            new = [cleaned(x) for x in old]
            columns = [pa.array(new, part.column(at).type) if k == at else c for k, c in enumerate(part.columns)]
            moved = pa.array([a is not b for a, b in zip(old, new, strict=True)], pa.bool_())
            gone = pa.array([a is None or b is not None for a, b in zip(old, new, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*columns, moved], names=[*part.schema.names, changed]).filter(gone)

    changed = free_name(df, "changed")
    rows = df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(changed, T.BooleanType())]))
    if length:
        rows = rows.withColumn(length, F.when(F.col(changed), F.length(text)).otherwise(F.col(length)).cast(df.schema[length].dataType))
    return rows.drop(changed)
