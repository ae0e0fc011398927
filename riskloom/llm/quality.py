"""Quality: a generalised additive model with pairwise interactions over measures of a text.

Each measure has a lookup table over its bins, and a few pairs of measures have one over pairs of bins. Tables
are learned by cyclic boosting: round by round each measure in turn gets one shallow tree, fitted to the
gradients that all tables together leave, a small step of which is added to its table. When rows that were
held back see no gain any more, the pairs whose best two cuts would gain most are boosted in the same way.
A score adds up table entries, which is a few vectorised look-ups a batch.

Fitted on a bounded sample, ``PER_CLASS`` labelled keys of each class, the first by hash, one row of each. The
rows weigh what their class weighs among all labelled keys, so a score is a probability for the whole table.

Scoring reads whole texts and nothing else.

Defined cases: a null text is empty; an empty text has measures of zero and a score like any other; without
labelled rows of both classes every score is the share of label 1 (0 without any); null labels and labels
other than 0 and 1 teach nothing; a key with both labels counts once for each; of rows with one key a single
one teaches; repeated rows each have a result; an empty table gives no rows.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import bucket_of, free_name, slices

PER_CLASS, SEED = 3000, 11
BINS, PAIR_BINS, PAIRS = 48, 12, 8
ROUNDS, RATE, PATIENCE, LEAVES, RIDGE, LEAST_WEIGHT = 400, 0.08, 30, 4, 1.0, 3.0
#: Code points measured in one go.
PIECE = 1 << 19
#: Classes of code points.
_SPACE, _BREAK, _LOWER, _UPPER, _DIGIT, _STOP, _COMMA, _SYMBOL = range(8)
MEASURES = (
    "words", "word_length", "word_length_spread", "upper_letters", "digits", "symbols", "letters", "foreign_letters",
    "stops", "commas", "letterless_words", "capital_words", "symbol_ends", "short_words",
    "neighbours_alike", "top_word", "distinct_words", "words_a_line", "lines_alike",
)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, _SYMBOL, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if x.isspace():
            table[c] = _BREAK if x == "\n" else _SPACE
        elif x.isalpha():
            table[c] = _UPPER if x.isupper() else _LOWER
        elif x.isdigit():
            table[c] = _DIGIT
    table[[ord(x) for x in ".!?…。"]] = _STOP
    table[[ord(x) for x in ",;:'\"()-’«»"]] = _COMMA
    return table


def _pieces(text: str) -> Iterator[str]:
    """The text cut at white space."""
    start = 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end


def measure(text: str) -> np.ndarray:
    """The measures of a whole text."""
    of_class, words = np.zeros(8, np.int64), Counter()
    n = foreign = letterless = capital = symbol_ends = short = alike = length = square = 0
    last = None
    for piece in _pieces(text):
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = _classes()[points]
        of_class += np.bincount(kinds, minlength=8)
        inside = kinds > _BREAK
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(begins):
            continue
        letter = (kinds == _LOWER) | (kinds == _UPPER)
        foreign += int((letter & (points > 0x7F)).sum())
        upto = np.concatenate([[0], np.cumsum(letter)])
        sizes = ends - begins
        n += len(begins)
        length, square = length + int(sizes.sum()), square + int((sizes * sizes).sum())
        letterless += int((upto[ends] == upto[begins]).sum())
        capital += int((kinds[begins] == _UPPER).sum())
        symbol_ends += int((kinds[ends - 1] == _SYMBOL).sum())
        short += int((sizes <= 3).sum())
        parts = piece.split()
        alike += sum(map(operator.eq, parts, parts[1:])) + (parts[0] == last)
        last = parts[-1]
        words.update(parts)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    seen = int(of_class[_LOWER:].sum())
    letters = int(of_class[_LOWER] + of_class[_UPPER])
    share = lambda a, b: a / b if b else 0.0
    mean = share(length, n)
    return np.array(
        [
            np.log1p(n), mean, max(share(square, n) - mean * mean, 0.0) ** 0.5, share(of_class[_UPPER], letters), share(of_class[_DIGIT], seen), share(of_class[_SYMBOL], seen),
            share(letters, seen), share(foreign, letters), share(of_class[_STOP], n), share(of_class[_COMMA], n), share(letterless, n), share(capital, n), share(symbol_ends, n),
            share(short, n), share(alike, n), share(max(words.values(), default=0), n), share(len(words), n), np.log1p(share(n, len(lines))), share(len(lines) - len(set(lines)), len(lines)),
        ]
    )


@dataclass
class Additive:
    """Edges of the bins and tables of the measures; pairs of measures with their own, coarser bins."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            z += table[np.searchsorted(self.edges[k], x[:, k], side="right")]
        if self.pairs:
            cells = _binned(x, self.coarse)
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                z += table[cells[:, a], cells[:, b]]
        return _chance(z)


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cuts between values that are seen, at quantiles of the distinct ones' rows."""
    out = []
    for column in x.T:
        at = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
        nearest = np.unique(column)
        place = np.searchsorted(nearest, at, side="right")
        place = place[place < len(nearest)]
        out.append((nearest[place] + nearest[place - 1]) / 2)
    return out


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, column, side="right") for e, column in zip(edges, x.T, strict=True)], axis=1)


def _worth(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def shallow_tree(g: np.ndarray, h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The step of each bin: a tree of at most ``LEAVES`` leaves over bins in order, best cut first."""
    leaves = [(0, len(g))]
    totals = [np.concatenate([[0.0], np.cumsum(v)]) for v in (g, h, weight)]
    while len(leaves) < LEAVES:
        best = (1e-9, 0, 0)
        for place, (low, high) in enumerate(leaves):
            if high - low < 2:
                continue
            left = [t[low + 1 : high] - t[low] for t in totals]
            right = [t[high] - t[low + 1 : high] for t in totals]
            gain = _worth(left[0], left[1]) + _worth(right[0], right[1]) - _worth(left[0] + right[0], left[1] + right[1])
            gain[(left[2] < LEAST_WEIGHT) | (right[2] < LEAST_WEIGHT)] = 0.0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), place, low + 1 + k)
        if not best[2]:
            break
        low, high = leaves[best[1]]
        leaves[best[1] : best[1] + 1] = [(low, best[2]), (best[2], high)]
    step = np.zeros(len(g))
    for low, high in leaves:
        step[low:high] = -(totals[0][high] - totals[0][low]) / (totals[1][high] - totals[1][low] + RIDGE)
    return step


def shallow_pair_tree(g: np.ndarray, h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """The step of each pair of bins and its gain: a cut of one measure, then one of the other on each side."""
    best, gain = np.zeros_like(g), 1e-9
    for turned in (False, True):
        sums = [np.cumsum(v.T if turned else v, axis=0) for v in (g, h, weight)]
        rows = sums[0].shape[0]
        for cut in range(rows - 1):
            step, total = np.zeros(g.T.shape if turned else g.shape), 0.0
            for part, side in ((slice(0, cut + 1), [s[cut] for s in sums]), (slice(cut + 1, rows), [s[-1] - s[cut] for s in sums])):
                along = [np.cumsum(v) for v in side]
                if along[2][-1] < LEAST_WEIGHT:
                    total = -np.inf
                    break
                left, right = [a[:-1] for a in along], [a[-1] - a[:-1] for a in along]
                worth = _worth(left[0], left[1]) + _worth(right[0], right[1])
                worth[(left[2] < LEAST_WEIGHT) | (right[2] < LEAST_WEIGHT)] = -np.inf
                whole = float(_worth(along[0][-1], along[1][-1]))
                k = int(worth.argmax()) if len(worth) else 0
                if len(worth) and worth[k] > whole:
                    total += float(worth[k])
                    step[part, : k + 1] = -left[0][k] / (left[1][k] + RIDGE)
                    step[part, k + 1 :] = -right[0][k] / (right[1][k] + RIDGE)
                else:
                    total += whole
                    step[part] = -along[0][-1] / (along[1][-1] + RIDGE)
            total -= float(_worth(sums[0][-1].sum(), sums[1][-1].sum()))
            if total > gain:
                best, gain = (step.T if turned else step), total
    return best, gain


class _Boosting:
    """Gradients, tables and the loss of rows held back."""

    def __init__(self, y: np.ndarray, weight: np.ndarray, held: np.ndarray, start: float) -> None:
        self.y, self.weight, self.held, self.z = y, weight, held, np.full(len(y), start)
        self.grow = ~held

    def sums(self, cells: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradient, curvature and weight of the growing rows in each cell."""
        p, w = _chance(self.z[self.grow]), self.weight[self.grow]
        at = cells[self.grow]
        return tuple(np.bincount(at, v, n) for v in (w * (p - self.y[self.grow]), w * p * (1 - p), w))

    def loss(self) -> float:
        p = np.clip(_chance(self.z[self.held]), 1e-12, 1 - 1e-12)
        y, w = self.y[self.held], self.weight[self.held]
        return float(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / max(w.sum(), 1e-12))

    def cycle(self, cells: list[np.ndarray], shapes: list[tuple[int, ...]], tree) -> list[np.ndarray]:
        """One table for each column of cells, boosted in turn until the loss of the held rows stays."""
        tables = [np.zeros(shape) for shape in shapes]
        best, kept, kept_z, since = self.loss(), [t.copy() for t in tables], self.z.copy(), 0
        for _ in range(ROUNDS):
            for k, shape in enumerate(shapes):
                step = RATE * tree(*(s.reshape(shape) for s in self.sums(cells[k], int(np.prod(shape)))))
                tables[k] += step
                self.z += step.ravel()[cells[k]]
            since += 1
            if (loss := self.loss()) < best - 1e-7:
                best, kept, kept_z, since = loss, [t.copy() for t in tables], self.z.copy(), 0
            if since >= PATIENCE:
                break
        self.z = kept_z
        return kept


def train(x: np.ndarray, y: np.ndarray, counts: dict[int, int]) -> Additive:
    """Fit on measures and labels; counts: of the classes among all labelled keys."""
    n = {k: int((y == k).sum()) for k in (0, 1)}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    start = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    if not n[0] or not n[1]:
        return Additive(start)
    weight = np.where(y == 1, share / n[1], (1 - share) / n[0]) * len(y)
    held = np.random.default_rng(SEED).random(len(y)) < 0.2
    run = _Boosting(y.astype(float), weight, held, start)
    edges, coarse = _edges(x, BINS), _edges(x, PAIR_BINS)
    fine = _binned(x, edges)
    tables = run.cycle(list(fine.T), [(len(e) + 1,) for e in edges], shallow_tree)
    model = Additive(start, edges, tables, coarse)
    cells = _binned(x, coarse)
    wide = [len(e) + 1 for e in coarse]
    candidates = [(a, b) for a in range(x.shape[1]) for b in range(a + 1, x.shape[1]) if wide[a] > 1 and wide[b] > 1]
    joined = {(a, b): cells[:, a] * wide[b] + cells[:, b] for a, b in candidates}
    gain = {(a, b): shallow_pair_tree(*(s.reshape(wide[a], wide[b]) for s in run.sums(joined[a, b], wide[a] * wide[b])))[1] for a, b in candidates}
    chosen = sorted(candidates, key=lambda p: (-gain[p], p))[:PAIRS]
    model.pairs = chosen
    model.pair_tables = run.cycle([joined[p] for p in chosen], [(wide[a], wide[b]) for a, b in chosen], lambda g, h, w: shallow_pair_tree(g, h, w)[0])
    return model


def sample(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """(measures, label) of a bounded sample of the labelled rows that aren't held out, and the classes' counts among all labelled keys."""
    known = labels.select(F.col(key).cast("string").alias("k"), F.col(label).cast("int").alias("y")).where(F.col("k").isNotNull() & F.col("y").isin(0, 1) & (bucket_of("k", 5) != 0)).distinct()
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    order = [F.xxhash64(F.lit("row"), "k"), F.col("k")]
    drawn = known.where("y = 0").orderBy(*order).limit(per_class).unionAll(known.where("y = 1").orderBy(*order).limit(per_class))
    # At most 2 * per_class rows of two short values: small enough to send everywhere.
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).where(bucket_of("k", 5) != 0).join(F.broadcast(drawn), "k").select("k", "y", "t")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            found = [measure(x or "").tolist() for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.float64()))], names=["k", "y", "x"])

    # One row a key and label, so no key brings more than one to the driver.
    each = rows.mapInArrow(run, "k string, y int, x array<double>").groupBy("k", "y").agg(F.min("x").alias("x"))
    held = sorted((r["k"], r["y"], r["x"]) for r in each.collect())
    return np.array([x for _, _, x in held]).reshape(-1, len(MEASURES)), np.array([y for _, y, _ in held], int), counts


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Additive:
    return train(*sample(df, labels, key, text, label))


def score(df: DataFrame, model: Additive, text: str = "text") -> tuple[DataFrame, str]:
    """The rows of ``df`` and the name of the new column."""
    at, name = df.columns.index(text), free_name(df, "score")
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            found = np.array([measure(x or "") for x in part.column(at).to_pylist()]).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sent.value.score(found), pa.float64())], names=[*part.schema.names, name])

    return df.mapInArrow(run, df.select("*", F.lit(0.0).alias(name)).schema), name
