"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

Features are the hashed n-grams that a text has, however often. Each is multiplied by the logarithm of the
ratio of its share among toxic and other texts; ratios near 0 are left out. A logistic regression on these
scaled features gives the score. It is fitted on a bounded sample, about ``PER_CLASS`` labelled rows of
each class, drawn by hash; the intercept is then set right for the classes' shares among all labelled rows.

Scoring reads whole texts and nothing else.

Defined cases: a null, empty or letterless text has no features and the score of the intercept; without
labelled rows of both classes every score is the share of toxic rows (0 without any row); null labels teach
nothing; of several labels of one text each counts; repeated rows each have a result; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import bucket_of, free_name, slices
from riskloom.llm.ngrams import hashed, pieces

ORDERS, BITS = (4, 5, 6, 7), 20
PER_CLASS, SMOOTHING, LEAST_RATIO, PENALTY, STEPS = 1500, 1.0, 0.7, 1e-3, 200


@dataclass
class Scorer:
    weights: np.ndarray
    intercept: float

    def score(self, found: list[np.ndarray]) -> np.ndarray:
        sums = np.array([self.weights[f].sum() for f in found]) + self.intercept
        return 1 / (1 + np.exp(-np.clip(sums, -500, 500)))


def features(texts: list[str]) -> list[np.ndarray]:
    """The distinct buckets of each text."""
    parts_of: list[list[np.ndarray]] = [[] for _ in texts]
    place = np.empty(1 << BITS, np.int64)
    for of, parts in pieces(texts):
        rows = list(hashed(parts, ORDERS, BITS))
        for k, text in enumerate(of):
            parts_of[text].append(_distinct(np.concatenate([b[begins[k] : ends[k]] for b, begins, ends in rows]), place))
    return [np.zeros(0, np.int64) if not x else x[0] if len(x) == 1 else _distinct(np.concatenate(x), place) for x in parts_of]


def _distinct(buckets: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Each bucket once; place: scratch space, where the last place of each is left."""
    n = np.arange(len(buckets))
    place[buckets] = n
    return buckets[place[buckets] == n].astype(np.int64)


def sample(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = PER_CLASS) -> tuple[list[np.ndarray], np.ndarray, dict[int, int]]:
    """(features, label) of a bounded sample of the rows with a label that aren't held out, and the classes' counts among them all."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where(F.col("k").isNotNull() & F.col("y").isin(0, 1) & (bucket_of("k", 5) != 0))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, min(1.0, per_class / n)).otherwise(share)
    drawn = known.where(F.pmod(F.xxhash64(F.lit("row"), F.col("k").cast("string")), F.lit(1 << 30)) / float(1 << 30) < share)
    # About 2 * per_class rows of two numbers: small enough to send everywhere.
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(bucket_of("k", 5) != 0).join(F.broadcast(drawn), "k").select(F.col("k").cast("string"), "y", "t")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            found = [np.sort(f).astype(np.int32) for f in features([x or "" for x in part.column(2).to_pylist()])]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.int32()))], names=["k", "y", "f"])

    held = rows.mapInArrow(run, "k string, y int, f array<int>").toArrow()
    order = np.lexsort((held["y"].to_numpy(), np.array(held["k"].to_pylist(), dtype=object).astype(str))) if held.num_rows else []
    lists = held["f"].combine_chunks() if held.num_rows else []
    return [lists[int(k)].values.to_numpy() for k in order], held["y"].to_numpy()[order] if held.num_rows else np.zeros(0, int), counts


def train(found: list[np.ndarray], y: np.ndarray, counts: dict[int, int]) -> Scorer:
    """Fit on features and labels; counts: of the classes among all labelled rows."""
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if not n1 or not n0:
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return Scorer(np.zeros(1 << BITS), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    with_it = {k: np.full(1 << BITS, SMOOTHING) for k in (0, 1)}
    for f, k in zip(found, y.tolist(), strict=True):
        with_it[k][f] += 1
    ratio = np.log((with_it[1] / (n1 + 2 * SMOOTHING)) / (with_it[0] / (n0 + 2 * SMOOTHING)))
    ratio[np.abs(ratio) < LEAST_RATIO] = 0.0
    told = [f[ratio[f] != 0] for f in found]
    of = np.repeat(np.arange(len(told)), [len(f) for f in told])
    used, column = np.unique(np.concatenate(told), return_inverse=True)
    value = ratio[used][column]
    w, b = np.zeros(len(used)), 0.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):  # whole-sample gradients, Adam's steps
        z = np.bincount(of, value * w[column], len(found)) + b
        off = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(found)
        g = np.append(np.bincount(column, value * off[of], len(used)) + PENALTY * w, off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    weights = np.zeros(1 << BITS)
    weights[used] = w * ratio[used]
    return Scorer(weights, float(b + np.log(counts[1] / counts[0]) - np.log(n1 / n0)))


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Scorer:
    return train(*sample(df, labels, key, text, label))


def score(df: DataFrame, model: Scorer, text: str = "text") -> tuple[DataFrame, str]:
    """The rows of ``df`` and the name of the new column."""
    at, name = df.columns.index(text), free_name(df, "score")
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            scores = sent.value.score(features([x or "" for x in part.column(at).to_pylist()]))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, name])

    return df.mapInArrow(run, df.select("*", F.lit(0.0).alias(name)).schema), name
