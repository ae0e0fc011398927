"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed character n-grams; a linear layer and softmax give a
probability for each language. Training is stochastic gradient descent in numpy on a bounded sample:
about ``PER_LANGUAGE`` labelled rows of each language, one stretch of each (its place and length by hash of
the row).

Rejection is calibrated on whole texts of other labelled rows, about ``CALIBRATED`` of each language, that taught
nothing: one temperature makes the probabilities fit, and the threshold of a language and a class of lengths is
the score that all but ``MOST_LOST`` of its right rows reach, less ``SLACK`` log odds. Where a language has fewer
than ``FEWEST`` right rows of a length, all languages' are taken together, or those of the nearest length; where
there is none, what is as likely wrong as right is rejected.

Prediction reads whole texts and nothing else.

Defined cases: a null text, or one without letters, is ``und`` with score 0 and rejected; without any
labelled row everything is ``und``; labels that are null teach nothing; of more than ``MOST_LANGUAGES`` values of
the label the most frequent are learned, so the table of weights stays bounded; copies of a row, or rows of one
key, teach once for each stretch that differs; repeated rows each have a result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import bucket_of, free_name, slices
from riskloom.llm.ngrams import has_letter, hashed, pieces

ORDERS, BITS, DIM = (2, 3, 4), 16, 16
PER_LANGUAGE, SHORTEST, LONGEST, MOST_LANGUAGES = 3000, 20, 600, 500
EPOCHS, LEAST_STEPS, RATE, EVEN = 4, 20_000, 0.4, 0.5
CALIBRATED, MOST_LOST, SLACK, FEWEST = 1500, 0.001, 0.5, 100
#: Lengths of texts, in n-grams, that thresholds are told apart by.
LENGTHS = (60, 200, 600, 2000)
UNKNOWN = "und"


@dataclass
class Identifier:
    languages: list[str]
    embedding: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    #: By language (None: all of them) and class of lengths; EVEN for those that aren't in it.
    thresholds: dict[tuple[str | None, int], float] = field(default_factory=dict)

    def accepts(self, name: str, score: float, size: float) -> bool:
        """size: of the text, in n-grams."""
        length = length_class(size)
        return name != UNKNOWN and score >= self.thresholds.get((name, length), self.thresholds.get((None, length), EVEN))

    def logits(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(means, n-grams) of each text; table: a row for each bucket, whose means are the logits without bias."""
        sums, counts = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts))
        for of, parts in pieces(texts):
            for buckets, begins, ends in hashed(parts, ORDERS, BITS):
                upto = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(table[buckets], axis=0, dtype=np.float64)])
                np.add.at(sums, of, upto[ends] - upto[begins])
                np.add.at(counts, of, ends - begins)
        return sums / np.maximum(counts, 1)[:, None], counts

    def narrow(self) -> tuple[np.ndarray, np.ndarray]:
        """(rows for each bucket, what turns their mean into logits): the narrower of embeddings and their products."""
        n = len(self.languages)
        return (self.embedding @ self.weights, np.eye(n)) if n <= DIM else (self.embedding, self.weights)

    def raw(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(logits before the temperature, n-grams) of each text."""
        table, last = self.narrow()
        means, sizes = self.logits(texts, table)
        return means @ last + self.bias, sizes

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, n-grams) of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        logits, sizes = self.raw(texts)
        p = _softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        known = np.array([has_letter(t) for t in texts], bool)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, np.where(known, np.clip(p.max(axis=1), 0, 1), 0.0), sizes


def length_class(size: float) -> int:
    return int(np.searchsorted(LENGTHS, size, side="right"))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _labelled(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(k, t, l, u): rows with text and label and a number from 0 to 1 by hash of the whole row."""
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).where("t is not null and l is not null")
    return rows.withColumn("u", _part(F.lit("row"), "k", "l", F.xxhash64("t")))


def _part(*of) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(1 << 30)) / float(1 << 30)


def language_counts(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, int]:
    """Labelled rows of the ``MOST_LANGUAGES`` most frequent languages."""
    counted = _labelled(df, key, text, lang).groupBy("l").count().orderBy(F.col("count").desc(), "l").limit(MOST_LANGUAGES)
    return {r["l"]: r["count"] for r in counted.collect()}


def _share(counts: dict[str, int], wanted: int, most: float) -> Column:
    table = F.create_map(*(F.lit(x) for name, n in counts.items() for x in (name, min(most, wanted / n))))
    return F.coalesce(table[F.col("l")], F.lit(0.0))


def sample(df: DataFrame, counts: dict[str, int], key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """A bounded sample of (stretch of a text, language), in an order that depends on the rows only."""
    if not counts:
        return []
    seeded = lambda seed: _part(F.lit(seed), "k", "l", "u")
    length = (SHORTEST + seeded("length") * (LONGEST - SHORTEST)).cast("int")
    place = (seeded("place") * F.greatest(F.length("t") - length, F.lit(0))).cast("int") + 1
    drawn = _labelled(df, key, text, lang).where(F.col("u") < _share(counts, per_language, 0.8)).select("k", F.substring("t", place, length).alias("x"), "l")
    # Copies of a row are one; the limit holds however unevenly hashes fall.
    bounded = drawn.dropDuplicates().orderBy(F.xxhash64("k", "x", "l")).limit(2 * per_language * len(counts))
    return [(x, name) for _, x, name in sorted((r["k"] or "", r["x"], r["l"]) for r in bounded.collect())]


def _examples(texts: list[str]) -> list[np.ndarray]:
    """The buckets of each text."""
    out = []
    for t in texts:
        found = [b for b, _, _ in hashed([t], ORDERS, BITS)]
        out.append(np.concatenate(found).astype(np.int64))
    return out


def train(examples: list[tuple[str, str]], seed: int = 7, epochs: int = EPOCHS, rate: float = RATE) -> Identifier:
    """Fit on the examples; the model is not calibrated."""
    examples = [(t, name) for t, name in examples if has_letter(t)]
    languages = sorted({name for _, name in examples})
    draw = np.random.default_rng(seed)
    model = Identifier(languages, draw.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)), np.zeros((DIM, len(languages))), np.zeros(len(languages)))
    if not languages:
        return model
    buckets = _examples([t for t, _ in examples])
    wanted = np.array([languages.index(name) for _, name in examples])
    fitted = draw.permutation(len(examples))
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(fitted))))  # a small sample is gone over more often
    steps, step = epochs * len(fitted), 0
    for _ in range(epochs):
        for k in draw.permutation(fitted):
            ids = buckets[k]
            lr = rate * (1 - step / steps)
            step += 1
            mean = model.embedding[ids].mean(axis=0)
            g = _softmax(mean @ model.weights + model.bias)
            g[wanted[k]] -= 1
            back = model.weights @ g
            model.weights -= lr * np.outer(mean, g)
            model.bias -= 0.1 * lr * g
            np.subtract.at(model.embedding, ids, lr * back / len(ids))
    return model


def calibrate(model: Identifier, logits: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> None:
    """Temperature and thresholds from texts that taught nothing: their logits, n-grams and languages' places."""
    if not len(wanted):
        return
    loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(wanted)), wanted] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    p = _softmax(logits / model.temperature)
    right, score = p.argmax(axis=1) == wanted, np.clip(p.max(axis=1), 1e-12, 1 - 1e-12)
    odds = np.log(score / (1 - score))
    lengths = np.array([length_class(n) for n in sizes])
    for length in range(len(LENGTHS) + 1):
        for k, name in enumerate([*model.languages, None]):
            of = right & (lengths == length) & ((wanted == k) | (name is None))
            if of.sum() >= (1 if name is None else FEWEST):
                low = np.quantile(odds[of], MOST_LOST, method="lower") - SLACK
                model.thresholds[name, length] = float(1 / (1 + np.exp(-low)))
    known = [length for name, length in model.thresholds if name is None]
    for length in range(len(LENGTHS) + 1) if known else ():
        # A length that no right text has takes the threshold of the nearest one, the longer of two.
        model.thresholds.setdefault((None, length), model.thresholds[None, min(known, key=lambda x: (abs(x - length), -x))])  # noqa: B023


def held_back(df: DataFrame, model: Identifier, counts: dict[str, int], key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = CALIBRATED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logits, n-grams, place of the language) of whole texts of labelled rows that ``sample`` never draws."""
    rows = _labelled(df, key, text, lang).where(F.col("u") >= F.lit(1.0) - _share(counts, per_language, 0.2)).select("k", "l", "t")
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            texts = part.column(2).to_pylist()
            logits, sizes = sent.value.raw(texts)
            known = [has_letter(t) for t in texts]
            told = pa.RecordBatch.from_arrays([part.column(1), pa.array(logits.tolist(), pa.list_(pa.float64())), pa.array(sizes, pa.float64())], names=["l", "z", "n"])
            yield told.filter(pa.array(known, pa.bool_()))

    found = rows.mapInArrow(run, "l string, z array<double>, n double").dropDuplicates()
    held = found.orderBy(F.xxhash64("l", "z", "n")).limit(2 * per_language * max(1, len(counts))).collect()
    held = sorted((r["l"], r["z"], r["n"]) for r in held if r["l"] in model.languages)
    place = {name: k for k, name in enumerate(model.languages)}
    return np.array([z for _, z, _ in held]).reshape(-1, max(1, len(place))), np.array([n for _, _, n in held]), np.array([place[name] for name, _, _ in held], int)


def identify(df: DataFrame, model: Identifier, text: str = "text") -> tuple[DataFrame, str, str, str]:
    """The rows of ``df`` and the names of three new columns: language, score, accepted."""
    at = df.columns.index(text)
    name, score, accepted = (free_name(df, x) for x in ("lang_pred", "score", "accepted"))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            names, scores, sizes = sent.value.predict([x or "" for x in part.column(at).to_pylist()])
            good = [sent.value.accepts(*x) for x in zip(names, scores, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores), pa.array(good, pa.bool_())], names=[*part.schema.names, name, score, accepted])

    schema = df.select("*", F.lit("").alias(name), F.lit(0.0).alias(score), F.lit(True).alias(accepted)).schema
    return df.mapInArrow(run, schema), name, score, accepted


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Identifier:
    """Learn from the rows that aren't held out (crc32 of the key modulo 4 is 2)."""
    seen = df.where(bucket_of(key, 4) != 2)
    counts = language_counts(seen, key, text, lang)
    model = train(sample(seen, counts, key, text, lang))
    if model.languages:
        calibrate(model, *held_back(seen, model, counts, key, text, lang))
    return model
