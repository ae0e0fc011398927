"""The additive quality model: held-out accuracy, parts against brute force, defined cases."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import quality
from riskloom.llm.queries import op13_quality

WORDS = "the of and to in is was for with house garden river slowly bright under table winter".split()


def prose(k, n=60):
    draw = np.random.default_rng(k)
    return " ".join(w.capitalize() + "." if draw.random() < 0.1 else w for w in draw.choice(WORDS, n))


def junk(k):
    return [" | ".join(prose(k).split()), prose(k).upper().replace(" ", "!! "), "again " * 70][k % 3]


@pytest.fixture(scope="module")
def taught(spark, documents):
    docs = documents([(k, junk(k) if k % 4 == 0 else prose(k)) for k in range(300)])
    labels = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(300)], "doc_id long, quality int")
    return docs, labels, quality.fit(docs, labels)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in op13_quality(spark, sf).collect()}
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    assert got.keys() == docs.keys()
    held = {k for k in docs if zlib.crc32(str(k).encode()) % 5 == 0}
    assert {k for k, r in got.items() if r["held_out"]} == held
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    known = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    right = [got[k]["predicted"] == y for k, y in known if k in held]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_held_out_labels_teach_nothing(spark, taught):
    docs, labels, model = taught
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = quality.fit(docs, labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert all(np.array_equal(a, b) for a, b in zip(model.tables + model.pair_tables, other.tables + other.pair_tables, strict=True))


def test_defined_cases(spark, documents, taught):
    _, _, model = taught
    rows = [(1, None), (2, ""), (3, junk(4)), (3, junk(4)), (None, prose(7)), (4, prose(8, 60_000)), (5, "\n\n \t")]
    df = documents(rows).withColumn("SCORE", F.lit("x"))
    out, name = quality.score(df, model)
    assert name != "SCORE" and out.columns == [*df.columns, name]
    got = [(r["doc_id"], r[name]) for r in out.collect()]
    by = dict(got)
    assert by[1] == by[2] and got.count((3, by[3])) == 2 and by[3] < 0.3 and by[None] > 0.5 and by[4] > 0.3
    assert all(0 <= s <= 1 for _, s in got)
    assert quality.score(documents([]), model)[0].count() == 0


def test_few_or_odd_labels(spark, documents, taught):
    docs, _, _ = taught
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    # keys 1, 2 and 4 teach; a null key, a null label and other labels don't
    x, y, counts = quality.sample(docs, make([(1, 1), (1, 1), (2, 1), (2, 0), (4, None), (None, 1), (3, 7)]))
    assert len(x) == len(y) and counts == {1: sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in (1, 2)), **({0: 1} if zlib.crc32(b"2") % 5 else {})}
    for rows, share in (([], 0.0), ([(1, 1), (2, 1), (3, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)):
        out, name = quality.score(docs.limit(5), quality.fit(docs, make(rows)))
        assert all(abs(r[name] - share) < 1e-6 for r in out.collect())


def test_a_repeated_key_teaches_once(spark, documents, taught):
    _, labels, _ = taught
    docs = documents([(2, prose(k)) for k in range(500)] + [(4, junk(4))])
    x, y, _ = quality.sample(docs, labels)
    assert sorted(y.tolist()) == sorted(int(k % 4 != 0) for k in (2, 4) if zlib.crc32(str(k).encode()) % 5)


def test_long_text_in_pieces(monkeypatch):
    text = "\n".join(prose(k) + " §§ 12 again again ÉÀ" for k in range(50))
    whole = quality.measure(text)
    monkeypatch.setattr(quality, "PIECE", 37)
    assert np.allclose(quality.measure(text), whole, rtol=1e-12)


def test_measures():
    got = dict(zip(quality.MEASURES, quality.measure("The the THE cat### 12\n| été, |\n| été, |"), strict=True))
    assert got["words"] == np.log1p(11) and got["letterless_words"] == 5 / 11 and got["capital_words"] == 2 / 11
    assert got["symbol_ends"] == 5 / 11 and got["neighbours_alike"] == 1 / 11 and got["top_word"] == 4 / 11 and got["lines_alike"] == 1 / 3
    assert got["upper_letters"] == 4 / 18 and got["foreign_letters"] == 4 / 18


def test_first_cut_is_the_best_one():
    draw = np.random.default_rng(0)
    for _ in range(20):
        g, h, w = draw.normal(size=9), draw.random(9) + 0.1, draw.random(9) * 10
        worth = lambda a, b: a * a / (b + quality.RIDGE)
        gains = {c: worth(g[:c].sum(), h[:c].sum()) + worth(g[c:].sum(), h[c:].sum()) for c in range(1, 9) if min(w[:c].sum(), w[c:].sum()) >= quality.LEAST_WEIGHT}
        step = quality.shallow_tree(g, h, w)
        cuts = {c for c in range(1, 9) if step[c] != step[c - 1]}
        assert len(cuts) < quality.LEAVES and (not cuts or max(gains, key=gains.get) in cuts)
        for low, high in zip([0, *sorted(cuts)], [*sorted(cuts), 9], strict=True):
            assert np.allclose(step[low:high], -g[low:high].sum() / (h[low:high].sum() + quality.RIDGE))


def test_pair_tree_against_all_cuts():
    draw = np.random.default_rng(1)
    for _ in range(10):
        g, h, w = draw.normal(size=(4, 3)), draw.random((4, 3)) + 0.1, draw.random((4, 3)) * 20
        worth = lambda m: g[m].sum() ** 2 / (h[m].sum() + quality.RIDGE)
        best = 0.0
        for axis, size, other in ((0, 4, 3), (1, 3, 4)):
            at = np.indices(g.shape)
            for cut in range(1, size):
                total = 0.0
                for side in (at[axis] < cut, at[axis] >= cut):
                    options = [worth(side)] + [worth(side & (at[1 - axis] < c)) + worth(side & (at[1 - axis] >= c)) for c in range(1, other) if min(w[side & (at[1 - axis] < c)].sum(), w[side & (at[1 - axis] >= c)].sum()) >= quality.LEAST_WEIGHT]
                    total += max(options) if w[side].sum() >= quality.LEAST_WEIGHT else -np.inf
                best = max(best, total - worth(np.ones_like(g, bool)))
        step, gain = quality.shallow_pair_tree(g, h, w)
        assert gain == pytest.approx(max(best, 1e-9))


def test_score_adds_up_tables(taught):
    docs, _, model = taught
    x = np.array([quality.measure(r["text"]) for r in docs.limit(20).collect()])
    for row, score in zip(x, model.score(x), strict=True):
        z = model.intercept + sum(t[sum(v >= e for e in edges)] for v, edges, t in zip(row, model.edges, model.tables, strict=True))
        z += sum(t[sum(row[a] >= e for e in model.coarse[a]), sum(row[b] >= e for e in model.coarse[b])] for (a, b), t in zip(model.pairs, model.pair_tables, strict=True))
        assert score == pytest.approx(1 / (1 + np.exp(-z)))
    assert len(model.pairs) <= quality.PAIRS
