"""Held-out accuracy of the trained operators, and their defined cases."""

import zlib

import numpy as np
import pytest

from riskloom.llm import langid, ngrams, toxicity
from riskloom.llm.queries import op2_language, op4_toxicity

FR = "le chat mange la souris dans la maison avec une belle robe et des fleurs où il était né déjà"
EN = "the cat eats the mouse in the house with a lovely dress and some flowers where it was born already"


def mixed(words, k, n=12):
    draw = np.random.default_rng(k)
    return " ".join(draw.choice(words.split(), n))


@pytest.mark.parametrize("text", ["Hello, wörld 42!", "a", " ab  cd ", "ŁÓDŹ x", "no"])
def test_ngrams_lie_within_words(text):
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    for n, (buckets, begins, ends) in zip((2, 3), ngrams.hashed([text, "zz"], (2, 3), 16), strict=True):
        want = sum(max(0, len(w) + 2 - n + 1) for w in words)
        assert ends[0] - begins[0] == want and ends[1] - begins[1] == 4 - n + 1 and len(buckets) == ends[1]


def test_long_text_in_pieces(monkeypatch):
    text = (EN + ", " + FR + "! ") * 30
    whole = toxicity.features([text, "ab cd"])
    monkeypatch.setattr(ngrams, "PIECE", 100)
    parts = toxicity.features([text, "ab cd"])
    assert [sorted(x) for x in whole] == [sorted(x) for x in parts]


def test_language(documents):
    rows = [(k, mixed(FR if k % 2 else EN, k), "fr" if k % 2 else "en") for k in range(300)]
    model = langid.fit(documents(rows))
    odd = documents([(1, None), (2, ""), (3, "123 !!"), (4, EN), (5, FR * 3000), (5, FR * 3000), (None, FR), (6, EN + " " + FR)])
    out, name, score, accepted = langid.identify(odd, model)
    got = [(r["doc_id"], r[name], r[score], r[accepted]) for r in out.collect()]
    by = {g[0]: g for g in got}
    for k in (1, 2, 3):
        assert by[k][1:] == ("und", 0.0, False)
    assert by[4][1] == "en" and by[5][1] == "fr" == by[None][1] and got.count(by[5]) == 2
    assert all(0 <= g[2] <= 1 for g in got)


def test_language_thresholds_come_from_held_back_scores():
    """By language and length; all languages together where one has few texts of a length."""
    model = langid.Identifier(["aa", "bb"], np.zeros((1, 2)), np.eye(2), np.zeros(2))
    lead = np.linspace(2, 6, 200)
    logits = np.stack([np.concatenate([lead, np.zeros(200), [9.0] * 5]), np.concatenate([np.zeros(200), lead + 3, [0.0] * 5])], axis=1)
    wanted = np.concatenate([np.repeat([0, 1], 200), np.zeros(5, int)])
    sizes = np.concatenate([np.full(400, 100.0), np.full(5, 5000.0)])
    wrong = list(range(0, 200, 8))  # so that the temperature doesn't saturate
    langid.calibrate(model, np.concatenate([logits, logits[wrong]]), np.concatenate([sizes, sizes[wrong]]), np.concatenate([wanted, np.ones(len(wrong), int)]))
    score = lambda x: 1 / (1 + np.exp(-(x / model.temperature - langid.SLACK)))
    assert model.thresholds == {("aa", 1): pytest.approx(score(2)), ("bb", 1): pytest.approx(score(5)), **{(None, n): pytest.approx(score(2)) for n in (0, 1, 2)}, **{(None, n): pytest.approx(score(9)) for n in (3, 4)}}
    assert model.accepts("aa", score(2.1), 100) and not model.accepts("aa", score(1.9), 100)
    assert not model.accepts("bb", score(4.9), 100) and not model.accepts(langid.UNKNOWN, 1.0, 100)
    assert model.accepts("bb", score(9.1), 9000) and not model.accepts("bb", score(8.9), 9000)
    empty = langid.Identifier(["aa"], np.zeros((1, 2)), np.eye(2), np.zeros(2))
    assert empty.accepts("aa", langid.EVEN, 10) and not empty.accepts("aa", 0.49, 10)


def test_rare_languages_are_left_out_beyond_the_most(documents, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [(k, mixed(EN, k), "en") for k in range(80)] + [(100 + k, mixed(FR, k), "fr") for k in range(60)] + [(200 + k, mixed(EN, k), "xx") for k in range(20)]
    assert langid.fit(documents(rows)).languages == ["en", "fr"]


def test_a_hot_key_is_drawn_row_by_row(documents):
    """Half of the rows share a key and another half has none: the languages are learned, copies once."""
    rows = [(1, mixed(EN, k), "en") for k in range(200)] + [(None, mixed(FR, k), "fr") for k in range(200)] + [(2, EN, "en")] * 300
    df = documents(rows)
    counts = langid.language_counts(df)
    drawn = langid.sample(df, counts, per_language=60)
    by = {name: [x for x, n in drawn if n == name] for name in ("en", "fr")}
    assert all(20 < len(x) < 120 for x in by.values()) and len(set(drawn)) > 0.9 * len(drawn)


def test_unlearned_language_is_rejected(documents):
    model = langid.fit(documents([(k, mixed(FR if k % 2 else EN, k), "fr" if k % 2 else "en") for k in range(300)]))
    odd = ["zażółć gęślą jaźń wczoraj poszedłem do sklepu", "köszönöm szépen a segítséget holnap találkozunk", "xq zj wv kp qz"]
    out, _, score, accepted = langid.identify(documents([*enumerate(odd), (9, EN), (10, FR)]), model)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert not any(rows[k][accepted] for k in range(3)) and rows[9][accepted] and rows[10][accepted]
    assert any(rows[k][score] >= langid.EVEN for k in range(3))  # which a constant would accept


def test_clean_rows_are_kept(spark):
    """Whole table: of the rows that are predicted right hardly any is rejected, held out or not."""
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op2_language(spark, sf).collect()
    right = [r for r in got if r["lang_pred"] == docs[r["doc_id"]]]
    assert len(right) > 0.995 * len(docs) and sum(not r["accepted"] for r in right) <= 0.004 * len(docs)


def test_language_learns_nothing_from_held_out_rows(documents):
    rows = [(k, mixed(EN, k), "en") for k in range(100) if zlib.crc32(str(k).encode()) % 4 != 2]
    rows += [(k, mixed(FR, k), "fr") for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert langid.fit(documents(rows)).languages == ["en"]


def test_language_without_labels(documents):
    model = langid.fit(documents([(0, EN, None), (1, None, "en")]))
    out, name, _, accepted = langid.identify(documents([(1, EN)]), model)
    assert [(r[name], r[accepted]) for r in out.collect()] == [("und", False)]
    assert langid.identify(documents([]), model)[0].collect() == []


def test_language_held_out_accuracy(spark, sf_dir):
    got = {r["doc_id"]: r for r in op2_language(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    held = [(got[d["doc_id"]]["lang_pred"], d["lang"]) for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2]
    assert len(got) == len(docs) and all(got[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) for d in docs)
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def labelled(spark, documents):
    rows = [(k, mixed(EN, k, 30) + (" you awful scoundrel" if k % 3 == 0 else "")) for k in range(300)]
    return documents(rows), spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(300)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, documents):
    docs, labels = labelled(spark, documents)
    model = toxicity.fit(docs, labels)
    clean = mixed(EN, 1000, 30)
    odd = documents([(1, None), (2, ""), (3, clean + " Scoundrel"), (4, clean), (4, clean), (5, clean + " word" * 50_000 + " scoundrel"), (None, clean)])
    out, name = toxicity.score(odd, model)
    got = [(r["doc_id"], r[name]) for r in out.collect()]
    by = dict(got)
    assert by[1] == by[2] and by[3] > 0.5 and by[5] > 0.5 and by[4] < 0.5 and by[None] == by[4] and len(got) == 7
    held = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5 == 0]
    scores = {r["doc_id"]: r[name] for r in toxicity.score(docs, model)[0].collect()}
    assert all((scores[k] >= 0.5) == (k % 3 == 0) for k in held)


def test_toxicity_reads_no_held_out_label(spark, documents):
    docs, labels = labelled(spark, documents)
    found, y, counts = toxicity.sample(docs, labels)
    learnt = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5]
    assert len(found) == len(y) == len(learnt) and counts == {0: sum(k % 3 > 0 for k in learnt), 1: sum(k % 3 == 0 for k in learnt)}


def test_toxicity_without_labels(spark, documents):
    docs, labels = labelled(spark, documents)
    for some, want in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0)):
        out, name = toxicity.score(docs, toxicity.fit(docs, some))
        assert out.first()[name] == pytest.approx(want, abs=1e-6)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels))[0].collect() == []
    nulls = spark.createDataFrame([(None, None), (1, None), (2, 7)], "doc_id long, toxic int")
    assert toxicity.sample(docs, nulls)[2] == {}


def test_toxicity_query(spark, sf_dir):
    rows = op4_toxicity(spark, sf_dir).collect()
    assert len(rows) == 200 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, EN, "x", 2.0, True)], "doc_id long, text string, lang_pred string, score double, accepted boolean")
    model = langid.train([(mixed(EN, k), "en") for k in range(20)])
    out, name, score, accepted = langid.identify(df, model)
    row = out.collect()[0]
    assert (row["lang_pred"], row["score"], row[name]) == ("x", 2.0, "en") and len({name, score, accepted, *df.columns}) == 8
    assert toxicity.score(df, toxicity.Scorer(np.zeros(1 << toxicity.BITS), 0.0))[0].columns[-1] == "score_1"
