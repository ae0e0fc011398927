"""Hits against all windows."""

import random
import re

import pytest

from riskloom.llm import decontaminate as D


def said(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, items, window=10):
    words, hit, named = said(text), set(), set()
    for name, item in items:
        w = said(item)
        n = min(window, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                named.add(name)
    return len(words), hit, named


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(seed):
    draw = random.Random(seed)
    make = lambda n: " ".join(draw.choice("abcd") for _ in range(n))
    items = [(str(k), make(draw.randint(0, 9))) for k in range(6)]
    automaton = D.Automaton([(k, D.words(t.encode())) for k, t in items], window=4)
    for _ in range(150):
        text = make(draw.randint(0, 30))
        hit, named = automaton.find(D.words(text.encode()))
        _, want, names = brute(text, items, 4)
        assert set(hit.nonzero()[0]) == want and named == names, (items, text)


def test_words():
    text = "It's A-1 Éa_b 日本\x7fz"
    assert [w.decode() for w in D.words(text.encode())] == said(text)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "short item"), (10, "ONE two three four five six seven eight nine ten"), (3, None), (4, ""), (None, "nameless thing")]


def tables(spark, documents):
    long = "zero one two three four five six seven eight nine ten eleven twelve"
    docs = documents([(1, long), (2, "a short, item!"), (3, None), (4, ""), (5, "nothing"), (6, "nameless thing"), (1, long), (7, "filler " * 50_000 + "short item")])
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block", [4, 500_000])
def test_findings(spark, documents, block):
    import hashlib

    docs, items = tables(spark, documents)
    rows = D.findings(docs, items, block_words=block).collect()
    assert len(rows) == 8
    for r in rows:
        text = next(d["text"] for d in docs.collect() if d["doc_id"] == r["doc_id"])
        n, hit, named = brute(text, ITEMS)
        names = sorted(str(x) for x in named if x is not None)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, len(hit), len(names), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()


def test_clean(spark, documents):
    docs, items = tables(spark, documents)
    more = documents([(20, "Before this. One, two three FOUR five six seven eight nine ten! After it came a lot of other words that stay here in place")])
    out = {r["doc_id"]: r for r in D.clean(docs.unionAll(more), items, length="n_chars").collect()}
    assert set(out) == {3, 4, 5, 7, 20}
    assert out[20]["text"] == "Before this.\n! After it came a lot of other words that stay here in place"
    assert out[20]["n_chars"] == len(out[20]["text"]) and out[5]["text"] == "nothing" and out[3]["text"] is None
    assert not any(r["contaminated"] for r in D.findings(documents([(k, r["text"]) for k, r in out.items()]), items).collect())


def test_ends_that_meet_are_cut_too(spark, documents):
    items = spark.createDataFrame([(1, "alpha beta"), (2, "gamma delta")], "item_id long, text string")
    filler = " ".join(f"w{k}" for k in range(20))
    out = D.clean(documents([(1, f"{filler} alpha gamma delta beta {filler}")]), items).collect()
    assert not brute(out[0]["text"], [(1, "alpha beta"), (2, "gamma delta")])[1]


def test_empty_tables(spark, documents):
    docs, items = tables(spark, documents)
    assert not any(r["contaminated"] for r in D.findings(docs, items.limit(0)).collect())
    assert D.findings(docs.limit(0), items).collect() == [] == D.clean(docs.limit(0), items).collect()


def test_clashing_columns(spark, documents):
    _, items = tables(spark, documents)
    df = spark.createDataFrame([(1, "x", 3, True)], "doc_id long, text string, hits int, changed boolean")
    assert D.clean(df, items).collect()[0].asDict() == {"doc_id": 1, "text": "x", "hits": 3, "changed": True}
