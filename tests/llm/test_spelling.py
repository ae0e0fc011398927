"""Spelling variants against all pairs of words, word counts against a regular expression, defined cases."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import spelling
from riskloom.llm.queries import op12_spelling

LETTERS = "[A-Za-zÀ-ÿ]+"


def words_of(rows, slip, least=6):
    out = Counter()
    for key, text in rows:
        for run in re.findall(LETTERS, text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if slip and h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                out[w] += 1
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(count, ratio=5):
    near = {w: [v for v in count if v != w and one_edit(v, w)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * count[w] else None
    out = {}
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, count[w], len(near[w]), count.get(form[w]))
    return out


def made(rows):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def dense(seed, n=400, alphabet="abÉé", longest=9):
    """Words of few letters, so that many are near each other, with skewed counts."""
    draw = np.random.default_rng(seed)
    words = {"".join(draw.choice(list(alphabet), draw.integers(6, longest))) for _ in range(n)}
    return {w: int(5 * 3 ** draw.integers(0, 6)) for w in sorted(words)}


@pytest.mark.parametrize("seed, cell", [(0, 2000), (1, 7)])
def test_variants_are_those_of_all_pairs(spark, monkeypatch, seed, cell):
    """cell: with a small one, frequent keys are dealt to many cells."""
    monkeypatch.setattr(spelling.near_words, "__defaults__", (cell,))
    count = dense(seed)
    got = made(spelling.variants(spark.createDataFrame(list(count.items()), "word string, n long")).collect())
    assert got == expected(count)
    assert sum(v[0] is not None for v in got.values()) > 20


def test_ties_and_chains(spark):
    count = {"abcdef": 5, "abcdeg": 30, "abcdeh": 30, "abcdei": 4, "zzzzzzz": 9, "zzzzzz": 45, "zzzzzzé": 44, "longest": 150, "longes": 30, "onges": 6, "chained": 5, "chainedx": 25, "chainedxy": 125, "chainedxyz": 625}
    count = {w: n for w, n in count.items() if len(w) >= 6}
    got = made(spelling.variants(spark.createDataFrame(list(count.items()), "word string, n long")).collect())
    assert got == expected(count) and got["abcdef"][0] == "abcdeg" and got["zzzzzzz"][0] == "zzzzzz" and got["chained"][1] == "chainedxyz"


def test_query_on_texts(spark, tmp_path):
    draw = np.random.default_rng(4)
    some = ["Gartenzaun", "gartenzaun", "Garten", "garten", "maison", "maisoN", "été", "Éclairer", "éclairer", "hopital", "hôpital", "qwertyuiop" * 12, "x"]
    rows = [(k, " ".join(draw.choice(some, 60)) + ("!" if k % 2 else "\n") + "garten-garten") for k in range(60)]
    rows += [(None, "garten maison"), (70, None), (71, ""), (72, "12 §§ ---"), (73, "GARTEN " * 30_000), (1, rows[1][1]), (1, rows[1][1])]
    spark.createDataFrame([(k, t, "a", "b", 1, "c", 2) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long, word string, n long").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    count = words_of(rows, 199)
    got = made(op12_spelling(spark, str(tmp_path)).collect())
    assert got == expected({w: n for w, n in count.items() if n >= 5})
    assert max(map(len, got)) == 120


def test_no_words(spark, documents):
    for rows in ([], [(1, None), (2, "short words only")]):
        out = spelling.spelling_variants(documents(rows))
        assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0


@pytest.mark.parametrize("slip", [0, 3, 199])
def test_runs_of_letters(monkeypatch, slip):
    draw = np.random.default_rng(5)
    letters = list("abzAZÀÿ×ßÉ ,.-0\n漢€")
    rows = [(k, "".join(draw.choice(letters, draw.integers(0, 400), p=[0.07] * 10 + [0.0375] * 8))) for k in range(40)] + [(7, "Z" * 300), (8, "ÿ" * 99)]
    monkeypatch.setattr(spelling, "PIECE", 50)
    cut = [(str(k).encode(), piece) for k, t in rows for piece in spelling._cut(t.encode())]
    found = spelling.runs([p for _, p in cut], [k for k, _ in cut], 6, slip)
    assert Counter(found.to_pylist()) == words_of(rows, slip)
    assert b"".join(p for _, p in cut) == b"".join(t.encode() for _, t in rows) and len(cut) > 60


def test_pivots_are_the_cheapest_disjoint_grams():
    draw = np.random.default_rng(6)
    for _ in range(200):
        places = sorted(draw.choice(12, draw.integers(3, 9), replace=False).tolist())
        cost = draw.integers(1, 50, len(places)).tolist()
        got = spelling.pivots(places, cost)
        least = min(a + b for (p, a), (q, b) in itertools.combinations(zip(places, cost, strict=True), 2) if q - p >= 2)
        assert got[1] - got[0] >= 2 and sum(cost[places.index(p)] for p in got) == least


def test_prefix_keeps_ties():
    count = {"ab": 1, "bc": 2, "ca": 2, "xy": 9, "bx": 9, "ya": 9}
    rank = {g: k for k, g in enumerate(sorted(count, key=lambda g: (count[g], g)))}
    assert spelling.prefix("abcabxyab", count, rank) == ([0, 3, 7], rank["ab"])
    assert spelling.prefix("abcabxya", count, rank) == ([0, 1, 3], rank["bc"])
