"""Perplexity rules against plain counting."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import perplexity as P
from riskloom.llm.frames import FREED, shuffles_freed

PROSE = "the men of the house went to the other side of the road and then they came home again by the same way "


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


@pytest.mark.parametrize(
    "text", ["", " \n\t", "a", "a b c", "a b c a b c", "x\nx\n \nx\r\nx", "# <b> é ü | 100%", "a a a a a", PROSE * 40, "日本 語\v\f語 " * 9, "w\n" * 500]
)
def test_base_counts(text):
    assert P.base_counts(text.encode()) == brute_base(text)


def brute_model(texts, order=5):
    """A function of (context, character) by plain dictionaries: modified Kneser-Ney as published, of the numbers of other distinct texts."""
    begin = chr(0x10FFFF)
    counts = Counter()
    for t in dict.fromkeys(texts):
        row = begin * (order - 1) + (t or "")
        counts.update({row[k : k + order] for k in range(len(row) - order + 1)})
    levels = {order: {g: n - 1 for g, n in counts.items()}}
    for k in range(order - 1, 0, -1):
        levels[k] = {}
        for g, n in levels[k + 1].items():
            levels[k][g[1:]] = levels[k].get(g[1:], 0) + (n > 0)
    cut = {}
    for k, grams in levels.items():
        n = Counter(grams.values())
        if all(n[x] for x in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            cut[k] = {c: min(max(c - (c + 1) * y * n[c + 1] / n[c], 0.05), c - 0.05) for c in (1, 2, 3)}
        else:
            cut[k] = {1: 0.5, 2: 0.75, 3: 0.9}

    def p(gram):
        if not gram:
            return 1 / len(levels[1])
        k = len(gram)
        after = {g: n for g, n in levels[k].items() if n and g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:])
        n, d, total = levels[k].get(gram, 0), cut[k], sum(after.values())
        own = n - d[min(n, 3)] if n else 0
        return own / total + sum(d[min(x, 3)] for x in after.values()) / total * p(gram[1:])

    return lambda context, c: p((begin * (order - 1) + context + c)[-order:])


SMALL = ["abracadabra, the cat sat.", "the bat sat on the mat\nthe end", "", None, "Ünïcode 42! \U0001f600 日本", "a", "THE bat", "the bat sat", "the mat", "a mat sat", "the cat"]


def test_probabilities_match_dictionaries(spark, documents):
    counts = P.count_grams(P._packed(documents(list(enumerate([*SMALL, *SMALL[:2]]))), "text")).groupBy("gram").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    got = {r["gram"]: r["p"] for r in P.model(counts).collect()}
    begin = chr(0x10FFFF)
    seen = {(begin * 4 + t)[k : k + 5] for t in SMALL if t for k in range(len(t))}
    assert set(got) == seen
    p = brute_model(SMALL)
    for gram, value in got.items():
        assert value == pytest.approx(p(gram[:-1], gram[-1]), rel=1e-12)
    # a distribution sums to one
    assert sum(p("the", c) for c in set("".join(t or "" for t in SMALL))) == pytest.approx(1.0)


def test_text_in_pieces_counts_the_same(monkeypatch):
    def hashes(texts):
        return np.sort(np.concatenate([P._hash(P._windows(points))[P._ends(sizes)] for points, _, sizes in P._pieces(texts)]))

    text = PROSE * 3 + "é日本"
    whole = hashes([text, "ab"])
    monkeypatch.setattr(P, "PIECE", 7)
    assert (whole == hashes([text, "ab"])).all() and len(whole) == len(text) + 2


def test_hashes_tell_ngrams_apart():
    """Also those that differ by one in places side by side, and whatever the order."""
    draw = np.random.default_rng(3)
    grams = np.unique(np.concatenate([draw.integers(0, 4, (3000, 5)), draw.integers(0x10FFFB, 0x110000, (3000, 5)), draw.integers(0, 0x110000, (3000, 5))]).astype(np.uint32), axis=0)
    assert len(np.unique(P._hash(list(grams.T)))) == len(grams)


@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_hashes_are_found_by_their_first_bits(n):
    draw = np.random.default_rng(n)
    top = np.uint64(2**64 - 1)
    close = np.uint64(123 << 50) + np.arange(50, dtype=np.uint64)  # all with the same first bits
    some = np.unique(np.concatenate([draw.integers(0, 2**64, n, np.uint64), close, [np.uint64(0)]]))[-n:]
    for hashes in (some, np.unique(np.append(some, top))):
        wanted = np.concatenate([hashes, hashes + np.uint64(1), hashes - np.uint64(1), draw.integers(0, 2**64, 99, np.uint64), [np.uint64(0), top]])
        at, found = P._Places(hashes).find(wanted)
        assert (at == np.searchsorted(hashes, wanted)).all()
        assert (found == np.isin(wanted, hashes)).all()


@pytest.mark.parametrize(("piece", "held"), [(7, 5), (40, 1), (1 << 17, 3 << 19)])
def test_a_text_counts_once_though_batches_share_it(documents, monkeypatch, piece, held):
    monkeypatch.setattr(P, "PIECE", piece)
    monkeypatch.setattr(P, "HELD", held)
    draw = random.Random(piece)
    texts = [*(t for t in SMALL if t), PROSE, PROSE * 3, *("".join(draw.choice("ab ") for _ in range(draw.randrange(1, 60))) for _ in range(40))]
    want = Counter(g for t in set(texts) for g in {(chr(0x10FFFF) * 4 + t)[k : k + 5] for k in range(len(t))})
    got = P.count_grams(P._packed(documents(list(enumerate(texts))), "text")).collect()
    assert len(got) == len(want) and {r["gram"]: r["n"] for r in got} == want


def test_a_block_is_counted_once(documents, monkeypatch):
    calls, count = [], P.count_grams
    monkeypatch.setattr(P, "count_grams", lambda texts: calls.append(1) or count(texts))
    assert P.log_perplexities(documents(list(enumerate(SMALL)))).count() == len({t for t in SMALL if t})
    assert len(calls) == 1


def test_shuffle_files_are_removed_for_the_scores_only(spark, documents, monkeypatch):
    seen, put, before = [], P.stored, spark.conf.get(FREED)
    monkeypatch.setattr(P, "stored", lambda df, label: seen.append((label, spark.conf.get(FREED))) or put(df, label))
    assert P.score(documents(list(enumerate(SMALL)))).count() == len(SMALL)
    assert {label for label, freed in seen if freed == "true"} == {"block-grams", "grams", "model", "log-perplexity"}
    assert spark.conf.get(FREED) == before
    with pytest.raises(ValueError, match="stops"), shuffles_freed(spark):
        raise ValueError("stops")
    assert spark.conf.get(FREED) == before


def test_strings_and_code_points():
    grams = np.array([[0x10FFFF, 0x7F, 0x80, 0x7FF, 0x800], [0xFFFF, 0x10000, 0x20, 0, 0x65E5]], np.uint32)
    strings = P._strings(grams)
    assert strings.to_pylist() == ["".join(map(chr, g)) for g in grams]
    assert (P._from_strings(strings) == grams).all()


@pytest.mark.parametrize("block", [1, 50, 1 << 25])
def test_score_is_the_mean_log_probability_whatever_the_blocks(documents, block, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", block)
    monkeypatch.setattr(P, "HELD", 30)
    monkeypatch.setattr(P, "PIECE", 70)
    texts = [*SMALL, PROSE, PROSE[:60], "xx", PROSE]
    got = {r["doc_id"]: r["log_perplexity"] for r in P.score(documents(list(enumerate(texts)))).collect()}
    p = brute_model(texts)
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        if not text:
            assert got[k] is None
            continue
        logs = [math.log(p(text[:i], c)) for i, c in enumerate(text)]
        assert got[k] == pytest.approx(-sum(logs) / len(text), rel=1e-6)


def test_letters_in_another_order_are_less_likely(documents):
    """Other scripts count by their letters, and by case."""
    words = "привет мир сегодня хорошая погода в нашем городе и люди гуляют в парке".split()
    draw = random.Random(8)
    good = [(k, " ".join(draw.choice(words) for _ in range(90))) for k in range(60)]
    mixed = "".join(chr(0x430 + (ord(c) - 0x430 + 7) % 32) if c != " " else c for c in good[0][1])
    odd = [(100, mixed), (101, "".join(c.upper() if i % 2 else c for i, c in enumerate(good[1][1])))]
    rows = {r["doc_id"]: r for r in P.judge(documents([*good, *odd])).collect()}
    assert all(rows[k]["kept"] for k, _ in good if not rows[k]["base_failed"])
    for k in (100, 101):
        assert rows[k]["perplexity"] > 1.2 * max(rows[i]["perplexity"] for i, _ in good)


def test_bands_reject_outliers_by_language(documents):
    draw = random.Random(4)
    good = [(k, " ".join(draw.choice(PROSE.split()) + draw.choice(["", "s", "er", "ing"]) for _ in range(120))) for k in range(40)]
    odd = [(100, " ".join(f"q{chr(97 + i % 26)}zx{i}vv" for i in range(80)))]
    rows = {r["doc_id"]: r for r in P.judge(documents([*good, *odd, (101, None), (102, ""), (103, "too short"), (None, good[0][1])])).collect()}
    assert not rows[100]["base_failed"] and not rows[100]["kept"]
    assert all(rows[k]["kept"] for k, _ in good) and rows[None]["kept"]
    for k in (101, 102, 103):
        assert rows[k]["base_failed"] and not rows[k]["kept"]
    assert rows[101]["perplexity"] is None and rows[101]["n_words"] == 0


def _scored(spark, rows):
    """Scores of documents that pass the base rules; rows are (lang, text_hash, log_perplexity)."""
    return spark.createDataFrame([(lang, h, x, 100, 0) for lang, h, x in rows], "lang string, text_hash long, log_perplexity double, n_words long, n_repeat_words long")


@pytest.mark.parametrize("at", [1.97, 2.0, 2.03])
@pytest.mark.parametrize("near", [False, True])
def test_a_group_of_copies_leaves_the_band_of_a_small_language(spark, at, near):
    draw = random.Random(5)
    clean = [("small", k, draw.gauss(2.0, 0.08)) for k in range(450)]
    large = [("large", k, draw.gauss(2.5, 0.08)) for k in range(1500)]
    copies = [("small", 10_000 + k * near, at) for k in range(1000)]  # a third of all rows
    band = {r["lang"]: r for r in P.bands(_scored(spark, [*clean, *large, *copies])).collect()}
    kept = sum(band["small"]["lower"] <= x <= band["small"]["upper"] for _, _, x in clean)
    assert kept >= 0.99 * len(clean)
    assert band["small"]["upper"] - band["small"]["lower"] < 1.0  # still rejects


def test_copies_of_one_text_reject_no_other(documents):
    draw = random.Random(6)
    prose = lambda n: " ".join(draw.choice(PROSE.split()) + draw.choice(["", "s", "er", "ing"]) for _ in range(n))
    small = [(k, prose(60 + k), "small") for k in range(30)]
    large = [(100 + k, prose(120), "large") for k in range(90)]
    copies = [(1000 + k, prose(100) if k == 0 else None, "small") for k in range(60)]
    copies = [(k, copies[0][1], lang) for k, _, lang in copies]
    rows = P.judge(documents([*small, *large, *copies])).collect()
    assert all(r["kept"] for r in rows if r["doc_id"] < 30 or r["doc_id"] >= 1000)


def test_one_score_is_its_own_band_and_null_language_is_one(documents):
    words = PROSE.split()
    text = " ".join(w + str(k) for k, w in enumerate(words * 3))
    rows = P.judge(documents([(1, text, None), (2, text + " more", "xx")])).collect()
    assert all(r["kept"] for r in rows)


def test_empty_table(documents):
    assert P.judge(documents([])).collect() == []
