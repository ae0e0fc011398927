"""Fingerprints, links and components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from riskloom.llm import simhash as S
from riskloom.llm.components import connected


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    """Smallest member of each one's component over all pairs."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("text", ["", " ", "A", "a b", "É é e", "the cat sat on the mat", "A b C " * 100, "x\x0by\x1fz w"])
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == brute_print(text)


def test_long_text_in_pieces():
    words = [f"w{k % 977}" for k in range(70_000)]
    assert S.fingerprint(" ".join(words).encode()) == brute_print(" ".join(words))


def clusters(n, seed):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        p = draw.getrandbits(64)
        for _ in range(draw.randint(1, 12)):
            out.append(p)
            for b in draw.sample(range(64), draw.randint(0, 4)):
                p ^= 1 << b
    return sorted(set(out))


@pytest.mark.parametrize("direct", [2, 512])
def test_links_span_all_components(spark, monkeypatch, direct):
    monkeypatch.setattr(S, "DIRECT", direct)
    prints = clusters(60, 5) + [0, 7, 1 << 63]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(k, p) for k, p in enumerate(signed)], "doc_id long, fingerprint long")
    want = brute_roots(prints)
    groups = {}
    for k, p in enumerate(prints):
        groups.setdefault(want[p], []).append(k)
    got = {r["fingerprint"]: r["component_id"] for r in S.components(df).collect()}
    for members in groups.values():
        assert {got[signed[k]] for k in members} == {min(members)}


@pytest.mark.parametrize(("chunk", "held_rows", "batch"), [(1, 2, 7), (1 << 18, 20, 10_000)])
def test_large_buckets_are_dealt_again(spark, monkeypatch, chunk, held_rows, batch):
    """Fingerprints that share 24 bits: their buckets pass the limit at every level."""
    monkeypatch.setattr(S, "CHUNK", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    draw = random.Random(11)
    base = draw.getrandbits(64)
    prints = {base}
    while len(prints) < 400:
        prints.add(draw.choice(sorted(prints)) ^ sum(1 << b for b in draw.sample(range(40), draw.randint(2, 5))))
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    deep = S._deal(df.selectExpr("cast(0 as long) as k", "fingerprint as f"), 0, 20)
    assert deep.where("again").count() == 4 * len(prints) and deep.where("not again").isEmpty()
    want = brute_roots(prints)
    got = {r["node"]: r["root"] for r in connected(S.links(df, held_rows=held_rows)).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    root = {p: got.get(s, s) for p, s in zip(prints, signed, strict=True)}
    assert len({(want[p], root[p]) for p in prints}) == len(set(want.values())) == len(set(root.values()))


def test_large_group_is_split_in_the_same_way():
    draw = random.Random(3)
    base = draw.getrandbits(64)
    prints = {base}
    while len(prints) < 1500:
        prints.add(draw.choice(sorted(prints)[:50]) ^ sum(1 << b for b in draw.sample(range(20, 64), 3)))
    prints = np.array(sorted(prints), np.uint64)
    ids = np.arange(len(prints))
    forest = S._Forest(len(prints))
    S._split(prints, ids, list(range(20, 64)), forest, S._pivot_table(prints))
    whole = S._Forest(len(prints))
    for k in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[k]) <= 3)
        whole.join(np.full(len(near), k), near)
    assert (forest.label == whole.label).all()


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected(edges).collect()}
    assert len({got[k] for k in range(201)}) == 1 and got[500] == got[501] != got[0] and len(got) == 203
    assert connected(edges.limit(0)).collect() == []


def test_near_duplicates_and_keep_one(documents):
    text = " ".join(f"word{k}" for k in range(400))
    rows = [(5, text), (3, text.upper()), (9, text + " x"), (7, ""), (8, None), (4, "other words here"), (None, text), (3, text.upper()), (None, "alone null key"), (None, "alone null key")]
    df = documents(rows)
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in S.near_duplicates(df).collect()}
    assert got[7, "0" * 16] == 7 == got[8, "0" * 16]
    assert {c for (k, _), c in got.items() if k in (3, 5, 9)} == {3}
    assert got[None, f"{brute_print(text):016x}"] == 3 and got[None, f"{brute_print('alone null key'):016x}"] is None
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in S.keep_one(df).collect())
    assert kept == [(False, 3), (False, 4), (False, 7), (True, 0)]
    assert S.keep_one(df.limit(0)).collect() == [] == S.near_duplicates(df.limit(0)).collect()


def test_one_row_of_a_component_without_keys_stays(documents):
    text = " ".join(f"other{k}" for k in range(400))
    near = next(x for x in (text + f" x{k} y{k} z{k}" for k in range(100)) if 0 < (brute_print(text) ^ brute_print(x)).bit_count() <= 3)
    assert 0 < (brute_print(text) ^ brute_print(near)).bit_count() <= 3
    kept = S.keep_one(documents([(None, text), (None, near), (None, near), (None, "alone")])).collect()
    assert len(kept) == 2 and sum(r["text"] == "alone" for r in kept) == 1


def test_clashing_columns_stay(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "r"), (2, "a b c", 6, "s")], "doc_id long, text string, fingerprint int, row string")
    assert [r.asDict() for r in S.keep_one(df).collect()] == [{"doc_id": 1, "text": "a b c", "fingerprint": 5, "row": "r"}]
