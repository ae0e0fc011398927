"""Leakage safety of entity history, and its independence from how the work is cut up."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import table
from riskloom.operators import dealing, history, prefix
from riskloom.operators.joining import lookup
from riskloom.schema import CARD_PAYMENTS, DEFAULT

SCHEMA = (
    "transaction_id long, transaction_dt long, transaction_amt double, is_fraud int,"
    " card1 string, addr1 string, p_emaildomain string, device_info string"
)


def five(spark):
    return spark.createDataFrame(
        [
            (1, 1, 10.0, 0, "A", "1", "a", "x"),
            (2, 2, 20.0, 1, "A", "1", "a", "x"),
            (3, 3, 30.0, 0, "A", "1", "a", "x"),
            (4, 10, 5.0, 0, "B", "2", "b", "y"),
            (5, 20, 7.0, 0, "B", "2", "b", "y"),
        ],
        SCHEMA,
    )


def skewed(spark, n=3000, seed=5):
    """A third of the rows on one card, and a third of those on one instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        at = 500_000 if hot and i % 9 == 0 else rng.randrange(0, 1_000_000, 50)
        card = "HOT" if hot else rng.choice([None, *(f"c{k}" for k in range(40))])
        amount = None if rng.random() < 0.05 else float(rng.randrange(1, 50_000)) / 100
        rows.append((i, at, amount, int(rng.random() < 0.2), card, str(i % 4), "m", "d"))
    return spark.createDataFrame(rows, SCHEMA)


def plain_window(df, key):
    """The textbook window, unsuited to hot keys but obviously right."""
    w = (
        Window.partitionBy(F.coalesce(key, F.lit("__MISSING__")))
        .orderBy("transaction_dt", "transaction_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    n = F.count(F.lit(1)).over(w)
    return df.select(
        "transaction_id",
        n.alias("n"),
        F.try_divide(F.sum("is_fraud").over(w).cast("double"), n).alias("rate"),
        F.try_divide(F.coalesce(F.sum("transaction_amt").over(w), F.lit(0.0)), n).alias("mean"),
    )


def test_current_row_is_left_out(spark):
    out = table(history.add_entity_history(five(spark), keys=["card1"]), "transaction_id")
    assert [out[i]["card1_hist_fraud_rate"] for i in (1, 2, 3)] == [None, 0.0, 0.5]
    assert [out[i]["card1_hist_count"] for i in (1, 2, 3, 4, 5)] == [0, 1, 2, 0, 1]
    assert [out[i]["card1_hist_amt_mean"] for i in (2, 3, 5)] == [10.0, 15.0, 5.0]


def test_frozen_mapping_for_later_rows(spark):
    fitted = history.entity_aggregates(five(spark), keys=["card1"])
    later = spark.createDataFrame([(9, "A"), (10, "Z"), (11, None)], "transaction_id long, card1 string")
    out = table(history.map_entity_history(later, fitted, keys=["card1"]), "transaction_id")
    assert out[9]["card1_hist_fraud_rate"] == pytest.approx(1 / 3)
    assert out[9]["card1_hist_count"] == 3
    assert (out[10]["card1_hist_count"], out[10]["card1_hist_fraud_rate"]) == (0, None)
    # No missing entity was seen while fitting either.
    assert out[11]["card1_hist_count"] == 0


def test_missing_key_is_an_entity(spark):
    df = five(spark).withColumn("card1", F.when(F.col("transaction_id") > 2, F.col("card1")))
    out = table(history.add_entity_history(df, keys=["card1"]), "transaction_id")
    assert [out[i]["card1_hist_count"] for i in (1, 2, 3, 4, 5)] == [0, 1, 0, 0, 1]


@pytest.mark.parametrize(
    "options",
    [
        {},
        # The hot card is cut only, then all cards are.
        {"cell_rows": 500},
        {"cell_rows": 60},
        # Every cell counts as crowded: cut by instant and by blocks of ids.
        {"cell_rows": 5},
    ],
)
def test_cutting_does_not_change_the_result(spark, options):
    df = skewed(spark)
    got = table(history.add_entity_history(df, keys=["card1"], **options), "transaction_id")
    want = table(plain_window(df, "card1"), "transaction_id")
    assert len(got) == len(want) == 3000
    for i, row in want.items():
        mine = got[i]
        assert mine["card1_hist_count"] == row["n"]
        assert mine["card1_hist_fraud_rate"] == row["rate"]
        if row["mean"] is None:
            assert mine["card1_hist_amt_mean"] is None
        else:
            assert mine["card1_hist_amt_mean"] == pytest.approx(row["mean"], rel=1e-9)


@pytest.mark.parametrize("cell_rows", [1_000_000, 50])
def test_strict_history_leaves_out_the_same_instant(spark, cell_rows):
    df = skewed(spark)
    w = (
        Window.partitionBy(F.coalesce("card1", F.lit("__MISSING__")))
        .orderBy("transaction_dt")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    want = table(df.select("transaction_id", F.count(F.lit(1)).over(w).alias("n")), "transaction_id")
    got = table(history.add_entity_history(df, keys=["card1"], strict=True, cell_rows=cell_rows), "transaction_id")
    assert {i: r["card1_hist_count"] for i, r in got.items()} == {i: r["n"] for i, r in want.items()}


def test_own_label_never_changes_own_history(spark):
    df = skewed(spark, 600)
    flipped = df.withColumn(
        "is_fraud", F.when(F.col("transaction_id") == 300, 1 - F.col("is_fraud")).otherwise(F.col("is_fraud"))
    )
    before = table(history.add_entity_history(df), "transaction_id")
    after = table(history.add_entity_history(flipped), "transaction_id")
    names = [c for c in before[300] if "_hist_" in c]
    assert {n: before[300][n] for n in names} == {n: after[300][n] for n in names}


def test_later_rows_never_change_earlier_history(spark):
    df = skewed(spark, 600)
    early = df.where("transaction_dt < 400000")
    whole = table(history.add_entity_history(df, strict=True), "transaction_id")
    for i, row in table(history.add_entity_history(early, strict=True), "transaction_id").items():
        assert row["card1_hist_count"] == whole[i]["card1_hist_count"]
        assert row["card1_hist_fraud_rate"] == whole[i]["card1_hist_fraud_rate"]


def test_rows_without_time_come_last(spark):
    df = five(spark).withColumn(
        "transaction_dt", F.when(F.col("transaction_id") != 1, F.col("transaction_dt"))
    )
    for options in ({}, {"cell_rows": 1}):
        out = table(history.add_entity_history(df, keys=["card1"], **options), "transaction_id")
        assert [out[i]["card1_hist_count"] for i in (2, 3, 1)] == [0, 1, 2]


@pytest.mark.parametrize("share", [1.0, 0.5])
def test_leakage_check_finds_no_mismatch(spark, share):
    """Rows without a time, an instant with many rows, and a card with a third of them."""
    df = skewed(spark).withColumn("transaction_dt", F.when(F.col("transaction_id") % 50 != 7, F.col("transaction_dt")))
    df = df.withColumn("transaction_id", F.when(F.col("transaction_id") != 11, F.col("transaction_id")))
    out = table(history.leakage_check(df, cell_rows=20, share=share), "key_type")
    assert all(r["mismatches"] == 0 for r in out.values())
    if share == 1.0:
        assert {r["n_rows"] for r in out.values()} == {3000} and len(out) == len(DEFAULT.history_keys)
    else:
        assert 0 < out["card1"]["n_rows"] < 3000


def test_leakage_check_counts_planted_leaks(spark):
    df = skewed(spark, 800)
    given = history.history_long(df)
    hit = lambda n: (F.col("key_type") == "card1") & (F.col("transaction_id") % n == 0)
    own = given.withColumn("cnt", F.when(hit(10), F.col("cnt") + 1).otherwise(F.col("cnt")))
    later = given.withColumn("fraud_rate", F.when(hit(40), F.coalesce("fraud_rate", F.lit(0.0)) + 0.001).otherwise(F.col("fraud_rate")))
    lost = given.where(~hit(20))
    for wrong, n in ((own, 80), (later, 20), (lost, 40), (given, 0)):
        out = table(history.leakage_check(df, history=wrong), "key_type")
        assert out["card1"]["mismatches"] == n and out["addr1"]["mismatches"] == 0, n


def test_interval_sums_are_those_of_all_earlier_rows(spark):
    rows = [(r["transaction_dt"], r["transaction_id"], r["card1"], r["transaction_amt"], r["is_fraud"]) for r in skewed(spark, 300).collect()]
    df = spark.createDataFrame(rows, "transaction_dt long, transaction_id long, card1 string, transaction_amt double, is_fraud int")
    got = history.recomputed_sums(history.measured(df, DEFAULT, ("card1",)), DEFAULT, ["key_type", "key"])
    for r in got.collect():
        before = [x for x in rows if (x[2] or "__MISSING__") == r["key"] and x[:2] < (r["transaction_dt"], r["transaction_id"])]
        assert (r["before_n"], r["before_y"]) == (len(before), sum(x[4] for x in before))
        assert r["before_amt"] == pytest.approx(sum(x[3] or 0 for x in before))



def test_interval_sums_make_few_rows(spark, monkeypatch):
    """Wide spans of times and ids: a row is stored and looked up a few times, not once a bit."""
    df = spark.range(600).select(
        F.lit("card1").alias("key_type"), F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        (F.col("id") % 7 * (1 << 40)).alias("transaction_dt"), F.col("id").alias("transaction_id"),
        F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("y"), F.col("id").cast("double").alias("amt"),
    )
    looked_up, whole = [], history.lookup

    def watched(probe, table, on):
        looked_up.append(probe.count())
        return whole(probe, table, on)

    monkeypatch.setattr(history, "lookup", watched)
    got = history.recomputed_sums(df, DEFAULT, ["key_type", "key"]).collect()
    rows = [(r["key"], r["transaction_dt"], r["transaction_id"], r["amt"]) for r in df.collect()]
    assert sum(looked_up) <= 8 * 400 and len(got) == 600
    for r in got:
        earlier = [x for x in rows if x[0] == r["key"] and x[1:3] < (r["transaction_dt"], r["transaction_id"])]
        assert (r["before_n"], r["before_y"], r["before_amt"]) == (len(earlier), len(earlier), sum(x[3] for x in earlier))


def test_aggregates_by_target(spark):
    df = five(spark).withColumn("split", F.when(F.col("transaction_id") < 3, "train").otherwise("validation"))
    feeds = {"train": ("validation", "holdout"), "validation": ("holdout",)}
    out = {
        (r["target"], r["key"]): (r["cnt"], r["fraud_rate"])
        for r in history.aggregates_by_target(df, "split", feeds, keys=["card1"]).collect()
    }
    assert out[("validation", "A")] == (2, 0.5)
    assert out[("holdout", "A")][0] == 3 and out[("holdout", "A")][1] == pytest.approx(1 / 3)
    assert ("validation", "B") not in out and out[("holdout", "B")][0] == 2


def test_feature_history_has_no_missing_entity(spark):
    df = five(spark).withColumn("card1", F.when(F.col("transaction_id") != 4, F.col("card1")))
    out = history.feature_history(df)
    assert out.where("key IS NULL OR key = '__MISSING__'").count() == 0
    assert table(out.where("key_type = 'card1'"), "key")["B"]["cnt"] == 1


@pytest.mark.parametrize("limits", [{}, {"max_broadcast_rows": 10, "heavy_key_rows": 200},
                                    {"max_broadcast_rows": 10, "heavy_key_rows": 10**9}])
def test_lookup_keeps_every_row_however_it_joins(spark, limits):
    probe = skewed(spark).select("transaction_id", F.lit("card1").alias("key_type"), F.col("card1").alias("key"))
    facts = probe.where("key IS NOT NULL AND key <> 'c7'").groupBy("key_type", "key").count()
    want = probe.join(facts, ["key_type", "key"], "left").select("transaction_id", "key", "count")
    got = lookup(probe, facts, ["key_type", "key"], **limits).select("transaction_id", "key", "count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()), key=lambda r: r[0])


def test_other_column_names(spark):
    df = five(spark).selectExpr(
        "transaction_id AS TransactionID", "transaction_dt AS TransactionDT", "transaction_amt AS TransactionAmt",
        "is_fraud AS isFraud", "card1", "addr1", "p_emaildomain AS P_emaildomain",
    )
    out = table(history.add_entity_history(df, CARD_PAYMENTS), "TransactionID")
    assert out[3]["P_emaildomain_hist_fraud_rate"] == 0.5
    assert DEFAULT.id != CARD_PAYMENTS.id


@pytest.mark.parametrize("cell_rows", [1_000_000, 2])
def test_null_text_and_scattered_ids_behave_alike_when_cut(spark, cell_rows):
    by, sums = ["k"], ["n"]
    rows = [("a", 5, None), ("a", 5, "x9"), ("a", None, "x1"), ("a", 1, "zz"), (None, 2, "p"), (None, 2, None), (None, 1, "q"), ("b", 1, "b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "k string, t long, id string, n long")
    got = sorted((str(r["k"]), str(r["t"]), str(r["id"]), r["before_n"]) for r in prefix.prior_sums_by_time(df, by, "t", "id", sums, cell_rows=cell_rows).collect())
    assert got == sorted([("a", "1", "zz", 0), ("a", "5", "None", 1), ("a", "5", "x9", 2), ("a", "None", "x1", 3), ("None", "1", "q", 0), ("None", "2", "None", 1), ("None", "2", "p", 2), ("b", "1", "b", 0)])
    strict = sorted((str(r["k"]), str(r["t"]), r["before_n"]) for r in prefix.prior_sums_strict(df, by, "t", sums, cell_rows=cell_rows).collect())
    assert strict == sorted([("a", "1", 0), ("a", "5", 1), ("a", "5", 1), ("a", "None", 3), ("None", "1", 0), ("None", "2", 1), ("None", "2", 1), ("b", "1", 0)])


@pytest.mark.parametrize("unit", [1, 1_000, 1_000_000])
@pytest.mark.parametrize("strict", [False, True])
def test_no_range_holds_a_large_group_whole(spark, monkeypatch, unit, strict):
    """Whatever the unit of time, and with all rows at one instant and scattered ids."""
    sizes = []
    whole = prefix._in_ranges

    def watched(*args):
        out = whole(*args)
        sizes.extend(r["count"] for r in out.groupBy("_cell").count().collect())
        return out

    monkeypatch.setattr(prefix, "_in_ranges", watched)
    instant = F.lit(7) if not strict else F.col("id") * unit
    df = spark.range(8000).select(F.lit("k").alias("k"), instant.cast("long").alias("t"), F.xxhash64("id").alias("id"), F.lit(1).cast("long").alias("n"))
    out = prefix.prior_sums_strict(df, ["k"], "t", ["n"], cell_rows=500) if strict else prefix.prior_sums_by_time(df, ["k"], "t", "id", ["n"], cell_rows=500)
    assert sorted(r["before_n"] for r in out.collect()) == list(range(8000))
    assert len(sizes) >= 12 and max(sizes) < 1500


def test_small_ranges_make_no_small_tasks(spark):
    """Eight hundred ranges of ten rows come out of the session's few tasks."""
    df = spark.range(8000).select(F.lit("k").alias("k"), F.col("id").alias("t"))
    cut = prefix._in_ranges(df, ["k"], [F.col("t").asc()], 8000, 10)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [r["count"] for r in cut.groupBy("_cell").count().collect()]
    assert len(cut.inputFiles()) <= tasks and len(sizes) >= 800 and max(sizes) <= 10
    # Ranges follow the order.
    ends = cut.groupBy("_cell").agg(F.min("t").alias("a"), F.max("t").alias("b")).orderBy("_cell").collect()
    assert all(x["b"] < y["a"] for x, y in zip(ends, ends[1:]))


def test_strict_needs_whole_times(spark):
    df = spark.createDataFrame([("a", 1.5, 1)], "k string, t double, n long")
    with pytest.raises(TypeError, match="whole numbers"):
        prefix.prior_sums_strict(df, ["k"], "t", ["n"])


def test_a_second_row_with_an_id_is_an_error(spark):
    df = five(spark)
    with pytest.raises(ValueError, match="duplicate"):
        history.add_entity_history(df.unionByName(df.limit(1)))


@pytest.mark.parametrize("strict", [False, True])
def test_many_rows_go_to_more_tasks(spark, monkeypatch, strict):
    """Tasks get a bounded number of rows, with the same histories; before, all went to the session's 4 partitions."""
    df = skewed(spark)
    expected = table(history.add_entity_history(df, DEFAULT, ("card1",), strict=strict), "transaction_id")
    monkeypatch.setattr(dealing, "DEALT_ROWS", 100)
    light, heavy, n = prefix.split_heavy(history.measured(df, DEFAULT, ("card1",)), ["key_type", "key"], 500)
    assert n == 1000 and heavy.count() == 1000
    assert light.rdd.getNumPartitions() == 20
    long = history.history_long(df, DEFAULT, ("card1",), strict=strict)
    assert history.spread_history(long, DEFAULT, ("card1",), 3000).rdd.getNumPartitions() == 30
    for most, limit in ((0, 500), (1000, 100)):
        monkeypatch.setattr(prefix, "MAX_BROADCAST_CELLS", most)
        got = table(history.add_entity_history(df, DEFAULT, ("card1",), strict=strict, cell_rows=limit), "transaction_id")
        assert got.keys() == expected.keys()
        for i, row in got.items():
            for c, v in row.items():
                assert v == expected[i][c] or v == pytest.approx(expected[i][c], rel=1e-9)


def test_null_groups_stay_one_group_however_they_are_dealt(spark, monkeypatch):
    rows = spark.createDataFrame([(k % 2 or None, k // 20, k, 1) for k in range(400)], "k int, t long, i long, n long")
    expected = sorted(map(tuple, prefix.prior_sums_strict(rows, ["k"], "t", ["n"]).select("i", "before_n").collect()))
    assert expected[:2] == [(0, 0), (1, 0)] and expected[-1] == (399, 190)
    monkeypatch.setattr(dealing, "DEALT_ROWS", 5)
    monkeypatch.setattr(prefix, "MAX_BROADCAST_CELLS", 30)
    got = prefix.prior_sums_strict(rows, ["k"], "t", ["n"], cell_rows=50)
    assert sorted(map(tuple, got.select("i", "before_n").collect())) == expected
    values = rows.groupBy("k", "t").agg(F.sum("n").alias("n"))
    whole, cut = (prefix.prior_sums_by_value(values, ["k"], "t", ["n"], cell_rows=m, with_next=True) for m in (1000, 5))
    assert sorted(map(str, cut.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_lookup_deals_a_long_probe(spark, monkeypatch):
    probe = spark.range(2000).select("id", (F.col("id") % 300).alias("key"))
    facts = spark.range(250).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    monkeypatch.setattr(dealing, "DEALT_ROWS", 100)
    got = lookup(probe, facts, ["key"], max_broadcast_rows=10)
    assert got.count() == 2000 and got.where("twice = 2 * key").count() == sum(k % 300 < 250 for k in range(2000))
    assert got.rdd.getNumPartitions() >= 20
