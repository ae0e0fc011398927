import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import table
from riskloom.functions import scalars as S
from riskloom.operators import encodings
from riskloom.plans import features
from test_history import SCHEMA, five


def test_frequency_uses_the_fitting_rows(spark):
    train = spark.createDataFrame([(1, "X"), (2, "X"), (3, "Y"), (4, None)], "transaction_id long, card1 string")
    out, counts = encodings.add_frequency(train, keys=["card1"])
    assert {r["transaction_id"]: r["card1_freq"] for r in out.collect()} == {1: 2, 2: 2, 3: 1, 4: 0}
    later = spark.createDataFrame([(5, "X"), (6, "Z"), (7, None)], "transaction_id long, card1 string")
    mapped = table(encodings.map_frequency(later, counts, keys=["card1"]), "transaction_id")
    assert [mapped[i]["card1_freq"] for i in (5, 6, 7)] == [2, 0, 0]


def test_calendar(spark):
    out = encodings.add_calendar(spark.createDataFrame([(0,), (86400,)], "transaction_dt long")).collect()
    assert [(r["DT_M"], r["hour"]) for r in out] == [(11, 0), (12, 0)]
    # 2017-11-30 was a Thursday of ISO week 48.
    assert (out[0]["day_of_week"], out[0]["is_weekend"], out[0]["DT_W"], out[0]["DT_D"]) == (3, 0, 48, 30)


def test_weekend_and_event_time(spark):
    df = spark.createDataFrame([(2 * 86400 + 3661,)], "transaction_dt long")
    row = encodings.add_calendar(df).first()
    assert (row["day_of_week"], row["is_weekend"], row["hour"]) == (5, 1, 1)
    at = df.select(S.event_time(F.col("transaction_dt"), "2017-11-30")).first()[0]
    assert at == datetime(2017, 12, 2, 1, 1, 1)


def test_identity_parsing(spark):
    df = spark.createDataFrame(
        [("iOS 11.1", "Chrome Mobile 71.0", 1), ("Windows 10", "Samsung Browser 6.4", None)],
        "id_30 string, id_31 string, id_12 int",
    )
    out = encodings.add_identity(df).collect()
    assert [r["os_family"] for r in out] == ["iOS", "Windows"]
    assert [r["browser_family"] for r in out] == ["Chrome", "Samsung"]
    assert [r["n_identity_present"] for r in out] == [3, 2]


def test_identity_columns_that_are_not_there(spark):
    df = spark.createDataFrame([(1,)], "transaction_id long")
    assert encodings.add_identity(df).columns == ["transaction_id"]
    odd = spark.createDataFrame([("10 Windows", " "), (None, None)], "id_30 string, id_31 string")
    assert [tuple(r)[2:] for r in encodings.add_identity(odd).collect()] == [
        (2, None, None), (0, None, None),
    ]


def test_amounts(spark):
    df = spark.createDataFrame([(250.75,), (-3.0,), (None,)], "transaction_amt double")
    rows = encodings.add_amount(df).collect()
    assert rows[0]["transaction_amt_cents"] == pytest.approx(75.0)
    assert rows[0]["transaction_amt_log"] == pytest.approx(math.log1p(250.75))
    assert rows[1]["transaction_amt_log"] == 0.0
    assert rows[2]["transaction_amt_log"] is None and rows[2]["transaction_amt_cents"] is None


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(S.safe_divide(F.col("a"), F.col("b"))).collect()] == [0.5, None, None]


def one_card(spark):
    rows = [(1, 1, 1.0, 0), (2, 2, 2.0, 1), (3, 10, 3.0, 1), (4, 20, 4.0, 0)]
    return spark.createDataFrame([(*r, "A", "1", "a", "x") for r in rows], SCHEMA)


def test_temporal_splits_see_only_earlier_periods(spark):
    out = table(features.build_temporal_splits(one_card(spark), 5, 15), "transaction_id")
    assert [out[i]["split"] for i in (1, 2, 3, 4)] == ["train", "train", "validation", "holdout"]
    assert out[1]["card1_hist_fraud_rate"] is None and out[2]["card1_hist_fraud_rate"] == 0.0
    assert out[3]["card1_hist_fraud_rate"] == pytest.approx(0.5)
    assert out[4]["card1_hist_fraud_rate"] == pytest.approx(2 / 3)
    # Counts of the whole fitting period, the row's own included on train.
    assert [out[i]["card1_freq"] for i in (1, 2, 3, 4)] == [2, 2, 2, 3]
    assert [out[i]["card1_hist_count"] for i in (1, 2, 3, 4)] == [0, 1, 2, 3]


def test_train_and_test_features_share_their_columns(spark, tmp_path):
    train, artifacts = features.build_train_features(five(spark))
    later = spark.createDataFrame([(9, 100, 1.0, "A", "1", "a", "x"), (10, 101, 1.0, None, "9", None, None)],
                                  SCHEMA.replace(" is_fraud int,", ""))
    artifacts.save(str(tmp_path / "artifacts"))
    artifacts = features.FeatureArtifacts.load(spark, str(tmp_path / "artifacts"))
    out = table(features.build_test_features(later, artifacts), "transaction_id")
    assert set(train.columns) - set(out[9]) == {"is_fraud"}
    assert out[9]["card1_hist_fraud_rate"] == pytest.approx(1 / 3)
    assert (out[9]["card1_freq"], out[9]["device_info_freq"]) == (3, 3)
    assert (out[10]["card1_freq"], out[10]["card1_hist_count"], out[10]["addr1_freq"]) == (0, 0, 0)


def test_missing_keys_have_history_but_no_frequency(spark):
    df = five(spark).withColumn("card1", F.lit(None).cast("string"))
    out, artifacts = features.build_train_features(df)
    rows = table(out, "transaction_id")
    assert [rows[i]["card1_hist_count"] for i in range(1, 6)] == [0, 1, 2, 3, 4]
    assert {r["card1_freq"] for r in rows.values()} == {0}
    assert artifacts.frequency.where("key_type = 'card1'").count() == 0
    assert artifacts.entity.where("key_type = 'card1'").first()["cnt"] == 5


def test_features_are_built_again_over_themselves(spark):
    once, _ = features.build_train_features(five(spark))
    twice, _ = features.build_train_features(once)
    assert sorted(once.columns) == sorted(twice.columns)


def test_no_task_holds_all_rows(spark, sf_dir):
    """Row-level data never meets a single-partition exchange."""
    from riskloom.operators import history
    from riskloom.sources import testbed

    plan = history.history_long(testbed.transactions(spark, sf_dir), testbed.COLS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "Python" not in text


def test_period_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    from riskloom.operators import splitting
    from riskloom.sources import testbed

    path = str(tmp_path / "txn")
    testbed.transactions(spark, sf_dir).write.parquet(path)
    df = splitting.period_filter(spark.read.parquet(path), 1000.5, 9000.0).select("transaction_amt")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(transaction_dt,1000)" in text and "LessThanOrEqual(transaction_dt,9000)" in text
    assert "ReadSchema: struct<transaction_dt:bigint,transaction_amt:double>" in text


def test_repeated_and_missing_ids_get_their_own_values(spark):
    """Frozen mappings come back row by row, whatever the ids are."""
    from riskloom.operators import encodings, history

    schema = "transaction_id long, transaction_dt long, transaction_amt double, is_fraud int, card1 string"
    past = spark.createDataFrame([(1, 1, 2.0, 1, "A"), (2, 2, 4.0, 0, "A"), (3, 3, 6.0, 0, "C")], schema)
    later = spark.createDataFrame([(7, 4, 1.0, 0, "A"), (7, 5, 1.0, 0, "B"), (None, 6, 1.0, 0, "C"), (None, 7, 1.0, 0, None)], schema)
    out = history.map_entity_history(later, history.entity_aggregates(past, keys=["card1"]), keys=["card1"])
    assert out.columns == [*later.columns, "card1_hist_count", "card1_hist_fraud_rate", "card1_hist_amt_mean"]
    got = {r["transaction_dt"]: tuple(r)[-3:] for r in out.collect()}
    assert got == {4: (2, 0.5, 3.0), 5: (0, None, None), 6: (1, 0.0, 6.0), 7: (0, None, None)}
    freq = encodings.map_frequency(later, encodings.frequency_counts(past, keys=["card1"]), keys=["card1"])
    assert {r["transaction_dt"]: r["card1_freq"] for r in freq.collect()} == {4: 2, 5: 0, 6: 1, 7: 0}
    assert freq.columns == [*later.columns, "card1_freq"]
