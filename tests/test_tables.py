"""Ingestion, validation, splitting and table helpers."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import table
from riskloom.operators import joining, splitting, validation
from riskloom.schema import CARD_PAYMENTS
from riskloom.sources import tables


def txn(spark, n=5):
    rows = [(i, 3600 * i + 7, 2.5 + i, int(i % 3 == 0)) for i in range(1, n + 1)]
    return spark.createDataFrame(
        rows, "transaction_id long, transaction_dt long, transaction_amt double, is_fraud int"
    )


def idn(spark):
    return spark.createDataFrame(
        [(2, "tablet", 70), (4, "phone", 80)], "transaction_id long, device_type string, id_05 int"
    )


def test_identity_join_keeps_all_transactions(spark):
    out = table(joining.join_identity(txn(spark), idn(spark)), "transaction_id")
    assert len(out) == 5 and out[1]["device_type"] is None and out[4]["id_05"] == 80 and out[2]["device_type"] == "tablet"


def test_identity_may_be_absent(spark):
    assert joining.join_identity(txn(spark), None).columns == txn(spark).columns
    assert joining.join_identity(txn(spark), idn(spark).limit(0)).columns == txn(spark).columns


def test_identity_join_errors(spark):
    with pytest.raises(ValueError, match="duplicate"):
        joining.join_identity(txn(spark).union(txn(spark)), idn(spark))
    with pytest.raises(ValueError, match="duplicate"):
        joining.join_identity(txn(spark), idn(spark).union(idn(spark)))
    assert joining.join_identity(txn(spark), idn(spark).union(idn(spark)), verify=False).count() == 7
    with pytest.raises(ValueError, match="transactions have no column"):
        joining.join_identity(txn(spark).drop("transaction_id"), idn(spark))
    with pytest.raises(ValueError, match="identity has no column"):
        joining.join_identity(txn(spark), idn(spark).drop("transaction_id"))


def test_ingest_round_trip(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "train_transaction.csv").write_text(
        # The public layout: another order than the schema's, and columns that it doesn't know.
        "TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD,card1,addr1,P_emaildomain,V1,M4\n"
        "1,0,86400,10.5,W,A,1,x.com,0.5,T\n2,1,86401,20.0,C,,2,,,\n3,0,never,1.0,W,B,1,x.com,1,F\n"
    )
    (raw / "train_identity.csv").write_text(
        'TransactionID,DeviceType,DeviceInfo,id_01,id_30,id_31\n1,mobile,"{""k"": ""v, w""}",-5.0,iOS 11,Chrome 7\n'
    )
    out, path = tables.ingest_split(spark, "train", str(raw), str(tmp_path / "interim"), CARD_PAYMENTS)
    rows = table(out, "TransactionID")
    assert rows[1]["DeviceInfo"] == '{"k": "v, w"}' and rows[2]["DeviceType"] is None
    assert rows[2]["card1"] is None and spark.read.parquet(path).count() == 2
    assert (rows[1]["TransactionDT"], rows[1]["TransactionAmt"], rows[1]["isFraud"], rows[1]["card1"]) == (86400, 10.5, 0, "A")
    assert (rows[1]["V1"], rows[2]["V1"], rows[1]["M4"], rows[2]["ProductCD"]) == (0.5, None, "T", "C")
    left = spark.read.parquet(str(tmp_path / "interim" / "train_transaction_rejects")).collect()
    assert [r["_rejected_line"] for r in left] == ["3,0,never,1.0,W,B,1,x.com,1,F"]
    with pytest.raises(FileNotFoundError):
        tables.ingest_split(spark, "test", str(raw), str(tmp_path / "interim"), CARD_PAYMENTS)


def test_ingest_without_identity_file(spark, tmp_path):
    (tmp_path / "test_transaction.csv").write_text(
        "card1,TransactionID,TransactionDT,TransactionAmt,addr1,P_emaildomain\nA,1,5,1.0,1,x\n"
    )
    out, _ = tables.ingest_split(spark, "test", str(tmp_path), str(tmp_path / "interim"), CARD_PAYMENTS)
    assert out.count() == 1 and not {"DeviceType", "isFraud"} & set(out.columns) and out.first()["TransactionDT"] == 5
    (tmp_path / "late_transaction.csv").write_text("TransactionID,TransactionDT\n1,5\n")
    with pytest.raises(ValueError, match="TransactionAmt"):
        tables.ingest_split(spark, "late", str(tmp_path), str(tmp_path / "interim"), CARD_PAYMENTS)


def test_a_row_that_does_not_fit_is_an_error_without_rejects(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\nx,3\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.scan_csv(spark, str(tmp_path / "x.csv"), schema).collect()


def test_keys_have_one_form(spark):
    df = spark.createDataFrame([(315.0, "315.0", 315, 2.5, float("nan")), (None, "a.0", -4, -7.0, 1e300)], "d double, s string, i int, f double, x double")
    rows = df.select(*[joining.key_text(df, c).alias(c) for c in df.columns]).collect()
    assert tuple(rows[0])[:4] == ("315", "315", "315", "2.5") and tuple(rows[1])[:4] == (None, "a.0", "-4", "-7")
    history = spark.createDataFrame([("card1", "315", 0.25, 8.0, 4)], "key_type string, key string, fraud_rate double, amt_mean double, cnt long")
    got = joining.lookup_feature_history(df, history, "card1", "d").collect()
    assert {r["d"]: r["card1_hist_count"] for r in got} == {315.0: 4, None: None}


def test_json_report(spark, tmp_path):
    report = splitting.split_manifest(txn(spark, 10), 0.6, 0.3)
    path = tables.sink_json_report(report, str(tmp_path / "manifest"))
    files = [f for f in (tmp_path / "manifest").iterdir() if f.name.startswith("part-")]
    lines = [json.loads(line) for line in files[0].read_text().splitlines()]
    assert len(files) == 1 and {"section": "split", "name": "train_frac", "value": "0.6"} in lines
    assert spark.read.json(path).count() == len(lines)


def test_bucketed_table_is_joined_in_place(spark, tmp_path):
    wide = tables.sink_bucketed(txn(spark, 200), "wide_rows", "transaction_id", 4, str(tmp_path / "wide"))
    narrow = txn(spark, 200).groupBy("transaction_id").agg(F.sum("is_fraud").alias("y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = wide.join(narrow, "transaction_id", "left")
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The one exchange belongs to the narrow side.
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1
    assert joined.count() == 200


def test_align_columns(spark):
    df = spark.createDataFrame([(1, 2.5, None), (2, float("nan"), 7)], "id int, a double, b int")
    out = tables.align_columns(df, ["b", "gone", "a"], ["id"]).collect()
    assert [tuple(r) for r in out] == [(1, 0.0, 0.0, 2.5), (2, 7.0, 0.0, 0.0)]


def test_sample_is_seeded_and_clean(spark):
    df = txn(spark, 50).withColumn("x", F.when(F.col("transaction_id") > 25, float("inf"))).withColumn("s", F.lit("t"))
    one = [r[0] for r in tables.sample_rows(df, 10, 7, "transaction_id").collect()]
    assert one == [r[0] for r in tables.sample_rows(df, 10, 7, "transaction_id").collect()]
    assert len(set(one)) == 10 and one != [r[0] for r in tables.sample_rows(df, 10, 8, "transaction_id").collect()]
    clean = tables.sample_rows(df, 100, 7, "transaction_id", clean=True)
    assert "s" not in clean.columns and {r["x"] for r in clean.collect()} == {0.0} and clean.count() == 50


def test_topk_scores(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([0.1, 0.9, 0.9, 0.5])], "id int, score double")
    out = {(r["extreme"], r["place"]): r["id"] for r in tables.topk_scores(df, "score", "id", 2).collect()}
    assert out == {("highest", 1): 1, ("highest", 2): 2, ("lowest", 1): 0, ("lowest", 2): 3}


def test_union_fills_absent_columns(spark):
    out = tables.union_rows(txn(spark, 1), idn(spark).limit(1))
    assert out.count() == 2 and "device_type" in out.columns


# --- validation ------------------------------------------------------------------------------


def joined(spark):
    rows = [(1, 0, 5.0, 0, "mobile"), (2, 10, 6.0, 1, "desktop"), (3, 20, 7.0, 0, None)]
    return spark.createDataFrame(
        rows,
        "transaction_id long, transaction_dt long, transaction_amt double, is_fraud int, device_type string",
    )


def findings(df, stage="train"):
    return table(validation.validation_report(df, stage), "check_name")


def test_valid_train(spark):
    rep = findings(joined(spark))
    assert {r["status"] for r in rep.values()} == {"pass"}
    assert rep["fraud_rate"]["value"] == pytest.approx(1 / 3, abs=1e-6)
    assert rep["identity_coverage"]["value"] == pytest.approx(2 / 3, abs=1e-4)
    assert (rep["rows"]["value"], rep["n_columns"]["value"], rep["n_positives"]["value"]) == (3, 5, 1)
    validation.raise_on_errors(validation.validation_report(joined(spark), "train"))


def test_valid_test_stage_needs_no_label(spark):
    rep = findings(joined(spark).drop("is_fraud"), "test")
    assert {r["status"] for r in rep.values()} == {"pass"} and "fraud_rate" not in rep


@pytest.mark.parametrize(
    ("change", "check"),
    [
        (lambda d: d.union(d.limit(1)), "unique_key"),
        (lambda d: d.withColumn("transaction_id", F.when(F.col("transaction_id") > 2, 1)), "unique_key"),
        (lambda d: d.withColumn("transaction_dt", F.col("transaction_dt") - 1), "time_range"),
        (lambda d: d.withColumn("transaction_amt", F.col("transaction_amt") - 5), "amount_positive"),
        (lambda d: d.withColumn("is_fraud", F.col("is_fraud") * 2), "label_domain"),
        (lambda d: d.withColumn("is_fraud", F.when(F.col("is_fraud") == 1, 1)), "label_domain"),
        (lambda d: d.drop("transaction_amt"), "required_columns"),
    ],
)
def test_each_hard_error(spark, change, check):
    report = validation.validation_report(change(joined(spark)), "train")
    failed = {r["check_name"] for r in report.where("status = 'fail'").collect()}
    assert failed == {check}
    with pytest.raises(validation.ValidationError, match=check):
        validation.raise_on_errors(report)


def test_missing_label_is_reported_twice(spark):
    rep = findings(joined(spark).drop("is_fraud"))
    assert rep["required_columns"]["status"] == rep["label_present"]["status"] == "fail"


def test_null_amounts_pass_and_low_coverage_warns(spark):
    df = joined(spark).withColumns(
        {"transaction_amt": F.lit(None).cast("double"), "device_type": F.lit(None).cast("string")}
    )
    rep = findings(df)
    assert rep["amount_positive"]["status"] == "pass"
    low = rep["identity_coverage_low"]
    assert (low["severity"], low["status"]) == ("warning", "fail")
    validation.raise_on_errors(validation.validation_report(df, "train"))


def test_two_null_ids_are_duplicates(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "transaction_id long")
    assert tuple(validation.duplicate_keys(df).first()) == (1, 2)


def test_unknown_stage(spark):
    with pytest.raises(ValueError, match="unknown stage"):
        validation.validation_report(joined(spark), "other")


# --- time split ------------------------------------------------------------------------------


def test_split_counts(spark):
    df = spark.createDataFrame(
        [(i, 10 * i, i % 2) for i in range(10)], "transaction_id long, transaction_dt long, is_fraud int"
    )
    t1, t2 = splitting.boundary_values(splitting.split_boundaries(df, 0.6, 0.3))
    assert (t1, t2) == (54.0, 81.0)
    summary = table(splitting.split_summary(df, t1, t2), "split")
    assert [summary[s]["rows"] for s in ("train", "validation", "holdout")] == [6, 3, 1]
    assert summary["holdout"]["fraud_rate"] == 1.0


def test_empty_split_is_listed(spark):
    df = spark.createDataFrame([(1, 5, 1)], "transaction_id long, transaction_dt long, is_fraud int")
    row = table(splitting.split_summary(df, 10.0, 20.0), "split")["holdout"]
    assert (row["rows"], row["fraud_rate"], row["n_positives"], row["date_min"]) == (0, None, 0, None)


def test_edges_are_right_closed_and_null_stays_null(spark):
    df = spark.createDataFrame([(5,), (6,), (7,), (8,), (None,)], "transaction_dt long")
    assert [r["split"] for r in splitting.assign_split(df, 5.0, 7.0).collect()] == [
        "train", "validation", "validation", "holdout", None,
    ]


def test_bad_fractions(spark):
    for train, val in ((0, 0.5), (0.5, 0), (0.7, 0.3)):
        with pytest.raises(ValueError):
            splitting.split_boundaries(txn(spark), train, val)


@pytest.mark.parametrize("options", [{}, {"cell_rows": 20}])
def test_quantiles_equal_numpy(spark, options):
    import numpy as np

    from riskloom.operators.prefix import exact_quantiles

    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(400, 7.25), rng.exponential(10, 800)]).round(3)
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(values)], "g int, v double")
    got = exact_quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.95}, ["g"], **options).collect()
    for r in got:
        want = np.quantile(values[r["g"] :: 2], [0.1, 0.5, 0.95])
        assert [r["a"], r["b"], r["c"]] == pytest.approx(list(want), abs=1e-6)


# --- shared folder ---------------------------------------------------------------------------


class _Session:
    """As much of a session as the working folder looks at."""

    def __init__(self, master, setting=None, set_dir=None):
        self.master, self.setting, self.set_dir = master, setting, set_dir
        self.conf = self.sparkContext = self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.set_dir


def test_working_folder_follows_the_session():
    from riskloom.session import working_dir

    assert working_dir(_Session("spark://host", "hdfs://shared/"), "x").startswith("hdfs://shared/riskloom/x-")
    assert working_dir(_Session("yarn", set_dir="hdfs://other/c"), "x").startswith("hdfs://other/c/riskloom/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        working_dir(_Session("yarn"), "x")
