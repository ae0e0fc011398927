"""Ranking metrics, thresholds, slices and the gate."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import table
from riskloom.operators import monitoring, ranking, selection
from riskloom.operators.selection import GateConfig


def scored(spark, y, s):
    return spark.createDataFrame(list(zip(y, s, strict=True)), "label int, score double")


def brute_ap(y, s):
    total, ap, seen = sum(y), 0.0, 0
    for t in sorted(set(s), reverse=True):
        flagged = [a for a, b in zip(y, s, strict=True) if b >= t]
        ap += (sum(flagged) - seen) / total * sum(flagged) / len(flagged)
        seen = sum(flagged)
    return ap


def brute_auc(y, s):
    pos = [b for a, b in zip(y, s, strict=True) if a]
    neg = [b for a, b in zip(y, s, strict=True) if not a]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


def test_average_precision_is_the_step_sum(spark):
    df = scored(spark, [0, 0, 1, 0, 0], [0.2, 0.8, 0.7, 0.3, 0.4])
    assert ranking.pr_auc(df).first()[0] == pytest.approx(0.5)


@pytest.mark.parametrize("by", [(), ("model",)])
@pytest.mark.parametrize("options", [{}, {"cell_rows": 10}])
@pytest.mark.parametrize("kind", ["ties", "one_hot_score", "near_zero"])
def test_metrics_equal_brute_force(spark, kind, options, by):
    rng = random.Random(11)
    y = [int(rng.random() < 0.15) for _ in range(900)]
    s = {
        "ties": lambda: rng.randrange(20) / 20,
        "one_hot_score": lambda: 0.25 if rng.random() < 0.4 else rng.random(),
        "near_zero": lambda: rng.random() ** 12,
    }[kind]
    s = [s() for _ in y]
    small = spark.createDataFrame([(1, 0.5), (0, 0.4)], "label int, score double").withColumn("model", F.lit("small"))
    df = scored(spark, y, s).withColumn("model", F.lit("large"))
    if by:
        # A large and a small group side by side, treated differently.
        rows = table(ranking.evaluate(df.unionByName(small), by, **options), "model")
        assert rows["small"]["roc_auc"] == 1.0
        row = rows["large"]
    else:
        row = ranking.evaluate(df, **options).first()
    assert row["pr_auc"] == pytest.approx(brute_ap(y, s))
    assert row["roc_auc"] == pytest.approx(brute_auc(y, s))
    assert (row["n"], row["positives"]) == (900, sum(y))


def test_undefined_areas_are_null(spark):
    row = ranking.evaluate(scored(spark, [0, 0], [0.1, 0.2])).first()
    assert row["pr_auc"] is None and row["roc_auc"] is None
    assert ranking.evaluate(scored(spark, [1, 1], [0.1, 0.2])).first()["roc_auc"] is None


def test_perfect_threshold(spark):
    row = ranking.threshold_by_f1(scored(spark, [1, 0, 1, 0, 1], [0.66, 0.31, 0.95, 0.12, 0.73])).first()
    assert row["threshold"] == 0.66
    assert [row[c] for c in ("precision", "recall", "f1")] == pytest.approx([1, 1, 1])


def test_lowest_threshold_wins_ties_and_no_positives_gives_default(spark):
    # F1 is 2/3 at 0.88 (1 of 2 found, no false alarm) and at 0.27 (2 found, 2 false alarms).
    row = ranking.threshold_by_f1(scored(spark, [0, 1, 1, 0], [0.61, 0.27, 0.88, 0.45])).first()
    assert row["threshold"] == 0.27
    none = ranking.threshold_by_f1(scored(spark, [0, 0, 0], [0.77, 0.33, 0.05])).first()
    assert tuple(none) == (0.5, 0.0, 0.0, 0.0)


def test_counts_at_threshold(spark):
    row = ranking.evaluate_at_threshold(scored(spark, [1, 1, 0, 0, 1, 0, 0, 0], [0.7, 0.4, 0.6, 0.2, 0.9, 0.1, 0.3, 0.59]), 0.6).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"], row["alert_rate"]) == (2, 1, 1, 4, 0.375)
    nothing = ranking.evaluate_at_threshold(scored(spark, [1, 0, 0], [0.3, 0.44, 0.2]), 0.45).first()
    assert (nothing["precision"], nothing["recall"], nothing["f1"]) == (0.0, 0.0, 0.0)


def sliced(spark):
    # "full": 3 positives, precision 1, 2/3, 3/5 where they are found. "single": one positive, on top. "none": no positive.
    rows = [("full", 1, 0.92), ("full", 0, 0.81), ("full", 1, 0.64), ("full", 0, 0.5), ("full", 1, 0.37), ("full", 0, 0.11)]
    rows += [("single", 1, 0.58), ("single", 0, 0.22), ("none", 0, 0.74), ("none", 0, 0.3), ("none", 0, 0.29)]
    return spark.createDataFrame(rows, "slice string, label int, score double")


def test_slice_checks(spark):
    cfg = GateConfig(slice_min_positives=3, slice_pr_auc_floor=0.6)
    out = table(selection.slice_checks(sliced(spark), cfg, ["full", "single", "none", "absent"]), "slice")
    assert out["full"]["status"] == "pass" and (out["full"]["n"], out["full"]["positives"]) == (6, 3)
    assert {out[s]["status"] for s in ("single", "none", "absent")} == {"insufficient_data"}
    assert out["single"]["pr_auc"] is None and (out["absent"]["n"], out["absent"]["positives"]) == (0, 0)


def test_slice_below_the_floor_fails(spark):
    cfg = GateConfig(slice_min_positives=1, slice_pr_auc_floor=0.8)
    out = table(selection.slice_checks(sliced(spark), cfg, ["single", "full"]), "slice")
    # Average precision of "full" is (1 + 2/3 + 3/5) / 3 = 0.7556.
    assert (out["single"]["status"], out["full"]["status"]) == ("pass", "fail")
    assert out["full"]["pr_auc"] == pytest.approx((1 + 2 / 3 + 3 / 5) / 3)


@pytest.mark.parametrize(
    ("cand", "base", "precision", "recall", "slice_status", "want"),
    [
        (0.5, 0.2, 0.3, 0.4, "pass", (True, True, True)),
        (0.5, 0.2, 0.05, 0.4, "pass", (True, False, True)),
        (0.5, 0.2, 0.3, 0.1, "pass", (True, False, True)),
        (0.1, 0.2, 0.3, 0.4, "pass", (False, True, True)),
        (0.2, 0.2, 0.3, 0.4, "pass", (False, True, True)),
        (0.5, 0.2, 0.3, 0.4, "fail", (True, True, False)),
    ],
)
def test_gate(spark, cand, base, precision, recall, slice_status, want):
    metrics = spark.createDataFrame(
        [("candidate", "holdout", cand), ("baseline", "holdout", base), ("baseline", "train", 0.99)],
        "model string, split string, pr_auc double",
    )
    operating = spark.createDataFrame([(precision, recall)], "precision double, recall double")
    slices = spark.createDataFrame([("s1", slice_status), ("s2", "insufficient_data")], "slice string, status string")
    row = selection.promotion_gate(metrics, operating, slices).first()
    assert (row["g1_beat_baseline"], row["g2_precision_recall"], row["g3_slices"]) == want
    assert row["promoted"] == all(want)
    assert row["failed_slices"] == (["s1"] if slice_status == "fail" else [])


def test_equal_quartile_edges_leave_a_bin_empty(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 1, 9, 9, 10]], "transaction_amt double")
    out = [r["amt_quartile"] for r in selection.amount_quartiles(df).orderBy("transaction_amt").collect()]
    assert out == ["q1"] * 5 + ["q3"] * 2 + ["q4"]


def test_compare_models(spark):
    metrics = spark.createDataFrame(
        [("candidate", "holdout", 0.5, 0.9), ("baseline", "holdout", 0.4, 0.95)],
        "model string, split string, pr_auc double, roc_auc double",
    )
    row = selection.compare_models(metrics).first()
    assert row["pr_auc_delta"] == pytest.approx(0.1) and row["roc_auc_delta"] == pytest.approx(-0.05)
    assert row["candidate_beats_baseline"] is True


def test_monitoring_counters(spark):
    df = scored(spark, [0, 1, 1], [0.05, 0.3, 1.0]).withColumn("decision", F.lit("allow"))
    assert monitoring.decision_counts(df).first()["n"] == 3
    grid = {r["le"]: r["n"] for r in monitoring.score_histogram(df).collect()}
    assert (grid[0.0], grid[0.1], grid[0.3], grid[1.0], grid[float("inf")]) == (0, 1, 2, 3, 3)


def test_scored_rows_are_read_once(spark, tmp_path):
    path = str(tmp_path / "scored")
    scored(spark, [0, 1] * 50, [i / 100 for i in range(100)]).write.parquet(path)
    out = ranking.evaluate(spark.read.parquet(path).withColumn("split", F.lit("x")), ["split"])
    # Only the stored (split, score) counts are left to read.
    text = out._jdf.queryExecution().executedPlan().toString()
    assert path not in text and "FileScan" in text
