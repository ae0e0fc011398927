"""Threshold study, slice checks and gate as one report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators import ranking, selection
from riskloom.operators.selection import GateConfig
from riskloom.schema import SPLITS

TRAIN, VALIDATION, HOLDOUT = SPLITS


def as_rows(df: DataFrame, section: str | Column, fields: list[str]) -> DataFrame:
    """Fields of a small frame as ``section, name, value`` rows; booleans become 1 and 0."""
    where = F.lit(section) if isinstance(section, str) else section
    typed = df.select(where.alias("section"), *[F.col(f).cast("double").alias(f) for f in fields])
    return typed.unpivot(["section"], fields, "name", "value")


CONFUSION = ["threshold", "precision", "recall", "f1", "tp", "fp", "fn", "tn", "alert_rate", "n"]


def promotion_report(
    scored: DataFrame,
    sliced_holdout: DataFrame,
    cfg: GateConfig = GateConfig(),
    candidate: str = "candidate",
    baseline: str = "baseline",
) -> DataFrame:
    """``section, name, value`` rows of the whole promotion decision.

    ``scored`` has ``model, split, label, score``; ``sliced_holdout`` has ``slice, label,
    score`` of the candidate on the hold-out period. The threshold is chosen on validation
    and only then applied to the hold-out. Slice status is 1 pass, 0 fail, null not judged.
    """
    mine = scored.where(F.col("model") == candidate)
    study = ranking.threshold_by_f1(mine.where(F.col("split") == VALIDATION))
    best = study.first()
    threshold = float(best["threshold"])
    at = ranking.evaluate_at_threshold(
        mine.where(F.col("split").isin(VALIDATION, HOLDOUT)), threshold, ["split"]
    )
    checks = selection.slice_checks(sliced_holdout, cfg)
    metrics = ranking.pr_auc(scored.where(F.col("split") == HOLDOUT), ["model", "split"])
    gate = selection.promotion_gate(
        metrics, at.where(F.col("split") == HOLDOUT), checks, cfg, candidate, baseline
    )
    spark = scored.sparkSession
    head = spark.createDataFrame(
        [
            ("threshold_study", "operating_threshold", threshold),
            *[("threshold_study", k, float(best[k])) for k in ("precision", "recall", "f1")],
        ],
        "section string, name string, value double",
    )
    judged = checks.withColumn(
        "passed", F.when(F.col("status") == "pass", 1).when(F.col("status") == "fail", 0)
    )
    return (
        head.unionByName(as_rows(at, F.concat("split", F.lit("_at_threshold")), CONFUSION))
        .unionByName(
            as_rows(judged, F.concat(F.lit("slice."), "slice"), ["n", "positives", "pr_auc", "passed"])
        )
        .unionByName(
            as_rows(gate, "gate", ["g1_beat_baseline", "g2_precision_recall", "g3_slices", "promoted"])
        )
    )


def final_report(
    validation: DataFrame,
    split_summary: DataFrame,
    metrics: DataFrame,
    comparison: DataFrame,
    promotion: DataFrame,
    importance: DataFrame,
    drift: DataFrame,
    top_n: int | None = None,
    *,
    test_validation: DataFrame | None = None,
    parameters: DataFrame | None = None,
) -> DataFrame:
    """Every figure of a model card as ``section, name, value`` rows; ``top_n``: how many features, default all.

    ``test_validation`` is the report of the stage without labels, ``parameters`` (``model, name, value``) what the
    models were fitted with.
    """
    staged = validation if test_validation is None else validation.unionByName(test_validation)
    stats = staged.where(F.col("severity") == "stat").select(
        F.concat(F.lit("dataset."), "stage").alias("section"), F.col("check_name").alias("name"), "value"
    )
    listed = importance if top_n is None else importance.where(F.col("place") <= top_n)
    top = listed.select(
        F.lit("explainability").alias("section"),
        F.col("feature").alias("name"),
        F.col("importance").alias("value"),
    )
    per_split = as_rows(
        split_summary, F.concat(F.lit("split."), "split"), ["rows", "fraud_rate", "n_positives"]
    )
    per_model = as_rows(
        metrics, F.concat_ws(".", F.lit("model"), "model", "split"), ["pr_auc", "roc_auc", "n", "positives"]
    )
    versus = as_rows(
        comparison,
        F.concat(F.lit("comparison."), "split"),
        ["pr_auc_delta", "roc_auc_delta", "candidate_beats_baseline"],
    )
    monitoring = as_rows(drift, "monitoring", ["drifted_columns", "total_columns", "dataset_drift"])
    gathered = promotion.withColumn("section", F.concat(F.lit("promotion."), "section"))
    out = stats
    if parameters is not None:
        fitted = F.concat(F.lit("parameters."), "model").alias("section")
        out = out.unionByName(parameters.select(fitted, "name", F.col("value").cast("double").alias("value")))
    for part in (per_split, per_model, versus, gathered, top, monitoring):
        out = out.unionByName(part)
    return out
