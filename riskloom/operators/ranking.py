"""Ranking metrics as distributed aggregations over distinct scores.

Rows are first combined into (group, score) counts, so ties cost nothing; the running sums
over scores never put a large group in one task. ``by`` names report dimensions such as
model, split or slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import safe_divide
from riskloom.operators.prefix import prior_sums_by_value

# Fixed value: keeps the F1 denominator above zero.
F1_EPSILON = 1e-12
# Fixed value: the operating point when nothing better is known.
DEFAULT_THRESHOLD = 0.5


def _ranked(scored: DataFrame, by: Sequence[str], score: str, label: str, **options) -> DataFrame:
    counts = scored.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    ranked = prior_sums_by_value(counts, by, "threshold", ["pos", "n"], **options)
    # Everything at or above the score is flagged.
    tp = F.col("total_pos") - F.col("before_pos")
    flagged = F.col("total_n") - F.col("before_n")
    return ranked.withColumns(
        {
            "tp": tp,
            "flagged": flagged,
            "precision": safe_divide(tp, flagged),
            "recall": safe_divide(tp, F.col("total_pos")),
        }
    )


def _collapse(df: DataFrame, by: Sequence[str], *aggregates: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def _average_precision() -> Column:
    # Sum over scores of (recall step) x precision; not the trapezoid.
    return F.sum(safe_divide(F.col("pos") * F.col("precision"), F.col("total_pos")))


def _rank_auc() -> Column:
    negatives = F.col("n") - F.col("pos")
    below = F.col("before_n") - F.col("before_pos")
    wins = F.sum(F.col("pos") * (below + negatives / F.lit(2.0)))
    pairs = F.max(F.col("total_pos").cast("double") * (F.col("total_n") - F.col("total_pos")))
    return safe_divide(wins, pairs)


def pr_curve(
    scored: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label"
) -> DataFrame:
    """Precision and recall at each distinct score, a row being flagged when score >= threshold."""
    return _ranked(scored, by, score, label).select(*by, "threshold", "precision", "recall", "tp", "flagged")


def pr_auc(
    scored: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label"
) -> DataFrame:
    """Average precision per group; null where a group has no positives."""
    return _collapse(_ranked(scored, by, score, label), by, _average_precision().alias("pr_auc"))


def roc_auc(
    scored: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label"
) -> DataFrame:
    """Rank AUC, ties counted half; null where a group has one class only."""
    return _collapse(_ranked(scored, by, score, label), by, _rank_auc().alias("roc_auc"))


def evaluate(
    scored: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label", **options
) -> DataFrame:
    """Both areas, rows and positives per group, from one pass.

    ``options`` go to the running sums (``cell_rows``).
    """
    return _collapse(
        _ranked(scored, by, score, label, **options),
        by,
        _average_precision().alias("pr_auc"),
        _rank_auc().alias("roc_auc"),
        F.sum("n").alias("n"),
        F.sum("pos").alias("positives"),
    )


def f1_score(precision: Column, recall: Column) -> Column:
    total = precision + recall
    return F.when(total > 0, 2 * precision * recall / (total + F1_EPSILON)).otherwise(0.0)


def threshold_by_f1(
    scored: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label"
) -> DataFrame:
    """The threshold of the highest F1, the lowest one on ties; 0.5 without positives."""
    f1 = f1_score(F.col("precision"), F.col("recall"))
    best = F.max(
        F.struct(f1.alias("f1"), (-F.col("threshold")).alias("minus"), "precision", "recall")
    )
    picked = _collapse(
        _ranked(scored, by, score, label), by, best.alias("b"), F.sum("pos").alias("positives")
    )
    none = F.coalesce(F.col("positives"), F.lit(0)) == 0

    def or_else(value: Column, otherwise: float) -> Column:
        return F.when(none, otherwise).otherwise(value)

    return picked.select(
        *by,
        or_else(-F.col("b.minus"), DEFAULT_THRESHOLD).alias("threshold"),
        or_else(F.col("b.precision"), 0.0).alias("precision"),
        or_else(F.col("b.recall"), 0.0).alias("recall"),
        or_else(F.col("b.f1"), 0.0).alias("f1"),
    )


def evaluate_at_threshold(
    scored: DataFrame,
    threshold: float,
    by: Sequence[str] = (),
    score: str = "score",
    label: str = "label",
) -> DataFrame:
    """Confusion counts and rates of ``score >= threshold``; 0 where a rate is undefined."""
    flagged, fraud = F.col(score) >= threshold, F.col(label) == 1
    counts = _collapse(
        scored,
        by,
        F.count_if(flagged & fraud).alias("tp"),
        F.count_if(flagged & ~fraud).alias("fp"),
        F.count_if(~flagged & fraud).alias("fn"),
        F.count_if(~flagged & ~fraud).alias("tn"),
        F.count(F.lit(1)).alias("n"),
    )

    def rate(num: Column, den: Column) -> Column:
        return F.coalesce(safe_divide(num, den), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    with_rates = counts.withColumns(
        {
            "threshold": F.lit(float(threshold)),
            "precision": rate(tp, tp + fp),
            "recall": rate(tp, tp + fn),
            "alert_rate": rate(tp + fp, F.col("n")),
        }
    )
    return with_rates.withColumn("f1", f1_score(F.col("precision"), F.col("recall"))).select(
        *by, "threshold", "precision", "recall", "f1", "tp", "fp", "fn", "tn", "alert_rate", "n"
    )
