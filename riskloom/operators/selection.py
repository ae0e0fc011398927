"""Slice checks, model comparison and the promotion gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators import ranking
from riskloom.operators.prefix import exact_quantiles
from riskloom.schema import DEFAULT, TxnColumns

# The slices of the hold-out period, which overlap.
SLICES = (
    "identity_present", "identity_absent", "new_card", "known_card", "weekend", "weekday",
    "amt_q1", "amt_q2", "amt_q3", "amt_q4",
)


@dataclass(frozen=True)
class GateConfig:
    # The published promotion floors.
    min_pr_auc_improvement: float = 0.0
    min_precision: float = 0.10
    min_recall: float = 0.20
    slice_pr_auc_floor: float = 0.05
    slice_min_positives: int = 20


def amount_edges(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """One row ``q25, q50, q75`` of the amount."""
    return exact_quantiles(df, cols.amount, {"q25": 0.25, "q50": 0.5, "q75": 0.75})


def quartile_label(amount: Column, edges: Sequence[float | Column]) -> Column:
    """q1..q4 with right-closed bins; equal edges leave the later bin empty."""
    first, second, third = edges
    return (
        F.when(amount.isNull(), None)
        .when(amount <= first, "q1")
        .when(amount <= second, "q2")
        .when(amount <= third, "q3")
        .otherwise("q4")
    )


def amount_quartiles(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Add ``amt_quartile``; the three edges enter the plan as literals."""
    return df.withColumn(
        "amt_quartile", quartile_label(F.col(cols.amount), tuple(amount_edges(df, cols).first()))
    )


def build_slices(df: DataFrame, carry: Sequence[str], cols: TxnColumns = DEFAULT) -> DataFrame:
    """One row per (row, slice it belongs to) with the carried columns and ``slice``."""
    edges = tuple(amount_edges(df, cols).first())
    card_freq = F.col(f"{cols.history_keys[0]}_freq")
    present = F.col("n_identity_present")
    weekend = F.col("is_weekend")
    member = F.array(
        F.when(present > 0, "identity_present").when(present == 0, "identity_absent"),
        F.when(card_freq == 0, "new_card").when(card_freq > 0, "known_card"),
        F.when(weekend == 1, "weekend").when(weekend == 0, "weekday"),
        F.concat(F.lit("amt_"), quartile_label(F.col(cols.amount), edges)),
    )
    return df.select(*carry, F.explode(F.array_compact(member)).alias("slice"))


def slice_pr_auc(sliced: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Average precision per slice, null where a slice has no positives."""
    return ranking.pr_auc(sliced, ["slice"], score, label)


def slice_checks(
    sliced: DataFrame,
    cfg: GateConfig = GateConfig(),
    slices: Sequence[str] = SLICES,
    score: str = "score",
    label: str = "label",
) -> DataFrame:
    """``slice, n, positives, pr_auc, status`` for every named slice, empty ones included."""
    names = sliced.sparkSession.createDataFrame([(s,) for s in slices], "slice string")
    found = ranking.evaluate(sliced, ["slice"], score, label)
    n_pos = F.coalesce(F.col("positives"), F.lit(0))
    enough = n_pos >= cfg.slice_min_positives
    return names.join(found, "slice", "left").select(
        "slice",
        F.coalesce("n", F.lit(0)).alias("n"),
        n_pos.alias("positives"),
        F.when(enough, F.col("pr_auc")).alias("pr_auc"),
        F.when(~enough, "insufficient_data")
        .when(F.col("pr_auc") >= cfg.slice_pr_auc_floor, "pass")
        .otherwise("fail")
        .alias("status"),
    )


def promotion_gate(
    metrics: DataFrame,
    operating: DataFrame,
    slices: DataFrame,
    cfg: GateConfig = GateConfig(),
    candidate: str = "candidate",
    baseline: str = "baseline",
    split: str = "holdout",
) -> DataFrame:
    """One row with the three rules, the failed slices and the decision.

    ``metrics`` has ``model, split, pr_auc``; ``operating`` one row with precision and recall
    at the operating threshold; ``slices`` comes from ``slice_checks``. The facts are stacked
    and folded by one aggregate, so nothing is cross-joined.
    """
    fields = ("candidate", "baseline", "precision", "recall")

    def facts(df: DataFrame, failed: Column | None = None, **given: Column) -> DataFrame:
        return df.select(
            *[given.get(f, F.lit(None)).cast("double").alias(f) for f in fields],
            (F.lit(None) if failed is None else failed).cast("string").alias("failed"),
        )

    model = F.col("model")
    stacked = (
        facts(
            metrics.where(F.col("split") == split),
            candidate=F.when(model == candidate, F.col("pr_auc")),
            baseline=F.when(model == baseline, F.col("pr_auc")),
        )
        .unionByName(facts(operating, precision=F.col("precision"), recall=F.col("recall")))
        .unionByName(facts(slices.where(F.col("status") == "fail"), failed=F.col("slice")))
    )
    # At most one name per slice is gathered.
    folded = stacked.agg(
        *[F.max(f).alias(f) for f in fields], F.sort_array(F.collect_list("failed")).alias("failed_slices")
    )
    g1 = F.col("candidate") > F.col("baseline") + cfg.min_pr_auc_improvement
    g2 = (F.col("precision") >= cfg.min_precision) & (F.col("recall") >= cfg.min_recall)
    g3 = F.size("failed_slices") == 0
    rules = {"g1_beat_baseline": g1, "g2_precision_recall": g2, "g3_slices": g3}
    return folded.select(
        *[F.coalesce(rule, F.lit(False)).alias(name) for name, rule in rules.items()], "failed_slices"
    ).withColumn("promoted", F.col("g1_beat_baseline") & F.col("g2_precision_recall") & F.col("g3_slices"))


def compare_models(
    metrics: DataFrame, candidate: str = "candidate", baseline: str = "baseline"
) -> DataFrame:
    """Per split: both areas of both models, their differences and whether the candidate wins."""

    def of(model: str, metric: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(metric)))

    side = metrics.where(F.col("model").isin(candidate, baseline)).groupBy("split").agg(
        *[
            of(model, metric).alias(f"{role}_{metric}")
            for metric in ("pr_auc", "roc_auc")
            for role, model in (("baseline", baseline), ("candidate", candidate))
        ]
    )
    return side.withColumns(
        {
            "pr_auc_delta": F.col("candidate_pr_auc") - F.col("baseline_pr_auc"),
            "roc_auc_delta": F.col("candidate_roc_auc") - F.col("baseline_roc_auc"),
            "candidate_beats_baseline": F.col("candidate_pr_auc") > F.col("baseline_pr_auc"),
        }
    )
