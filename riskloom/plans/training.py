"""Fit both models on the temporal splits and measure them on every split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import modelling, ranking
from riskloom.schema import DEFAULT, SPLITS, TxnColumns
from riskloom.session import materialize

TRAIN, VALIDATION, HOLDOUT = SPLITS


@dataclass(frozen=True)
class TrainedModels:
    models: dict[str, modelling.Model]
    features: list[str]
    # model, split, id, label, score
    scored: DataFrame
    # model, split, pr_auc, roc_auc, n, positives, n_features, best_iteration
    metrics: DataFrame
    # model, name, value: what each was fitted with
    parameters: DataFrame


def train_and_evaluate(
    split_features: DataFrame,
    cols: TxnColumns = DEFAULT,
    *,
    boosted: dict | None = None,
    baseline: dict | None = None,
    carry: Sequence[str] = (),
) -> TrainedModels:
    """Both models from a frame with a ``split`` column (see ``build_temporal_splits``).

    The feature matrix is written once, partitioned by split, so the many passes of the two
    fits read it back instead of rebuilding the features, and a fit prunes to its split.
    """
    names = modelling.feature_columns(split_features, cols)
    keep = [cols.id, "split", *[c for c in carry if c not in names]]
    matrix = materialize(
        modelling.select_features(split_features, cols, names, keep), "matrix", ("split",)
    )
    train = matrix.where(F.col("split") == TRAIN)
    validation = matrix.where(F.col("split") == VALIDATION)
    models = {
        "baseline": modelling.train_baseline(train, names, **(baseline or {})),
        "candidate": modelling.train_boosted_trees(train, names, validation, **(boosted or {})),
    }
    scored: DataFrame | None = None
    for name, model in models.items():
        one = modelling.score(model, matrix, [cols.id, "split", "label", *carry]).withColumn(
            "model", F.lit(name)
        )
        scored = one if scored is None else scored.unionByName(one)
    assert scored is not None
    scored = materialize(scored, "scored")
    trees = models["candidate"].best_iteration
    metrics = ranking.evaluate(scored, ["model", "split"]).withColumns(
        {
            "n_features": F.lit(len(names)),
            "best_iteration": F.when(F.col("model") == "candidate", trees),
        }
    )
    spark = split_features.sparkSession
    told = [modelling.training_parameters(m, spark).select(F.lit(name).alias("model"), "name", "value") for name, m in models.items()]
    return TrainedModels(models, names, scored, metrics, told[0].unionByName(told[1]))
