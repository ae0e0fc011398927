"""Feature matrix, class weights and the two models: logistic regression by Spark ML, and boosted trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalars import safe_divide
from riskloom.operators import boosting
from riskloom.operators.boosting import BoostedTrees
from riskloom.schema import DEFAULT, TxnColumns
from riskloom.sources.tables import align_columns, numeric_columns

# The published settings of the two models.
BASELINE_PARAMS = {"C": 1.0, "max_iter": 2000}
BOOSTED_PARAMS = {
    "n_estimators": 1000,
    "max_depth": 6,
    "learning_rate": 0.02,
    "subsample": 0.8,
    "colsample": 0.4,
    "scale_pos_weight": "auto",
}
Model = PipelineModel | BoostedTrees
# Fixed value: rounds without a better validation loss after which boosting stops.
EARLY_STOPPING_ROUNDS = 50


def feature_columns(df: DataFrame, cols: TxnColumns = DEFAULT) -> list[str]:
    """Numeric and boolean columns that are neither identifiers nor the label."""
    return numeric_columns(df, cols.non_features)


def select_features(
    df: DataFrame, cols: TxnColumns = DEFAULT, columns: Sequence[str] | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Model inputs as doubles with missing values 0, then ``label``; ``columns`` aligns to a fit."""
    chosen = list(columns) if columns is not None else feature_columns(df, cols)
    labelled = df.withColumn("label", F.col(cols.label).cast("int"))
    return align_columns(labelled, chosen, [*carry, "label"])


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (2 n_class)``: one row per class."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # Two classes, so the window below holds two rows.
    from pyspark.sql import Window

    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("weight", safe_divide(total, F.lit(2) * F.col("n")))


def scale_pos_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: positives, negatives and their ratio, 1.0 without positives."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(
        pos.alias("positives"),
        neg.alias("negatives"),
        F.coalesce(safe_divide(neg, pos), F.lit(1.0)).alias("scale_pos_weight"),
    )


def train_baseline(
    train: DataFrame,
    features: Sequence[str],
    *,
    C: float = BASELINE_PARAMS["C"],
    max_iter: int = BASELINE_PARAMS["max_iter"],
) -> PipelineModel:
    """Standardized, class-balanced L2 logistic regression.

    With balanced weights the weights sum to the row count, so a penalty of 1/(C n) on Spark's
    mean loss is the usual ``1/2 |w|^2 + C sum`` objective.
    """
    weights = {r["label"]: (r["n"], r["weight"]) for r in class_weights(train).collect()}
    n = sum(count for count, _ in weights.values())
    weight = F.lit(None).cast("double")
    for label, (_, w) in weights.items():
        weight = F.when(F.col("label") == label, w).otherwise(weight)
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(
            featuresCol="features",
            labelCol="label",
            weightCol="weight",
            maxIter=max_iter,
            regParam=1.0 / (C * n),
            elasticNetParam=0.0,
            standardization=False,
        ),
    ]
    return Pipeline(stages=stages).fit(train.withColumn("weight", weight))


def train_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    validation: DataFrame | None = None,
    *,
    n_estimators: int = BOOSTED_PARAMS["n_estimators"],
    max_depth: int = BOOSTED_PARAMS["max_depth"],
    learning_rate: float = BOOSTED_PARAMS["learning_rate"],
    subsample: float = BOOSTED_PARAMS["subsample"],
    colsample: float = BOOSTED_PARAMS["colsample"],
    pos_weight: float | str = BOOSTED_PARAMS["scale_pos_weight"],
    early_stopping: int | None = EARLY_STOPPING_ROUNDS,
    seed: int = 42,
    **options,
) -> BoostedTrees:
    """Second-order boosted trees with positive-class weight; see ``boosting.fit`` for ``options``.

    With ``validation`` rows boosting stops ``early_stopping`` rounds after their least log loss (unweighted), and
    the trees up to it are kept.
    """
    if pos_weight == "auto":
        pos_weight = scale_pos_weight(train).first()["scale_pos_weight"]
    return boosting.fit(
        train, features, validation, n_estimators=n_estimators, max_depth=max_depth, learning_rate=learning_rate,
        subsample=subsample, colsample=colsample, pos_weight=float(pos_weight), early_stopping=early_stopping, seed=seed, **options,
    )


def model_inputs(model: Model) -> list[str]:
    """The feature names a fitted model expects, in order."""
    return model.features if isinstance(model, BoostedTrees) else model.stages[0].getInputCols()


def score(model: Model, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Add ``score``, the probability of the positive class; keeps ``carry`` or all columns."""
    if isinstance(model, BoostedTrees):
        scored = df.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-model.margin(df.sparkSession))))
    else:
        scored = model.transform(df).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*(carry or df.columns), "score")


def save_model(model: Model, path: str) -> str:
    if isinstance(model, BoostedTrees):
        return model.save(SparkSession.active(), path)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """A saved baseline."""
    return PipelineModel.load(path)


def load_boosted_trees(path: str) -> BoostedTrees:
    return BoostedTrees.load(SparkSession.active(), path)


def training_parameters(model: Model, spark: SparkSession) -> DataFrame:
    """``name, value`` rows: what a model was fitted with, its features and, for trees, the rounds kept."""
    if isinstance(model, BoostedTrees):
        told = {**model.params, "n_features": len(model.features), "best_iteration": model.best_iteration}
    else:
        lr = model.stages[-1]
        told = {
            "C_times_rows": 1.0 / lr.getRegParam(),
            "max_iter": lr.getMaxIter(),
            "n_features": len(model_inputs(model)),
        }
    return spark.createDataFrame([(k, float(v)) for k, v in told.items()], "name string, value double")
