"""Model fitting, scoring and tree explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog import sql
from riskloom.catalog.featuring import temporal_features
from riskloom.catalog.registry import query
from riskloom.catalog.relational import COLS, with_split
from riskloom.operators import encodings, explaining, modelling, ranking
from riskloom.operators.treeshap import tree_contributions
from riskloom.plans.serving import BatchScorer, explain_extremes
from riskloom.plans.training import train_and_evaluate
from riskloom.session import materialize, working_dir
from riskloom.sources import testbed

# Fits have the published settings: so many rounds at most, fewer where the patience on the validation loss ends them.
ROUNDS = modelling.BOOSTED_PARAMS["n_estimators"]
# Per application and folder: where the matrix and the fitted trees lie that several queries read.
_FITTED: dict[tuple[str, str], tuple[str, str]] = {}


def _matrix(spark, sf) -> tuple[DataFrame, list[str]]:
    """The feature matrix of all splits, written once and partitioned by split."""
    feats = temporal_features(spark, sf)
    names = modelling.feature_columns(feats, COLS)
    rows = modelling.select_features(feats, COLS, names, ["transaction_id", "split"])
    return materialize(rows, "matrix", ("split",)), names


def fitted_trees(spark, sf):
    """(model, matrix, features): fitted by the first query that asks, loaded by the others."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _FITTED:
        path = working_dir(spark, "trees")
        rows, names = _matrix(spark, sf)
        rows.write.partitionBy("split").parquet(f"{path}/matrix")
        model = modelling.train_boosted_trees(rows.where("split = 'train'"), names, rows.where("split = 'validation'"))
        _FITTED[place] = modelling.save_model(model, f"{path}/model"), f"{path}/matrix"
    saved, matrix = _FITTED[place]
    model = modelling.load_boosted_trees(saved)
    return model, spark.read.parquet(matrix), model.features


@query(
    "select_features",
    sql.with_(
        f"""SELECT transaction_id, is_fraud AS label, transaction_amt, coalesce(id_01, 0) AS id_01,
        CAST("DT_M" AS DOUBLE) AS "DT_M", CAST("DT_W" AS DOUBLE) AS "DT_W", CAST("DT_D" AS DOUBLE) AS "DT_D",
        CAST(hour AS DOUBLE) AS hour, CAST(day_of_week AS DOUBLE) AS day_of_week, CAST(is_weekend AS DOUBLE) AS is_weekend,
        round(transaction_amt_log, 6) AS transaction_amt_log, round(transaction_amt_cents, 6) AS transaction_amt_cents,
        CAST(n_identity_present AS DOUBLE) AS n_identity_present
        FROM (SELECT *, {sql.CALENDAR}, {sql.AMOUNT}, {sql.N_IDENTITY} AS n_identity_present FROM jnd)""",
        "jnd",
    ),
)
def select_features(spark, sf):
    rows = testbed.joined(spark, sf)
    rows = rows.withColumns(encodings.row_expressions(rows, COLS))
    out = modelling.select_features(rows, COLS, carry=["transaction_id"])
    rounded = ("transaction_amt_log", "transaction_amt_cents")
    return out.withColumns({n: F.round(n, 6) for n in rounded})


@query(
    "class_weights",
    sql.with_(
        """SELECT is_fraud AS label, count(*) AS n,
        round(CAST((SELECT count(*) FROM sp WHERE split = 'train') AS DOUBLE) / (2 * count(*)), 6) AS weight
        FROM sp WHERE split = 'train' GROUP BY is_fraud""",
        "sp",
    ),
)
def class_weights(spark, sf):
    train = with_split(spark, sf, identity=False).where("split = 'train'")
    out = modelling.class_weights(train, "is_fraud")
    return out.withColumn("weight", F.round("weight", 6))


@query(
    "scale_pos_weight",
    sql.with_(
        """SELECT count(*) FILTER (WHERE is_fraud = 1) AS positives, count(*) FILTER (WHERE is_fraud = 0) AS negatives,
        round(CAST(count(*) FILTER (WHERE is_fraud = 0) AS DOUBLE) / count(*) FILTER (WHERE is_fraud = 1), 6)
        AS scale_pos_weight FROM sp WHERE split = 'train'""",
        "sp",
    ),
)
def scale_pos_weight(spark, sf):
    train = with_split(spark, sf, identity=False).where("split = 'train'")
    out = modelling.scale_pos_weight(train, "is_fraud")
    return out.withColumn("scale_pos_weight", F.round("scale_pos_weight", 6))


@query("train_baseline")
def train_baseline(spark, sf):
    rows, names = _matrix(spark, sf)
    model = modelling.train_baseline(rows.where("split = 'train'"), names)
    return ranking.evaluate(modelling.score(model, rows, ["split", "label"]), ["split"])


@query("train_boosted_trees")
def train_boosted_trees(spark, sf):
    model, rows, _ = fitted_trees(spark, sf)
    return ranking.evaluate(modelling.score(model, rows, ["split", "label"]), ["split"])


@query("score")
def score(spark, sf):
    model, rows, _ = fitted_trees(spark, sf)
    return modelling.score(model, rows.where("split = 'holdout'"), ["transaction_id", "label"])


@query("training_parameters")
def training_parameters(spark, sf):
    """What the trees were fitted with, the rounds fitted and kept, and the validation loss by round."""
    model, _, _ = fitted_trees(spark, sf)
    losses = spark.createDataFrame([(f"validation_loss_{k:04d}", v) for k, v in enumerate(model.losses)], "name string, value double")
    return modelling.training_parameters(model, spark).unionByName(losses)


# The fitted numbers have no SQL counterpart. What can be checked row by row is: which rows come
# out, and whether each one keeps the promise of its operator.


@query(
    "save_load_model",
    sql.with_(
        "SELECT transaction_id, is_fraud AS label, true AS same_score FROM sp WHERE split = 'holdout'", "sp"
    ),
)
def save_load_model(spark, sf):
    rows, names = _matrix(spark, sf)
    model = modelling.train_baseline(rows.where("split = 'train'"), names)
    again = modelling.load_model(modelling.save_model(model, working_dir(spark, "model")))
    holdout = rows.where("split = 'holdout'")
    before = modelling.score(model, holdout, ["transaction_id", "label"])
    after = modelling.score(again, holdout, ["transaction_id"]).withColumnRenamed("score", "again")
    return before.join(after, "transaction_id").select(
        "transaction_id", "label", (F.col("score") == F.col("again")).alias("same_score")
    )


@query("train_and_evaluate")
def train_and_evaluate_query(spark, sf):
    return train_and_evaluate(temporal_features(spark, sf), COLS).metrics


@query(
    "tree_contributions",
    sql.with_(
        """SELECT transaction_id, CAST(24 AS INTEGER) AS n_features, true AS adds_up
        FROM sp WHERE split = 'holdout'""",
        "sp",
    ),
)
def tree_contributions_query(spark, sf):
    """Per row: contributions plus bias equal the model's log-odds."""
    model, rows, names = fitted_trees(spark, sf)
    phi, bias = tree_contributions(spark, model, F.array(*[F.col(n) for n in names]))
    holdout = modelling.score(model, rows.where("split = 'holdout'")).withColumn("phi", phi)
    explained = F.aggregate("phi", F.lit(0.0), lambda a, x: a + x) + F.lit(bias)
    log_odds = F.log(F.col("score") / (1 - F.col("score")))
    return holdout.select(
        "transaction_id",
        F.size("phi").alias("n_features"),
        (F.abs(explained - log_odds) < 1e-8).alias("adds_up"),
    )


def explained_holdout(spark, sf) -> tuple[DataFrame, list[str]]:
    """Hold-out rows with ``score`` and the ``contributions`` of the fitted trees."""
    model, rows, names = fitted_trees(spark, sf)
    return BatchScorer(model, 0.5).explain(rows.where("split = 'holdout'"), ["transaction_id"]), names


@query("tree_contribution_values")
def tree_contribution_values(spark, sf):
    """The contribution of every feature to every row."""
    rows, _ = explained_holdout(spark, sf)
    return rows.select("transaction_id", F.inline("contributions"))


@query("tree_importance")
def tree_importance(spark, sf):
    """Mean absolute contribution of every feature to the fitted trees' margin."""
    rows, names = explained_holdout(spark, sf)
    return explaining.global_importance(rows, "contributions", names)


@query("tree_risk_factors")
def tree_risk_factors(spark, sf):
    """The five features that raise each row's score most."""
    rows, _ = explained_holdout(spark, sf)
    factors = explaining.risk_factors(F.col("contributions")).alias("f")
    return rows.select("transaction_id", "score", F.posexplode(factors).alias("pos", "f")).select(
        "transaction_id", "score", (F.col("pos") + 1).alias("place"), "f.feature", "f.contribution", "f.value"
    )


@query("tree_extremes")
def tree_extremes(spark, sf):
    """The factors of the rows that the trees score highest and lowest."""
    model, rows, names = fitted_trees(spark, sf)
    scored = modelling.score(model, rows.where("split = 'holdout'"), ["transaction_id", *names])
    scorer = BatchScorer(model, 0.5)
    out = explain_extremes(scored, "transaction_id", explain=lambda few: scorer.explain(few, ["extreme", "place", "transaction_id"]))
    return out.select("extreme", "place", "transaction_id", "score", F.inline("risk_factors"))


RESULT_SQL = sql.with_(
    """SELECT transaction_id, CAST(0.5 AS DOUBLE) AS threshold, true AS is_probability, true AS decision_follows,
    CAST(5 AS INTEGER) AS n_factors, true AS factors_descend FROM sp WHERE split = 'holdout'""",
    "sp",
)


def checked_results(results: DataFrame) -> DataFrame:
    """The contract of a scoring result, row by row."""
    c = F.col("risk_factors.contribution")
    return results.select(
        "transaction_id",
        "threshold",
        F.col("score").between(0.0, 1.0).alias("is_probability"),
        ((F.col("decision") == "review") == (F.col("score") >= F.col("threshold"))).alias("decision_follows"),
        F.size("risk_factors").alias("n_factors"),
        (c == F.reverse(F.array_sort(c))).alias("factors_descend"),
    )


@query("score_batch", RESULT_SQL)
def score_batch(spark, sf):
    model, rows, _ = fitted_trees(spark, sf)
    return checked_results(BatchScorer(model, 0.5).score_batch(rows.where("split = 'holdout'")))
