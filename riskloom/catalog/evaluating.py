"""Metric, selection and explanation queries on a model-free, integer-made score."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import sql
from riskloom.catalog.featuring import temporal_features
from riskloom.catalog.registry import query
from riskloom.catalog.relational import COLS, both_models, boundaries, interim, scored, with_split
from riskloom.operators import encodings, explaining, ranking, selection, splitting
from riskloom.operators.joining import keys_long, lookup
from riskloom.plans import promotion
from riskloom.session import materialize
from riskloom.sources import testbed


def rounded(df, *names, places=6):
    return df.withColumns({n: F.round(n, places) for n in names})


@query("pr_auc", sql.with_(f"SELECT split, round({sql.AP}, 6) AS pr_auc FROM c GROUP BY split", "scored", c=sql.curve("scored", "split")))
def pr_auc(spark, sf):
    return rounded(ranking.pr_auc(scored(spark, sf), ["split"]), "pr_auc")


@query("roc_auc", sql.with_(f"SELECT split, round({sql.AUC}, 6) AS roc_auc FROM c GROUP BY split", "scored", c=sql.curve("scored", "split")))
def roc_auc(spark, sf):
    return rounded(ranking.roc_auc(scored(spark, sf), ["split"]), "roc_auc")


_EVALUATE = (
    f"round({sql.AP}, 6) AS pr_auc, round({sql.AUC}, 6) AS roc_auc,"
    " CAST(sum(n) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives"
)


@query("evaluate", sql.with_(f"SELECT model, split, {_EVALUATE} FROM c GROUP BY model, split", "duo", c=sql.curve("duo", "model, split")))
def evaluate(spark, sf):
    return rounded(ranking.evaluate(both_models(spark, sf), ["model", "split"]), "pr_auc", "roc_auc")


@query(
    "pr_curve",
    sql.with_(
        f"""SELECT split, score AS threshold, round({sql.PRECISION}, 6) AS precision,
        round({sql.RECALL}, 6) AS recall, tp, flagged FROM c""",
        "scored", c=sql.curve("scored", "split"),
    ),
)
def pr_curve(spark, sf):
    return rounded(ranking.pr_curve(scored(spark, sf), ["split"]), "precision", "recall")


_F1_ROWS = (
    f"SELECT *, {sql.f1('p', 'r')} AS f FROM (SELECT *, {sql.PRECISION} AS p, {sql.RECALL} AS r FROM c)"
)
_BEST = """SELECT split, score AS threshold, p, r, f FROM (
    SELECT *, row_number() OVER (PARTITION BY split ORDER BY f DESC, score) AS k FROM fs) WHERE k = 1"""


@query(
    "threshold_by_f1",
    sql.with_(
        "SELECT split, threshold, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM best",
        "scored", c=sql.curve("scored", "split"), fs=_F1_ROWS, best=_BEST,
    ),
)
def threshold_by_f1(spark, sf):
    return rounded(ranking.threshold_by_f1(scored(spark, sf), ["split"]), "precision", "recall", "f1")


@query(
    "evaluate_at_threshold",
    sql.with_(sql.rates("k", "split"), "scored", k=sql.confusion("scored", "0.5", "split")),
)
def evaluate_at_threshold(spark, sf):
    out = ranking.evaluate_at_threshold(scored(spark, sf), 0.5, ["split"])
    return rounded(out, "precision", "recall", "f1", "alert_rate")


@query("amount_quartiles", sql.with_("SELECT transaction_id, amt_quartile FROM quart", "quart"))
def amount_quartiles(spark, sf):
    holdout = with_split(spark, sf, identity=False).where("split = 'holdout'")
    return selection.amount_quartiles(holdout, COLS).select("transaction_id", "amt_quartile")


def sliced_holdout(spark, sf):
    """Hold-out rows per slice: only the features slices are made of are built."""
    t1, t2 = boundaries(spark, sf)
    rows = splitting.assign_split(interim(spark, sf), t1, t2, COLS)
    fitted = splitting.period_filter(rows, until=t2, cols=COLS)
    counts = encodings.frequency_counts(fitted, COLS, ["card1"])
    holdout = splitting.period_filter(rows, after=t2, cols=COLS)
    long = lookup(keys_long(holdout, ["card1"], ["transaction_id"]), counts, ["key_type", "key"])
    freq = encodings.spread_frequency(long, COLS, ["card1"])
    ready = holdout.join(freq, "transaction_id", "left").withColumns(
        {
            **encodings.row_expressions(holdout, COLS),
            "label": F.col("is_fraud"),
            "score": testbed.integer_score(),
        }
    )
    return selection.build_slices(ready, ["transaction_id", "label", "score"], COLS)


@query("build_slices", sql.with_("SELECT transaction_id, label, score, slice FROM sliced", "sliced"))
def build_slices(spark, sf):
    return sliced_holdout(spark, sf)


_SLICE_CURVE = {"c": sql.curve("sliced", "slice")}


@query("slice_pr_auc", sql.with_(f"SELECT slice, round({sql.AP}, 6) AS pr_auc FROM c GROUP BY slice", "sliced", **_SLICE_CURVE))
def slice_pr_auc(spark, sf):
    return rounded(selection.slice_pr_auc(sliced_holdout(spark, sf)), "pr_auc")


_NAMES = ", ".join(f"('{s}')" for s in selection.SLICES)
_CHECKS = f"""
    SELECT s.slice, coalesce(CAST(e.n AS BIGINT), 0) AS n, coalesce(e.positives, 0) AS positives,
           CASE WHEN coalesce(e.positives, 0) >= 20 THEN e.pr_auc END AS pr_auc,
           CASE WHEN coalesce(e.positives, 0) < 20 THEN 'insufficient_data'
                WHEN e.pr_auc >= 0.05 THEN 'pass' ELSE 'fail' END AS status
    FROM (VALUES {_NAMES}) AS s(slice) LEFT JOIN
         (SELECT slice, CAST(sum(n) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives, {sql.AP} AS pr_auc
          FROM c GROUP BY slice) e ON s.slice = e.slice"""


@query(
    "slice_checks",
    sql.with_(
        "SELECT slice, n, positives, round(pr_auc, 6) AS pr_auc, status FROM ck",
        "sliced", **_SLICE_CURVE, ck=_CHECKS,
    ),
)
def slice_checks(spark, sf):
    return rounded(selection.slice_checks(sliced_holdout(spark, sf)), "pr_auc")


# The whole promotion chain in SQL: threshold on validation, used on both later splits.
PROMOTION = {
    **_SLICE_CURVE,
    "ck": _CHECKS,
    "vc": sql.curve("(SELECT * FROM scored WHERE split = 'validation')", "split"),
    "vf": f"SELECT *, {sql.f1('p', 'r')} AS f FROM (SELECT *, {sql.PRECISION} AS p, {sql.RECALL} AS r FROM vc)",
    "op": "SELECT score AS threshold, p, r, f FROM vf ORDER BY f DESC, score LIMIT 1",
    "withop": "SELECT s.*, op.threshold AS cut FROM scored s CROSS JOIN op WHERE split <> 'train'",
    "k": """SELECT split, max(cut) AS threshold, count(*) FILTER (WHERE score >= cut AND label = 1) AS tp,
        count(*) FILTER (WHERE score >= cut AND label = 0) AS fp,
        count(*) FILTER (WHERE score < cut AND label = 1) AS fn,
        count(*) FILTER (WHERE score < cut AND label = 0) AS tn, count(*) AS n FROM withop GROUP BY split""",
    "att": sql.rates("k", "split"),
    "bc": sql.curve("(SELECT * FROM duo WHERE split = 'holdout')", "model"),
    "ap": f"SELECT model, {sql.AP} AS pr_auc FROM bc GROUP BY model",
    "gate": """SELECT (SELECT pr_auc FROM ap WHERE model = 'candidate') > (SELECT pr_auc FROM ap WHERE model = 'baseline') AS g1,
        (SELECT precision >= 0.10 AND recall >= 0.20 FROM att WHERE split = 'holdout') AS g2,
        (SELECT count(*) = 0 FROM ck WHERE status = 'fail') AS g3,
        coalesce((SELECT string_agg(slice, ',' ORDER BY slice) FROM ck WHERE status = 'fail'), '') AS failed_slices""",
}
PROMOTION_BLOCKS = ("sliced", "duo")


@query(
    "promotion_gate",
    sql.with_(
        """SELECT g1 AS g1_beat_baseline, g2 AS g2_precision_recall, g3 AS g3_slices, failed_slices,
        g1 AND g2 AND g3 AS promoted FROM gate""",
        *PROMOTION_BLOCKS, **PROMOTION,
    ),
)
def promotion_gate(spark, sf):
    models = both_models(spark, sf)
    mine = models.where("model = 'candidate'")
    threshold = ranking.threshold_by_f1(mine.where("split = 'validation'")).first()["threshold"]
    out = selection.promotion_gate(
        ranking.pr_auc(models, ["model", "split"]),
        ranking.evaluate_at_threshold(mine.where("split = 'holdout'"), threshold),
        selection.slice_checks(sliced_holdout(spark, sf)),
    )
    return out.withColumn("failed_slices", F.array_join("failed_slices", ","))


_SIDES = ", ".join(
    f"max({m}) FILTER (WHERE model = '{r}') AS {r}_{m}" for m in ("pr_auc", "roc_auc") for r in ("baseline", "candidate")
)


COMPARISON = {
    "cc": sql.curve("duo", "model, split"),
    "ce": f"SELECT model, split, {sql.AP} AS pr_auc, {sql.AUC} AS roc_auc FROM cc GROUP BY model, split",
    "cw": f"SELECT split, {_SIDES} FROM ce GROUP BY split",
}


@query(
    "compare_models",
    sql.with_(
        """SELECT split, round(baseline_pr_auc, 6) AS baseline_pr_auc, round(candidate_pr_auc, 6) AS candidate_pr_auc,
        round(baseline_roc_auc, 6) AS baseline_roc_auc, round(candidate_roc_auc, 6) AS candidate_roc_auc,
        round(candidate_pr_auc - baseline_pr_auc, 6) AS pr_auc_delta,
        round(candidate_roc_auc - baseline_roc_auc, 6) AS roc_auc_delta,
        candidate_pr_auc > baseline_pr_auc AS candidate_beats_baseline FROM cw""",
        "duo",
        **COMPARISON,
    ),
)
def compare_models(spark, sf):
    out = selection.compare_models(ranking.evaluate(both_models(spark, sf), ["model", "split"]))
    return rounded(out, *[c for c in out.columns if "auc" in c and "beats" not in c])


def promotion_rows(spark, sf):
    models = materialize(both_models(spark, sf), "models")
    sliced = materialize(sliced_holdout(spark, sf), "sliced")
    return promotion.promotion_report(models, sliced)


_AT_ROWS = " UNION ALL ".join(
    f"SELECT split || '_at_threshold', '{f}', CAST({f} AS DOUBLE) FROM att" for f in promotion.CONFUSION
)
_SLICE_ROWS = " UNION ALL ".join(
    f"SELECT 'slice.' || slice, '{name}', CAST({expr} AS DOUBLE) FROM ck"
    for name, expr in (
        ("n", "n"), ("positives", "positives"), ("pr_auc", "pr_auc"),
        ("passed", "CASE status WHEN 'pass' THEN 1 WHEN 'fail' THEN 0 END"),
    )
)
PROMOTION_ROWS = f"""
    SELECT 'threshold_study' AS section, 'operating_threshold' AS name, threshold AS value FROM op
    UNION ALL SELECT 'threshold_study', 'precision', p FROM op
    UNION ALL SELECT 'threshold_study', 'recall', r FROM op
    UNION ALL SELECT 'threshold_study', 'f1', f FROM op
    UNION ALL {_AT_ROWS} UNION ALL {_SLICE_ROWS}
    UNION ALL SELECT 'gate', 'g1_beat_baseline', CAST(g1 AS DOUBLE) FROM gate
    UNION ALL SELECT 'gate', 'g2_precision_recall', CAST(g2 AS DOUBLE) FROM gate
    UNION ALL SELECT 'gate', 'g3_slices', CAST(g3 AS DOUBLE) FROM gate
    UNION ALL SELECT 'gate', 'promoted', CAST(g1 AND g2 AND g3 AS DOUBLE) FROM gate"""


@query(
    "promotion_report",
    sql.with_(
        "SELECT section, name, round(value, 6) AS value FROM pr",
        *PROMOTION_BLOCKS, **PROMOTION, pr=PROMOTION_ROWS,
    ),
)
def promotion_report(spark, sf):
    return rounded(promotion_rows(spark, sf), "value")


# --- explanations with fixed coefficients ----------------------------------------------------

# A hand-made linear model on eight features.
COEFFICIENTS = {
    "transaction_amt_log": 0.25,
    "card1_hist_fraud_rate": 1.5,
    "card1_hist_count": -0.4,
    "addr1_hist_count": 0.05,
    "card1_freq": -0.3,
    "n_identity_present": 0.2,
    "day_of_week": 0.1,
    "hour": 0.7,
}


def _value(name: str) -> str:
    return f"coalesce(CAST({name} AS DOUBLE), 0)"


_SCALING = "SELECT " + ", ".join(
    f"avg({_value(n)}) AS {n}_m, stddev_pop({_value(n)}) AS {n}_s" for n in COEFFICIENTS
) + " FROM feats WHERE split = 'train'"
_PARTS = " UNION ALL ".join(
    f"""SELECT transaction_id, '{n}' AS feature, {_value(n)} AS value,
    CASE WHEN {n}_s = 0 THEN 0 ELSE ({_value(n)} - {n}_m) / {n}_s * CAST({w} AS DOUBLE) END AS contribution
    FROM feats CROSS JOIN sc WHERE split = 'holdout'"""
    for n, w in COEFFICIENTS.items()
)
LINEAR = {"sc": _SCALING, "parts": _PARTS}


def linear_holdout(spark, sf):
    """Hold-out rows with the ``contributions`` of the fixed linear model."""
    feats = materialize(temporal_features(spark, sf), "features", ("split",))
    scaling = explaining.fit_standardizer(feats.where("split = 'train'"), list(COEFFICIENTS))
    return feats.where("split = 'holdout'").withColumn(
        "contributions", explaining.linear_contributions(COEFFICIENTS, scaling)
    )


@query(
    "linear_contributions",
    sql.with_("SELECT transaction_id, feature, round(contribution, 6) AS contribution FROM parts", "feats", **LINEAR),
)
def linear_contributions(spark, sf):
    rows = linear_holdout(spark, sf).select("transaction_id", F.inline("contributions"))
    return rounded(rows, "contribution").drop("value")


IMPORTANCE = "SELECT feature, avg(abs(contribution)) AS importance FROM parts GROUP BY feature"


@query(
    "global_importance",
    sql.with_(
        """SELECT feature, round(importance, 6) AS importance,
        CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS place FROM imp""",
        "feats", **LINEAR, imp=IMPORTANCE,
    ),
)
def global_importance(spark, sf):
    out = explaining.global_importance(linear_holdout(spark, sf), "contributions", list(COEFFICIENTS))
    return rounded(out, "importance")


_FACTORS = """SELECT transaction_id, feature, contribution, CAST(place AS INTEGER) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY round(contribution, 9) DESC, feature) AS place
    FROM parts) WHERE place <= 5"""


def _with_place(df, *keys):
    return df.select(*keys, F.posexplode("risk_factors").alias("pos", "f")).select(
        *keys, F.col("f.feature").alias("feature"), F.round("f.contribution", 6).alias("contribution"),
        (F.col("pos") + 1).alias("place"),
    )


def _nine_places(column):
    return F.transform(
        column,
        lambda c: F.struct(c["feature"].alias("feature"), F.round(c["contribution"], 9).alias("contribution"),
                           c["value"].alias("value")),
    )


@query(
    "risk_factors",
    sql.with_(
        "SELECT transaction_id, feature, round(round(contribution, 9), 6) AS contribution, place FROM fct",
        "feats", **LINEAR, fct=_FACTORS,
    ),
)
def risk_factors(spark, sf):
    factors = explaining.risk_factors(_nine_places(F.col("contributions")))
    rows = linear_holdout(spark, sf).select("transaction_id", factors.alias("risk_factors"))
    return _with_place(rows, "transaction_id")


@query(
    "explain_extremes",
    sql.with_(
        """SELECT extreme, e.transaction_id, feature, round(round(contribution, 9), 6) AS contribution, fct.place
        FROM ext e JOIN fct ON e.transaction_id = fct.transaction_id""",
        "feats", "scored", **LINEAR, fct=_FACTORS,
        ext="""SELECT extreme, transaction_id FROM (
            SELECT 'highest' AS extreme, row_number() OVER (ORDER BY score DESC, transaction_id) AS k, transaction_id
            FROM scored WHERE split = 'holdout' UNION ALL
            SELECT 'lowest', row_number() OVER (ORDER BY score, transaction_id), transaction_id
            FROM scored WHERE split = 'holdout') WHERE k <= 5""",
    ),
)
def explain_extremes(spark, sf):
    from riskloom.plans.serving import explain_extremes as extremes

    rows = linear_holdout(spark, sf).select(
        "transaction_id", testbed.integer_score().alias("score"),
        _nine_places(F.col("contributions")).alias("contributions"),
    )
    return _with_place(extremes(rows, "transaction_id"), "extreme", "transaction_id")
