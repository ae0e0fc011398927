"""Drift, monitoring, request checks and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import sql
from riskloom.catalog.evaluating import rounded
from riskloom.catalog.registry import query
from riskloom.catalog.relational import COLS, scored, with_split
from riskloom.operators import drift, encodings, monitoring, ranking, scoring
from riskloom.plans import promotion
from riskloom.session import materialize
from riskloom.sources import testbed

_DRIFT_COLUMNS = (
    "transaction_id", "transaction_dt", "transaction_amt", "id_01", "DT_M", "DT_W", "DT_D", "hour",
    "day_of_week", "is_weekend", "transaction_amt_log", "transaction_amt_cents", "n_identity_present",
)


def _sides(spark, sf):
    rows = with_split(spark, sf)
    rows = rows.withColumns(encodings.row_expressions(rows, COLS))
    return rows.where("split = 'train'"), rows.where("split = 'holdout'")


@query(
    "drift_columns",
    sql.with_(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(\"{c}\") AS filled FROM d WHERE split = 'train'" for c in _DRIFT_COLUMNS
        ),
        "sp",
        d=f"SELECT *, {sql.CALENDAR}, {sql.AMOUNT}, {sql.N_IDENTITY} AS n_identity_present FROM sp",
    ),
)
def drift_columns(spark, sf):
    train, holdout = _sides(spark, sf)
    names = drift.drift_columns(train, holdout, "is_fraud")
    return train.agg(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.count(c).alias("filled")) for c in names]).alias("a")
    ).select(F.inline("a"))


_LONG = " UNION ALL ".join(
    f"SELECT split, '{c}' AS column_name, CAST(\"{c}\" AS DOUBLE) AS value FROM d WHERE \"{c}\" IS NOT NULL"
    for c in _DRIFT_COLUMNS
)
_KS_P = "least(1, greatest(0, " + " + ".join(
    f"({2 if k % 2 else -2}) * exp(-2 * {k * k} * lam * lam)" for k in range(1, 21)
) + "))"
DRIFT = {
    "d": f"""SELECT *, {sql.CALENDAR}, {sql.RAW_AMOUNT}, {sql.N_IDENTITY} AS n_identity_present FROM sp WHERE split IN ('train', 'holdout')""",
    "l": _LONG,
    "v": """SELECT column_name, value, count(*) FILTER (WHERE split = 'train') AS a,
        count(*) FILTER (WHERE split = 'holdout') AS b FROM l GROUP BY column_name, value""",
    "cum": """SELECT column_name, value, sum(a) OVER w AS ca, sum(b) OVER w AS cb,
        sum(a) OVER (PARTITION BY column_name) AS na, sum(b) OVER (PARTITION BY column_name) AS nb,
        lead(value) OVER w0 AS nxt FROM v
        WINDOW w AS (PARTITION BY column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               w0 AS (PARTITION BY column_name ORDER BY value)""",
    "gap": """SELECT *, abs(CAST(ca AS DOUBLE) / na - CAST(cb AS DOUBLE) / nb) AS g FROM cum""",
    "m": """SELECT column_name, CAST(max(na) AS BIGINT) AS n_ref, CAST(max(nb) AS BIGINT) AS n_cur, max(g) AS ks,
        sum(g * coalesce(nxt - value, 0)) AS w1 FROM gap GROUP BY column_name""",
    "sd": "SELECT column_name, stddev_pop(value) AS s FROM l WHERE split = 'train' GROUP BY column_name",
    "dr": f"""SELECT column_name, n_ref, n_cur, ks, CASE WHEN lam < 0.3 THEN 1 ELSE {_KS_P} END AS ks_p,
        w1 / greatest(s, 0.001) AS w1_norm
        FROM (SELECT m.*, sd.s, ks * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) AS lam
              FROM m JOIN sd ON m.column_name = sd.column_name)""",
}


def _column_drift(spark, sf, **options):
    train, holdout = _sides(spark, sf)
    return drift.column_drift(train, holdout, drift.drift_columns(train, holdout, "is_fraud"), **options)


@query(
    "column_drift",
    sql.with_(
        """SELECT column_name, n_ref, n_cur, round(ks, 6) AS ks, round(ks_p, 6) AS ks_p,
        round(w1_norm, 6) AS w1_norm, 'wasserstein' AS method, CAST(0.1 AS DOUBLE) AS cut_off,
        w1_norm >= 0.1 AS drift_detected FROM dr""",
        "sp", **DRIFT,
    ),
)
def column_drift(spark, sf):
    return rounded(_column_drift(spark, sf), "ks", "ks_p", "w1_norm").drop("w1")


@query(
    "dataset_drift",
    sql.with_(
        """SELECT count(*) FILTER (WHERE ks_p < 0.05) AS drifted_columns, count(*) AS total_columns,
        round(CAST(count(*) FILTER (WHERE ks_p < 0.05) AS DOUBLE) / count(*), 6) AS drift_share,
        CAST(count(*) FILTER (WHERE ks_p < 0.05) AS DOUBLE) / count(*) >= 0.5 AS dataset_drift, 'ks' AS method FROM dr
        UNION ALL
        SELECT count(*) FILTER (WHERE w1_norm >= 0.1), count(*),
        round(CAST(count(*) FILTER (WHERE w1_norm >= 0.1) AS DOUBLE) / count(*), 6),
        CAST(count(*) FILTER (WHERE w1_norm >= 0.1) AS DOUBLE) / count(*) >= 0.5, 'wasserstein' FROM dr""",
        "sp", **DRIFT,
    ),
)
def dataset_drift(spark, sf):
    train, holdout = _sides(spark, sf)
    measured = materialize(drift.distances(train, holdout, drift.drift_columns(train, holdout, "is_fraud")), "drift")
    by = [drift.dataset_drift(drift.flagged(measured, method=m)).withColumn("method", F.lit(m)) for m in ("ks", "wasserstein")]
    return rounded(by[0].unionByName(by[1]), "drift_share")


@query(
    "column_drift_sketch",
    sql.with_(
        """SELECT column_name, n_ref, n_cur, true AS ks_within_error, true AS w1_close, w1_norm >= 0.1 AS drift_detected FROM dr""",
        "sp", **DRIFT,
    ),
)
def column_drift_sketch(spark, sf):
    """Drift from sketches, beside the exact distances."""
    train, holdout = _sides(spark, sf)
    columns = drift.drift_columns(train, holdout, "is_fraud")
    exact = drift.distances(train, holdout, columns).select("column_name", F.col("ks").alias("true_ks"), F.col("w1_norm").alias("true_w1"))
    rough = drift.column_drift(train, holdout, columns, form="sketch").join(exact, "column_name")
    return rough.select(
        "column_name", "n_ref", "n_cur",
        (F.abs(F.col("ks") - F.col("true_ks")) <= F.col("ks_error")).alias("ks_within_error"),
        (F.abs(F.col("w1_norm") - F.col("true_w1")) <= 0.02 + 0.02 * F.col("true_w1")).alias("w1_close"),
        "drift_detected",
    )


@query(
    "decision_counts",
    sql.with_(
        """SELECT split, CASE WHEN score >= 0.5 THEN 'review' ELSE 'allow' END AS decision, count(*) AS n
        FROM scored GROUP BY 1, 2""",
        "scored",
    ),
)
def decision_counts(spark, sf):
    rows = scored(spark, sf).withColumn("decision", scoring.decide(F.col("score"), 0.5))
    return monitoring.decision_counts(rows, ["split"])


_BUCKETS = [*monitoring.SCORE_BUCKETS, "'Infinity'"]


@query(
    "score_histogram",
    sql.with_(
        " UNION ALL ".join(
            f"""SELECT split, CAST({b} AS DOUBLE) AS le,
            count(*) FILTER (WHERE score <= CAST({b} AS DOUBLE)) AS n FROM scored GROUP BY split"""
            for b in _BUCKETS
        ),
        "scored",
    ),
)
def score_histogram(spark, sf):
    return monitoring.score_histogram(scored(spark, sf), ["split"])


_WIDE = ("transaction_id", "transaction_dt", "transaction_amt", "is_fraud", "card1", "addr1", "p_emaildomain",
         "device_type", "device_info", "id_01", "id_30", "id_31")


@query(
    "missingness",
    sql.with_(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS missing,
            round(CAST(count(*) - count({c}) AS DOUBLE) / count(*), 6) AS missing_share FROM jnd"""
            for c in _WIDE
        ),
        "jnd",
    ),
)
def missingness(spark, sf):
    return monitoring.missingness(testbed.joined(spark, sf), _WIDE)


_ARRIVED = "(transaction_id * 31) % 10 < 7"


@query(
    "delayed_label_performance",
    sql.with_(
        f"""SELECT period, round({sql.AP}, 6) AS pr_auc, round({sql.AUC}, 6) AS roc_auc,
        CAST(sum(n) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives FROM c GROUP BY period""",
        "scored",
        known=f"SELECT CAST(year({sql.EVENT_TIME}) AS INTEGER) AS period, label, score FROM scored WHERE {_ARRIVED}",
        c=sql.curve("known", "period"),
    ),
)
def delayed_label_performance(spark, sf):
    from riskloom.functions.scalars import event_time

    rows = scored(spark, sf)
    year = F.year(event_time(F.col("transaction_dt"), COLS.reference_time))
    predictions = rows.select("transaction_id", "score", year.alias("period"))
    # Labels of seven in ten transactions have come in.
    labels = rows.where(F.pmod(F.col("transaction_id") * 31, F.lit(10)) < 7).select("transaction_id", "label")
    out = monitoring.delayed_label_performance(predictions, labels, "transaction_id", "period")
    return rounded(out, "pr_auc", "roc_auc")


# --- requests and decisions ------------------------------------------------------------------


@query(
    "validate_finite",
    """SELECT event_id, value AS amount, CAST(NULL AS VARCHAR) AS bad_features, true AS accepted FROM events
    WHERE NOT (event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0)
    UNION ALL
    SELECT event_id, value, concat_ws(',',
        CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'extra' END, CASE WHEN event_id % 13 = 0 THEN 'ratio' END), false
    FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0""",
)
def validate_finite(spark, sf):
    eid = F.col("event_id")
    events = spark.read.parquet(f"{sf}/events.parquet")
    requests = events.select(
        "event_id",
        F.create_map(
            F.lit("amount"), F.col("value").cast("string"),
            # JSON text is not a number; NaN and infinity are, but not finite ones.
            F.lit("extra"),
            F.when(F.pmod(eid, F.lit(7)) == 0, F.col("props"))
            .when(F.pmod(eid, F.lit(11)) == 0, "NaN").otherwise(eid.cast("string")),
            F.lit("ratio"),
            F.when(F.pmod(eid, F.lit(13)) == 0, "-Infinity").otherwise("0.5"),
        ).alias("features"),
    )
    accepted, rejected = scoring.validate_finite(requests)
    return accepted.select(
        "event_id", F.col("features")["amount"].alias("amount"), F.lit(None).cast("string").alias("bad_features"),
        F.lit(True).alias("accepted"),
    ).unionByName(
        rejected.select(
            "event_id", F.col("features")["amount"].try_cast("double").alias("amount"),
            F.array_join("bad_features", ",").alias("bad_features"), F.lit(False).alias("accepted"),
        )
    )


@query(
    "decide",
    sql.with_(
        """SELECT transaction_id, CASE WHEN score >= CAST(648 AS DOUBLE) / CAST(1297 AS DOUBLE) THEN 'review'
        ELSE 'allow' END AS decision FROM scored""",
        "scored",
    ),
)
def decide(spark, sf):
    # A cut that is itself a score, so the boundary is met.
    return scored(spark, sf).select(
        "transaction_id", scoring.decide(F.col("score"), 648.0 / 1297.0).alias("decision")
    )


@query(
    "operating_threshold",
    sql.with_(
        """SELECT 'with_report' AS source, (SELECT score FROM fs WHERE split = 'validation' ORDER BY f DESC, score LIMIT 1) AS threshold
        UNION ALL SELECT 'without_report', CAST(0.5 AS DOUBLE)""",
        "scored", c=sql.curve("scored", "split"),
        fs=f"SELECT *, {sql.f1('p', 'r')} AS f FROM (SELECT *, {sql.PRECISION} AS p, {sql.RECALL} AS r FROM c)",
    ),
)
def operating_threshold(spark, sf):
    study = ranking.threshold_by_f1(scored(spark, sf).where("split = 'validation'"))
    report = promotion.as_rows(
        study.withColumnRenamed("threshold", "operating_threshold"), "threshold_study", ["operating_threshold", "f1"]
    )
    other = report.where("name = 'f1'")
    return (
        scoring.operating_threshold(report).select(F.lit("with_report").alias("source"), "threshold")
        .unionByName(scoring.operating_threshold(other).select(F.lit("without_report").alias("source"), "threshold"))
    )


@query(
    "decision_bands",
    sql.with_(
        """SELECT transaction_id, CASE WHEN score <= 0.20 THEN 'low' WHEN score <= 0.80 THEN 'review' ELSE 'high' END AS band
        FROM scored""",
        "scored",
    ),
)
def decision_bands(spark, sf):
    return scored(spark, sf).select("transaction_id", scoring.decision_band(F.col("score")).alias("band"))
