"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import sql
from riskloom.catalog.registry import ORACLES, query, steady
from riskloom.catalog.relational import (
    COLS,
    KEYS,
    ROUNDED_HISTORY_SQL,
    boundaries,
    interim,
    rounded_history,
)
from riskloom.functions import scalars as S
from riskloom.operators import encodings, history, scoring, splitting
from riskloom.plans import features as feature_plans
from riskloom.sources import testbed


@query(
    "safe_divide",
    sql.with_(
        "SELECT transaction_id, CAST(transaction_amt AS DOUBLE) / nullif(is_fraud, 0) AS quotient FROM txn", "txn"
    ),
)
def safe_divide(spark, sf):
    return testbed.transactions(spark, sf).select(
        "transaction_id", S.safe_divide(F.col("transaction_amt"), F.col("is_fraud")).alias("quotient")
    )


@query("calendar_features", sql.with_(f"SELECT transaction_id, {sql.CALENDAR} FROM txn", "txn"))
def calendar_features(spark, sf):
    out = encodings.add_calendar(testbed.transactions(spark, sf), COLS)
    return out.select("transaction_id", *S.calendar(F.col("transaction_dt"), COLS.reference_time))


@query("amount_features", sql.with_(f"SELECT transaction_id, {sql.AMOUNT} FROM txn", "txn"))
def amount_features(spark, sf):
    names = ("transaction_amt_log", "transaction_amt_cents")
    out = encodings.add_amount(testbed.transactions(spark, sf), COLS)
    return out.select("transaction_id", *[F.round(n, 6).alias(n) for n in names])


def _history(spark, sf, **options):
    rows = testbed.transactions(spark, sf)
    n_rows = testbed.transactions(spark, sf, address=False).count()
    return history.spread_history(history.history_long(rows, COLS, **options), COLS, KEYS, n_rows)


@query(
    "entity_hist_count",
    sql.with_(
        "SELECT transaction_id, "
        + ", ".join(f"{sql.prior('count(*)', k)} AS {k}_hist_count" for k in KEYS)
        + " FROM txn",
        "txn",
    ),
)
def entity_hist_count(spark, sf):
    return _history(spark, sf).select("transaction_id", *[f"{k}_hist_count" for k in KEYS])


@query(
    "entity_hist_fraud_rate",
    sql.with_(
        "SELECT transaction_id, "
        + ", ".join(f"round({sql.prior_rate(k)}, 6) AS {k}_hist_fraud_rate" for k in KEYS)
        + " FROM txn",
        "txn",
    ),
)
def entity_hist_fraud_rate(spark, sf):
    names = [f"{k}_hist_fraud_rate" for k in KEYS]
    return _history(spark, sf).select("transaction_id", *[F.round(n, 6).alias(n) for n in names])


@query(
    "entity_hist_amt_mean",
    sql.with_(
        "SELECT transaction_id, "
        + ", ".join(f"{sql.steady(sql.prior_mean(k))} AS {k}_hist_amt_mean" for k in KEYS)
        + " FROM txn",
        "txn",
    ),
)
def entity_hist_amt_mean(spark, sf):
    names = [f"{k}_hist_amt_mean" for k in KEYS]
    return _history(spark, sf).select("transaction_id", *[steady(F.col(n)).alias(n) for n in names])


# The same histories, large groups cut into ranges: any key above this many rows counts as large.
CUT_ABOVE = 100


@query("entity_hist_cut", ORACLES["entity_hist_count"])
def entity_hist_cut(spark, sf):
    return _history(spark, sf, cell_rows=CUT_ABOVE).select("transaction_id", *[f"{k}_hist_count" for k in KEYS])


def _strict(what: str, k: str) -> str:
    return (
        f"{what} OVER (PARTITION BY coalesce({k}, {sql.MISSING}) ORDER BY transaction_dt"
        " RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )


@query(
    "entity_hist_strict",
    sql.with_(
        "SELECT transaction_id, "
        + ", ".join(
            f"{_strict('count(*)', k)} AS {k}_hist_count,"
            f" round(CAST({_strict('sum(is_fraud)', k)} AS DOUBLE) / nullif({_strict('count(*)', k)}, 0), 6)"
            f" AS {k}_hist_fraud_rate,"
            f" {sql.steady(_strict('sum(transaction_amt)', k) + ' / nullif(' + _strict('count(*)', k) + ', 0)')}"
            f" AS {k}_hist_amt_mean"
            for k in KEYS
        )
        + " FROM txn",
        "txn",
    ),
)
def entity_hist_strict(spark, sf):
    return rounded_history(_history(spark, sf, strict=True))


@query("entity_hist_strict_cut", ORACLES["entity_hist_strict"])
def entity_hist_strict_cut(spark, sf):
    return rounded_history(_history(spark, sf, strict=True, cell_rows=CUT_ABOVE))


@query(
    "entity_aggregates",
    sql.with_(
        f"""SELECT key_type, key, round(avg(is_fraud), 6) AS fraud_rate,
        {sql.steady('avg(transaction_amt)')} AS amt_mean, count(*) AS cnt FROM l GROUP BY key_type, key""",
        "txn",
        l=sql.long_keys("txn", KEYS, "is_fraud, transaction_amt", True),
    ),
)
def entity_aggregates(spark, sf):
    out = history.entity_aggregates(testbed.transactions(spark, sf), COLS)
    return out.select(
        "key_type", "key", F.round("fraud_rate", 6).alias("fraud_rate"),
        steady(F.col("amt_mean")).alias("amt_mean"), "cnt",
    )


@query(
    "frequency_counts",
    sql.with_(
        "SELECT key_type, key, count(*) AS freq FROM l WHERE key IS NOT NULL GROUP BY key_type, key",
        "jnd",
        l=sql.long_keys("jnd", COLS.frequency_keys, "transaction_id", False),
    ),
)
def frequency_counts(spark, sf):
    return encodings.frequency_counts(testbed.joined(spark, sf), COLS)


@query("identity_count", sql.with_(f"SELECT transaction_id, {sql.N_IDENTITY} AS n_identity_present FROM jnd", "jnd"))
def identity_count(spark, sf):
    return encodings.add_identity(testbed.joined(spark, sf), COLS).select("transaction_id", "n_identity_present")


@query("os_family", sql.with_(f"SELECT transaction_id, {sql.OS_FAMILY} AS os_family FROM jnd", "jnd"))
def os_family(spark, sf):
    return encodings.add_identity(testbed.joined(spark, sf), COLS).select("transaction_id", "os_family")


@query("browser_family", sql.with_(f"SELECT transaction_id, {sql.BROWSER_FAMILY} AS browser_family FROM jnd", "jnd"))
def browser_family(spark, sf):
    return encodings.add_identity(testbed.joined(spark, sf), COLS).select("transaction_id", "browser_family")


@query(
    "device_as_string",
    sql.with_(
        """SELECT transaction_id, CAST(device_type AS VARCHAR) AS device_type,
        CAST(device_info AS VARCHAR) AS device_info FROM jnd""",
        "jnd",
    ),
)
def device_as_string(spark, sf):
    return encodings.add_identity(testbed.joined(spark, sf), COLS).select(
        "transaction_id", "device_type", "device_info"
    )


FEATURE_SQL = (
    f"transaction_id, split, is_fraud, {ROUNDED_HISTORY_SQL}, "
    + ", ".join(f"{k}_freq" for k in COLS.frequency_keys)
    + ', "DT_M", "DT_W", "DT_D", hour, day_of_week, is_weekend,'
    + " round(transaction_amt_log, 6) AS transaction_amt_log, round(transaction_amt_cents, 6) AS transaction_amt_cents,"
    + f" n_identity_present, {sql.OS_FAMILY} AS os_family, {sql.BROWSER_FAMILY} AS browser_family"
)


def _feature_view(df):
    rounded = [F.round(n, 6).alias(n) for n in ("transaction_amt_log", "transaction_amt_cents")]
    hist = []
    for k in KEYS:
        hist += [
            f"{k}_hist_count",
            F.round(f"{k}_hist_fraud_rate", 6).alias(f"{k}_hist_fraud_rate"),
            steady(F.col(f"{k}_hist_amt_mean")).alias(f"{k}_hist_amt_mean"),
        ]
    return df.select(
        "transaction_id", "split", "is_fraud", *hist, *feature_plans.frequency_names(COLS),
        "DT_M", "DT_W", "DT_D", "hour", "day_of_week", "is_weekend", *rounded,
        "n_identity_present", "os_family", "browser_family",
    )


@query("build_train_features", sql.with_(f"SELECT {FEATURE_SQL} FROM feats WHERE split = 'train'", "feats"))
def build_train_features(spark, sf):
    t1, _ = boundaries(spark, sf)
    train = splitting.period_filter(interim(spark, sf), until=t1, cols=COLS)
    out, _ = feature_plans.build_train_features(train, COLS)
    return _feature_view(out.withColumn("split", F.lit("train")))


@query("build_test_features", sql.with_(f"SELECT {FEATURE_SQL} FROM feats WHERE split = 'validation'", "feats"))
def build_test_features(spark, sf):
    t1, t2 = boundaries(spark, sf)
    rows = interim(spark, sf)
    _, artifacts = feature_plans.build_train_features(
        splitting.period_filter(rows, until=t1, cols=COLS), COLS
    )
    later = splitting.period_filter(rows, after=t1, until=t2, cols=COLS)
    out = feature_plans.build_test_features(later, artifacts, COLS)
    return _feature_view(out.withColumn("split", F.lit("validation")))


def temporal_features(spark, sf):
    return feature_plans.build_temporal_splits(interim(spark, sf), *boundaries(spark, sf), COLS)


@query("build_temporal_splits", sql.with_(f"SELECT {FEATURE_SQL} FROM feats", "feats"))
def build_temporal_splits(spark, sf):
    return _feature_view(temporal_features(spark, sf))


@query(
    "materialize_feature_history",
    sql.with_(
        f"""SELECT key_type, key, round(avg(is_fraud), 6) AS fraud_rate,
        {sql.steady('avg(transaction_amt)')} AS amt_mean, count(*) AS cnt
        FROM l WHERE key IS NOT NULL GROUP BY key_type, key""",
        "txn",
        l=sql.long_keys("txn", COLS.online_keys, "is_fraud, transaction_amt", False),
    ),
)
def materialize_feature_history(spark, sf):
    out = history.feature_history(testbed.transactions(spark, sf), COLS)
    return out.select(
        "key_type", "key", F.round("fraud_rate", 6).alias("fraud_rate"),
        steady(F.col("amt_mean")).alias("amt_mean"), "cnt",
    )


def _online(k: str) -> str:
    return (
        f"coalesce(round({k}_h.r, 6), 0) AS {k}_hist_fraud_rate, coalesce({sql.steady(f'{k}_h.a')}, 0)"
        f" AS {k}_hist_amt_mean, CAST(coalesce({k}_h.c, 0) AS DOUBLE) AS {k}_hist_count"
    )


def _online_join(k: str) -> str:
    return (
        f"LEFT JOIN (SELECT {k}, avg(is_fraud) AS r, avg(transaction_amt) AS a, count(*) AS c FROM sp"
        f" WHERE split = 'train' AND {k} IS NOT NULL GROUP BY {k}) {k}_h ON t.{k} = {k}_h.{k}"
    )


@query(
    "recompute_features",
    sql.with_(
        f"""SELECT t.transaction_id, {_online('card1')}, {_online('addr1')}, t.transaction_amt,
        {sql.AMOUNT.replace('transaction_amt', 't.transaction_amt').replace('AS t.', 'AS ')},
        CAST(1 AS DOUBLE) AS untouched,
        CAST(1 + CASE WHEN card1_h.c IS NULL THEN 1 ELSE 3 END + CASE WHEN addr1_h.c IS NULL THEN 1 ELSE 3 END
             AS INTEGER) AS notes
        FROM txn t {_online_join('card1')} {_online_join('addr1')}""",
        "sp",
    ),
)
def recompute_features(spark, sf):
    t1, _ = boundaries(spark, sf)
    rows = testbed.transactions(spark, sf)
    table = history.feature_history(splitting.period_filter(rows, until=t1, cols=COLS), COLS)
    requests = rows.select(
        "transaction_id", "card1", "addr1", F.col("transaction_amt").alias("new_amount"),
        F.lit(0.0).alias("transaction_amt"), F.lit(1.0).alias("untouched"),
    )
    out = scoring.recompute_features(requests, table, COLS, "new_amount")
    names = [f"{k}_hist_fraud_rate" for k in COLS.online_keys] + ["transaction_amt_log", "transaction_amt_cents"]
    means = [f"{k}_hist_amt_mean" for k in COLS.online_keys]
    return out.select(
        "transaction_id",
        *[F.round(n, 6).alias(n) for n in names],
        # An unseen entity's mean is a plain 0, which the shift would leave at 0 as well.
        *[steady(F.col(m)).alias(m) for m in means],
        *[f"{k}_hist_count" for k in COLS.online_keys],
        "transaction_amt",
        "untouched",
        F.size("derivation").alias("notes"),
    )


@query(
    "leakage_check",
    sql.with_(
        " UNION ALL ".join(
            f"""SELECT '{k}' AS key_type, count(*) AS n_rows, CAST(0 AS BIGINT) AS mismatches,
            round(corr(is_fraud, r), 6) AS rate_label_corr
            FROM (SELECT is_fraud, {sql.prior_rate(k)} AS r FROM txn)"""
            for k in KEYS
        ),
        "txn",
    ),
)
def leakage_check(spark, sf):
    out = history.leakage_check(testbed.transactions(spark, sf), COLS)
    return out.select("key_type", "n_rows", "mismatches", F.round("rate_label_corr", 6).alias("rate_label_corr"))
