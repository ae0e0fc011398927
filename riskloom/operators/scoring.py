"""Request checks, decisions and thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import scalars as S
from riskloom.operators.joining import lookup_feature_history
from riskloom.operators.ranking import DEFAULT_THRESHOLD
from riskloom.schema import DEFAULT, TxnColumns

# Upper ends of the low and the review band.
LOW_RISK_MAX = 0.20
REVIEW_MAX = 0.80


def bad_features(features: Column) -> Column:
    """Names in a feature map whose value is missing, not a number or infinite."""

    def unusable(value: Column) -> Column:
        number = value.try_cast("double")
        return number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))

    return F.transform(
        F.filter(F.map_entries(features), lambda e: unusable(e["value"])), lambda e: e["key"]
    )


def validate_finite(requests: DataFrame, features: str = "features") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) requests; accepted maps hold doubles, rejects name the bad features."""
    checked = requests.withColumn("bad_features", bad_features(F.col(features)))
    accepted = (
        checked.where(F.size("bad_features") == 0)
        .drop("bad_features")
        .withColumn(features, F.transform_values(features, lambda _, v: v.try_cast("double")))
    )
    return accepted, checked.where(F.size("bad_features") > 0)


def features_from_map(
    requests: DataFrame, columns: Sequence[str], carry: Sequence[str] = (), features: str = "features"
) -> DataFrame:
    """A feature map as the model's columns: unknown names dropped, missing ones 0 in each row."""
    return requests.select(
        *carry, *[S.zero_if_missing(F.try_element_at(F.col(features), F.lit(c))).alias(c) for c in columns]
    )


def decide(score: Column, threshold: float | Column) -> Column:
    """``review`` at or above the threshold, ``allow`` below it."""
    return F.when(score >= threshold, "review").otherwise("allow")


def decision_band(score: Column, low_max: float = LOW_RISK_MAX, review_max: float = REVIEW_MAX) -> Column:
    return F.when(score <= low_max, "low").when(score <= review_max, "review").otherwise("high")


def operating_threshold(report: DataFrame, default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row ``threshold`` from a promotion report, or the default where it has none."""
    found = F.max(F.when(F.col("name") == "operating_threshold", F.col("value")))
    return report.agg(F.coalesce(found, F.lit(default)).alias("threshold"))


def recompute_features(
    requests: DataFrame, history: DataFrame, cols: TxnColumns = DEFAULT, amount: str | None = None
) -> DataFrame:
    """Refresh history and amount features of raw requests and record where each value comes from.

    ``requests`` carries the raw entity keys and other features, which stay as they are. An unseen or absent entity
    gets zeros. The same call serves a batch and a stream. ``derivation`` has an entry per refreshed feature:
    ``feature, value, origin`` (``seen`` history, ``new`` entity, ``given`` in the request), the ``entity`` and the
    number of past ``rows`` behind it; a new entity has one entry for all its features.
    """
    out = requests
    entries: list[Column] = []
    for key in cols.online_keys:
        names = [f"{key}_hist_fraud_rate", f"{key}_hist_amt_mean", f"{key}_hist_count"]
        out = lookup_feature_history(out.drop(*names), history, key, key)
        rows = F.col(names[2])
        seen = [F.when(rows.isNotNull(), _entry(n, F.col(n), "seen", F.col(key), rows)) for n in names]
        unseen = F.when(rows.isNull(), _entry(names[0], F.lit(0.0), "new", F.col(key), F.lit(0)))
        entries += [unseen, *seen]
    refreshed = {
        f"{k}_hist_{p}": F.coalesce(F.col(f"{k}_hist_{p}").cast("double"), F.lit(0.0))
        for k in cols.online_keys
        for p in ("fraud_rate", "amt_mean", "count")
    }
    if amount is not None:
        raw = F.col(amount).cast("double")
        entries.append(F.when(raw.isNotNull(), _entry(cols.amount, raw, "given", F.lit(None), F.lit(None))))
        for name, value in {cols.amount: raw, **S.amount_parts(raw, cols.amount)}.items():
            # An amount that is not given leaves the old feature in place.
            refreshed[name] = F.coalesce(value, F.col(name)) if name in out.columns else value
    return out.withColumn("derivation", F.array_compact(F.array(*entries))).withColumns(refreshed)


def _entry(feature: str, value: Column, origin: str, entity: Column, rows: Column) -> Column:
    return F.struct(
        F.lit(feature).alias("feature"),
        value.cast("double").alias("value"),
        F.lit(origin).alias("origin"),
        entity.cast("string").alias("entity"),
        rows.cast("long").alias("rows"),
    )
