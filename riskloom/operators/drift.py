"""Two-sample drift per column, on all rows or on an optional sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import safe_divide
from riskloom.operators.prefix import prior_sums_by_value
from riskloom.session import materialize
from riskloom.sources.tables import numeric_columns

# Cut-offs of this library.
DISTANCE_CUT = 0.1
P_VALUE_CUT = 0.05
DATASET_SHARE = 0.5
# Deviation below which a reference column counts as flat.
MIN_DEVIATION = 0.001


def drift_columns(reference: DataFrame, current: DataFrame, label: str) -> list[str]:
    """Numeric columns both frames have, the label left out, in reference order."""
    theirs = set(numeric_columns(current))
    return [c for c in numeric_columns(reference, [label]) if c in theirs]


def kolmogorov_p(d: Column, n: Column, m: Column, terms: int = 20) -> Column:
    """Asymptotic p-value of the two-sample Kolmogorov-Smirnov distance."""
    lam = d * F.sqrt(n.cast("double") * m.cast("double") / (n + m).cast("double"))
    series = F.lit(0.0)
    for k in range(1, terms + 1):
        series = series + F.lit(2.0 if k % 2 else -2.0) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
    # The alternating series needs many terms near zero, where the value is 1 anyway.
    return F.when(lam < 0.3, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def _deviations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.stddev_pop(F.col(c).cast("double")).alias("ref_std"),
                )
                for c in columns
            ]
        ).alias("s")
    ).select(F.inline("s"))


def _both_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    def long(df: DataFrame, side: str) -> DataFrame:
        typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        return typed.unpivot([], list(columns), "column_name", "value").select(
            "column_name",
            "value",
            F.lit(int(side == "ref")).cast("long").alias("ref"),
            F.lit(int(side == "cur")).cast("long").alias("cur"),
        )

    return long(reference, "ref").unionByName(long(current, "cur")).where(F.col("value").isNotNull() & ~F.isnan("value"))


def distances(reference: DataFrame, current: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """``n_ref, n_cur, ks, ks_p, w1, w1_norm`` per column, exactly.

    Both sides are unpivoted and combined into (column, value) counts before the shuffle; the
    distribution functions are running sums over distinct values. Nulls are left out.
    """
    counts = (
        _both_sides(reference, current, columns)
        .groupBy("column_name", "value")
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    )
    return _scaled(_compared(counts, **options), reference, columns)


def _compared(counts: DataFrame, **options) -> DataFrame:
    """``n_ref, n_cur, ks, w1`` per column of (column, value) counts of both sides."""
    ranked = prior_sums_by_value(counts, ["column_name"], "value", ["ref", "cur"], with_next=True, **options)
    gap = F.abs(
        safe_divide(F.col("before_ref") + F.col("ref"), F.col("total_ref"))
        - safe_divide(F.col("before_cur") + F.col("cur"), F.col("total_cur"))
    )
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    return ranked.groupBy("column_name").agg(
        F.max("total_ref").alias("n_ref"),
        F.max("total_cur").alias("n_cur"),
        F.max(gap).alias("ks"),
        F.sum(gap * width).alias("w1"),
    )


def _scaled(measured: DataFrame, reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    # One row per column on this side.
    scaled = measured.join(F.broadcast(_deviations(reference, columns)), "column_name")
    return scaled.select(
        "column_name",
        "n_ref",
        "n_cur",
        "ks",
        kolmogorov_p(F.col("ks"), F.col("n_ref"), F.col("n_cur")).alias("ks_p"),
        "w1",
        (F.col("w1") / F.greatest(F.col("ref_std"), F.lit(MIN_DEVIATION))).alias("w1_norm"),
    )


def rank_error(k: int) -> float:
    """Share of the rows by which a sketch's ranks may be off (published for these sketches, 99 % of the time)."""
    return 2.296 / k**0.9723


def sketched_distances(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], *, k: int = 2000, points: int = 500
) -> DataFrame:
    """The same from mergeable quantile sketches, with ``ks_error``, the most that ``ks`` may be off.

    One scan and one small row per task and side, whatever the rows and their distinct values are. Each side then
    stands for itself by ``points`` evenly spaced quantiles, whose distances are exact; so ``ks`` is off by no more
    than both sketches' rank errors and the steps between quantiles. A column without values on a side is left out.
    """
    ranks = F.array(*[F.lit((i + 0.5) / points) for i in range(points)])

    def sketches(df: DataFrame, side: str) -> DataFrame:
        value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        entries = [F.struct(F.lit(c).alias("column_name"), F.kll_sketch_agg_double(value(c), F.lit(k)).alias("s")) for c in columns]
        held = materialize(df.agg(F.array(*entries).alias("a")).select(F.inline("a")), "sketches")
        n = F.kll_sketch_get_n_double("s")
        # Guarded as well as filtered: an inferred filter may look at quantiles first, which an empty sketch has none of.
        quantiles = F.when(n > 0, F.kll_sketch_get_quantile_double("s", ranks))
        return held.select("column_name", n.alias(f"n_{side}"), quantiles.alias(f"q_{side}")).where(F.col(f"n_{side}") > 0)

    both = sketches(reference, "ref").join(sketches(current, "cur"), "column_name")
    one = lambda side, other: both.select("column_name", F.explode(f"q_{side}").alias("value"), F.lit(1).alias(side), F.lit(0).alias(other))
    counts = one("ref", "cur").unionByName(one("cur", "ref")).groupBy("column_name", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    measured = _compared(counts).drop("n_ref", "n_cur").join(both.select("column_name", "n_ref", "n_cur"), "column_name")
    return _scaled(measured, reference, columns).withColumn("ks_error", F.lit(2 * (rank_error(k) + 1.0 / points)))


def flagged(
    measured: DataFrame, *, method: str = "wasserstein", distance_cut: float = DISTANCE_CUT, p_value_cut: float = P_VALUE_CUT
) -> DataFrame:
    """``distances`` with the test that decides and whether it finds drift; the caller names the test."""
    if method not in ("wasserstein", "ks"):
        raise ValueError(f"unknown method: {method}")
    by_ks = method == "ks"
    found = F.col("ks_p") < p_value_cut if by_ks else F.col("w1_norm") >= distance_cut
    return measured.withColumns(
        {
            "method": F.lit(method),
            "cut_off": F.lit(p_value_cut if by_ks else distance_cut),
            "drift_detected": F.coalesce(found, F.lit(False)),
        }
    )


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    *,
    method: str = "wasserstein",
    form: str = "exact",
    distance_cut: float = DISTANCE_CUT,
    p_value_cut: float = P_VALUE_CUT,
    **options,
) -> DataFrame:
    """KS distance and p, and Wasserstein-1 over the reference deviation, per column.

    ``method`` is "wasserstein" or "ks". ``form`` is "exact" (``distances``) or "sketch" (``sketched_distances``, for
    hundreds of columns of continuous values): the caller names both, whatever the size.
    """
    if form not in ("exact", "sketch"):
        raise ValueError(f"unknown form: {form}")
    measure = distances if form == "exact" else sketched_distances
    return flagged(measure(reference, current, columns, **options), method=method, distance_cut=distance_cut, p_value_cut=p_value_cut)


def dataset_drift(per_column: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """Drifted and total columns and whether their share makes the data set drifted."""
    drifted = F.count_if(F.col("drift_detected"))
    total = F.count(F.lit(1))
    return per_column.agg(
        drifted.alias("drifted_columns"),
        total.alias("total_columns"),
        F.coalesce(safe_divide(drifted, total), F.lit(0.0)).alias("drift_share"),
    ).withColumn("dataset_drift", F.col("drift_share") >= share)
