"""Structural checks of a joined frame: one aggregate pass and one duplicate pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schema import DEFAULT, TxnColumns

STAGES = ("train", "test")
LOW_COVERAGE = 0.1


class ValidationError(ValueError):
    """At least one hard check failed."""


def _required(stage: str, cols: TxnColumns) -> tuple[str, ...]:
    if stage not in STAGES:
        raise ValueError(f"unknown stage: {stage}")
    return cols.required_with_label if stage == "train" else cols.required


def check_required_columns(df: DataFrame, stage: str, cols: TxnColumns = DEFAULT) -> DataFrame:
    """One row per required column: present or not, and its filled rows."""
    entries = []
    for name in _required(stage, cols):
        present = name in df.columns
        filled = F.count(name) if present else F.lit(0).cast("long")
        entries.append(
            F.struct(
                F.lit(stage).alias("stage"),
                F.lit(name).alias("column_name"),
                F.lit(present).alias("present"),
                filled.alias("filled_rows"),
            )
        )
    return df.agg(F.array(*entries).alias("c"), F.count(F.lit(1)).alias("n")).select(F.inline("c"))


def duplicate_keys(df: DataFrame, key: tuple[str, ...] | None = None, cols: TxnColumns = DEFAULT) -> DataFrame:
    """One row: distinct keys that occur more than once (two nulls count) and the rows they hold.

    Counts are combined before the shuffle, so a hot duplicate costs one row per task.
    """
    repeated = df.groupBy(*(key or (cols.id,))).count().where(F.col("count") > 1)
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("duplicate_rows"),
    )


def statistics(df: DataFrame, cols: TxnColumns = DEFAULT) -> dict[str, Column]:
    """Every aggregate of the report that one scan can answer."""
    out: dict[str, Column] = {"rows": F.count(F.lit(1))}
    if cols.time in df.columns:
        out["min_time"] = F.min(cols.time)
    if cols.amount in df.columns:
        out["non_positive_amounts"] = F.count_if(F.col(cols.amount) <= 0)
    if cols.label in df.columns:
        y = F.col(cols.label)
        out["bad_labels"] = F.count_if(y.isNull() | ~y.isin(0, 1))
        out["fraud_rate"] = F.round(F.avg(y), 6)
        out["n_positives"] = F.sum(y).cast("long")
    if cols.device_type in df.columns:
        out["identity_coverage"] = safe_share(F.count(cols.device_type), F.count(F.lit(1)))
    return out


def safe_share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), 4)


def validation_report(
    df: DataFrame, stage: str, cols: TxnColumns = DEFAULT, checks: Sequence[str] | None = None
) -> DataFrame:
    """All findings, or those of some ``checks``, as rows ``stage, check_name, severity, status, value``.

    ``severity`` is error, warning or stat; ``status`` is pass or fail (stats always pass).
    A missing label on the train stage is reported twice, as a missing column and as a
    missing target.
    """
    required = _required(stage, cols)
    missing = [c for c in required if c not in df.columns]
    stats = statistics(df, cols)
    n_columns = len(df.columns)

    def row(name: str, severity: str, failed: Column, value: Column) -> Column:
        names.append(name)
        return F.struct(
            F.lit(stage).alias("stage"),
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            F.when(failed, "fail").otherwise("pass").alias("status"),
            value.cast("double").alias("value"),
        )

    ok = F.lit(False)
    names: list[str] = []
    entries = [row("required_columns", "error", F.lit(bool(missing)), F.lit(len(missing)))]
    if cols.time in df.columns:
        entries.append(row("time_range", "error", F.col("min_time") < 0, F.col("min_time")))
    if cols.amount in df.columns:
        bad = F.col("non_positive_amounts")
        entries.append(row("amount_positive", "error", bad > 0, bad))
    if stage == "train":
        if cols.label in df.columns:
            bad = F.col("bad_labels")
            entries += [
                row("label_domain", "error", bad > 0, bad),
                row("fraud_rate", "stat", ok, F.col("fraud_rate")),
                row("n_positives", "stat", ok, F.col("n_positives")),
            ]
        else:
            entries.append(row("label_present", "error", F.lit(True), F.lit(1)))
    if cols.device_type in df.columns:
        cov = F.col("identity_coverage")
        entries += [
            row("identity_coverage_low", "warning", cov < LOW_COVERAGE, cov),
            row("identity_coverage", "stat", ok, cov),
        ]
    entries += [
        row("rows", "stat", ok, F.col("rows")),
        row("n_columns", "stat", ok, F.lit(n_columns)),
    ]
    wanted = [e for name, e in zip(names, entries, strict=True) if checks is None or name in checks]
    one = df.agg(*[c.alias(n) for n, c in stats.items()])
    report = one.select(F.inline(F.array(*(wanted or entries))))
    if not wanted:
        report = report.limit(0)
    if cols.id in df.columns and (checks is None or "unique_key" in checks):
        dup = F.col("duplicate_keys")
        unique = duplicate_keys(df, cols=cols).select(
            F.inline(F.array(row("unique_key", "error", dup > 0, dup)))
        )
        report = report.unionByName(unique)
    return report


def raise_on_errors(report: DataFrame) -> None:
    """Strict mode: gather every failed hard check, then raise once."""
    failed = report.where("severity = 'error' AND status = 'fail'").orderBy("check_name").collect()
    if failed:
        text = "; ".join(f"{r['check_name']} ({r['value']:g})" for r in failed)
        raise ValidationError(f"validation failed [{failed[0]['stage']}]: {text}")
