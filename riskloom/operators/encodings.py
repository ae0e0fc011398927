"""Frequency, calendar, amount and identity features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import scalars as S
from riskloom.operators.joining import keys_long, lookup, with_row_key
from riskloom.schema import DEFAULT, TxnColumns
from riskloom.session import materialize


def frequency_counts(
    df: DataFrame,
    cols: TxnColumns = DEFAULT,
    keys: Sequence[str] | None = None,
    *,
    group: Sequence[str] = (),
) -> DataFrame:
    """Rows per value of each key column, nulls left out: ``key_type, key, freq``."""
    long = keys_long(df, tuple(keys or cols.frequency_keys), list(group))
    return (
        long.where(F.col("key").isNotNull())
        .groupBy(*group, "key_type", "key")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def frequency_columns(keys: Sequence[str]) -> list[Column]:
    """Aggregates that turn long counts of one id into ``<key>_freq`` columns."""
    return [
        F.coalesce(F.max(F.when(F.col("key_type") == k, F.col("freq"))), F.lit(0))
        .cast("long")
        .alias(f"{k}_freq")
        for k in keys
    ]


def spread_frequency(long: DataFrame, cols: TxnColumns, keys: Sequence[str]) -> DataFrame:
    return long.groupBy(cols.id).agg(*frequency_columns(keys))


def map_frequency(
    df: DataFrame,
    counts: DataFrame,
    cols: TxnColumns = DEFAULT,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """``frequency_counts`` of a fitting period joined onto rows; null or unseen values get 0.

    Ids may repeat or be missing: each row gets its own values.
    """
    keys = tuple(keys or cols.frequency_keys)
    stored = materialize(counts, "frequency")
    rows, by_row = with_row_key(df, cols)
    found = lookup(keys_long(rows, keys, [by_row.id]), stored, ["key_type", "key"])
    return rows.join(spread_frequency(found, by_row, keys), by_row.id, "left").select(*df.columns, *[f"{k}_freq" for k in keys])


def add_frequency(
    df: DataFrame, cols: TxnColumns = DEFAULT, keys: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fit counts on this frame and map them onto it; returns (frame, counts)."""
    counts = frequency_counts(df, cols, keys)
    return map_frequency(df, counts, cols, keys), counts


def identity_expressions(df: DataFrame, cols: TxnColumns = DEFAULT) -> dict[str, Column]:
    """Identity features for the identity columns the frame really has."""
    out: dict[str, Column] = {}
    identity = [c for c in df.columns if c.startswith(cols.identity_prefix)]
    if identity:
        present = F.lit(0)
        for c in identity:
            present = present + F.col(c).isNotNull().cast("int")
        out["n_identity_present"] = present
    if cols.os_source in df.columns:
        out["os_family"] = S.os_family(F.col(cols.os_source))
    if cols.browser_source in df.columns:
        out["browser_family"] = S.browser_family(F.col(cols.browser_source))
    for c in (cols.device_type, cols.device_info):
        if c in df.columns:
            out[c] = F.col(c).cast("string")
    return out


def row_expressions(df: DataFrame, cols: TxnColumns = DEFAULT) -> dict[str, Column]:
    """All features that need only the row itself, for one single projection."""
    return {
        **S.calendar(F.col(cols.time), cols.reference_time),
        **S.amount_parts(F.col(cols.amount), cols.amount),
        **identity_expressions(df, cols),
    }


def add_calendar(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    return df.withColumns(S.calendar(F.col(cols.time), cols.reference_time))


def add_amount(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    return df.withColumns(S.amount_parts(F.col(cols.amount), cols.amount))


def add_identity(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    new = identity_expressions(df, cols)
    return df.withColumns(new) if new else df
