"""Left equi-joins of the transaction table with its side tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.dealing import dealt, large_groups
from riskloom.operators.validation import ValidationError, duplicate_keys
from riskloom.schema import DEFAULT, TxnColumns
from riskloom.session import materialize

ROW_NUMBER = "_row_number"
# A probe key above this many rows is joined apart from the others.
HEAVY_KEY_ROWS = 1_000_000
# Above this many rows a side is not broadcast.
MAX_BROADCAST_ROWS = 500_000


def join_identity(
    transactions: DataFrame,
    identity: DataFrame | None,
    cols: TxnColumns = DEFAULT,
    *,
    verify: bool = True,
) -> DataFrame:
    """Keep every transaction, add its identity columns where there are any.

    Both sides are unique on the id, so the shuffle is even; no hint is given and the planner
    or the runtime picks broadcast or sort-merge from real sizes. ``verify`` runs the duplicate
    check on both sides first and raises; it also counts the rows, so that many of them go to more tasks.
    """
    if cols.id not in transactions.columns:
        raise ValueError(f"transactions have no column {cols.id!r}")
    n_rows = require_unique(transactions, cols) if verify else 0
    if identity is None or not identity.columns or identity.isEmpty():
        return transactions
    if cols.id not in identity.columns:
        raise ValueError(f"identity has no column {cols.id!r}")
    if verify and require_unique(identity.where(F.col(cols.id).isNotNull()), cols) > MAX_BROADCAST_ROWS:
        transactions = dealt(transactions, n_rows, cols.id)
    return transactions.join(identity, cols.id, "left")


def require_unique(df: DataFrame, cols: TxnColumns = DEFAULT) -> int:
    """The number of rows; raises if an id occurs twice (two missing ids count): values found by id would mix such rows."""
    counts = df.groupBy(cols.id).count()
    rows, repeated = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") > 1)).first()
    if repeated:
        raise ValidationError(f"duplicate {cols.id} (the join key must be unique)")
    return rows


def with_row_key(df: DataFrame, cols: TxnColumns = DEFAULT) -> tuple[DataFrame, TxnColumns]:
    """The frame, and its columns with a row id under which values that were found row by row come back.

    That is the id where it is unique and never missing. Else the rows are stored with a number of their own, in
    column ``ROW_NUMBER``, so that repeated ids keep apart.
    """
    missing = df.agg(F.count_if(F.col(cols.id).isNull())).first()[0]
    if not missing and not duplicate_keys(df, cols=cols).first()["duplicate_keys"]:
        return df, cols
    return materialize(df, "numbered").withColumn(ROW_NUMBER, F.monotonically_increasing_id()), replace(cols, id=ROW_NUMBER)


def key_text(df: DataFrame, column: str) -> Column:
    """An entity key as text; whole numbers have one form whatever their type: 315, 315.0 and "315.0" are "315"."""
    text = F.col(column).cast("string")
    if isinstance(df.schema[column].dataType, T.FractionalType):
        value = F.col(column)
        whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
        return F.when(whole, F.when(whole, value).cast("long").cast("string")).otherwise(text)
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.regexp_replace(text, r"^(-?[0-9]+)\.0+$", "$1")
    return text


def lookup(
    probe: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    *,
    heavy_key_rows: int = HEAVY_KEY_ROWS,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Left join of many rows with a table unique on ``on``, safe against hot probe keys.

    A table counted below ``max_broadcast_rows`` is broadcast; hand over a stored one, so the
    count is cheap. Otherwise the probe's heavy keys (there are at most rows / heavy_key_rows of
    them) meet a broadcast of just their own table rows, rows with a null key pass through since
    they match nothing, and the rest is a shuffle join in which no key is heavy, dealt over as many
    tasks as its rows need. All rows are kept in each case.
    """
    on = list(on)
    if table.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        return probe.join(F.broadcast(table), on, "left")

    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(key).isNull()
    keyed = probe.where(~no_key)
    heavy, n_heavy, _, others = large_groups(keyed, on, heavy_key_rows)
    added = [f for f in table.schema.fields if f.name not in on]
    keyless = probe.where(no_key).select(
        *on,
        *[c for c in probe.columns if c not in on],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in added],
    )
    if n_heavy > max_broadcast_rows:
        # Too many to set apart: the runtime splits skewed partitions of this join.
        return keyed.join(table, on, "left").unionByName(keyless)
    if n_heavy == 0:
        return dealt(keyed, others, *on).join(table, on, "left").unionByName(keyless)
    few = F.broadcast(heavy)
    hot = keyed.join(few, on, "left_semi").join(
        F.broadcast(table.join(few, on, "left_semi")), on, "left"
    )
    rest = dealt(keyed.join(few, on, "left_anti"), others, *on).join(table, on, "left")
    return hot.unionByName(rest).unionByName(keyless)


def keys_long(
    df: DataFrame, keys: Sequence[str], carry: Sequence[str], missing: str | None = None
) -> DataFrame:
    """One narrow row per (row, key column): ``carry``, ``key_type``, ``key``.

    All key columns then share one shuffle, and the wide feature columns stay out of it.
    With ``missing`` a null key becomes that value.
    """
    typed = df.select(*carry, *[key_text(df, k).alias(k) for k in keys])
    long = typed.unpivot(list(carry), list(keys), "key_type", "key")
    return long if missing is None else long.withColumn("key", F.coalesce("key", F.lit(missing)))


def lookup_feature_history(
    requests: DataFrame, history: DataFrame, key_type: str, column: str
) -> DataFrame:
    """Rate, mean and count of one entity per request row; null where unknown or not given.

    A batch goes through ``lookup``; for a streaming ``requests`` frame it is a stream-static
    left join whose strategy is left to the planner.
    """
    entry = history.where(F.col("key_type") == key_type).select(
        F.col("key").alias("_entity"),
        F.col("fraud_rate").alias(f"{key_type}_hist_fraud_rate"),
        F.col("amt_mean").alias(f"{key_type}_hist_amt_mean"),
        F.col("cnt").alias(f"{key_type}_hist_count"),
    )
    probe = requests.withColumn("_entity", key_text(requests, column))
    if requests.isStreaming:
        return probe.join(entry, "_entity", "left").drop("_entity")
    return lookup(probe, entry, ["_entity"]).drop("_entity")
