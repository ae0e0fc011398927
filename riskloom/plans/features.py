"""Feature tables: training rows see their own past, later rows see a frozen period.

The wide table is shuffled once, on the row id. Every history and frequency value is worked
out on narrow (id, key) rows: one lookup and one regrouping serve all key columns, and the
result is joined back on that same id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import encodings, history
from riskloom.operators.dealing import dealt
from riskloom.operators.joining import keys_long, lookup, require_unique
from riskloom.operators.splitting import assign_split
from riskloom.schema import DEFAULT, MISSING_KEY, SPLITS, TxnColumns
from riskloom.session import materialize

TRAIN, VALIDATION, HOLDOUT = SPLITS
# For which splits the rows of a split are summed up. What a split's own rows say about its
# labels is used for none of its rows; their plain counts are.
FEEDS = {TRAIN: (TRAIN, VALIDATION, HOLDOUT), VALIDATION: (HOLDOUT,)}


@dataclass(frozen=True)
class FeatureArtifacts:
    """Frozen per-value aggregates of all key columns, fitted on the training rows."""

    profile: DataFrame
    cols: TxnColumns = DEFAULT

    @property
    def entity(self) -> DataFrame:
        """Fraud rate, mean amount and rows per entity, the missing entity included."""
        return self.profile.where(F.col("key_type").isin(*self.cols.history_keys))

    @property
    def frequency(self) -> DataFrame:
        """Rows per value, nulls left out."""
        kept = F.col("key_type").isin(*self.cols.frequency_keys) & (F.col("key") != MISSING_KEY)
        return self.profile.where(kept).select("key_type", "key", F.col("cnt").alias("freq"))

    def save(self, path: str) -> None:
        self.profile.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str, cols: TxnColumns = DEFAULT) -> FeatureArtifacts:
        return FeatureArtifacts(spark.read.parquet(path), cols)


def _all_keys(cols: TxnColumns) -> tuple[str, ...]:
    return tuple(dict.fromkeys((*cols.history_keys, *cols.frequency_keys)))


def key_feature_names(cols: TxnColumns = DEFAULT) -> list[str]:
    parts = ("count", "fraud_rate", "amt_mean")
    return [f"{k}_hist_{p}" for k in cols.history_keys for p in parts] + frequency_names(cols)


def frequency_names(cols: TxnColumns = DEFAULT) -> list[str]:
    return [f"{k}_freq" for k in cols.frequency_keys]


def _frozen(df: DataFrame, profile: DataFrame, cols: TxnColumns, extra: Sequence[str] = ()) -> DataFrame:
    """Long rows of every key column with what the profile knows about their value."""
    long = keys_long(df, _all_keys(cols), [cols.id, *extra], MISSING_KEY)
    found = lookup(long, profile, [*extra, "key_type", "key"])
    # A missing value is an entity of its own, but has no frequency.
    return found.withColumn("freq", F.when(F.col("key") != MISSING_KEY, F.col("cnt")))


def _assemble(df: DataFrame, long: DataFrame, cols: TxnColumns, n_rows: int) -> DataFrame:
    """Key features from long rows, joined to the ``n_rows`` wide rows, plus all row-level features."""
    per_id = dealt(long, n_rows, cols.id).groupBy(cols.id).agg(
        *history.history_columns(cols.history_keys), *encodings.frequency_columns(cols.frequency_keys)
    )
    base = df.drop(*key_feature_names(cols))
    return base.join(per_id, cols.id, "left").withColumns(encodings.row_expressions(base, cols))


_LONG = ("key_type", "cnt", "fraud_rate", "amt_mean", "freq")


def _own_past(train: DataFrame, frozen: DataFrame, is_train, cols: TxnColumns, **options) -> DataFrame:
    """Training rows take their running history and keep only the counts of the frozen one."""
    running = history.history_long(train, cols, **options).withColumn("freq", F.lit(None).cast("long"))
    masked = frozen.withColumns(
        {c: F.when(~is_train, F.col(c)) for c in ("cnt", "fraud_rate", "amt_mean")}
    )
    return masked.select(cols.id, *_LONG).unionByName(running.select(cols.id, *_LONG))


def build_train_features(
    df: DataFrame, cols: TxnColumns = DEFAULT, **options
) -> tuple[DataFrame, FeatureArtifacts]:
    """All feature groups on the training rows, and the frozen tables for later rows."""
    n_rows = require_unique(df, cols)
    profile = materialize(history.entity_aggregates(df, cols, _all_keys(cols)), "profile")
    long = _own_past(df, _frozen(df, profile, cols), F.lit(True), cols, **options)
    return _assemble(df, long, cols, n_rows), FeatureArtifacts(profile, cols)


def build_test_features(
    df: DataFrame, artifacts: FeatureArtifacts, cols: TxnColumns = DEFAULT
) -> DataFrame:
    """The same columns for later rows, from frozen tables only."""
    n_rows = require_unique(df, cols)
    return _assemble(df, _frozen(df, artifacts.profile, cols), cols, n_rows)


def build_temporal_splits(
    df: DataFrame, t1: float, t2: float, cols: TxnColumns = DEFAULT, **options
) -> DataFrame:
    """One feature frame with a ``split`` column, safe against leakage between periods.

    Training rows get their running history, validation rows the training aggregates, hold-out
    rows those of training and validation together. Both sets of aggregates come from one pass.
    ``df`` is read several times, so hand over a stored table; write the result with
    ``partitionBy("split")``. Rows without a time belong to no split and are left out, as three
    range filters would.
    """
    n_rows = require_unique(df, cols)
    rows = assign_split(df, t1, t2, cols).where(F.col("split").isNotNull())
    profile = materialize(
        history.aggregates_by_target(rows, "split", FEEDS, cols, _all_keys(cols)), "profile"
    ).withColumnRenamed("target", "split")
    frozen = _frozen(rows, profile, cols, ["split"])
    is_train = F.col("split") == TRAIN
    long = _own_past(rows.where(is_train), frozen, is_train, cols, **options)
    return _assemble(rows, long, cols, n_rows)
