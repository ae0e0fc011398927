"""Split by time, never at random."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import event_time
from riskloom.operators.prefix import exact_quantiles
from riskloom.schema import DEFAULT, SPLITS, TxnColumns


def split_boundaries(
    df: DataFrame, train_frac: float = 0.70, val_frac: float = 0.15, cols: TxnColumns = DEFAULT
) -> DataFrame:
    """One row ``t1, t2``: interpolated time quantiles."""
    shares = dict(zip(SPLITS, (train_frac, val_frac, round(1 - train_frac - val_frac, 12)), strict=True))
    if empty := [name for name, share in shares.items() if share <= 0]:
        raise ValueError(f"no rows left for {', '.join(empty)}")
    return exact_quantiles(df, cols.time, {"t1": train_frac, "t2": train_frac + val_frac})


def boundary_values(boundaries: DataFrame) -> tuple[float, float]:
    """The two numbers, as literals a scan filter can use."""
    row = boundaries.first()
    return float(row["t1"]), float(row["t2"])


def split_label(time: Column, t1: float, t2: float) -> Column:
    t = time.cast("double")
    return F.when(t <= t1, SPLITS[0]).when(t <= t2, SPLITS[1]).when(t > t2, SPLITS[2])


def assign_split(df: DataFrame, t1: float, t2: float, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Add ``split``: up to t1 train, up to t2 validation, later holdout; null time gives null."""
    return df.withColumn("split", split_label(F.col(cols.time), t1, t2))


def period_filter(
    df: DataFrame, after: float | None = None, until: float | None = None, cols: TxnColumns = DEFAULT
) -> DataFrame:
    """Rows with ``after < time <= until``; the literals reach the file scan.

    The time column holds whole seconds, so a fractional bound is floored: ``time <= 5.5`` and
    ``time <= 5`` keep the same rows, and an integer literal needs no cast in the filter.
    """
    import math

    out = df
    if after is not None:
        out = out.where(F.col(cols.time) > math.floor(after))
    if until is not None:
        out = out.where(F.col(cols.time) <= math.floor(until))
    return out


def split_summary(df: DataFrame, t1: float, t2: float, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Rows, fraud rate, positives and date range per split; an empty split is still listed."""
    time = F.col(cols.time)
    label = split_label(time, t1, t2)
    stats = []
    for name in SPLITS:
        mine = label == name
        y = F.when(mine, F.col(cols.label))
        stats.append(
            F.struct(
                F.lit(name).alias("split"),
                F.count_if(mine).alias("rows"),
                F.round(F.avg(y), 6).alias("fraud_rate"),
                F.coalesce(F.sum(y), F.lit(0)).cast("long").alias("n_positives"),
                event_time(F.min(F.when(mine, time)), cols.reference_time).alias("date_min"),
                event_time(F.max(F.when(mine, time)), cols.reference_time).alias("date_max"),
            )
        )
    # One aggregate row holds all three splits, so none can be missing.
    return df.agg(F.array(*stats).alias("splits")).select(F.inline("splits"))


def split_manifest(
    df: DataFrame, train_frac: float = 0.70, val_frac: float = 0.15, cols: TxnColumns = DEFAULT
) -> DataFrame:
    """Boundaries and summary as ``section, name, value`` rows, ready for a JSON sink."""
    t1, t2 = boundary_values(split_boundaries(df, train_frac, val_frac, cols))
    summary = split_summary(df, t1, t2, cols)
    fixed = {
        "reference_date": cols.reference_time,
        "train_frac": train_frac,
        "val_frac": val_frac,
        "t1": round(t1, 6),
        "t2": round(t2, 6),
    }
    head = df.sparkSession.createDataFrame(
        [("split", k, str(v)) for k, v in fixed.items()], "section string, name string, value string"
    )
    fields = ["rows", "fraud_rate", "n_positives", "date_min", "date_max"]
    body = summary.select(
        F.concat(F.lit("split."), "split").alias("section"),
        *[F.col(f).cast("string").alias(f) for f in fields],
    ).unpivot(["section"], fields, "name", "value")
    return head.unionByName(body)
