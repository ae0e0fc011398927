"""Rows dealt to tasks by their number, so what one task holds does not grow with the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize

# Rows that a task of a hash shuffle is meant to hold. Up to so many tasks' worth the planner decides.
DEALT_ROWS, FEW_TASKS = 500_000, 4


def dealt(rows: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """The rows, equal ``keys`` together, over as many tasks as ``n_rows`` need; few rows are left to the planner.

    Runtime skew handling does not split such a shuffle, so heavy keys must have been set apart.
    """
    n = -(-n_rows // DEALT_ROWS)
    if n <= FEW_TASKS:
        return rows
    return rows.repartition(max(n, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def large_groups(rows: DataFrame, by: Sequence[str], limit: int) -> tuple[DataFrame, int, int, int]:
    """(groups of more than ``limit`` rows, stored; how many; rows they hold; rows of all others).

    Rows are counted with map-side combine, and the other groups' counts are added up before they are written.
    """
    large = F.col("count") > limit
    told = materialize(
        rows.groupBy(*by).count()
        .groupBy(*[F.when(large, F.col(k)).alias(k) for k in by], large.alias("_large"))
        .agg(F.sum("count").alias("count")),
        "heavy",
    )
    groups, held, others = told.agg(
        F.count_if("_large"), *[F.coalesce(F.sum(F.when(kind, F.col("count"))), F.lit(0)) for kind in (F.col("_large"), ~F.col("_large"))]
    ).first()
    return told.where("_large").select(*by), groups, held, others
