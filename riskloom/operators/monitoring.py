"""Operational counters, missing values and performance on late labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import ranking

# The upper bounds of the score histogram; the open bucket follows them.
SCORE_BUCKETS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def decision_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by, "decision").agg(F.count(F.lit(1)).alias("n"))


def score_histogram(scored: DataFrame, by: Sequence[str] = (), score: str = "score") -> DataFrame:
    """Cumulative bucket counts: rows with score <= ``le``, the last bucket holding all."""
    s = F.col(score)
    buckets = [
        F.struct(F.lit(b).alias("le"), F.count_if(s <= b).alias("n")) for b in SCORE_BUCKETS
    ] + [F.struct(F.lit(float("inf")).alias("le"), F.count(score).alias("n"))]
    grid = F.array(*buckets).alias("grid")
    folded = scored.groupBy(*by).agg(grid) if by else scored.agg(grid)
    return folded.select(*by, F.inline("grid"))


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing rows and their share per column: one aggregate row, turned on its side."""
    total = F.count(F.lit(1))
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNull()).alias("missing"),
            F.round(F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), total.cast("double")), 6).alias(
                "missing_share"
            ),
        )
        for c in (columns or df.columns)
    ]
    return df.agg(F.array(*entries).alias("m")).select(F.inline("m"))


def delayed_label_performance(
    scored: DataFrame, labels: DataFrame, row_id: str, period: str, score: str = "score"
) -> DataFrame:
    """Ranking metrics per period over the scored rows whose label has arrived."""
    known = scored.join(labels, row_id)
    return ranking.evaluate(known, [period], score, "label")


def labelled_performance(joined: DataFrame, period: str, score: str = "score") -> DataFrame:
    """Per period: rows scored, with and without a label in time, and ranking metrics of those with one.

    ``joined`` has a null ``label`` where none arrived (``streaming.jobs.labelled_stream``).
    """
    counts = joined.groupBy(period).agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count("label").alias("n_labelled"),
        F.count_if(F.col("label").isNull()).alias("n_unlabelled"),
    )
    return counts.join(ranking.evaluate(joined.where(F.col("label").isNotNull()), [period], score, "label"), period, "left")
