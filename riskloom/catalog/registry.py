"""Where queries and their SQL counterparts are registered side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def steady(value: Column) -> Column:
    """A money average made comparable across engines.

    Sums of doubles differ in the last bits with their order, and halves, quarters and eighths
    of cents sit exactly on rounding ties; the small shift moves the ties off the values.
    """
    return F.round(value + 0.0001234, 3)
