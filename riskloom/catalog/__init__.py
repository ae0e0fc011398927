"""All registered queries with their SQL counterparts."""

from riskloom.catalog import (  # noqa: F401
    evaluating,
    featuring,
    learning,
    relational,
    reporting,
    streamed,
    watching,
)
from riskloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
