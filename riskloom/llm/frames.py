"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import working_dir

#: Rows of one Arrow batch, and bytes of its texts, that are turned into Python objects at a time.
ROWS_AT_ONCE, BYTES_AT_ONCE = 256, 1 << 22
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], text: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: bounds what is decoded at once. text: the place of a column of long texts."""
    for batch in batches:
        start, n = 0, batch.num_rows
        size = np.zeros(n) if text is None else np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy())
        while start < n:
            most = (size[start - 1] if start else 0) + BYTES_AT_ONCE
            end = min(start + ROWS_AT_ONCE, max(start + 1, int(np.searchsorted(size, most, side="right"))))
            yield batch.slice(start, end - start)
            start = end


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have yet (names are compared without case, as Spark does)."""
    taken, name, k = {c.lower() for c in df.columns}, base, 0
    while name.lower() in taken:
        k += 1
        name = f"{base}_{k}"
    return name


def bucket_of(column: Column | str, n: int) -> Column:
    """crc32 of a value's text, modulo ``n``; a null value counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string").cast("binary")) % n


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: shared by several jobs, safe when executors are lost."""
    spark, path = df.sparkSession, working_dir(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Herein the shuffle files of a write are removed when it ends, not whenever the driver collects its garbage."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)
