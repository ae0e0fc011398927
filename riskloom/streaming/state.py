"""Entity totals in a keyed state store, updated by each micro-batch.

The state of a key is what was summed up in earlier micro-batches. The store (RocksDB) keeps it beside the
checkpoint and reads only the keys that a micro-batch has. A hot entity has several keys: its rows are dealt to
``ways`` sub-keys, and since each of its rows needs all of its totals, every batch of rows also asks all of its
sub-keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.operators.history import SUMS
from riskloom.schema import TxnColumns

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BY = ["key_type", "key", "sub"]
# What a row of the state's output is.
TOTALS, ROW, ASKED = "totals", "row", "asked"


def use_rocksdb(spark: SparkSession) -> None:
    """State variables need this store; the setting holds for queries started later."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def _summed(n: int, y: int, amt: float, rows: pd.DataFrame) -> tuple[int, int, float]:
    return n + int(rows["n"].sum()), y + int(rows["y"].fillna(0).sum()), amt + float(rows["amt"].fillna(0.0).sum())


class EntityTotals(StatefulProcessor):
    """Hands on the rows of a key and, before them, its totals without them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "n long, y long, amt double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, y, amt = self.totals.get() if self.totals.exists() else (0, 0, 0.0)
        if n:
            yield pd.DataFrame({"key_type": [key[0]], "key": [key[1]], "kind": [TOTALS], "id": [None], "time": [None], "n": [n], "y": [y], "amt": [amt]})
        for part in rows:
            mine = part[part["kind"] == ROW]
            if len(mine):
                n, y, amt = _summed(n, y, amt, mine)
                yield mine[["key_type", "key", "kind", "id", "time", "n", "y", "amt"]]
        self.totals.update((n, y, amt))

    def close(self) -> None:
        pass


def with_totals(long: DataFrame, cols: TxnColumns, hot: Sequence[tuple[str, str]] = (), ways: int = 16) -> DataFrame:
    """A stream of long history rows (``history.measured``) with the earlier totals of their entities.

    Output: ``key_type, key, kind, id, time`` (the last two as text) and the sums; ``kind`` is ``totals`` (one row per key and sub-key,
    to be added up) or ``row``. ``hot`` names (key_type, key) to be split; more may be named at a restart, but none
    may be left out and ``ways`` may only grow.
    """
    # As text: pandas has no whole numbers beside missing ones.
    typed = long.select("key_type", "key", F.lit(ROW).alias("kind"), F.col(cols.id).cast("string").alias("id"), F.col(cols.time).cast("string").alias("time"), *SUMS)
    named = set(hot)
    is_hot = F.lit(False)
    for t, k in named:
        is_hot = is_hot | ((F.col("key_type") == t) & (F.col("key") == k))
    rows = typed.withColumn("sub", F.when(is_hot, F.pmod(F.xxhash64("id", "time"), F.lit(ways)).cast("int")).otherwise(0))

    def asking(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            seen = {x for x in zip(batch["key_type"].to_pylist(), batch["key"].to_pylist(), strict=True) if x in named} if named else ()
            ask = [(t, k, s) for t, k in sorted(seen) for s in range(ways)]
            if ask:
                told = {"key_type": [a[0] for a in ask], "key": [a[1] for a in ask], "kind": [ASKED] * len(ask), "sub": [a[2] for a in ask]}
                yield pa.RecordBatch.from_arrays([pa.array(told.get(f.name, [None] * len(ask)), f.type) for f in batch.schema], schema=batch.schema)

    # Also where nothing is hot: the state's key must have one type at all starts.
    rows = rows.mapInArrow(asking, T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields]))
    out = T.StructType(
        [T.StructField(c, T.StringType()) for c in ("key_type", "key", "kind", "id", "time")]
        + [T.StructField(c, T.LongType()) for c in ("n", "y")]
        + [T.StructField("amt", T.DoubleType())]
    )
    return rows.groupBy(*BY).transformWithStateInPandas(statefulProcessor=EntityTotals(), outputStructType=out, outputMode="Append", timeMode="None")
