"""CSV records whose fields may hold line breaks, from files that stay splittable.

A line break lies inside a field where an odd number of quotes stands before it. So quotes are counted per block
of a file, and the parity at a block's start follows from the blocks before it. Each task then joins the lines of
its blocks to records on its own; only what a block's edge cuts apart is put together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import materialize

QUOTE = '"'
# What part of a record a row is.
WHOLE, HEAD, MIDDLE, TAIL = range(4)
# Stands for the block of a header that goes on in the next block.
HEADER = -1
FIELDS = "file string, block long, kind long, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines in the order of their blocks; a block is what one split of the file reads."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _odd(line: Column) -> Column:
    return F.pmod(F.length(line) - F.length(F.replace(line, F.lit(QUOTE), F.lit(""))), F.lit(2)) == 1


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any field holds a line break: then some line has an odd number of quotes."""
    return not _lines(spark, path).where(_odd(F.col("value"))).isEmpty()


def _begin_inside(lines: DataFrame) -> set[tuple[str, int]]:
    """The blocks that begin inside a quoted field: at most one entry a block of the files."""
    odd = lines.groupBy("file", "block").agg(F.count_if(_odd(F.col("value"))).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return {(r["file"], r["block"]) for r in odd.withColumn("before", before).where("before % 2 = 1").collect()}


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, record``: every record of the files but their headers, as text without its last line break."""
    lines = _lines(spark, path)
    sent = spark.sparkContext.broadcast(_begin_inside(lines))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, int, str]] = []
        here: tuple[str, int] | None = None
        held: list[str] = []  # lines of the record that is open
        inside = began_inside = header = False

        def closed(ends: bool) -> None:
            """The open record ends here, or the block does."""
            nonlocal began_inside, header, held
            if held and here:
                kind = (TAIL if ends else MIDDLE) if began_inside else WHOLE if ends else HEAD
                if not (header and ends):
                    out.append((here[0], HEADER if header else here[1], kind, "\n".join(held)))
                header = False
            began_inside, held = False, []

        for batch in batches:
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != here:
                    closed(False)
                    here = (file, block)
                    inside = began_inside = here in sent.value
                    header = block == 0
                held.append(line)
                inside ^= line.count(QUOTE) % 2 == 1
                if not inside:
                    closed(True)
            yield told(out)
            out.clear()
        closed(False)
        yield told(out)

    def told(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["file", "block", "kind", "record"])

    parts = materialize(lines.mapInArrow(run, FIELDS), "records")
    whole = parts.where(F.col("kind") == WHOLE)
    # A block has one head, middle or tail at most, so a window over a file's cut records is as short as its blocks.
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == HEAD)
    cut = parts.where(F.col("kind") != WHOLE).withColumn("nth", F.count_if(F.col("kind") == HEAD).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("block", "kind", "record")))
    joined = cut.groupBy("file", "nth").agg(F.min("block").alias("block"), pieces.alias("p"))
    mended = joined.where(F.col("block") != HEADER).select("file", "block", F.array_join("p.record", "\n").alias("record"))
    return whole.select("file", "block", "record").unionByName(mended)


def parsed(rows: DataFrame, schema: T.StructType, line: str, options: Mapping[str, str]) -> DataFrame:
    """Fields of ``record`` by ``schema``; the record itself in column ``line`` where it does not fit. Empty lines are none."""
    clean = F.regexp_replace("record", "\r$", "")
    whole = T.StructType([*schema.fields, T.StructField(line, T.StringType())])
    told = F.from_csv(clean, whole.toDDL(), {**options, "columnNameOfCorruptRecord": line})
    return rows.where(clean != "").select(told.alias("r")).select("r.*")
