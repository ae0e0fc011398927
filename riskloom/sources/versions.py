"""Tables that are replaced as a whole while others read them.

Each version is a folder of its own, complete once its success marker is there; nothing is changed afterwards. A
reader that names its version reads the same rows for ever.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions' folders."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root)]
    done = [p for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return [p.getName() for p in done]


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The newest complete version, None where there is none."""
    numbers = [int(name.removeprefix("v=")) for name in _folders(spark, path) if name.startswith("v=")]
    return max(numbers, default=None)


def publish(df: DataFrame, path: str) -> int:
    """Write the next version and return its number. One writer at a time."""
    number = (latest_version(df.sparkSession, path) or 0) + 1
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").mode("overwrite").parquet(f"{path}/v={number}")
    return number


def read_version(spark: SparkSession, path: str, number: int) -> DataFrame:
    return spark.read.option("basePath", f"{path}/v={number}").parquet(f"{path}/v={number}")
