"""Reading, writing and aligning tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalars import sampling_order, zero_if_missing
from riskloom.operators.joining import join_identity
from riskloom.schema import DEFAULT, TxnColumns, identity_schema, transaction_schema
from riskloom.sources import csvtext


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    required: Sequence[str] | None = None,
    others: Mapping[str, T.DataType] | None = None,
    rejects: str | None = None,
    line_breaks: bool | None = None,
) -> DataFrame:
    """CSV with a header, its columns found by name: in file order, no inference pass over the data.

    Columns that the file lacks are an error if ``required`` (default: all of ``schema``), else they
    are absent. Columns that the schema lacks are passed through with the type of the first pattern
    in ``others`` that matches their whole name, or as text. A row that doesn't fit its types goes to
    Parquet under ``rejects``, with its line; without ``rejects`` such a row is an error. A quote inside
    a quoted field is doubled, as spreadsheets and data frame tools write it.

    Fields may hold line breaks, though not the header's; files stay splittable (``csvtext``). ``line_breaks`` says
    whether they do; by default a scan looks first.
    """
    plain = spark.read.option("header", True).option("escape", '"')
    names = plain.csv(path).columns  # reads the first line
    known = {f.name.lower(): f for f in schema.fields}
    absent = [c for c in (schema.names if required is None else required) if c.lower() not in {n.lower() for n in names}]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")

    def typed(name: str) -> T.StructField:
        if name.lower() in known:
            return T.StructField(known[name.lower()].name, known[name.lower()].dataType)
        kind = next((t for pattern, t in (others or {}).items() if re.fullmatch(pattern, name)), T.StringType())
        return T.StructField(name, kind)

    fields = T.StructType([typed(n) for n in names])
    line = "_rejected_line"
    if csvtext.has_line_breaks(spark, path) if line_breaks is None else line_breaks:
        mode = "FAILFAST" if rejects is None else "PERMISSIVE"
        rows = csvtext.parsed(csvtext.records(spark, path), fields, line, {"escape": '"', "mode": mode})
        if rejects is not None:
            rows.where(F.col(line).isNotNull()).write.mode("overwrite").parquet(rejects)
        return rows.where(F.col(line).isNull()).drop(line)
    if rejects is None:
        return plain.schema(fields).option("mode", "FAILFAST").csv(path)
    rows = plain.schema(fields.add(line, T.StringType())).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line).csv(path)
    # The reader refuses queries on the line alone, so the filters look at another column too; it is always true.
    parsed = F.length(F.concat_ws("", F.col(fields.names[0]).cast("string"))) >= 0
    rows.where(F.col(line).isNotNull() & parsed).write.mode("overwrite").parquet(rejects)
    return rows.where(F.col(line).isNull() & parsed).drop(line)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def sink_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store a wide table in buckets of its id.

    Later joins on the id then read it in place: only their narrow side is shuffled, into as
    many partitions. Worth it for the joined table, which every feature build joins by id.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def sink_json_report(report: DataFrame, path: str) -> str:
    """A report frame as one JSON file of ``{...}`` lines.

    Reports have a row per check, split, slice or column, so one output file is right.
    """
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system it belongs to."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def ingest_split(
    spark: SparkSession,
    split: str,
    raw: str,
    interim: str,
    cols: TxnColumns = DEFAULT,
    transactions: T.StructType | None = None,
    identity: T.StructType | None = None,
    others: Mapping[str, T.DataType] | None = None,
) -> tuple[DataFrame, str]:
    """``<split>_transaction.csv`` and ``<split>_identity.csv`` joined into interim Parquet.

    No transaction file is an error; no identity file means no identity columns. A file may lack the
    label and all identity columns but the id, and may have further columns (``others``: their types by
    name). Rows that don't fit are left in ``<split>_transaction_rejects`` and ``<split>_identity_rejects``.
    """
    txn_path, idn_path = f"{raw}/{split}_transaction.csv", f"{raw}/{split}_identity.csv"
    if not path_exists(spark, txn_path):
        raise FileNotFoundError(f"missing {txn_path}")
    wanted = transactions or transaction_schema(cols)
    txn = scan_csv(
        spark, txn_path, wanted, required=[c for c in wanted.names if c != cols.label],
        others=others or cols.pass_through, rejects=f"{interim}/{split}_transaction_rejects",
    )
    idn = None
    if path_exists(spark, idn_path):
        idn = scan_csv(
            spark, idn_path, identity or identity_schema(cols), required=[cols.id],
            others=others or cols.pass_through, rejects=f"{interim}/{split}_identity_rejects",
        )
    out = sink_parquet(join_identity(txn, idn, cols, verify=True), f"{interim}/{split}_joined.parquet")
    return spark.read.parquet(out), out


def union_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, duplicates kept; a column absent on one side is null there."""
    out = first
    for df in others:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def align_columns(df: DataFrame, columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """The training columns in training order; absent ones are 0.0, missing values too."""
    have = set(df.columns)
    return df.select(
        *carry,
        *[(zero_if_missing(F.col(c)) if c in have else F.lit(0.0)).alias(c) for c in columns],
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric and boolean columns in frame order; names compare without case, as in Spark."""
    out = {c.lower() for c in exclude}
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType | T.BooleanType) and f.name.lower() not in out
    ]


def sample_rows(
    df: DataFrame, n: int, seed: int, row_id: str, *, clean: bool = False
) -> DataFrame:
    """``n`` rows in a seeded pseudo-random order of the id (a top-n, not a full sort).

    ``clean`` keeps the id and the numeric columns only and turns null, NaN and infinities
    into 0.
    """
    order = sampling_order(F.col(row_id), seed)
    top = df.orderBy(order, row_id).limit(n)
    if not clean:
        return top
    keep = [c for c in numeric_columns(df) if c != row_id]

    def finite(c: str):
        v = zero_if_missing(F.col(c))
        return F.when(F.abs(v) == float("inf"), 0.0).otherwise(v).alias(c)

    return top.select(row_id, *[finite(c) for c in keep])


def topk_scores(df: DataFrame, score: str, row_id: str, k: int = 5) -> DataFrame:
    """The k highest and k lowest scores, ties by id, with their ``extreme`` and ``place``."""
    from pyspark.sql import Window

    def side(name: str, order) -> DataFrame:
        few = df.orderBy(order, F.col(row_id).asc()).limit(k)
        place = Window.partitionBy("extreme").orderBy(order, F.col(row_id).asc())
        return few.withColumn("extreme", F.lit(name)).withColumn("place", F.row_number().over(place))

    return side("highest", F.col(score).desc()).unionByName(side("lowest", F.col(score).asc()))
