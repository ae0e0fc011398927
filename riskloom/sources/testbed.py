"""The transaction and identity tables, derived from the order/event test tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.joining import join_identity
from riskloom.schema import DEFAULT

# The derived times start in 1995 instead.
COLS = replace(DEFAULT, reference_time="1995-01-01")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fraud_label():
    mix = F.pmod(F.col("o_orderkey") * 7919, F.lit(1000))
    return (
        F.when((F.pmod(F.col("o_custkey"), F.lit(29)) == 0) & (mix < 600), 1).when(mix < 15, 1).otherwise(0)
    )


def transactions(spark: SparkSession, sf_dir: str, *, address: bool = True) -> DataFrame:
    """The transaction table; ``address=False`` leaves out addr1 and the join it needs."""
    start = F.lit(COLS.reference_time).cast("timestamp_ntz")
    key = F.col("o_orderkey")
    rows = _read(spark, sf_dir, "orders")
    if address:
        customer = _read(spark, sf_dir, "customer")
        nation = customer.select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("string").alias("addr1")
        )
        rows = rows.join(nation, "o_custkey", "left")
    return rows.select(
        key.alias("transaction_id"),
        F.timestamp_diff("SECOND", start, F.col("o_orderdate")).alias("transaction_dt"),
        F.col("o_totalprice").alias("transaction_amt"),
        fraud_label().cast("int").alias("is_fraud"),
        F.when(F.pmod(key, F.lit(17)) != 0, F.col("o_custkey").cast("string")).alias("card1"),
        *(["addr1"] if address else []),
        F.when(F.pmod(key, F.lit(11)) != 0, F.col("o_orderpriority")).alias("p_emaildomain"),
    )


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, part = _read(spark, sf_dir, "events"), _read(spark, sf_dir, "part")
    eid, parts = F.col("event_id"), part.count()
    described = part.select(
        F.col("p_partkey").alias("_part"),
        F.col("p_name").alias("id_30"),
        F.concat("p_type", F.lit(" "), "p_brand").alias("id_31"),
    )
    return (
        events.where(F.pmod(eid, F.lit(3)) != 0)
        .withColumn("_part", F.pmod(eid, F.lit(max(parts, 1))))
        .join(described, "_part", "left")
        .select(
            eid.alias("transaction_id"),
            F.when(F.pmod(eid, F.lit(10)) != 0, F.col("event_type")).alias("device_type"),
            F.col("props").alias("device_info"),
            F.col("value").alias("id_01"),
            "id_30",
            "id_31",
        )
    )


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_identity(transactions(spark, sf_dir), identity(spark, sf_dir), COLS)


def integer_score(factor: int = 7907, label_lift: int = 300):
    """A model-free score built from integers, with many ties."""
    return (
        F.pmod(F.col("transaction_id") * factor, F.lit(997)) + label_lift * F.col("is_fraud")
    ).cast("double") / F.lit(1297.0)
