"""Streams over the event table, drained once, then read back."""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import functions as F

from riskloom.catalog import sql
from riskloom.catalog.learning import RESULT_SQL, checked_results, fitted_trees
from riskloom.catalog.registry import query, steady
from riskloom.catalog.relational import COLS, boundaries
from riskloom.operators import history, monitoring, splitting
from riskloom.plans.serving import BatchScorer
from riskloom.schema import TxnColumns
from riskloom.session import materialize, working_dir
from riskloom.sources import testbed, versions
from riskloom.streaming import jobs

EVENT_COLS = replace(
    TxnColumns(), id="event_id", time="at", amount="value", label="is_error", history_keys=("user_id",)
)


def stream_of(spark, path: str, files: str = "*.parquet"):
    """A Parquet folder (or one file of it) as a stream with the schema the files have."""
    single = path if files == "*.parquet" else os.path.join(path, files)
    schema = spark.read.parquet(single).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(path)


def _as_instant(events):
    here = F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts")
    return events.withColumn("ts", here.cast("timestamp"))


def event_stream(spark, sf: str):
    """Events with their zone-free time read as UTC, whatever the session's zone is."""
    return _as_instant(stream_of(spark, sf, "events.parquet"))


def event_table(spark, sf: str):
    return _as_instant(spark.read.parquet(os.path.join(sf, "events.parquet")))


def _utc(name: str):
    """An instant as zone-free UTC time."""
    local = F.col(name).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local).alias(name)


# Integer-made score of an event.
_EVENT_SCORE = "CAST((event_id * 7907) % 997 AS DOUBLE) / CAST(997 AS DOUBLE)"


@query(
    "monitor_stream",
    f"""SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS n,
    count(*) FILTER (WHERE score >= 0.5) AS reviewed, count(*) FILTER (WHERE score < 0.5) AS allowed,
    count(*) FILTER (WHERE score <= 0.3) AS upto_3, count(*) FILTER (WHERE score <= 1.0) AS upto_10
    FROM (SELECT date_trunc('day', ts) AS window_start, ts, {_EVENT_SCORE} AS score FROM events)
    GROUP BY window_start""",
)
def monitor_stream(spark, sf):
    scored = event_stream(spark, sf).select(
        "ts", (F.pmod(F.col("event_id") * 7907, F.lit(997)).cast("double") / 997.0).alias("score")
    )
    out = working_dir(spark, "monitor")
    windows = jobs.monitor_stream(scored, "ts")
    jobs.windows_to_parquet(windows, f"{out}/data", f"{out}/checkpoint", once=True).awaitTermination()
    return jobs.latest_windows(spark, f"{out}/data").select(
        _utc("window_start"),
        _utc("window_end"),
        "n", "reviewed", "allowed",
        F.col("at_or_below")[3].alias("upto_3"), F.col("at_or_below")[10].alias("upto_10"),
    )


_EVENT_WINDOW = "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_ERRORS = f"CAST(count(*) FILTER (WHERE event_type = 'error') OVER {_EVENT_WINDOW} AS DOUBLE)"


@query(
    "history_stream",
    f"""SELECT event_id, CAST(user_id AS VARCHAR) AS entity, count(*) OVER {_EVENT_WINDOW} AS hist_count,
    round({_ERRORS} / nullif(count(*) OVER {_EVENT_WINDOW}, 0), 6) AS hist_fraud_rate,
    {sql.steady(f'sum(value) OVER {_EVENT_WINDOW} / nullif(count(*) OVER {_EVENT_WINDOW}, 0)')} AS hist_amt_mean
    FROM events""",
)
def history_stream(spark, sf):
    events = event_stream(spark, sf).select(
        "event_id", F.unix_micros("ts").alias("at"), "value", "user_id",
        (F.col("event_type") == "error").cast("int").alias("is_error"),
    )
    out = working_dir(spark, "history")
    jobs.history_stream(
        events, f"{out}/data", f"{out}/checkpoint", EVENT_COLS, once=True,
    ).awaitTermination()
    return spark.read.parquet(f"{out}/data").select(
        "event_id", F.col("key").alias("entity"), F.col("cnt").alias("hist_count"),
        F.round("fraud_rate", 6).alias("hist_fraud_rate"), steady(F.col("amt_mean")).alias("hist_amt_mean"),
    )


_LABELLED = """SELECT event_id, ts, event_type = 'error' AS positive, CAST((event_id * 7907) % 997 AS DOUBLE) / CAST(997 AS DOUBLE) AS score,
    CASE WHEN event_id % 7 <> 0 AND event_id % 10 <= 5 THEN CAST(event_type = 'error' AS INTEGER) END AS label FROM events"""


@query(
    "labelled_stream",
    sql.with_(
        f"""SELECT s.period, n_scored, n_labelled, n_scored - n_labelled AS n_unlabelled, round({sql.AP}, 6) AS pr_auc,
        CAST(sum(n) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives
        FROM (SELECT period, count(*) AS n_scored, count(label) AS n_labelled FROM closed GROUP BY period) s
        LEFT JOIN c ON c.period = s.period GROUP BY s.period, n_scored, n_labelled""",
        e=_LABELLED,
        closed="""SELECT date_trunc('month', ts)::TIMESTAMP AS period, label, score FROM e
        WHERE date_trunc('month', ts) + INTERVAL 1 MONTH + INTERVAL 5 DAY < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
        known="SELECT * FROM closed WHERE label IS NOT NULL",
        c=sql.curve("known", "period"),
    ),
)
def labelled_stream(spark, sf):
    """Labels come 0 to 9 days after their events, or never; those within 5 days count, in months that are over."""
    events = event_stream(spark, sf)
    scored = events.select("event_id", "ts", (F.pmod(F.col("event_id") * 7907, F.lit(997)).cast("double") / 997.0).alias("score"))
    arrived = F.col("ts") + F.make_dt_interval(days=(F.col("event_id") % 10).cast("int"))
    labels = events.where("event_id % 7 <> 0").select("event_id", arrived.alias("labelled_at"), (F.col("event_type") == "error").cast("int").alias("label"))
    joined = jobs.labelled_stream(scored, labels, "event_id", scored_at="ts", within="5 days", late_by="1 hour")
    out = working_dir(spark, "labelled")
    jobs.start_to_parquet(joined, f"{out}/data", f"{out}/checkpoint", once=True).awaitTermination()
    rows = spark.read.parquet(f"{out}/data")
    last = event_table(spark, sf).agg(F.max("ts")).first()[0]
    month = F.date_trunc("month", "ts")
    over = month + F.expr("INTERVAL 1 MONTH") + F.expr("INTERVAL 5 DAYS") < F.lit(last) - F.expr("INTERVAL 1 HOUR")
    told = monitoring.labelled_performance(rows.where(over).withColumn("period", month), "period")
    return told.select(_utc("period"), "n_scored", "n_labelled", "n_unlabelled", F.round("pr_auc", 6).alias("pr_auc"), "n", "positives")


def _requests(spark, sf):
    """(stream folder, history table, model) of hold-out requests with their raw keys and amounts."""
    model, rows, _ = fitted_trees(spark, sf)
    t1, _ = boundaries(spark, sf)
    txn = testbed.transactions(spark, sf)
    table = materialize(
        history.feature_history(splitting.period_filter(txn, until=t1, cols=COLS), COLS), "online"
    )
    # Raw requests: the model's other features plus the entity keys and the amount.
    raw = txn.select("transaction_id", "card1", "addr1", F.col("transaction_amt").alias("new_amount"))
    out = working_dir(spark, "requests")
    rows.where("split = 'holdout'").drop("split", "label").join(raw, "transaction_id").write.parquet(f"{out}/in")
    return out, table, model


@query("score_stream", RESULT_SQL)
def score_stream(spark, sf):
    out, table, model = _requests(spark, sf)
    scored = jobs.score_stream(
        stream_of(spark, f"{out}/in"), table, BatchScorer(model, 0.5), cols=COLS, amount="new_amount"
    )
    jobs.start_to_parquet(scored, f"{out}/data", f"{out}/checkpoint", once=True).awaitTermination()
    return checked_results(spark.read.parquet(f"{out}/data"))


@query("score_stream_versioned", RESULT_SQL)
def score_stream_versioned(spark, sf):
    out, table, model = _requests(spark, sf)
    versions.publish(table, f"{out}/history")
    jobs.score_stream_versioned(
        stream_of(spark, f"{out}/in"), f"{out}/history", BatchScorer(model, 0.5), f"{out}/data", f"{out}/checkpoint",
        cols=COLS, amount="new_amount", once=True,
    ).awaitTermination()
    return checked_results(spark.read.parquet(f"{out}/data/results"))
