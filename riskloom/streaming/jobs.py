"""The online service as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators import history
from riskloom.operators.monitoring import SCORE_BUCKETS
from riskloom.operators.scoring import decide, recompute_features
from riskloom.plans.serving import BatchScorer
from riskloom.schema import DEFAULT, TxnColumns
from riskloom.session import working_dir
from riskloom.sources import versions
from riskloom.sources.tables import path_exists
from riskloom.streaming import state


def start_to_parquet(
    stream: DataFrame, path: str, checkpoint: str, *, once: bool = False, **options: str
) -> StreamingQuery:
    """Append a stream to Parquet files exactly once; ``once`` drains what is there and stops."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def score_stream(
    requests: DataFrame,
    history: DataFrame,
    scorer: BatchScorer,
    carry: tuple[str, ...] = ("transaction_id",),
    cols: TxnColumns = DEFAULT,
    amount: str | None = None,
) -> DataFrame:
    """Refresh history features from the static table, then score, decide and explain.

    Stateless: a request depends on nothing but the history table and the model.
    """
    fresh = recompute_features(requests, history, cols, amount)
    return scorer.score_batch(fresh, carry)


def score_stream_versioned(
    requests: DataFrame,
    history_path: str,
    scorer: BatchScorer,
    path: str,
    checkpoint: str,
    carry: tuple[str, ...] = ("transaction_id",),
    cols: TxnColumns = DEFAULT,
    amount: str | None = None,
    *,
    once: bool = False,
) -> StreamingQuery:
    """The same against the newest version of a table that is refreshed meanwhile (``sources.versions``).

    Each micro-batch takes the newest version, records its number before it reads a row, and writes its results,
    with the number, to a folder of its own. A replay finds the record and reads the version it read before. Keys
    with many rows are set apart, as in any batch (``joining.lookup``).
    """

    def version_of(spark: SparkSession, batch_id: int) -> int:
        record = f"{path}/versions/batch_id={batch_id}"
        if path_exists(spark, f"{record}/_SUCCESS"):
            return spark.read.parquet(record).first()["version"]
        newest = versions.latest_version(spark, history_path)
        if newest is None:
            raise FileNotFoundError(f"no version under {history_path}")
        spark.createDataFrame([(newest,)], "version int").coalesce(1).write.mode("overwrite").parquet(record)
        return newest

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = version_of(spark, batch_id)
        fresh = recompute_features(batch, versions.read_version(spark, history_path, version), cols, amount)
        results = scorer.score_batch(fresh, carry).withColumn("history_version", F.lit(version))
        results.write.mode("overwrite").parquet(f"{path}/results/batch_id={batch_id}")

    writer = requests.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def monitor_stream(
    scored: DataFrame,
    time: str,
    *,
    window: str = "1 day",
    late_by: str = "1 hour",
    score: str = "score",
    threshold: float = 0.5,
) -> DataFrame:
    """Decisions and score buckets per event-time window, rows later than ``late_by`` dropped.

    In append mode (``start_to_parquet``) a window comes out once the watermark has passed its end; in
    update mode (``windows_to_parquet``) every change of a window does, so a drained run has them all.
    """
    s = F.col(score)
    review = F.count_if(decide(s, threshold) == "review")
    return (
        scored.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, late_by)
        .groupBy(F.window(time, window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            review.alias("reviewed"),
            F.array(*[F.count_if(s <= b) for b in SCORE_BUCKETS]).alias("at_or_below"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n",
            "reviewed",
            (F.col("n") - F.col("reviewed")).alias("allowed"),
            "at_or_below",
        )
    )


def windows_to_parquet(windows: DataFrame, path: str, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """Write a windowed aggregate as it changes, the open windows included.

    Each micro-batch leaves the windows that it changed under its own number, so a replay overwrites
    its own output; ``latest_windows`` reads the last state of each.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = windows.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every window that ``windows_to_parquet`` has written."""
    rows = spark.read.parquet(path)
    by = ["window_start", "window_end"]
    others = [c for c in rows.columns if c not in (*by, "batch_id")]
    newest = rows.groupBy(*by).agg(F.max_by(F.struct(*others), "batch_id").alias("row"))
    return newest.select(*by, "row.*")


def history_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    cols: TxnColumns = DEFAULT,
    *,
    once: bool = False,
    hot: Sequence[tuple[str, str]] = (),
    ways: int = 16,
    **options,
) -> StreamingQuery:
    """Running entity history of a stream, one ``batch_id=N`` folder per micro-batch.

    Earlier totals come from the keyed state (``state.with_totals``, which see for ``hot`` and ``ways``). They enter
    as one more row at the front of each entity, and the micro-batch goes through the same bounded running sums as a
    batch table; so a hot entity is spread over tasks in both. Rows are ordered by (time, id) inside a micro-batch; a
    row that arrives later than its time is counted on arrival. Writes overwrite by batch number, which makes a
    replay harmless, and the state goes back to the batch before.
    """
    spark = events.sparkSession
    state.use_rocksdb(spark)
    long = history.measured(events, cols, cols.history_keys)
    staged = working_dir(spark, "staged")

    def step(batch: DataFrame, batch_id: int) -> None:
        # Written first: what follows reads it several times, and the state must be updated once.
        place = f"{staged}/{batch_id}"
        batch.write.mode("overwrite").parquet(place)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(place)
        earlier = history.add_up(rows.where(F.col("kind") == state.TOTALS))
        back = [F.col(c).cast(long.schema[name].dataType).alias(name) for c, name in (("id", cols.id), ("time", cols.time))]
        mine = rows.where(F.col("kind") == state.ROW).select(*back, "key_type", "key", *history.SUMS)
        prior = history.history_of_measured(mine, cols, earlier=earlier, **options)
        prior.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = state.with_totals(long, cols, hot, ways).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def labelled_stream(
    scored: DataFrame,
    labels: DataFrame,
    row_id: str,
    *,
    scored_at: str = "scored_at",
    labelled_at: str = "labelled_at",
    within: str = "30 days",
    late_by: str = "1 day",
) -> DataFrame:
    """Scored rows with the label that arrives up to ``within`` after them, null when none does.

    A left outer join of two streams: both sides wait in the state for as long as the other may still bring a
    partner, which the watermarks (event time less ``late_by``) bound. A row with its label comes out at once, one
    without when its time is up; a label after that finds nothing.
    """
    left = scored.withColumn(scored_at, F.col(scored_at).cast("timestamp")).withWatermark(scored_at, late_by).alias("s")
    right = labels.select(F.col(row_id).alias("_id"), F.col("label"), F.col(labelled_at).cast("timestamp").alias(labelled_at)).withWatermark(labelled_at, late_by).alias("l")
    met = (
        (F.col(f"s.{row_id}") == F.col("l._id"))
        & (F.col(f"l.{labelled_at}") >= F.col(f"s.{scored_at}"))
        & (F.col(f"l.{labelled_at}") <= F.col(f"s.{scored_at}") + F.expr(f"INTERVAL {within}"))
    )
    return left.join(right, met, "left_outer").drop("_id")
