"""Streams against their batch twins."""

import pytest
from pyspark.sql import functions as F

from riskloom.catalog.registry import steady
from riskloom.operators import history, modelling, monitoring
from riskloom.operators.scoring import recompute_features
from riskloom.plans.serving import BatchScorer
from riskloom.session import working_dir
from riskloom.sources import versions
from riskloom.streaming import jobs
from test_history import skewed


def stream(spark, df, path, parts, by):
    """A frame as a file stream of ``parts`` micro-batches in the order of ``by``."""
    bounds = df.approxQuantile(by, [i / parts for i in range(1, parts)], 0.0)
    edges = [float("-inf"), *bounds, float("inf")]
    for i in range(parts):
        piece = df.where((F.col(by) > edges[i]) & (F.col(by) <= edges[i + 1])).coalesce(1)
        piece.write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def history_rows(df):
    cols = ["transaction_id", "key_type", "key", "cnt", F.round("fraud_rate", 9), steady(F.col("amt_mean"))]
    return sorted(map(str, df.select(cols).collect()))


@pytest.mark.parametrize("hot", [(), (("card1", "HOT"), ("addr1", "0"))])
def test_history_stream_equals_batch_over_many_micro_batches(spark, hot):
    """Ids beyond what a double holds, missing labels and amounts; with and without entities dealt to sub-keys."""
    df = skewed(spark, 600).withColumn("transaction_id", F.col("transaction_id") + (1 << 60))
    df = df.withColumn("is_fraud", F.when(F.col("transaction_id") % 17 != 0, F.col("is_fraud"))).cache()
    base = working_dir(spark, "history-test")
    source = stream(spark, df, f"{base}/in", 4, "transaction_dt")
    query = jobs.history_stream(source, f"{base}/out", f"{base}/checkpoint", once=True, hot=hot, ways=3, cell_rows=30)
    query.awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    assert got.select("batch_id").distinct().count() == 4
    assert history_rows(got) == history_rows(history.history_long(df))


def test_history_stream_goes_on_from_its_checkpoint(spark):
    df = skewed(spark, 300)
    base = working_dir(spark, "history-restart")
    parts = [df.where(F.col("transaction_dt").between(a, b)) for a, b in ((0, 399_999), (400_000, 499_999), (500_000, 2_000_000))]
    run = lambda hot: jobs.history_stream(
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in"),
        f"{base}/out", f"{base}/checkpoint", once=True, hot=hot, ways=2,
    ).awaitTermination()
    for part, hot in zip(parts, ((), (), (("card1", "HOT"),)), strict=True):  # split at a later start
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        run(hot)
    assert history_rows(spark.read.parquet(f"{base}/out")) == history_rows(history.history_long(df))
    run((("card1", "HOT"),))  # nothing new, nothing changes
    assert spark.read.parquet(f"{base}/out").count() == history.history_long(df).count()


def labelled(spark, base, scored, labels, parts=3):
    """Both sides as streams of several files, joined in one drained run."""
    for name, df, at in (("scored", scored, "scored_at"), ("labels", labels, "labelled_at")):
        seconds = df.withColumn("_s", F.unix_timestamp(at).cast("double")).cache()
        bounds = [float("-inf"), *seconds.approxQuantile("_s", [k / parts for k in range(1, parts)], 0.0), float("inf")]
        for low, high in zip(bounds, bounds[1:], strict=False):
            seconds.where((F.col("_s") > low) & (F.col("_s") <= high)).drop("_s").coalesce(1).write.mode("append").parquet(f"{base}/{name}")
    read = lambda name, df: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}")
    joined = jobs.labelled_stream(read("scored", scored), read("labels", labels), "id", within="5 days", late_by="1 hour")
    jobs.start_to_parquet(joined, f"{base}/out", f"{base}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/out")


def test_labels_that_arrive_in_time_join_and_later_ones_do_not(spark):
    """The last rows only move the watermarks past the others."""
    at = lambda day, hour=0: f"2024-01-{day:02d} {hour:02d}:00:00"
    scored = [(k, k / 10, at(1 + k, 3)) for k in range(6)] + [(99, 0.5, at(31))]
    labels = [(0, 1, at(1, 3)), (1, 0, at(7, 3)), (2, 1, at(8, 4)), (3, 1, at(4, 2)), (4, None, at(6, 0)), (98, 0, at(31))]
    cast = lambda rows, schema, name: spark.createDataFrame(rows, schema).withColumn(name, F.col(name).cast("timestamp"))
    out = labelled(
        spark, working_dir(spark, "labels-test"),
        cast(scored, "id long, score double, scored_at string", "scored_at"), cast(labels, "id long, label int, labelled_at string", "labelled_at"),
    )
    # 0 at the same instant and 1 at the bound join; 2 is an hour late, 3 before its score, 5 without label
    got = {r["id"]: (r["label"], r["labelled_at"] is not None) for r in out.collect()}
    assert {k: v for k, v in got.items() if k != 99} == {0: (1, True), 1: (0, True), 2: (None, False), 3: (None, False), 4: (None, True), 5: (None, False)}
    told = monitoring.labelled_performance(out.where("id < 99").withColumn("period", F.lit("all")), "period").first()
    assert (told["n_scored"], told["n_labelled"], told["n_unlabelled"], told["n"], told["positives"]) == (6, 2, 4, 2, 1)


def test_monitor_stream_holds_back_the_open_window(spark):
    rows = [(f"2024-01-0{d} 0{h}:00:00", h / 10) for d in (1, 2, 3) for h in range(10)]
    df = spark.createDataFrame(rows, "ts string, score double").select(F.col("ts").cast("timestamp").alias("ts"), "score")
    base = working_dir(spark, "monitor-test")
    df.coalesce(1).write.parquet(f"{base}/in")
    source = spark.readStream.schema(df.schema).parquet(f"{base}/in")
    query = jobs.start_to_parquet(
        jobs.monitor_stream(source, "ts", threshold=0.5), f"{base}/out", f"{base}/checkpoint", once=True
    )
    query.awaitTermination()
    out = spark.read.parquet(f"{base}/out").orderBy("window_start").collect()
    assert [(r["n"], r["reviewed"], r["allowed"]) for r in out] == [(10, 5, 5)] * 2
    assert out[0]["at_or_below"][3] == 4 and out[0]["at_or_below"][10] == 10


def test_a_drained_run_has_all_windows_over_many_micro_batches(spark):
    base = working_dir(spark, "windows-test")
    for part in range(3):  # every file holds rows of both days
        rows = [(f"2024-01-0{d} 0{h}:30:00", h / 10) for d in (1, 2) for h in range(part, 9, 3)]
        df = spark.createDataFrame(rows, "ts string, score double").select(F.col("ts").cast("timestamp").alias("ts"), "score")
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    windows = jobs.monitor_stream(source, "ts", late_by="3 days")
    jobs.windows_to_parquet(windows, f"{base}/out", f"{base}/checkpoint", once=True).awaitTermination()
    assert spark.read.parquet(f"{base}/out").select("batch_id").distinct().count() >= 3
    out = jobs.latest_windows(spark, f"{base}/out").orderBy("window_start").collect()
    assert [(r["n"], r["reviewed"]) for r in out] == [(9, 4)] * 2


@pytest.fixture(scope="module")
def scoring(spark):
    """(requests, history table, scorer)."""
    df = skewed(spark, 300)
    features = ["card1_hist_fraud_rate", "card1_hist_count", "transaction_amt_log"]
    table_ = history.feature_history(df).cache()
    train = recompute_features(df.drop("transaction_amt").withColumn("amount", F.lit(12.5)), table_, amount="amount")
    model = modelling.train_boosted_trees(
        train.select(*features, F.col("is_fraud").alias("label")), features,
        n_estimators=3, max_depth=2, learning_rate=0.3, colsample=1.0,
    )
    return df.select("transaction_id", "card1", "addr1", F.lit(12.5).alias("amount")), table_, BatchScorer(model, 0.5)


def test_score_stream_equals_batch(spark, scoring):
    raw, table_, scorer = scoring
    base = working_dir(spark, "score-test")
    raw.coalesce(2).write.parquet(f"{base}/in")
    source = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query = jobs.start_to_parquet(
        jobs.score_stream(source, table_, scorer, amount="amount"), f"{base}/out", f"{base}/checkpoint", once=True
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    want = scorer.score_batch(recompute_features(raw, table_, amount="amount"))
    assert got.count() == 300
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_refreshed_history_is_used_by_the_next_batch_and_not_by_a_replay(spark, scoring):
    raw, table_, scorer = scoring
    base = working_dir(spark, "versions-test")
    fresh = table_.withColumn("fraud_rate", F.lit(0.9)).withColumn("cnt", F.col("cnt") + 1000)
    run = lambda checkpoint: jobs.score_stream_versioned(
        spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in"),
        f"{base}/history", scorer, f"{base}/out", f"{base}/{checkpoint}", amount="amount", once=True,
    ).awaitTermination()
    parts = [raw.where("transaction_id < 150"), raw.where("transaction_id >= 150")]
    for k, (table, part) in enumerate(zip((table_, fresh), parts, strict=True)):
        assert versions.publish(table, f"{base}/history") == k + 1
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
        run("checkpoint")
    versions.publish(table_.limit(0), f"{base}/history")
    spark.range(1).write.parquet(f"{base}/history/v=9")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/history/v=9/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)  # a version that was never finished
    assert versions.latest_version(spark, f"{base}/history") == 3
    want = sorted(
        str((*r, k + 1)) for k, (table, part) in enumerate(zip((table_, fresh), parts, strict=True))
        for r in scorer.score_batch(recompute_features(part, table, amount="amount")).collect()
    )
    got = lambda: sorted(str(tuple(r)) for r in spark.read.parquet(f"{base}/out/results").drop("batch_id").collect())
    assert got() == want
    run("lost")  # the same batches from the start, as after a failure
    assert got() == want
