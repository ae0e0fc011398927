"""Sources, joins, validation and time split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import sql
from riskloom.catalog.registry import query
from riskloom.operators import encodings, history, joining, splitting, validation
from riskloom.operators.history import map_entity_history
from riskloom.plans import features as feature_plans
from riskloom.schema import identity_schema, transaction_schema
from riskloom.session import materialize, working_dir
from riskloom.sources import tables, testbed

COLS = testbed.COLS
KEYS = COLS.history_keys


def boundaries(spark: SparkSession, sf: str) -> tuple[float, float]:
    rows = testbed.transactions(spark, sf, address=False)
    return splitting.boundary_values(splitting.split_boundaries(rows, cols=COLS))


def interim(spark: SparkSession, sf: str) -> DataFrame:
    """The joined table as ingestion leaves it: stored once, read by every later pass."""
    return materialize(testbed.joined(spark, sf), "joined")


def with_split(spark: SparkSession, sf: str, identity: bool = True) -> DataFrame:
    rows = testbed.joined(spark, sf) if identity else testbed.transactions(spark, sf, address=False)
    return splitting.assign_split(rows, *boundaries(spark, sf), COLS)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return with_split(spark, sf, identity=False).select(
        "transaction_id", "transaction_dt", "split", F.col("is_fraud").alias("label"),
        testbed.integer_score().alias("score"),
    )


def both_models(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_split(spark, sf, identity=False)
    keep = ["split", F.col("is_fraud").alias("label")]
    return rows.select(
        F.lit("candidate").alias("model"), *keep, testbed.integer_score().alias("score")
    ).unionByName(
        rows.select(F.lit("baseline").alias("model"), *keep, testbed.integer_score(7901, 0).alias("score"))
    )


# --- sources and sinks ---------------------------------------------------------------------

_TXN_COLUMNS = "transaction_id, transaction_dt, transaction_amt, is_fraud, card1, addr1, p_emaildomain"
_IDN_COLUMNS = "device_type, device_info, id_01, id_30, id_31"


@query("scan_csv", sql.with_(f"SELECT {_TXN_COLUMNS} FROM txn", "txn"))
def scan_csv(spark, sf):
    path = working_dir(spark, "csv")
    rows = testbed.transactions(spark, sf)
    # In another order than the schema's, and with a column that it doesn't know.
    rows.select(F.lit("x").alias("M1"), *reversed(rows.columns)).write.option("header", True).csv(path)
    return tables.scan_csv(spark, path, transaction_schema(COLS)).select(*rows.columns)


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf):
    return tables.scan_parquet(spark, f"{sf}/orders.parquet")


@query(
    "sink_parquet",
    sql.with_(
        """SELECT transaction_id, transaction_dt, transaction_amt, is_fraud, card1, p_emaildomain, split FROM sp""",
        "sp",
    ),
)
def sink_parquet(spark, sf):
    rows = with_split(spark, sf, identity=False)
    return spark.read.parquet(tables.sink_parquet(rows, working_dir(spark, "sink"), ["split"]))


SUMMARY = f"""SELECT n.split, count(transaction_id) AS rows, round(avg(is_fraud), 6) AS fraud_rate,
    CAST(coalesce(sum(is_fraud), 0) AS BIGINT) AS n_positives,
    min({sql.EVENT_TIME}) AS date_min, max({sql.EVENT_TIME}) AS date_max
    FROM (VALUES ('train'), ('validation'), ('holdout')) AS n(split) LEFT JOIN sp ON sp.split = n.split
    GROUP BY n.split"""


@query(
    "sink_json_report",
    sql.with_(
        """SELECT 'split' AS section, 'reference_date' AS name, '1995-01-01' AS value
        UNION ALL SELECT 'split', 'train_frac', '0.7' UNION ALL SELECT 'split', 'val_frac', '0.15'
        UNION ALL SELECT 'split', 't1', CAST(t1 AS VARCHAR) FROM bounds
        UNION ALL SELECT 'split', 't2', CAST(t2 AS VARCHAR) FROM bounds"""
        + "".join(
            f" UNION ALL SELECT 'split.' || split, '{f}', CAST({f} AS VARCHAR) FROM summary"
            for f in ("rows", "fraud_rate", "n_positives", "date_min", "date_max")
        ),
        "sp",
        summary=SUMMARY,
    ),
)
def sink_json_report(spark, sf):
    manifest = splitting.split_manifest(testbed.transactions(spark, sf, address=False), cols=COLS)
    path = tables.sink_json_report(manifest, working_dir(spark, "manifest"))
    return spark.read.schema(manifest.schema).json(path)


@query("ingest_split", sql.with_(f"SELECT {_TXN_COLUMNS}, {_IDN_COLUMNS} FROM jnd", "jnd"))
def ingest_split(spark, sf):
    raw = working_dir(spark, "raw")
    write = {"train_transaction": testbed.transactions, "train_identity": testbed.identity}
    for name, table in write.items():
        # The JSON text in one column holds quotes, escaped the standard way; columns come in another order.
        rows = table(spark, sf)
        rows.select(*reversed(rows.columns)).write.option("header", True).option("escape", '"').csv(f"{raw}/{name}.csv")
    df, _ = tables.ingest_split(
        spark, "train", raw, working_dir(spark, "interim"), COLS,
        transaction_schema(COLS), identity_schema(COLS),
    )
    return df.select(*testbed.joined(spark, sf).columns)


@query(
    "union_train_validation",
    sql.with_(
        "SELECT transaction_id, split, device_type FROM sp WHERE split IN ('train', 'validation')", "sp"
    ),
)
def union_train_validation(spark, sf):
    t1, t2 = boundaries(spark, sf)
    rows = splitting.assign_split(testbed.joined(spark, sf), t1, t2, COLS)
    train = splitting.period_filter(rows, until=t1, cols=COLS)
    later = splitting.period_filter(rows, after=t1, until=t2, cols=COLS)
    return tables.union_rows(train, later).select("transaction_id", "split", "device_type")


@query(
    "period_filter",
    sql.with_(
        """SELECT 'train' AS period, transaction_id, transaction_amt FROM txn, bounds WHERE transaction_dt <= t1
        UNION ALL SELECT 'validation', transaction_id, transaction_amt FROM txn, bounds
        WHERE transaction_dt > t1 AND transaction_dt <= t2
        UNION ALL SELECT 'holdout', transaction_id, transaction_amt FROM txn, bounds WHERE transaction_dt > t2""",
        "txn", "bounds",
    ),
)
def period_filter(spark, sf):
    t1, t2 = boundaries(spark, sf)
    rows = testbed.transactions(spark, sf)
    out = None
    for name, after, until in (("train", None, t1), ("validation", t1, t2), ("holdout", t2, None)):
        part = splitting.period_filter(rows, after, until, COLS).select(
            F.lit(name).alias("period"), "transaction_id", "transaction_amt"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "align_columns",
    sql.with_(
        """SELECT transaction_id, transaction_amt, coalesce(id_01, 0) AS id_01,
        CAST(0 AS DOUBLE) AS not_in_frame, CAST(is_fraud AS DOUBLE) AS is_fraud FROM jnd""",
        "jnd",
    ),
)
def align_columns(spark, sf):
    return tables.align_columns(
        testbed.joined(spark, sf), ["transaction_amt", "id_01", "not_in_frame", "is_fraud"], ["transaction_id"]
    )


_FIRST = "(((transaction_id % 2147483647) * 48271 + 7) % 2147483647)"
_ORDER = f"((({_FIRST} % 65536) * 32768 + {_FIRST} // 65536) * 69621 + 7) % 2147483647"


@query(
    "sample_rows",
    sql.with_(
        f"""SELECT transaction_id, CAST(transaction_dt AS DOUBLE) AS transaction_dt, transaction_amt,
        CAST(is_fraud AS DOUBLE) AS is_fraud, coalesce(id_01, 0) AS id_01
        FROM jnd ORDER BY {_ORDER}, transaction_id LIMIT 300""",
        "jnd",
    ),
)
def sample_rows(spark, sf):
    return tables.sample_rows(testbed.joined(spark, sf), 300, 7, "transaction_id", clean=True)


@query(
    "topk_scores",
    sql.with_(
        """SELECT extreme, CAST(place AS INTEGER) AS place, transaction_id, score FROM (
        SELECT 'highest' AS extreme, row_number() OVER (ORDER BY score DESC, transaction_id) AS place,
               transaction_id, score FROM scored WHERE split = 'holdout'
        UNION ALL SELECT 'lowest', row_number() OVER (ORDER BY score, transaction_id), transaction_id, score
        FROM scored WHERE split = 'holdout') WHERE place <= 5""",
        "scored",
    ),
)
def topk_scores(spark, sf):
    holdout = scored(spark, sf).where("split = 'holdout'").select("transaction_id", "score")
    return tables.topk_scores(holdout, "score", "transaction_id")


# --- joins -----------------------------------------------------------------------------------


@query("join_identity", sql.with_(f"SELECT {_TXN_COLUMNS}, {_IDN_COLUMNS} FROM jnd", "jnd"))
def join_identity(spark, sf):
    return joining.join_identity(testbed.transactions(spark, sf), testbed.identity(spark, sf), COLS)


_HIST_NAMES = [f"{k}_hist_{p}" for k in KEYS for p in ("count", "fraud_rate", "amt_mean")]


def rounded_history(df: DataFrame, keys=KEYS, *others: str) -> DataFrame:
    from riskloom.catalog.registry import steady

    out = ["transaction_id", *others]
    for k in keys:
        out += [
            f"{k}_hist_count",
            F.round(f"{k}_hist_fraud_rate", 6).alias(f"{k}_hist_fraud_rate"),
            steady(F.col(f"{k}_hist_amt_mean")).alias(f"{k}_hist_amt_mean"),
        ]
    return df.select(*out)


ROUNDED_HISTORY_SQL = ", ".join(
    f"{k}_hist_count, round({k}_hist_fraud_rate, 6) AS {k}_hist_fraud_rate,"
    f" {sql.steady(f'{k}_hist_amt_mean')} AS {k}_hist_amt_mean"
    for k in KEYS
)


@query(
    "map_entity_history",
    sql.with_(
        f"SELECT transaction_id, {ROUNDED_HISTORY_SQL} FROM hist WHERE split = 'validation'", "hist"
    ),
)
def map_entity_history_query(spark, sf):
    t1, t2 = boundaries(spark, sf)
    rows = testbed.transactions(spark, sf)
    fitted = history.entity_aggregates(splitting.period_filter(rows, until=t1, cols=COLS), COLS)
    later = splitting.period_filter(rows, after=t1, until=t2, cols=COLS)
    return rounded_history(map_entity_history(later, fitted, COLS))


_FREQ_SQL = ", ".join(f"{k}_freq" for k in COLS.frequency_keys)


@query(
    "map_frequency",
    sql.with_(f"SELECT transaction_id, {_FREQ_SQL} FROM hist WHERE split = 'validation'", "hist"),
)
def map_frequency(spark, sf):
    t1, t2 = boundaries(spark, sf)
    rows = interim(spark, sf)
    counts = encodings.frequency_counts(splitting.period_filter(rows, until=t1, cols=COLS), COLS)
    later = splitting.period_filter(rows, after=t1, until=t2, cols=COLS)
    return encodings.map_frequency(later, counts, COLS).select(
        "transaction_id", *feature_plans.frequency_names(COLS)
    )


@query(
    "lookup_feature_history",
    sql.with_(
        f"""SELECT t.transaction_id, round(h.r, 6) AS card1_hist_fraud_rate,
        {sql.steady('h.a')} AS card1_hist_amt_mean, h.c AS card1_hist_count
        FROM txn t LEFT JOIN (SELECT card1, avg(is_fraud) AS r, avg(transaction_amt) AS a, count(*) AS c
                              FROM sp WHERE split = 'train' AND card1 IS NOT NULL GROUP BY card1) h
        ON t.card1 = h.card1""",
        "sp",
    ),
)
def lookup_feature_history(spark, sf):
    t1, _ = boundaries(spark, sf)
    rows = testbed.transactions(spark, sf)
    table = history.feature_history(splitting.period_filter(rows, until=t1, cols=COLS), COLS)
    return rounded_history(joining.lookup_feature_history(rows, table, "card1", "card1"), ["card1"])


# --- validation ------------------------------------------------------------------------------


@query(
    "check_required_columns",
    sql.with_(
        """SELECT 'train' AS stage, 'transaction_id' AS column_name, true AS present, count(transaction_id) AS filled_rows FROM txn
        UNION ALL SELECT 'train', 'transaction_dt', true, count(transaction_dt) FROM txn
        UNION ALL SELECT 'train', 'transaction_amt', true, count(transaction_amt) FROM txn
        UNION ALL SELECT 'train', 'is_fraud', false, 0 FROM (SELECT 1)
        UNION ALL SELECT 'test', 'transaction_id', true, count(transaction_id) FROM txn
        UNION ALL SELECT 'test', 'transaction_dt', true, count(transaction_dt) FROM txn
        UNION ALL SELECT 'test', 'transaction_amt', true, count(transaction_amt) FROM txn""",
        "txn",
    ),
)
def check_required_columns(spark, sf):
    unlabelled = testbed.transactions(spark, sf).drop("is_fraud")
    return validation.check_required_columns(unlabelled, "train", COLS).unionByName(
        validation.check_required_columns(unlabelled, "test", COLS)
    )


@query(
    "check_unique_key",
    """SELECT 'orders' AS table_name, count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
    FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def check_unique_key(spark, sf):
    out = None
    for name, key in (("orders", ("o_orderkey",)), ("lineitem", ("l_orderkey", "l_linenumber"))):
        part = validation.duplicate_keys(spark.read.parquet(f"{sf}/{name}.parquet"), key).select(
            F.lit(name).alias("table_name"), "duplicate_keys", "duplicate_rows"
        )
        out = part if out is None else out.unionByName(part)
    return out


def _shifted(spark, sf) -> DataFrame:
    """Transactions made to fail: time from 1996 on, amounts less 100,000, one label value more."""
    return testbed.transactions(spark, sf).withColumns(
        {
            "transaction_dt": F.col("transaction_dt") - 31_536_000,
            "transaction_amt": F.col("transaction_amt") - 100_000.0,
            "is_fraud": F.col("is_fraud") * F.when(F.pmod("transaction_id", F.lit(5)) == 0, 2).otherwise(1),
        }
    )


_SHIFTED = """SELECT transaction_id, transaction_dt - 31536000 AS transaction_dt,
    transaction_amt - 100000 AS transaction_amt,
    is_fraud * CASE WHEN transaction_id % 5 = 0 THEN 2 ELSE 1 END AS is_fraud FROM txn"""


def _finding(name: str, spark, sf) -> DataFrame:
    good, bad = testbed.transactions(spark, sf), _shifted(spark, sf)
    out = None
    for source, df in (("as_is", good), ("shifted", bad)):
        part = validation.validation_report(df, "train", COLS, (name,))
        part = part.select(F.lit(source).alias("source"), "severity", "status", "value")
        out = part if out is None else out.unionByName(part)
    return out


def _finding_sql(value: str, failed: str, severity: str = "error") -> str:
    body = " UNION ALL ".join(
        f"""SELECT '{source}' AS source, '{severity}' AS severity,
        CASE WHEN {failed} THEN 'fail' ELSE 'pass' END AS status, CAST({value} AS DOUBLE) AS value FROM {table}"""
        for source, table in (("as_is", "txn"), ("shifted", "shifted"))
    )
    return sql.with_(body, "txn", shifted=_SHIFTED)


@query("check_time_range", _finding_sql("min(transaction_dt)", "min(transaction_dt) < 0"))
def check_time_range(spark, sf):
    return _finding("time_range", spark, sf)


_NON_POSITIVE = "count(*) FILTER (WHERE transaction_amt <= 0)"


@query("check_amount_positive", _finding_sql(_NON_POSITIVE, f"{_NON_POSITIVE} > 0"))
def check_amount_positive(spark, sf):
    return _finding("amount_positive", spark, sf)


_BAD_LABELS = "count(*) FILTER (WHERE is_fraud IS NULL OR is_fraud NOT IN (0, 1))"


@query("check_label_domain", _finding_sql(_BAD_LABELS, f"{_BAD_LABELS} > 0"))
def check_label_domain(spark, sf):
    return _finding("label_domain", spark, sf)


@query(
    "label_stats",
    sql.with_(
        "SELECT round(avg(is_fraud), 6) AS fraud_rate, CAST(sum(is_fraud) AS BIGINT) AS n_positives FROM txn",
        "txn",
    ),
)
def label_stats(spark, sf):
    stats = validation.statistics(testbed.transactions(spark, sf), COLS)
    return testbed.transactions(spark, sf).agg(*[stats[n].alias(n) for n in ("fraud_rate", "n_positives")])


_COVERAGE = "round(CAST(count(device_type) AS DOUBLE) / count(*), 4)"


@query(
    "identity_coverage",
    sql.with_(
        f"""SELECT {_COVERAGE} AS identity_coverage,
        CASE WHEN {_COVERAGE} < 0.1 THEN 'warning' ELSE 'ok' END AS finding FROM jnd""",
        "jnd",
    ),
)
def identity_coverage(spark, sf):
    joined = testbed.joined(spark, sf)
    return joined.agg(validation.statistics(joined, COLS)["identity_coverage"].alias("identity_coverage")).withColumn(
        "finding", F.when(F.col("identity_coverage") < validation.LOW_COVERAGE, "warning").otherwise("ok")
    )


REPORT_ROWS = f"""SELECT 'train' AS stage, * FROM (
    SELECT 'required_columns' AS check_name, 'error' AS severity, 'pass' AS status, CAST(0 AS DOUBLE) AS value
    UNION ALL SELECT 'time_range', 'error', CASE WHEN min(transaction_dt) < 0 THEN 'fail' ELSE 'pass' END,
                     CAST(min(transaction_dt) AS DOUBLE) FROM jnd
    UNION ALL SELECT 'amount_positive', 'error', CASE WHEN {_NON_POSITIVE} > 0 THEN 'fail' ELSE 'pass' END,
                     CAST({_NON_POSITIVE} AS DOUBLE) FROM jnd
    UNION ALL SELECT 'label_domain', 'error', CASE WHEN {_BAD_LABELS} > 0 THEN 'fail' ELSE 'pass' END,
                     CAST({_BAD_LABELS} AS DOUBLE) FROM jnd
    UNION ALL SELECT 'fraud_rate', 'stat', 'pass', round(avg(is_fraud), 6) FROM jnd
    UNION ALL SELECT 'n_positives', 'stat', 'pass', CAST(sum(is_fraud) AS DOUBLE) FROM jnd
    UNION ALL SELECT 'identity_coverage_low', 'warning', CASE WHEN {_COVERAGE} < 0.1 THEN 'fail' ELSE 'pass' END,
                     {_COVERAGE} FROM jnd
    UNION ALL SELECT 'identity_coverage', 'stat', 'pass', {_COVERAGE} FROM jnd
    UNION ALL SELECT 'rows', 'stat', 'pass', CAST(count(*) AS DOUBLE) FROM jnd
    UNION ALL SELECT 'n_columns', 'stat', 'pass', CAST(12 AS DOUBLE)
    UNION ALL SELECT 'unique_key', 'error', CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END, CAST(count(*) AS DOUBLE)
              FROM (SELECT 1 FROM jnd GROUP BY transaction_id HAVING count(*) > 1))"""


@query("validation_report", sql.with_("SELECT * FROM vr", "jnd", vr=REPORT_ROWS))
def validation_report(spark, sf):
    return validation.validation_report(testbed.joined(spark, sf), "train", COLS)


# --- time split ------------------------------------------------------------------------------


@query("to_event_time", sql.with_(f"SELECT transaction_id, {sql.EVENT_TIME} AS event_time FROM txn", "txn"))
def to_event_time(spark, sf):
    from riskloom.functions.scalars import event_time

    return testbed.transactions(spark, sf).select(
        "transaction_id", event_time(F.col("transaction_dt"), COLS.reference_time).alias("event_time")
    )


@query("split_boundaries", sql.with_("SELECT t1, t2 FROM bounds", "bounds"))
def split_boundaries(spark, sf):
    found = splitting.split_boundaries(testbed.transactions(spark, sf, address=False), cols=COLS)
    return found.select(F.round("t1", 6).alias("t1"), F.round("t2", 6).alias("t2"))


@query("assign_split", sql.with_("SELECT transaction_id, split FROM sp", "sp"))
def assign_split(spark, sf):
    return with_split(spark, sf, identity=False).select("transaction_id", "split")


@query(
    "split_summary",
    sql.with_("SELECT * FROM summary", "sp", summary=SUMMARY),
)
def split_summary(spark, sf):
    rows = testbed.transactions(spark, sf, address=False)
    return splitting.split_summary(rows, *boundaries(spark, sf), COLS)
