"""Leakage-safe history of an entity: what was known about it before each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import safe_divide
from riskloom.operators.dealing import dealt
from riskloom.operators.joining import keys_long, lookup, require_unique, with_row_key
from riskloom.operators.prefix import prior_sums_by_time, prior_sums_strict, split_heavy
from riskloom.schema import DEFAULT, MISSING_KEY, TxnColumns
from riskloom.session import materialize

SUMS = ("n", "y", "amt")
# A time before any other.
_FRONT = -(1 << 60)
# Rows that are compared one with another, and bits by which a larger group is cut.
FEW_ROWS, DIGIT_BITS = 64, 8


def measured(df: DataFrame, cols: TxnColumns, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """One row per row and key column: id, time, ``carry``, ``key_type``, ``key`` and what is summed up: ``n``, ``y``, ``amt``."""
    narrow = df.select(
        cols.id,
        cols.time,
        *carry,
        F.lit(1).cast("long").alias("n"),
        F.col(cols.label).cast("long").alias("y"),
        F.col(cols.amount).cast("double").alias("amt"),
        *keys,
    )
    return keys_long(narrow, keys, [cols.id, cols.time, *carry, *SUMS], MISSING_KEY)


def history_long(
    df: DataFrame,
    cols: TxnColumns = DEFAULT,
    keys: Sequence[str] | None = None,
    *,
    strict: bool = False,
    earlier: DataFrame | None = None,
    cell_rows: int = 1_000_000,
) -> DataFrame:
    """Count, fraud rate and mean amount of the earlier rows of the same entity, in long form.

    Default order is (time, id). ``strict`` leaves out rows at the same instant as well. The
    mean divides by rows, so a row without an amount still counts. ``earlier`` (``entity_sums``
    of rows before this frame) enters as one row in front of each entity.
    """
    return history_of_measured(measured(df, cols, tuple(keys or cols.history_keys)), cols, strict=strict, earlier=earlier, cell_rows=cell_rows)


def history_of_measured(
    rows: DataFrame, cols: TxnColumns, *, strict: bool = False, earlier: DataFrame | None = None, cell_rows: int = 1_000_000
) -> DataFrame:
    """The same of rows that are in long form already (``measured``)."""
    by = ["key_type", "key"]
    if earlier is not None:
        front = earlier.select(
            F.lit(None).cast(rows.schema[cols.id].dataType).alias(cols.id), F.lit(_FRONT).alias(cols.time), *by, *SUMS
        )
        rows = rows.unionByName(front)
    if strict:
        prior = prior_sums_strict(rows, by, cols.time, SUMS, cell_rows=cell_rows)
    else:
        prior = prior_sums_by_time(
            rows, by, cols.time, cols.id, SUMS, cell_rows=cell_rows,
        )
    if earlier is not None:
        prior = prior.where(F.col(cols.time).isNull() | (F.col(cols.time) != _FRONT))
    return prior.select(
        cols.id,
        *by,
        F.col("before_n").alias("cnt"),
        safe_divide(F.col("before_y"), F.col("before_n")).alias("fraud_rate"),
        safe_divide(F.col("before_amt"), F.col("before_n")).alias("amt_mean"),
    )


def entity_sums(
    df: DataFrame, cols: TxnColumns = DEFAULT, keys: Sequence[str] | None = None
) -> DataFrame:
    """Rows, label sum and amount sum per entity: ``key_type, key, n, y, amt``."""
    return add_up(measured(df, cols, tuple(keys or cols.history_keys)))


def add_up(sums: DataFrame) -> DataFrame:
    """Entity sums of several periods as one."""
    return sums.groupBy("key_type", "key").agg(
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in SUMS]
    )


def history_columns(keys: Sequence[str]) -> list[Column]:
    """Aggregates that turn long history rows of one id into ``<key>_hist_*`` columns."""
    out = []
    for key in keys:
        mine = F.col("key_type") == key
        out += [
            F.coalesce(F.max(F.when(mine, F.col("cnt"))), F.lit(0)).cast("long").alias(f"{key}_hist_count"),
            F.max(F.when(mine, F.col("fraud_rate"))).alias(f"{key}_hist_fraud_rate"),
            F.max(F.when(mine, F.col("amt_mean"))).alias(f"{key}_hist_amt_mean"),
        ]
    return out


def history_names(keys: Sequence[str]) -> list[str]:
    return [f"{k}_hist_{part}" for k in keys for part in ("count", "fraud_rate", "amt_mean")]


def spread_history(long: DataFrame, cols: TxnColumns, keys: Sequence[str], n_rows: int = 0) -> DataFrame:
    """Long history back to one row per id; ``n_rows`` (how many ids, if known) says over how many tasks.

    The output is partitioned by id, so the join to the wide table re-uses its id shuffle.
    """
    return dealt(long, n_rows, cols.id).groupBy(cols.id).agg(*history_columns(keys))


def add_entity_history(
    df: DataFrame, cols: TxnColumns = DEFAULT, keys: Sequence[str] | None = None, **options
) -> DataFrame:
    """Add ``<key>_hist_count``, ``_hist_fraud_rate`` and ``_hist_amt_mean`` of earlier rows.

    Ids must be unique, as values come back by id: a second row with an id would show the first its future.
    """
    keys = tuple(keys or cols.history_keys)
    n_rows = require_unique(df, cols)
    return df.join(spread_history(history_long(df, cols, keys, **options), cols, keys, n_rows), cols.id, "left")


def entity_aggregates(
    df: DataFrame,
    cols: TxnColumns = DEFAULT,
    keys: Sequence[str] | None = None,
    *,
    group: Sequence[str] = (),
) -> DataFrame:
    """Whole-frame aggregates per entity: ``key_type, key, fraud_rate, amt_mean, cnt``.

    One job for all keys. Null amounts are left out of the mean but counted in ``cnt``.
    """
    rows = measured(df, cols, tuple(keys or cols.history_keys), group)
    return rows.groupBy(*group, "key_type", "key").agg(
        F.avg("y").alias("fraud_rate"), F.avg("amt").alias("amt_mean"), F.count(F.lit(1)).alias("cnt")
    )


def map_entity_history(
    df: DataFrame,
    aggregates: DataFrame,
    cols: TxnColumns = DEFAULT,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Frozen ``entity_aggregates`` of a fitting period joined onto later rows.

    An unseen entity gets count 0 and null rate and mean; a null key is the missing entity. Ids may repeat or be
    missing: each row gets its own values.
    """
    keys = tuple(keys or cols.history_keys)
    stored = materialize(aggregates, "entity")
    rows, by_row = with_row_key(df, cols)
    found = lookup(keys_long(rows, keys, [by_row.id], MISSING_KEY), stored, ["key_type", "key"])
    return rows.join(spread_history(found, by_row, keys), by_row.id, "left").select(*df.columns, *history_names(keys))


def aggregates_by_target(
    df: DataFrame,
    source: str,
    feeds: dict[str, tuple[str, ...]],
    cols: TxnColumns = DEFAULT,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Entity aggregates per target split from one pass over the fitting rows.

    ``feeds`` names, for every value of column ``source``, the splits its rows are summed up
    for. Sums are formed per (source, entity) first; only those few rows are repeated per
    target. Result: ``target, key_type, key, fraud_rate, amt_mean, cnt``.
    """
    rows = measured(df.where(F.col(source).isin(*feeds)), cols, tuple(keys or cols.history_keys), [source])
    sums = rows.groupBy(source, "key_type", "key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("y"),
        F.count("y").alias("n_y"),
        F.sum("amt").alias("amt"),
        F.count("amt").alias("n_amt"),
    )
    targets = F.coalesce(
        *[F.when(F.col(source) == s, F.array(*[F.lit(t) for t in ts])) for s, ts in feeds.items()]
    )
    return (
        sums.withColumn("target", F.explode(targets))
        .groupBy("target", "key_type", "key")
        .agg(
            safe_divide(F.sum("y"), F.sum("n_y")).alias("fraud_rate"),
            safe_divide(F.sum("amt"), F.sum("n_amt")).alias("amt_mean"),
            F.sum("n").alias("cnt"),
        )
    )


def feature_history(
    df: DataFrame, cols: TxnColumns = DEFAULT, keys: Sequence[str] | None = None
) -> DataFrame:
    """The online lookup table: entity aggregates without the missing entity, nulls as 0."""
    keys = tuple(keys or cols.online_keys)
    narrow = df.select(
        F.col(cols.label).cast("long").alias("y"), F.col(cols.amount).cast("double").alias("amt"), *keys
    )
    return (
        keys_long(narrow, keys, ["y", "amt"])
        .where(F.col("key").isNotNull())
        .groupBy("key_type", "key")
        .agg(
            F.coalesce(F.avg("y"), F.lit(0.0)).alias("fraud_rate"),
            F.coalesce(F.avg("amt"), F.lit(0.0)).alias("amt_mean"),
            F.count(F.lit(1)).alias("cnt"),
        )
    )


def _sums_of_earlier(rows: DataFrame, group: Sequence[str], order: Sequence[str], sums: Sequence[str], out: Sequence[str]) -> DataFrame:
    """Add to columns ``out`` the ``sums`` of each group's rows that are smaller in ``order``, by comparing rows one with another.

    For groups of a few rows, each of which becomes one array.
    """
    others = [c for c in rows.columns if c not in group]
    all_rows = rows.groupBy(*group).agg(F.collect_list(F.struct(*others)).alias("_all"))

    def earlier(x: Column, r: Column) -> Column:
        less = F.lit(False)
        for c in reversed(order):
            less = (x[c] < r[c]) | ((x[c] == r[c]) & less)
        return less

    def filled(r: Column) -> Column:
        start = F.struct(*[r[b].alias(s) for s, b in zip(sums, out, strict=True)])
        found = F.aggregate(F.filter("_all", lambda x: earlier(x, r)), start, lambda a, x: F.struct(*[(a[s] + F.coalesce(x[s], F.lit(0))).alias(s) for s in sums]))
        return F.struct(*[r[c].alias(c) for c in others if c not in out], found.alias("_found"))

    inline = all_rows.select(*group, F.inline(F.transform("_all", filled)))
    return inline.select(*[F.col("_found")[sums[out.index(c)]].alias(c) if c in out else F.col(c) for c in rows.columns])


def recomputed_sums(rows: DataFrame, cols: TxnColumns, by: Sequence[str]) -> DataFrame:
    """``before_n, before_y, before_amt`` of long rows (``measured``) by comparing places, without any running sum.

    What comes before (time, id) is all earlier instants and, at the same instant, all smaller ids. Rows of a group of
    up to ``FEW_ROWS`` are compared one with another. A larger group is cut into aligned intervals by the next
    ``DIGIT_BITS`` bits of the time, then of the id: each row gets the sums of the intervals before its own, which
    are compared in the same way, and its interval is a group from there on. So a row moves a few times, whatever the
    span of times and ids. These must be whole numbers; no time counts as the last instant, no id as the first.
    """
    low = rows.agg(F.min(cols.time), F.max(cols.time), F.min(cols.id), F.max(cols.id)).first()
    t0, t1, i0, i1 = (v or 0 for v in low)
    before = [f"before_{s}" for s in SUMS]
    left = materialize(
        rows.withColumns(
            {
                "_t": F.coalesce(F.col(cols.time) - t0, F.lit(t1 - t0 + 1)).cast("long"),
                "_i": F.coalesce(F.col(cols.id) - i0 + 1, F.lit(0)).cast("long"),
                **{b: F.lit(0).cast(rows.schema[s].dataType) for s, b in zip(SUMS, before, strict=True)},
            }
        ),
        "placed",
    )
    digits = [(place, shift) for place, bits in (("_t", (t1 - t0 + 1).bit_length()), ("_i", (i1 - i0 + 1).bit_length())) for shift in reversed(range(0, bits, DIGIT_BITS))]
    wanted = [*rows.columns, *before]
    group, parts = list(by), []
    for k, (place, shift) in enumerate(digits):
        few, many, _ = split_heavy(left, group, FEW_ROWS)
        parts.append(_sums_of_earlier(few, group, ["_t", "_i"], SUMS, before).select(*wanted))
        if many is None:
            break
        digit = f"_digit_{k}"
        many = many.withColumn(digit, F.expr(f"shiftright({place}, {shift}) & {(1 << DIGIT_BITS) - 1}"))
        cells = many.groupBy(*group, digit).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in SUMS], *[F.lit(0).cast(rows.schema[s].dataType).alias(f"_{b}") for s, b in zip(SUMS, before, strict=True)])
        offsets = _sums_of_earlier(cells, group, [digit], SUMS, [f"_{b}" for b in before]).drop(*SUMS)
        group.append(digit)
        found = lookup(many, materialize(offsets, "intervals"), group)
        left = materialize(found.withColumns({b: F.col(b) + F.coalesce(F.col(f"_{b}"), F.lit(0)) for b in before}).drop(*[f"_{b}" for b in before]), "placed")
    else:
        # Rows that agree in time and id, so none comes before another.
        parts.append(left.select(*wanted))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def leakage_check(
    df: DataFrame,
    cols: TxnColumns = DEFAULT,
    keys: Sequence[str] | None = None,
    *,
    history: DataFrame | None = None,
    share: float = 1.0,
    **options,
) -> DataFrame:
    """Proof per key column that no row's history contains itself or anything later.

    ``history`` (default: ``history_long`` of ``df``) is compared with a recompute by another way
    (``recomputed_sums``), over all rows of a ``share`` of the entities, drawn by hash. Reported are the rows
    compared, those where the two differ, and the correlation of the given history rate with the label. Ids must
    be unique.
    """
    keys = tuple(keys or cols.history_keys)
    by = ["key_type", "key"]
    given = history_long(df, cols, keys, **options) if history is None else history
    drawn = F.pmod(F.xxhash64(F.lit("entity"), *by), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    again = recomputed_sums(measured(df, cols, keys).where(drawn), cols, by)
    mine = given.where(drawn).select(F.col(cols.id).alias("_id"), *[F.col(c).alias(f"_{c}") for c in (*by, "cnt", "fraud_rate", "amt_mean")])
    same = F.col(cols.id).eqNullSafe(F.col("_id")) & (F.col("key_type") == F.col("_key_type")) & (F.col("key") == F.col("_key"))
    both = again.join(mine, same, "left")
    rate = safe_divide(F.col("before_y"), F.col("before_n"))
    mean = safe_divide(F.col("before_amt"), F.col("before_n"))

    def off(given: Column, right: Column) -> Column:
        return ~F.coalesce(F.abs(given - right) <= 1e-9 * F.greatest(F.abs(right), F.lit(1.0)), given.isNull() & right.isNull())

    differs = ~F.col("_cnt").eqNullSafe(F.col("before_n")) | off(F.col("_fraud_rate"), rate) | off(F.col("_amt_mean"), mean)
    return both.groupBy("key_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(differs).alias("mismatches"),
        F.corr("_fraud_rate", F.when(F.col("_fraud_rate").isNotNull(), F.col("y"))).alias("rate_label_corr"),
    )
