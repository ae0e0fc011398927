"""Running sums whose windows stay bounded.

A window over a whole entity, score range or column sends that group to one task. Here
a large group is dealt by ranges of its own order, so a task holds one range of it: range totals
are pre-aggregated (with map-side combine), summed up over the short list of ranges, and added
to a window that never leaves its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import dealing
from riskloom.operators.dealing import dealt, large_groups
from riskloom.session import materialize

# A list of large groups of this many rows is small enough to broadcast (three narrow columns);
# a longer one is joined by shuffle.
MAX_BROADCAST_CELLS = 200_000


# Rows that one task of a range shuffle is meant to hold; windows inside of it hold as many as the caller says.
TASK_ROWS = 1_000_000

# What a row of a large group is dealt by.
_RANGE = ["_cell", "_group"]

# Rows without a time come after all others.
_LAST_INSTANT = 1 << 61


def _before(partition: Sequence[str], order: Sequence[Column]) -> Window:
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def cell_offsets(
    cells: DataFrame, by: Sequence[str], levels: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Sum of all earlier cells, for nested cells ordered level by level.

    ``cells`` has one row per ``by + levels``. Each level is summed on its own, so a window
    holds only the siblings under one parent cell. Result: ``by + levels`` and ``before_<sum>``.
    """
    by, levels = list(by), list(levels)
    out: DataFrame | None = None
    for depth in range(len(levels), 0, -1):
        keys = by + levels[:depth]
        totals = (
            cells
            if depth == len(levels)
            else cells.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
        )
        window = _before(keys[:-1], [F.col(keys[-1]).asc_nulls_last()])
        level = totals.select(
            *keys, *[F.coalesce(F.sum(s).over(window), F.lit(0)).alias(f"{s}@{depth}") for s in sums]
        )
        out = level if out is None else out.join(level, keys)
    assert out is not None
    return out.select(
        *by,
        *levels,
        *[
            sum((F.col(f"`{s}@{d}`") for d in range(2, len(levels) + 1)), F.col(f"`{s}@1`")).alias(
                f"before_{s}"
            )
            for s in sums
        ],
    )


def split_heavy(
    rows: DataFrame, by: Sequence[str], limit: int
) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of groups up to ``limit`` rows, rows of the larger groups or None, how many rows those are).

    The large groups, at most rows / limit of them, are counted and written down; a few numbers come back to the
    driver. The rows of small groups are dealt by group over as many tasks as they need. A null key is a group like
    any other.
    """
    heavy, groups, total, others = large_groups(rows, by, limit)
    if groups == 0:
        return dealt(rows, others, *by), None, 0
    keys = heavy.select(*[F.col(k).alias(f"_heavy_{i}") for i, k in enumerate(by)])
    marks = F.broadcast(keys) if groups <= MAX_BROADCAST_CELLS else keys
    same = F.lit(True)
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_heavy_{i}"))
    return dealt(rows.join(marks, same, "left_anti"), others, *by), rows.join(marks, same, "left_semi"), total


def _in_ranges(rows: DataFrame, by: Sequence[str], order: Sequence[Column], total: int, range_rows: int) -> DataFrame:
    """The rows, stored, with ``_cell`` (the range they lie in, in order) and ``_nth`` (orders equals).

    Equals of the order, too, are dealt to several ranges, so no range holds much more than its
    share whatever the types and values are. A task sorts its share, of about ``TASK_ROWS`` rows, and cuts
    it into ranges of ``range_rows``, so small ranges make no small tasks.
    """
    wanted = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(wanted, -(-total // max(range_rows, TASK_ROWS)))
    whole = [*[F.col(k).asc() for k in by], *order, F.col("_nth").asc()]
    dealt = rows.withColumn("_nth", F.monotonically_increasing_id()).repartitionByRange(n, *whole).sortWithinPartitions(*whole)
    # The rows of partition p are numbered from p * 2^33, so ranges ascend over all partitions.
    cell = F.expr(f"monotonically_increasing_id() div {int(range_rows)}")
    return materialize(dealt.withColumn("_cell", cell), "ranges")


def _sums_in_ranges(
    rows: DataFrame, by: list[str], order: Sequence[Column], sums: Sequence[str], total: int, range_rows: int
) -> DataFrame:
    """``before_<sum>`` of rows of large groups."""
    stored = _in_ranges(rows, by, order, total, range_rows)
    ranges = stored.groupBy(*by, "_cell").agg(*[F.sum(s).alias(s) for s in sums])
    offsets = _grouped(cell_offsets(ranges, by, ["_cell"], sums), by).drop(*by)
    leaf = _before(_RANGE, [*order, F.col("_nth").asc()])
    cut = dealt(_grouped(stored, by), total, *_RANGE)
    inside = cut.select("*", *[F.coalesce(F.sum(s).over(leaf), F.lit(0)).alias(f"_in_{s}") for s in sums])
    far = inside.join(offsets, _RANGE, "left")
    far = far.withColumns({f"before_{s}": F.coalesce(F.col(f"before_{s}"), F.lit(0)) + F.col(f"_in_{s}") for s in sums})
    return far.drop(*_RANGE, "_nth", *[f"_in_{s}" for s in sums])


def _grouped(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """With ``_group``, one value that is never null for the keys, so that windows and joins share one shuffle."""
    return rows.withColumn("_group", F.struct(*by) if by else F.lit(0))


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on equal or both null keys; the keys come from the left."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    same = F.lit(True)
    for k in on:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(other, same, "left").drop(*[f"_right_{k}" for k in on])


def prior_sums_by_time(
    rows: DataFrame,
    by: Sequence[str],
    time: str,
    tie: str,
    sums: Sequence[str],
    *,
    cell_rows: int = 1_000_000,
) -> DataFrame:
    """Add ``before_<sum>``: the sum over earlier rows of the same ``by`` group.

    Rows are ordered by ``(time, tie)``, any orderable types; no time comes last, no tie first. A
    group of up to ``cell_rows`` rows is one window. Larger ones are cut into ranges of about
    ``cell_rows`` rows of that same order, so they give the same result.
    """
    by = list(by)
    light, heavy, total = split_heavy(rows, by, cell_rows)
    order = [F.col(time).asc_nulls_last(), F.col(tie).asc()]
    whole = _before(by, order)
    out = light.select("*", *[F.coalesce(F.sum(s).over(whole), F.lit(0)).alias(f"before_{s}") for s in sums])
    if heavy is None:
        return out
    return out.unionByName(_sums_in_ranges(heavy, by, order, sums, total, cell_rows).select(*out.columns))


def prior_sums_strict(
    rows: DataFrame,
    by: Sequence[str],
    time: str,
    sums: Sequence[str],
    *,
    cell_rows: int = 1_000_000,
) -> DataFrame:
    """As above but over rows strictly earlier in time: peers at the same instant are left out.

    Times are whole numbers, of any unit. Small groups are one range window. Of large ones only
    (group, instant) totals are summed up, in ranges as above, and stored; the rows join them back by
    equality, those of instants with many rows by broadcast.
    """
    if not isinstance(rows.schema[time].dataType, T.IntegralType):
        raise TypeError(f"{time} must hold whole numbers, not {rows.schema[time].dataType.simpleString()}")
    by = list(by)
    # Rows with no time come after all others, as one instant.
    rows = rows.withColumn("_instant", F.coalesce(F.col(time).cast("long"), F.lit(_LAST_INSTANT)))
    light, heavy, total = split_heavy(rows, by, cell_rows)
    earlier = Window.partitionBy(*by).orderBy("_instant").rangeBetween(Window.unboundedPreceding, -1)
    out = light.select(
        "*", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"before_{s}") for s in sums]
    )
    if heavy is not None:
        instants = heavy.groupBy(*by, "_instant").agg(*[F.sum(s).alias(s) for s in sums], F.count(F.lit(1)).alias("_rows"))
        offsets = materialize(
            _sums_in_ranges(instants, by, [F.col("_instant").asc()], sums, total, cell_rows).drop(*sums), "instants"
        )
        out = out.unionByName(_at_instants(heavy, offsets, by, total).select(*out.columns))
    return out.drop("_instant")


def _at_instants(rows: DataFrame, offsets: DataFrame, by: Sequence[str], total: int) -> DataFrame:
    """The rows with what is known of their (group, instant); ``offsets`` are stored, with the ``_rows`` of each."""
    on = [*by, "_instant"]
    hot = offsets.where(F.col("_rows") > dealing.DEALT_ROWS)
    n, n_hot = offsets.agg(F.count(F.lit(1)), F.count_if(F.col("_rows") > dealing.DEALT_ROWS)).first()
    if n <= MAX_BROADCAST_CELLS:
        return _join_null_safe(rows, F.broadcast(offsets), on)
    if n_hot > MAX_BROADCAST_CELLS:
        # Too many to set apart: the runtime splits skewed partitions of this join.
        return _join_null_safe(rows, offsets, on)
    # Instants of many rows, at most total / DEALT_ROWS of them, are set apart.
    marked = _join_null_safe(rows, F.broadcast(hot), on)
    far = marked.where(F.col("_rows").isNotNull())
    near = _grouped(marked.where(F.col("_rows").isNull()).select(*rows.columns), by)
    known = _grouped(offsets, by).drop(*by)
    return far.unionByName(dealt(near, total, "_instant", "_group").join(known, ["_instant", "_group"], "left").drop("_group"))


def prior_sums_by_value(
    rows: DataFrame,
    by: Sequence[str],
    value: str,
    sums: Sequence[str],
    *,
    cell_rows: int = 1_000_000,
    with_next: bool = False,
) -> DataFrame:
    """Add ``before_<sum>`` and ``total_<sum>`` over ascending distinct values of a group.

    ``rows`` has one row per ``by + [value]``, counts already combined; it is stored once, so
    what it is made from is read once. Groups of up to ``cell_rows`` values are one window. Larger
    ones are cut into ranges of about that many values; the result does not depend on where the
    cuts fall. ``with_next`` also adds ``next_value``, the following distinct value of the group.
    """
    by = list(by)
    rows = materialize(rows, "values")
    if by:
        light, heavy, total = split_heavy(rows, by, cell_rows)
    else:
        total = rows.count()
        light, heavy = (rows, None) if total <= cell_rows else (None, rows)
    parts = []
    if light is not None:
        whole = Window.partitionBy(*by)
        before = _before(by, [F.col(value).asc()])
        parts.append(
            light.select(
                "*",
                *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"before_{s}") for s in sums],
                *[F.sum(s).over(whole).alias(f"total_{s}") for s in sums],
                *([F.lead(value).over(whole.orderBy(value)).alias("next_value")] if with_next else []),
            )
        )
    if heavy is not None:
        parts.append(_by_value_in_ranges(heavy, by, value, sums, total, cell_rows, with_next))
    out = parts[0]
    return out.unionByName(parts[1]) if len(parts) > 1 else out


def _by_value_in_ranges(
    rows: DataFrame, by: list[str], value: str, sums: Sequence[str], total: int, range_rows: int, with_next: bool
) -> DataFrame:
    rows = _in_ranges(rows, by, [F.col(value).asc()], total, range_rows).drop("_nth")
    per_cell = rows.groupBy(*by, "_cell").agg(
        *[F.sum(s).alias(s) for s in sums], F.min(value).alias("_first")
    )
    # One row per group and range from here on.
    before = _before(by, [F.col("_cell").asc()])
    whole = Window.partitionBy(*by)
    offsets = per_cell.select(
        *by,
        "_cell",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"before_{s}") for s in sums],
        *[F.sum(s).over(whole).alias(f"total_{s}") for s in sums],
        F.lead("_first").over(whole.orderBy("_cell")).alias("_next_first"),
    )
    leaf = _before(_RANGE, [F.col(value).asc()])
    in_order = Window.partitionBy(*_RANGE).orderBy(F.col(value).asc())
    inside = dealt(_grouped(rows, by), total, *_RANGE).select(
        "*",
        *[F.coalesce(F.sum(s).over(leaf), F.lit(0)).alias(f"_in_{s}") for s in sums],
        *([F.lead(value).over(in_order).alias("_next_in")] if with_next else []),
    )
    out = inside.join(_grouped(offsets, by).drop(*by), _RANGE, "left").withColumns(
        {f"before_{s}": F.col(f"before_{s}") + F.col(f"_in_{s}") for s in sums}
    )
    if with_next:
        out = out.withColumn("next_value", F.coalesce("_next_in", "_next_first")).drop("_next_in")
    return out.drop(*_RANGE, "_next_first", *[f"_in_{s}" for s in sums])


def exact_quantiles(
    df: DataFrame, value: str, fractions: dict[str, float], by: Sequence[str] = (), **options
) -> DataFrame:
    """Linearly interpolated quantiles, exact and without collecting a group anywhere.

    One row per ``by`` group with one column per entry of ``fractions``.
    """
    by = list(by)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = prior_sums_by_value(counts, by, "_v", ["_n"], **options)

    def at(rank: Column) -> Column:
        hit = (F.col("before__n") <= rank) & (rank < F.col("before__n") + F.col("_n"))
        return F.max(F.when(hit, F.col("_v")))

    picks, final = [], []
    for name, q in fractions.items():
        # A place that is a whole number must not miss it by the fraction's last bit.
        position = F.round((F.col("total__n") - 1) * F.lit(float(q)), 9)
        picks += [
            at(F.floor(position)).alias(f"{name}_lo"),
            at(F.ceil(position)).alias(f"{name}_hi"),
            F.max(position - F.floor(position)).alias(f"{name}_w"),
        ]
        lo, hi, w = (F.col(f"{name}_{p}") for p in ("lo", "hi", "w"))
        final.append((lo + (hi - lo) * w).alias(name))
    grouped = ranked.groupBy(*by).agg(*picks) if by else ranked.agg(*picks)
    return grouped.select(*by, *final)
