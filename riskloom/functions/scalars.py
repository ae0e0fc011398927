"""Row-level column expressions; every one stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """``num / den`` as double, null where the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def zero_if_missing(col: Column) -> Column:
    """Null and NaN become 0.0."""
    return F.coalesce(F.nanvl(col.cast("double"), F.lit(0.0)), F.lit(0.0))


def event_time(seconds: Column, reference: str) -> Column:
    """Zone-free timestamp ``seconds`` after the reference date."""
    return F.timestamp_add("SECOND", seconds, F.lit(reference).cast("timestamp_ntz"))


def calendar(seconds: Column, reference: str) -> dict[str, Column]:
    """Month, ISO week, day, hour, weekday (Monday 0) and weekend flag."""
    ts = event_time(seconds, reference)
    weekday = F.weekday(ts)
    return {
        "DT_M": F.month(ts),
        "DT_W": F.weekofyear(ts),
        "DT_D": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
    }


def amount_log(amount: Column) -> Column:
    """log(1 + amount) with negative amounts clipped to zero; null stays null."""
    amt = amount.cast("double")
    return F.when(amt.isNotNull(), F.log1p(F.greatest(amt, F.lit(0.0))))


def amount_cents(amount: Column) -> Column:
    amt = amount.cast("double")
    return (amt - F.floor(amt)) * 100.0


def amount_parts(amount: Column, name: str) -> dict[str, Column]:
    return {f"{name}_log": amount_log(amount), f"{name}_cents": amount_cents(amount)}


def os_family(text: Column) -> Column:
    """Leading letters of the operating-system string, null when there are none."""
    return F.nullif(F.regexp_extract(text.cast("string"), r"^([A-Za-z]+)", 1), F.lit(""))


def browser_family(text: Column) -> Column:
    """First whitespace-separated token of the browser string."""
    return F.nullif(F.regexp_extract(text.cast("string"), r"(\S+)", 1), F.lit(""))


def entity_key(key: Column, missing: str) -> Column:
    """A null entity is an entity of its own."""
    return F.coalesce(key.cast("string"), F.lit(missing))


# Fixed values of the sampling order: the Mersenne prime 2^31-1 and two multipliers below it.
_PRIME = 2_147_483_647
_MULT_A = 48_271
_MULT_B = 69_621


def sampling_order(row_id: Column, seed: int) -> Column:
    """A seeded pseudo-random order of integer ids in plain 64-bit arithmetic.

    Any SQL engine computes the same number, so a sample can be reproduced elsewhere.
    """
    first = F.pmod(F.pmod(row_id, F.lit(_PRIME)) * _MULT_A + seed, F.lit(_PRIME))
    folded = F.pmod(first, F.lit(65_536)) * 32_768 + F.floor(first / 65_536)
    return F.pmod(folded * _MULT_B + seed, F.lit(_PRIME))
