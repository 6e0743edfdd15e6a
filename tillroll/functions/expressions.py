"""Building blocks: tolerant parsing, ladders, conditional aggregates, ratios."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(value) -> Column:
    """A date column from a date, an ISO text or a column."""
    return value if isinstance(value, Column) else F.to_date(F.lit(str(value)))


def instant(value) -> Column:
    """A timestamp column from a datetime, an ISO text or a column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


# --- tolerant parsing: text that cannot be read gives NULL, never an error ------


def parse_ts(c: Column | str) -> Column:
    return F.try_to_timestamp(as_col(c))


def parse_day(c: Column | str) -> Column:
    return as_col(c).try_cast("date")


def parse_as(c: Column | str, dtype: str) -> Column:
    return as_col(c).try_cast(dtype)


def money(c: Column | str) -> Column:
    return as_col(c).try_cast(MONEY)


# --- ladders --------------------------------------------------------------------


def _ladder(tests: Iterable[tuple[Column, object]], rest: object) -> Column:
    out = None
    for test, label in tests:
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(rest)


def below(c: Column | str, steps, rest) -> Column:
    """First step whose limit is above the value; NULL falls through to ``rest``."""
    return _ladder(((as_col(c) < limit, label) for limit, label in steps), rest)


def up_to(c: Column | str, steps, rest) -> Column:
    return _ladder(((as_col(c) <= limit, label) for limit, label in steps), rest)


def at_least(c: Column | str, steps, rest) -> Column:
    return _ladder(((as_col(c) >= limit, label) for limit, label in steps), rest)


def more_than(c: Column | str, steps, rest) -> Column:
    return _ladder(((as_col(c) > limit, label) for limit, label in steps), rest)


def looked_up(c: Column | str, table: Mapping, rest) -> Column:
    return _ladder(((as_col(c) == key, label) for key, label in table.items()), rest)


# --- conditional aggregates and ratios ------------------------------------------


def sum_if(cond: Column, c: Column | str) -> Column:
    """Sum over matching rows; 0 when rows exist but none match."""
    value = as_col(c)
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def avg_if(cond: Column, c: Column | str) -> Column:
    """Mean over matching rows as a double; NULL when none match."""
    value = F.when(cond, as_col(c))
    return ratio(F.sum(value), F.count(value))


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as a double, NULL for a zero or missing denominator."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def mean(c: Column | str) -> Column:
    """Arithmetic mean as a double, computed from one exact sum and one count."""
    value = as_col(c)
    return ratio(F.sum(value), F.count(value))


def safe_divide(num: Column | str, den: Column | str, default: float = 0.0) -> Column:
    """num / den as a double, ``default`` for a zero or missing denominator."""
    n, d = as_col(num).cast("double"), as_col(den).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(float(default))).otherwise(F.try_divide(n, d))


def rounded(c: Column | str, digits: int) -> Column:
    """Half-up rounding by scale and floor, so that any SQL engine gives the same double."""
    scale = float(10 ** digits)
    return F.floor(as_col(c).cast("double") * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
