"""Column helpers for semantics that Spark's built-ins spell differently."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(value: dt.date) -> Column:
    return F.lit(value)


def moment(value: dt.datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def midnight(value: dt.date) -> dt.datetime:
    return dt.datetime.combine(value, dt.time())


def days_before(as_of: dt.date, n: int) -> Column:
    return F.lit(as_of - dt.timedelta(days=n))


def months_before(as_of: dt.date, n: int) -> Column:
    """n calendar months earlier; the day is cut to the length of the target month."""
    return F.add_months(F.lit(as_of), -n)


def month_earlier(as_of: dt.date) -> dt.date:
    """One calendar month earlier, as a Python date."""
    year, month = (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)
    return dt.date(year, month, min(as_of.day, calendar.monthrange(year, month)[1]))


def date_diff(unit: str, start: ColumnLike, end: ColumnLike) -> Column:
    """Number of unit boundaries crossed from start to end.

    00:00:59 to 00:01:01 is one minute. Spark's timestampdiff counts elapsed
    whole units instead and would say zero.
    """
    start, end = col(start), col(end)
    if unit == "day":
        return F.datediff(end, start)
    if unit in ("month", "year"):
        years = F.year(end) - F.year(start)
        return years if unit == "year" else years * 12 + F.month(end) - F.month(start)
    return _clock_index(unit, end) - _clock_index(unit, start)


def _clock_index(unit: str, c: Column) -> Column:
    """Number of the unit a wall-clock time lies in, without going through a time zone."""
    hours = F.datediff(c, F.lit(dt.date(1970, 1, 1))).cast("long") * 24 + F.hour(c)
    if unit == "hour":
        return hours
    minutes = hours * 60 + F.minute(c)
    if unit == "minute":
        return minutes
    if unit == "second":
        return minutes * 60 + F.second(c)
    if unit == "millisecond":
        return minutes * 60000 + F.floor(F.date_part(F.lit("SECOND"), c) * 1000).cast("long")
    raise ValueError(unit)


def ratio0(top: ColumnLike, bottom: ColumnLike) -> Column:
    """top / bottom as double; 0 where the divisor is 0 or NULL."""
    bottom = col(bottom).cast("double")
    return F.when(F.coalesce(bottom, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
        col(top).cast("double") / bottom
    )


def ratio(top: ColumnLike, bottom: ColumnLike) -> Column:
    """top / bottom as double; NULL where the divisor is 0."""
    return F.try_divide(col(top).cast("double"), col(bottom).cast("double"))


def clamp(value: ColumnLike, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), col(value)))


def band(value: ColumnLike, steps: Sequence[tuple[float, str]], default: str, op: str = ">") -> Column:
    """First label whose threshold the value passes, tested in the order given."""
    value = col(value)
    tests = {
        ">": lambda x: value > x,
        ">=": lambda x: value >= x,
        "<": lambda x: value < x,
        "<=": lambda x: value <= x,
    }
    out = None
    for threshold, label in steps:
        test = tests[op](F.lit(threshold))
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(default)


def mean(value: ColumnLike) -> Column:
    """Average as double over an exact sum, so the order of rows does not matter."""
    value = col(value)
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def slope(y: ColumnLike, x: ColumnLike) -> Column:
    """Least-squares slope over rows where both are set, from exact sums.

    ``y`` and ``x`` are decimals or integers, so the order of rows does not matter.
    """
    both = col(y).isNotNull() & col(x).isNotNull()
    y, x = F.when(both, col(y)), F.when(both, col(x))

    def total(c: Column) -> Column:
        return F.sum(c).cast("double")

    n = F.count(y).cast("double")
    return F.try_divide(n * total(x * y) - total(x) * total(y), n * total(x * x) - total(x) * total(x))


def corr(y: ColumnLike, x: ColumnLike) -> Column:
    """Correlation over rows where both are set; NULL where one side does not vary.

    The built-in raises a division error there.
    """
    both = col(y).isNotNull() & col(x).isNotNull()
    y, x = F.when(both, col(y).cast("double")), F.when(both, col(x).cast("double"))
    return F.try_divide(F.covar_pop(y, x), F.stddev_pop(y) * F.stddev_pop(x))


def count_if(test: Column) -> Column:
    return F.count(F.when(test, F.lit(1)))


def sum_if(test: Column, value: ColumnLike) -> Column:
    """Sum over rows that pass; 0 where rows exist but none passes."""
    return F.sum(F.when(test, col(value)).otherwise(F.lit(0)))


def flag(test: Column) -> Column:
    """1 where the test holds, 0 where it is false or NULL."""
    return F.when(test, F.lit(1)).otherwise(F.lit(0))


def draw(key: ColumnLike | Sequence[ColumnLike], salt: str, n: int = 100) -> Column:
    """A repeatable number in 0..n-1, one per key and salt.

    Taken from an MD5 digest, so any engine can draw the same number.
    """
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    digest = F.md5(F.concat_ws("|", *[col(k).cast("string") for k in keys], F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def pick(options: Sequence[str], index: Column) -> Column:
    """The option at a computed position, wrapping around."""
    return F.element_at(
        F.array(*[F.lit(o) for o in options]),
        (F.pmod(index, F.lit(len(options))) + 1).cast("int"),
    )


def is_weekend(date: ColumnLike) -> Column:
    return F.dayofweek(col(date)).isin(1, 7)
