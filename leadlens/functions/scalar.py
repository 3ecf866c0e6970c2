"""Scalar expressions (all JVM-side built-ins; no row-wise Python).

ANSI mode stays on: divisions use ``try_divide`` and parses ``try_to_timestamp`` so a
bad value gives NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name: dots and backticks in it are no syntax."""
    return F.col("`" + name.replace("`", "``") + "`")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: str | Column, text: str) -> Column:
    """Remove every literal occurrence of ``text`` (no regex)."""
    return F.replace(_c(c), F.lit(text), F.lit(""))


def parse_timestamp(c: str | Column, pattern: str | None = None) -> Column:
    """ISO text such as ``2013-04-05T10:11:12.000+0000`` to a timestamp; NULL when
    malformed. Without a pattern the ISO forms (with or without offset) are accepted."""
    if pattern is None:
        return F.try_to_timestamp(_c(c))
    return F.try_to_timestamp(_c(c), F.lit(pattern))


# Fixed value: the pattern of the export's timestamps (fraction and numeric offset).
ISSUE_TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"


def elapsed_minutes(start: str | Column, end: str | Column) -> Column:
    """Whole minutes elapsed from ``start`` to ``end`` (truncated, 1:59 -> 1)."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def elapsed_days(start: str | Column, end: str | Column) -> Column:
    """Whole days elapsed (truncated)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def duration_interval(start: str | Column, end: str | Column) -> Column:
    """The exact elapsed time as a day-time interval."""
    return _c(end) - _c(start)


def duration_text_minutes(c: str | Column) -> Column:
    """Text ``'N days HH:MM:SS'`` (optionally with fraction) to whole minutes."""
    pat = r"^\s*(-?\d+) days? (\d{1,2}):(\d{2}):(\d{2})"
    s = _c(c)
    days = F.regexp_extract(s, pat, 1)
    return F.when(
        days != "",
        days.cast("bigint") * 1440
        + F.regexp_extract(s, pat, 2).cast("bigint") * 60
        + F.regexp_extract(s, pat, 3).cast("bigint"),
    )


# Largest number of whole days that a day-time interval (microseconds in 64 bits) holds.
_MAX_INTERVAL_DAYS = 106751990


def minutes_to_interval(c: str | Column) -> Column:
    """Minutes (double) to a day-time interval, exact to the microsecond; NULL when the value is
    null, not finite or beyond what an interval holds (about 1.5e11 minutes)."""
    m = _c(c).cast("double")
    ok = m.isNotNull() & ~F.isnan(m) & (F.abs(m) < F.lit(float(_MAX_INTERVAL_DAYS) * 1440.0))
    size = F.when(ok, F.abs(m))
    days = F.floor(size / 1440.0)
    rest = size - days * 1440.0
    mins = F.floor(rest)
    span = F.make_dt_interval(days.cast("int"), F.lit(0), mins.cast("int"), ((rest - mins) * 60.0).cast("decimal(18,6)"))
    return F.when(ok, F.when(m < 0, -span).otherwise(span))


def log1p(c: str | Column) -> Column:
    return F.log1p(_c(c))


def ln_positive(c: str | Column) -> Column:
    """Natural log of positive values; NULL for <= 0 (callers count and exclude them)."""
    x = _c(c)
    return F.when(x > 0, F.ln(x))


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(_c(c), F.lit(0))


def two_groups(c: str | Column, members: Iterable[str], inside: str, outside: str) -> Column:
    """``inside`` when the value is one of ``members``, else ``outside`` (NULL -> outside)."""
    return F.when(_c(c).isin(*list(members)), F.lit(inside)).otherwise(F.lit(outside))


def significance(p: str | Column, alpha: float = 0.05) -> Column:
    return F.when(_c(p) < F.lit(alpha), F.lit("Yes")).otherwise(F.lit("No"))


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL when b is 0."""
    return F.try_divide(_c(a), _c(b))


def pct_change(new: str | Column, base: str | Column) -> Column:
    return F.lit(100.0) * F.try_divide(_c(new) - _c(base), _c(base))


def linspace(start: float, stop: float, num: int) -> Column:
    """Array of ``num`` evenly spaced doubles from start to stop inclusive."""
    if num == 1:
        return F.array(F.lit(float(start)))
    step = (stop - start) / (num - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(num - 1)), lambda i: F.lit(float(start)) + i.cast("double") * F.lit(step))


def logspace(start: float, stop: float, num: int) -> Column:
    """10 ** linspace(start, stop, num)."""
    return F.transform(linspace(start, stop, num), lambda e: F.pow(F.lit(10.0), e))


def arange(start: int, stop: int, step: int = 1) -> Column:
    """Integers start, start+step, ... below stop."""
    last = stop - 1 if step > 0 else stop + 1
    return F.sequence(F.lit(start), F.lit(last), F.lit(step))


def fmt(c: str | Column, decimals: int) -> Column:
    return F.format_number(_c(c), decimals)
