"""Scalar Column helpers (F1-F16). All JVM-side expressions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields null instead of raising under ANSI mode (x/0, x/null)."""
    return F.try_divide(num, den)


def ratio_change(now: Column, before: Column) -> Column:
    """(now - before) / before, null when ``before`` is 0 or null."""
    return safe_div(now - before, before)


def clip0(x: Column) -> Column:
    """max(x, 0) that keeps null as null (``greatest`` alone skips nulls)."""
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(x, F.lit(0.0)))


def nan_to_null(x: Column) -> Column:
    """Normalise NaN to SQL NULL at a read boundary (pandas has one notion of missing)."""
    return F.nanvl(x, F.lit(None).cast("double"))


def direction(up: Column) -> Column:
    """'UP' when the predicate holds, otherwise 'DOWN'."""
    return F.when(up, F.lit("UP")).otherwise(F.lit("DOWN"))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock ``timestamp_ntz``, independent of the session
    time zone (a cast to ``timestamp`` would shift by the zone and its DST rules)."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), ts)


def micros_between(start: Column, end: Column) -> Column:
    """``end - start`` in microseconds for wall-clock timestamps (time-zone free)."""
    return F.timestamp_diff("MICROSECOND", start, end)


def hour_floor(ts: Column) -> Column:
    """Wall-clock hour of a ``timestamp_ntz`` (time-zone free, unlike ``date_trunc``)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
