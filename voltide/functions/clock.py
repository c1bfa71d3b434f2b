"""Time arithmetic on the wall clock of a column, independent of the session zone.

Everything stays on the internal microsecond value: differences of zone-free timestamps are day-time
intervals, and ``window`` floors to fixed widths.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _wall(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970-01-01 of the wall-clock value."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (_wall(c) - origin).cast("interval second").cast("bigint")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference in seconds with microsecond resolution."""
    return (_wall(later) - _wall(earlier)).cast("interval second").cast("decimal(18,6)").cast("double")


def time_chunk(c: Column, seconds: int) -> Column:
    """Number of the fixed-width time slice that holds ``c``."""
    return F.floor(epoch_seconds(c) / F.lit(seconds)).cast("long")


def floor_time(c: Column, seconds: int) -> Column:
    """Start of the fixed-width window that holds ``c``, in the type of ``c``.

    Rows without a time fall out, as they belong to no window. Use at most once per projection.
    """
    return F.window(c, f"{seconds} seconds")["start"]


def plus_seconds(c: Column, seconds: Column) -> Column:
    return c + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def utc_instant(c: Column) -> Column:
    """The wall-clock value read as UTC, as the zoned type that watermarks need."""
    fraction = F.pmod((F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint"), F.lit(1_000_000))
    return F.timestamp_micros(epoch_seconds(c) * 1_000_000 + fraction)


def utc_wall(c: Column) -> Column:
    """The UTC wall clock of an instant, without a zone; inverse of ``utc_instant``."""
    seconds = (F.unix_micros(c).cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
