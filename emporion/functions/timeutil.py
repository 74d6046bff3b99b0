"""Explicit UTC conversions between instants and wall-clock times.

Event times are instants (TIMESTAMP, needed for watermarks); outputs, dates
and lake partitions use the UTC wall clock (TIMESTAMP_NTZ).  A cast between the
two, or ``timestamp_diff`` on wall-clock times, goes through
``spark.sql.session.timeZone`` and folds the repeated hour of a clock change.
These helpers only count microseconds from the epoch, so no zone takes part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def wall_micros(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end``, both TIMESTAMP_NTZ."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def utc_wall(instant: Column) -> Column:
    """TIMESTAMP (instant) -> TIMESTAMP_NTZ holding its UTC wall-clock time."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def from_utc_wall(wall: Column) -> Column:
    """TIMESTAMP_NTZ holding a UTC wall-clock time -> TIMESTAMP (instant)."""
    return F.timestamp_micros(wall_micros(_epoch(), wall))


def utc_date(instant: Column) -> Column:
    return F.to_date(utc_wall(instant))
