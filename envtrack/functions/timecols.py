"""Time helpers that give the same answer whatever the session time zone is.

Stored ``timestamp`` values are instants (TimestampType). Reports emit TIMESTAMP_NTZ wall-clock
values in UTC, and day/hour buckets are computed on epoch microseconds, not with zone-aware
functions such as ``to_date`` or ``date_trunc``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def _epoch_ntz():
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def micros(ts: Column) -> Column:
    """Epoch microseconds of an instant (TimestampType)."""
    return F.unix_micros(ts)


def ntz_micros(ts: Column) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ value read as UTC."""
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts)


def micros_to_ntz(us: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) from epoch microseconds."""
    return F.timestamp_add("MICROSECOND", us, _epoch_ntz())


def utc_ntz(ts: Column) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ of an instant."""
    return micros_to_ntz(micros(ts))


def bucket_micros(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket of ``seconds`` width, in microseconds."""
    width = seconds * MICROS_PER_SECOND
    return F.floor(micros(ts) / width) * width


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket as UTC TIMESTAMP_NTZ."""
    return micros_to_ntz(bucket_micros(ts, seconds))
