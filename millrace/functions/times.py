"""Times without a zone as instants, for operators that take these alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _start() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def as_instant(time: Column, kind: T.DataType) -> Column:
    """A time as an instant; one without a zone is read as UTC, whatever the session's zone."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _start(), time))
    return time.cast("timestamp")


def from_instant(instant: Column, kind: T.DataType) -> Column:
    """What ``as_instant`` was made from."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _start())
    return instant.cast(kind)
