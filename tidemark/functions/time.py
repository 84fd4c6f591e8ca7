"""Time conversions that do not depend on the session time zone.

The test tables hold TIMESTAMP_NTZ values (wall-clock UTC).  Converting them
through a zoned TIMESTAMP would shift them by the session zone, so epoch
values are computed as differences between NTZ timestamps, and epoch values
are turned into UTC dates arithmetically (as the original SQL's DATE() of a
timestamp does)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def ntz_literal(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal written as text (no zone conversion)."""
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = value
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def epoch_micros(ntz: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (read as UTC)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ntz)


def epoch_seconds(ntz: Column) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ (read as UTC)."""
    return F.floor(epoch_micros(ntz) / F.lit(1_000_000)).cast("long")


def utc_date_of_epoch_seconds(seconds: Column) -> Column:
    """UTC calendar date of an epoch-seconds value."""
    return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))
