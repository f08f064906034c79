"""Epoch seconds, timestamps and zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_now() -> Column:
    """Current epoch seconds, truncated; one value for the whole query."""
    return F.unix_timestamp(F.current_timestamp())


#: The last second of the year 9999. Stamps in milliseconds or finer lie beyond it.
LAST_SECOND = 253_402_300_799


def epoch_to_time(seconds: Column) -> Column:
    """Epoch seconds as a timestamp; NULL before 1970 and after the year 9999.

    Tested on the number: the conversion itself overflows, and would stop a
    stream for ever over one message.
    """
    return F.timestamp_seconds(F.when(seconds.between(0, LAST_SECOND), seconds))


def utc_ntz(moment: Column) -> Column:
    """The UTC wall clock as TIMESTAMP_NTZ, whatever the session time zone is."""
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), epoch)
