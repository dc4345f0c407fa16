"""Zone-free time expressions. None of them reads the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(text: str) -> Column:
    """A ``timestamp_ntz`` literal; folded at planning, so filters on it reach the scan."""
    return F.lit(text).cast("timestamp_ntz")


def utc_wall_clock(instant: Column) -> Column:
    """The UTC wall clock of a zone-aware timestamp.

    Counts microseconds from the epoch. Casting through the session zone would
    mix up the hour that repeats when its summer time ends.
    """
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), moment("1970-01-01"))


def month_bucket(when: Column) -> Column:
    """``yyyy-MM`` of a ``timestamp_ntz``; years beyond 9999 keep all their digits."""
    year = F.year(when).cast("string")
    year = F.when(F.length(year) < 4, F.lpad(year, 4, "0")).otherwise(year)
    month = F.lpad(F.month(when).cast("string"), 2, "0")
    return F.concat(year, F.lit("-"), month)


def hour_bucket(when: Column) -> Column:
    """Hour of day, 0 to 23."""
    return F.hour(when)
