"""Date and timestamp expressions; times are local and carry no zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of the source files.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"


def parse_ts(col: Column) -> Column:
    return F.to_timestamp_ntz(col, F.lit(TS_FORMAT))


def format_ts(col: Column) -> Column:
    return F.date_format(col, TS_FORMAT)


def format_day(col: Column) -> Column:
    return F.date_format(col, DAY_FORMAT)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``; both may be date text."""
    return F.datediff(end, start).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, truncated towards zero.

    Local times are subtracted as they stand, so a clock change in the zone of
    the session does not count. (``timestamp_diff`` would convert to that zone.)
    """
    gap = end - start
    part = {unit: F.extract(F.lit(unit), gap) for unit in ("DAY", "HOUR", "MINUTE", "SECOND")}
    whole = (part["DAY"].cast("bigint") * 24 + part["HOUR"]) * 60 + part["MINUTE"]
    # The parts of a negative gap are all negative, so truncating the seconds truncates the sum.
    return (whole * 60 + part["SECOND"].cast("bigint")).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated towards zero."""
    return (seconds_between(start, end) / 60).cast("bigint")
