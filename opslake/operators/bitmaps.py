"""Exact distinct counts over any range of days, from mergeable bitmaps.

A table holds, per day and bucket of 32,768 values, a bitmap of the values seen.
Bitmaps of many days are combined by OR, so a question about a range of days
reads one row per day and bucket, never the facts again, and a day that is
recomputed replaces its own rows only. A bitmap takes 4 kB however few values it
holds, so values should be dense whole numbers, such as ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_bitmaps(rows: DataFrame, day: Column, value: str) -> DataFrame:
    """(day, bucket, seen): which values occur on each day; NULL values count for none. Combined before the shuffle."""
    v = F.col(value).cast("bigint")
    return (
        rows.where(v.isNotNull() & day.isNotNull())
        .groupBy(day.cast("date").alias("day"), F.bitmap_bucket_number(v).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("seen"))
    )


def distinct_in_ranges(bitmaps: DataFrame, ranges: DataFrame, key: str = "range_id", first: str = "first_day", last: str = "last_day") -> DataFrame:
    """(key, distinct_values) for every row of ``ranges`` (key, first, last), both days included; 0 where nothing was seen.

    A range is unfolded to its days, so days and ranges meet by an equi join.
    """
    asked = ranges.select(F.col(key), F.explode(F.sequence(F.col(first).cast("date"), F.greatest(F.col(last).cast("date"), F.col(first).cast("date")))).alias("day"), (F.col(last) < F.col(first)).alias("_none"))
    merged = asked.where(~F.col("_none")).join(bitmaps, "day").groupBy(key, "bucket").agg(F.bitmap_or_agg("seen").alias("seen"))
    counts = merged.groupBy(F.col(key).alias("_key")).agg(F.sum(F.bitmap_count("seen")).alias("n"))
    found = ranges.select(key).join(counts, F.col(key).eqNullSafe(F.col("_key")), "left")
    return found.select(key, F.coalesce("n", F.lit(0)).cast("bigint").alias("distinct_values"))
