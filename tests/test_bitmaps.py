"""Distinct counts over ranges of days against sets."""

import datetime as dt
import random

from pyspark.sql import functions as F

from opslake.operators.bitmaps import daily_bitmaps, distinct_in_ranges


def test_ranges_equal_sets(spark, rows):
    rng, d0 = random.Random(2), dt.date(2026, 8, 1)
    day = lambda k: d0 + dt.timedelta(days=k)
    data = [(day(rng.randrange(20)), rng.choice([rng.randrange(50), rng.randrange(200_000), -rng.randrange(70_000), None])) for _ in range(3000)]
    data += [(None, 5), (day(3), 1 << 40), (day(4), 1 << 40)]
    ranges = [(i, day(a), day(b)) for i, (a, b) in enumerate([(0, 0), (0, 19), (3, 4), (5, 11), (30, 40), (7, 6), (-9, 2)])]
    table = daily_bitmaps(spark.createDataFrame(data, "d date, v long"), F.col("d"), "v")
    got = distinct_in_ranges(table, spark.createDataFrame(ranges, "range_id int, first_day date, last_day date"))
    want = [(i, len({v for d, v in data if d and v is not None and a <= d <= b})) for i, a, b in ranges]
    assert rows(got) == sorted(want, key=repr)
    facts = spark.createDataFrame([], "d date, v long")
    assert rows(distinct_in_ranges(daily_bitmaps(facts, F.col("d"), "v"), spark.createDataFrame(ranges[:1], "range_id int, first_day date, last_day date"))) == [(0, 0)]
