"""Joins with a sales plan: its days may be unfolded from few products, so it is never shipped whole."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from opslake.plans import metrics, views


def shipped(df):
    with redirect_stdout(io.StringIO()) as out:
        df.explain()
    return "BroadcastExchange" in out.getvalue()


def unfolded(spark):
    """Two days of products 1 (twice), 2 and NULL."""
    days = F.explode(F.array(F.lit("d1"), F.lit("d2")))
    units = {n: F.col("size") * k for n, k in (("baseline_forecast_units", 8), ("planned_stock_units", 10), ("interest_adjusted_forecast_units", 12))}
    parts = spark.sql("SELECT * FROM VALUES (1L, 1L), (1L, 1L), (2L, 3L), (NULL, 4L) AS t(product_id, size)")  # its size is known
    return parts.select("product_id", days.alias("festival_date"), *[c.alias(n) for n, c in units.items()])


def test_signal_forecast_deals_the_plan_out(spark, rows):
    signals = spark.createDataFrame([(1, 5), (1, 7), (9, 1), (None, 3)], "product_id long, predicted_units long")
    got = metrics.signal_forecast(signals, unfolded(spark))
    assert not shipped(got)
    assert rows(got) == [(1, "d1", 12, 12, 2, 1)] * 2 + [(1, "d2", 12, 12, 2, 1)] * 2


def products(spark):
    return spark.sql("SELECT * FROM VALUES (1L, 'a'), (2L, 'b'), (NULL, 'c') AS t(product_id, product_name)")


def test_stockout_deals_the_plan_out(spark, rows):
    sales = spark.createDataFrame([(1, "d1", "10:00", 5), (1, "d1", "11:00", 7), (None, "d1", "12:00", 1)], "product_id long, festival_date string, sale_ts string, quantity long")
    got = views.stockout(products(spark), unfolded(spark), sales)
    assert not shipped(got)
    assert rows(got) == [
        (1, "a", "d1", 8, 10, 12, "11:00", 24), (1, "a", "d2", 8, 10, 12, None, None),
        (2, "b", "d1", 24, 30, 36, None, None), (2, "b", "d2", 24, 30, 36, None, None),
    ]
    assert rows(metrics.stockout_metrics(got), "product_id", "festival_date", "units_sold") == [(1, "d1", 24), (1, "d2", None), (2, "d1", None), (2, "d2", None)]


def test_stockout_from_snapshots_deals_the_plan_out(spark, rows):
    seen = spark.createDataFrame([(1, "d1", "10:00", 3, 5), (1, "d1", "11:00", 0, 8), (1, "d1", "12:00", 0, 9)], "product_id long, festival_date string, snapshot_ts string, on_hand_units long, units_sold long")
    got = views.stockout_from_snapshots(products(spark), unfolded(spark), seen)
    assert not shipped(got)
    assert rows(got) == [
        (1, "a", "d1", 10, 12, "11:00", 9), (1, "a", "d2", 10, 12, None, None),
        (2, "b", "d1", 30, 36, None, None), (2, "b", "d2", 30, 36, None, None),
    ]
