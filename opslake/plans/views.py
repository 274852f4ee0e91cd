"""Analysis views: delay, equipment health, gate congestion, stock-out, refund context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions.numeric import exact_avg
from opslake.operators.aggregates import count_where
from opslake.operators.joins import flag_exists

# Sensor states that count as abnormal.
ABNORMAL = ("WARNING", "CRITICAL")
SUCCESS = "SUCCESS"


def stage_delay(schedule: DataFrame, actual: DataFrame, stages: DataFrame) -> DataFrame:
    """Planned against actual start of each performance, with the stage name if known."""
    happened = actual.select("performance_id", "actual_start_ts", "delay_minutes", "status", "incident_id")
    names = stages.select("stage_id", "stage_name")
    return (
        schedule.select("performance_id", "festival_date", "stage_id", "artist_name", "planned_start_ts")
        .join(happened, "performance_id")
        .join(names, "stage_id", "left")
        .select(
            "festival_date", "stage_id", "stage_name", "performance_id", "artist_name", "planned_start_ts",
            "actual_start_ts", "delay_minutes", "status", "incident_id",
        )
    )


def equipment_health(sensors: DataFrame) -> DataFrame:
    """Average, range and abnormal readings per day, stage, device and metric."""
    return sensors.groupBy("festival_date", "stage_id", "equipment_id", "metric_name").agg(
        exact_avg(F.col("metric_value"), 3).alias("avg_metric_value"),
        F.round(F.min("metric_value"), 3).alias("min_metric_value"),
        F.round(F.max("metric_value"), 3).alias("max_metric_value"),
        count_where(F.col("status").isin(*ABNORMAL)).alias("abnormal_event_count"),
    )


def gate_congestion(scans: DataFrame) -> DataFrame:
    """Attempts, scan time and queue per day, gate and result."""
    return scans.groupBy("festival_date", "gate_id", "result_code").agg(
        F.count(F.lit(1)).alias("scan_attempts"),
        exact_avg(F.col("scan_duration_ms"), 1).alias("avg_scan_duration_ms"),
        exact_avg(F.col("queue_estimate_minutes"), 1).alias("avg_queue_minutes"),
    )


def stockout(products: DataFrame, plan: DataFrame, sales: DataFrame) -> DataFrame:
    """Plan and forecast against sales; ``stockout_ts`` is the last sale of the day.

    Sales are summed per product and day before the join, so a best seller
    ships one row per task. The closing group keeps one row per plan. The plan
    is dealt out by product, as estimates do not count days that are unfolded.
    """
    sold = sales.groupBy("product_id", "festival_date").agg(
        F.max("sale_ts").alias("_last_sale"), F.sum("quantity").alias("_units")
    )
    keys = [
        "product_id", "product_name", "festival_date", "baseline_forecast_units", "planned_stock_units",
        "interest_adjusted_forecast_units",
    ]
    return (
        plan.select("product_id", "festival_date", *keys[3:]).hint("merge")
        .join(products.select("product_id", "product_name"), "product_id")
        .join(sold, ["product_id", "festival_date"], "left")
        .groupBy(*keys)
        .agg(F.max("_last_sale").alias("stockout_ts"), F.sum("_units").cast("bigint").alias("units_sold"))
    )


def stockout_from_snapshots(products: DataFrame, plan: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Plan and forecast against stock snapshots; the time is the first empty shelf.

    The plan is dealt out as in ``stockout``.
    """
    seen = snapshots.groupBy("product_id", "festival_date").agg(
        F.min(F.when(F.col("on_hand_units") == 0, F.col("snapshot_ts"))).alias("_first_zero"),
        F.max("units_sold").alias("_units"),
    )
    keys = ["product_id", "product_name", "festival_date", "planned_stock_units", "interest_adjusted_forecast_units"]
    return (
        plan.select("product_id", "festival_date", *keys[3:]).hint("merge")
        .join(products.select("product_id", "product_name"), "product_id")
        .join(seen, ["product_id", "festival_date"], "left")
        .groupBy(*keys)
        .agg(F.min("_first_zero").alias("first_zero_stock_ts"), F.max("_units").alias("units_sold"))
    )


def admission_key():
    """Ticket that passes the gate: the parent of an add-on, else the ticket itself."""
    parent = F.nullif(F.col("parent_ticket_id"), F.lit(""))
    return F.coalesce(parent, F.col("ticket_id"))


def refund_context(requests: DataFrame, tickets: DataFrame, scans: DataFrame, day: str) -> DataFrame:
    """Refund request with its ticket and whether the holder was let in on ``day``."""
    let_in = scans.where((F.col("festival_date") == day) & (F.col("result_code") == SUCCESS)).select("ticket_id")
    sold = tickets.select("ticket_id", "ticket_type_id", F.col("amount_jpy").alias("ticket_amount_jpy"))
    asked = requests.select(
        "request_id", "ticket_id", "parent_ticket_id", "attendee_id", "reason_code", "requested_amount_jpy"
    )
    return flag_exists(asked.join(sold, "ticket_id"), let_in, admission_key(), "ticket_id", "day3_admitted_flag").select(
        "request_id", "ticket_id", "parent_ticket_id", "attendee_id", "reason_code", "requested_amount_jpy",
        "ticket_type_id", "ticket_amount_jpy", "day3_admitted_flag",
    )
