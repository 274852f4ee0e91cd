"""Operations metrics; each reads every source table once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions.moments import days_between, minutes_between
from opslake.functions.numeric import exact_avg, gap_percent
from opslake.operators.aggregates import count_where, failure_columns
from opslake.operators.ranking import top_k
from opslake.plans.rules import APPROVED


def delay_metrics(delays: DataFrame, keys: Sequence[str] = ("festival_date", "stage_id")) -> DataFrame:
    """Maximum, average and number of performances with an incident, per day and stage."""
    return delays.groupBy(*keys).agg(
        F.max("delay_minutes").alias("max_delay_minutes"),
        exact_avg(F.col("delay_minutes"), 1).alias("avg_delay_minutes"),
        count_where(F.col("incident_id").isNotNull()).alias("affected_performances"),
    )


def affected_artists(delays: DataFrame) -> DataFrame:
    """(incident_id, performance_id, artist_name) of performances an incident hit; sort by id for a report."""
    return delays.where(F.col("incident_id").isNotNull()).select("incident_id", "performance_id", "artist_name")


def switch_metrics(sensors: DataFrame, keys: Sequence[str] = ("festival_date", "equipment_id"), digits: int = 1) -> DataFrame:
    """Peak temperature and packet loss and lowest fan speed, rounded for a report."""
    def of(metric: str):
        return F.when(F.col("metric_name") == metric, F.col("metric_value"))

    return sensors.groupBy(*keys).agg(
        F.bround(F.max(of("temperature_c")), digits).alias("max_temperature_c"),
        F.bround(F.max(of("packet_loss_pct")), digits).alias("max_packet_loss_pct"),
        F.bround(F.min(of("fan_rpm")), 0).cast("bigint").alias("min_fan_rpm"),
    )


def overdue_days(maintenance: DataFrame, on: str) -> DataFrame:
    """Days from the earliest overdue scheduled date to a reference date, per device."""
    first = F.min(F.when(F.col("status") == "OVERDUE", F.col("scheduled_date")))
    return (
        maintenance.groupBy("equipment_id").agg(first.alias("scheduled_date"))
        .where(F.col("scheduled_date").isNotNull())
        .withColumn("overdue_days", days_between(F.col("scheduled_date").cast("date"), F.lit(on).cast("date")))
    )


def in_window(rows: DataFrame, ts: str, low, high) -> DataFrame:
    """Rows with ``low <= ts <= high``."""
    return rows.where(F.col(ts).between(low, high))


def gate_metrics(scans: DataFrame, low, high, ok: str = "SUCCESS") -> DataFrame:
    """Attempts, failures, failure percent and average queue per gate in a closed time window."""
    return in_window(scans, "event_ts", low, high).groupBy("gate_id").agg(
        *failure_columns(F.col("result_code"), ok), exact_avg(F.col("queue_estimate_minutes"), 1).alias("avg_queue_minutes")
    )


def failover_minutes(actions: DataFrame) -> DataFrame:
    """Minutes from the first threshold action to the first fail-over action, per incident."""
    kind, ts = F.col("action_type"), F.col("event_ts")
    return actions.where(kind.isin("THRESHOLD", "FAILOVER")).groupBy("incident_id").agg(
        F.min(F.when(kind == "THRESHOLD", ts)).alias("threshold_ts"),
        F.min(F.when(kind == "FAILOVER", ts)).alias("failover_ts"),
    ).withColumn("failover_minutes", minutes_between(F.col("threshold_ts"), F.col("failover_ts")))


def stockout_metrics(stockout: DataFrame) -> DataFrame:
    """Stock-out view with the percent of the forecast that the plan leaves uncovered."""
    return stockout.select(
        "product_id", "festival_date", "stockout_ts", "units_sold", "planned_stock_units",
        "interest_adjusted_forecast_units",
        gap_percent(F.col("interest_adjusted_forecast_units"), F.col("planned_stock_units")).alias("plan_gap_pct"),
    )


def feedback_count(feedback: DataFrame, topic: str, sentiment: str | None = None) -> DataFrame:
    hit = F.col("topic") == topic
    if sentiment is not None:
        hit = hit & (F.col("sentiment") == sentiment)
    return feedback.agg(count_where(hit).alias("feedback_count"))


def first_threshold(weather: DataFrame, lightning_km: float = 10.0, gust_mps: float = 15.0) -> DataFrame:
    """Per day: first observation with lightning this near or a gust this strong, and how many there are."""
    met = (F.col("lightning_distance_km") <= lightning_km) | (F.col("wind_gust_mps") >= gust_mps)
    return weather.where(met).groupBy("festival_date").agg(
        F.min("observed_ts").alias("first_threshold_ts"), F.count(F.lit(1)).alias("observations")
    )


def refund_totals(decisions: DataFrame) -> DataFrame:
    """(decision, requests, amount): amounts count for approved requests only."""
    paid = F.when(F.col("decision") == APPROVED, F.col("refund_amount_jpy")).otherwise(0)
    return decisions.groupBy("decision").agg(
        F.count(F.lit(1)).alias("requests"), F.sum(paid).cast("bigint").alias("approved_amount_jpy")
    )


def signal_forecast(signals: DataFrame, plan: DataFrame) -> DataFrame:
    """Sum of the interest signals per product beside the planned forecast.

    A plan has rows per product and day, which size estimates do not count when
    the days are unfolded; both sides are dealt out by product, never shipped whole.
    """
    summed = signals.groupBy("product_id").agg(
        F.sum("predicted_units").cast("bigint").alias("signal_units"), F.count(F.lit(1)).alias("signals")
    )
    planned = plan.select("product_id", "festival_date", "interest_adjusted_forecast_units").hint("merge")
    return planned.join(summed, "product_id").withColumn(
        "matches_forecast", (F.col("signal_units") == F.col("interest_adjusted_forecast_units")).cast("int")
    )


def max_delay_per_stage(delays: DataFrame, k: int | None = None) -> DataFrame:
    """Longest delay of every stage with its performance, longest first; ties go to the smallest id."""
    longest_first = F.struct((-F.col("delay_minutes")).alias("_neg"), "performance_id")
    worst = (
        delays.where(F.col("delay_minutes").isNotNull())
        .groupBy("stage_id")
        .agg(F.min(longest_first).alias("_w"))
        .select(
            "stage_id", F.col("_w.performance_id").alias("performance_id"), (-F.col("_w._neg")).alias("max_delay_minutes")
        )
    )
    if k is None:
        return worst
    return top_k(worst, [F.col("max_delay_minutes").desc_nulls_last(), F.col("stage_id")], k)


def refunds_by_type(context: DataFrame) -> DataFrame:
    """Refund requests and amounts by ticket type and admission."""
    return context.groupBy("ticket_type_id", "day3_admitted_flag").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("requested_amount_jpy").cast("bigint").alias("requested_amount_jpy")
    )


def cancelled_shows(delays: DataFrame, incidents: DataFrame, day: str) -> DataFrame:
    """Cancelled or shortened shows of a day with their incident.

    ``refunds_by_type`` gives the refund groups that such a day opens.
    """
    shows = delays.where((F.col("festival_date") == day) & F.col("status").isin("CANCELED", "ENDED_EARLY"))
    events = incidents.select("incident_id", F.col("title").alias("incident_title"))
    return shows.select(
        "festival_date", "performance_id", "stage_id", "artist_name", "status", "incident_id"
    ).join(events, "incident_id", "left")
