"""One row per incident with sensor, maintenance and delay facts.

Each source is reduced to one row per join key before it is joined, so no join
multiplies incidents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.operators.aggregates import count_where, offending_keys

# Fixed value: maintenance state that counts as overdue.
OVERDUE = "OVERDUE"


def sensor_day(sensors: DataFrame) -> DataFrame:
    """Daily extremes per device, one column per metric, from the raw readings in one grouping.

    Rounding keeps the order of values, so the rounded extreme equals the
    extreme of the rounded per-metric values.
    """
    def of(metric: str):
        return F.when(F.col("metric_name") == metric, F.col("metric_value"))

    return sensors.groupBy("festival_date", "stage_id", "equipment_id").agg(
        F.round(F.max(of("temperature_c")), 3).alias("daily_max_temperature_c"),
        F.round(F.max(of("packet_loss_pct")), 3).alias("daily_max_packet_loss_pct"),
        F.round(F.min(of("fan_rpm")), 3).alias("daily_min_fan_rpm"),
    )


def maintenance_summary(maintenance: DataFrame) -> DataFrame:
    overdue = F.col("status") == OVERDUE
    return maintenance.groupBy("equipment_id").agg(
        F.count(F.lit(1)).alias("maintenance_record_count"),
        count_where(overdue).alias("overdue_maintenance_count"),
        F.min(F.when(overdue, F.col("scheduled_date"))).alias("earliest_overdue_scheduled_date"),
    )


def delay_summary(delays: DataFrame) -> DataFrame:
    return delays.where(F.col("incident_id").isNotNull()).groupBy("incident_id").agg(
        F.count(F.lit(1)).alias("affected_performance_count"), F.max("delay_minutes").alias("max_delay_minutes")
    )


def incident_facts(
    incidents: DataFrame, equipment: DataFrame, stages: DataFrame, sensors: DataFrame, maintenance: DataFrame,
    delays: DataFrame,
) -> DataFrame:
    """``incidents``, ``equipment`` and ``stages`` are graph nodes, ``delays`` the stage delay view."""
    device = equipment.select(
        F.col("equipment_id").alias("related_equipment_id"), F.col("stage_id").alias("equipment_stage_id"),
        "manufacturing_lot", "lot_source", "lot_assertion_status", "lot_source_reference_id",
        F.col("equipment_id").alias("_device"),
    )
    stage = stages.select(F.col("stage_id").alias("equipment_stage_id"), F.col("stage_name").alias("equipment_stage_name"))
    readings = sensor_day(sensors).withColumnsRenamed(
        {"stage_id": "equipment_stage_id", "equipment_id": "related_equipment_id"}
    )
    upkeep = maintenance_summary(maintenance).withColumnRenamed("equipment_id", "_device")
    i = incidents.select(
        "incident_id", "festival_date", "location_id", "category", "severity", "start_ts", "end_ts", "title", "status",
        "document_id", "related_equipment_id",
    )
    joined = (
        i.join(device, "related_equipment_id", "left")
        .join(stage, "equipment_stage_id", "left")
        .join(readings, ["festival_date", "equipment_stage_id", "related_equipment_id"], "left")
        # Equipment outside the graph has no key here, and so no maintenance facts, as it has no stage.
        .join(upkeep, "_device", "left")
        .join(delay_summary(delays), "incident_id", "left")
    )
    renamed = {
        "location_id": "incident_location_id", "category": "incident_category", "severity": "incident_severity",
        "start_ts": "incident_start_ts", "end_ts": "incident_end_ts", "title": "incident_title",
        "status": "incident_status", "document_id": "incident_document_id",
    }
    return joined.select(
        "incident_id", "festival_date", *[F.col(a).alias(b) for a, b in renamed.items()],
        F.col("related_equipment_id").alias("affected_equipment_id"), "equipment_stage_id", "equipment_stage_name",
        "manufacturing_lot", "lot_source", "lot_assertion_status", "lot_source_reference_id",
        "daily_max_temperature_c", "daily_max_packet_loss_pct", "daily_min_fan_rpm",
        "maintenance_record_count", "overdue_maintenance_count", "earliest_overdue_scheduled_date",
        "affected_performance_count", "max_delay_minutes",
    )


# What each computed column of the facts holds, for ``with_comments``.
FACT_COMMENTS = {
    "daily_max_temperature_c": "max of the device's temperature readings over the incident's date",
    "daily_max_packet_loss_pct": "max of the device's packet loss readings over the incident's date",
    "daily_min_fan_rpm": "min of the device's fan readings over the incident's date",
    "maintenance_record_count": "upkeep rows of the device, 0 without any",
    "overdue_maintenance_count": "upkeep rows of the device in state OVERDUE, 0 without any",
    "affected_performance_count": "rows of the delay view with this incident, 0 without any",
}


def fan_out(facts: DataFrame) -> DataFrame:
    """Incidents with more than one fact row; empty when every source was reduced first."""
    return offending_keys(facts, ["incident_id"])
