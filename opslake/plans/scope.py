"""Which locations belong to the graph, and which source records do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.operators.sets import union_all

# Scope labels.
IN_SCOPE = "IN_SCOPE"
OUT_OF_SCOPE = "OUT_OF_SCOPE"
UNKNOWN = "UNKNOWN_OR_MISSING"


def location_scope(stages: DataFrame, observed: DataFrame, column: str, fixed: Sequence[str]) -> DataFrame:
    """(location_id, scope_status): stages are in; observed and fixed locations are out unless a stage."""
    inside = stages.select(F.col("stage_id").cast("string").alias("location_id"), F.lit(IN_SCOPE).alias("scope_status"))
    seen = observed.select(F.col(column).cast("string").alias("location_id"))
    extra = observed.sparkSession.createDataFrame([(x,) for x in fixed], "location_id string")
    others = seen.where(F.col("location_id").isNotNull()).unionByName(extra).distinct()
    outside = others.join(inside.select("location_id"), "location_id", "left_anti").withColumn(
        "scope_status", F.lit(OUT_OF_SCOPE)
    )
    return inside.unionByName(outside)


def scope_audit(incidents: DataFrame, equipment: DataFrame, tasks: DataFrame, scope: DataFrame) -> DataFrame:
    """(entity_type, entity_id, location_id, scope_status) for every source record."""
    status = F.coalesce(F.col("scope_status"), F.lit(UNKNOWN))
    inc = incidents.select(
        F.lit("INCIDENT").alias("entity_type"), F.col("incident_id").cast("string").alias("entity_id"),
        F.col("location_id").cast("string").alias("location_id"),
    )
    eqp = equipment.select(
        F.lit("EQUIPMENT").alias("entity_type"), F.col("equipment_id").cast("string").alias("entity_id"),
        F.col("stage_id").cast("string").alias("location_id"),
    )
    places = incidents.select("incident_id", F.col("location_id").cast("string").alias("location_id"))
    # A task whose incident is unknown has no location and so no scope.
    tsk = tasks.select("task_id", "incident_id").join(places, "incident_id", "left").select(
        F.lit("TASK").alias("entity_type"), F.col("task_id").cast("string").alias("entity_id"), "location_id"
    )
    return (
        union_all([inc, eqp, tsk])
        .join(scope, "location_id", "left")
        .select("entity_type", "entity_id", "location_id", status.alias("scope_status"))
    )
