"""Checks on source records and expected counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.operators.joins import dangling_counts, in_scope
from opslake.operators.sets import union_all
from opslake.plans.kg import Sources, document_nodes, equipment_nodes, incident_nodes, lot_nodes, task_nodes
from opslake.plans.scope import UNKNOWN


def violations(rows: DataFrame, rule: Column) -> DataFrame:
    """Rows that break a rule; a rule that is NULL counts as broken."""
    return rows.where(~F.coalesce(rule, F.lit(False)))


def expect_counts(rules: Mapping[str, tuple[DataFrame, Column, int]]) -> DataFrame:
    """(rule, actual, expected, ok). Each rule gives rows, an aggregate over them and its expected value."""
    return union_all(
        df.agg(agg.cast("bigint").alias("actual")).select(
            F.lit(name).alias("rule"), "actual", F.lit(expected).cast("bigint").alias("expected"),
            F.coalesce(F.col("actual") == expected, F.lit(False)).alias("ok"),
        )
        for name, (df, agg, expected) in rules.items()
    )


def source_errors(s: Sources, scope: DataFrame, audit: DataFrame) -> DataFrame:
    """(relation_name, error_count): source records that a scope join would drop silently, only where found."""
    incidents, equipment, documents = incident_nodes(s), equipment_nodes(s), document_nodes(s)
    tasks, lots = task_nodes(s, incidents), lot_nodes(equipment)
    staged_equipment = in_scope(s.equipment, s.stages, "stage_id", "stage_id")
    good_patch = s.lot_patch.where((F.col("assertion_status") == "SYNTHETIC") & F.col("manufacturing_lot").isNotNull())
    no_lot = staged_equipment.where(F.col("manufacturing_lot").isNull()).join(
        good_patch.select("equipment_id"), "equipment_id", "left_anti"
    )
    given = incidents.where(F.col("related_equipment_id").isNotNull())
    documented = incidents.where(F.col("document_id").isNotNull())
    unresolved = dangling_counts(
        [
            ("INCIDENT_AFFECTS_SOURCE", given, [("related_equipment_id", "equipment")]),
            ("EQUIPMENT_STAGE_SOURCE", s.equipment, [("stage_id", "scope")]),
            ("INCIDENT_DOCUMENT_SOURCE", documented, [("document_id", "document")]),
            ("INCIDENT_TASK_SOURCE", s.tasks, [("incident_id", "incident")]),
            ("LOT_PATCH_SOURCE", s.lot_patch, [("equipment_id", "equipment")]),
            ("TASK_EQUIPMENT_SOURCE", s.task_equipment, [("task_id", "task"), ("equipment_id", "equipment")]),
            ("TASK_DOCUMENT_SOURCE", s.task_document, [("task_id", "task"), ("document_id", "document")]),
            ("LOT_DOCUMENT_SOURCE", s.lot_document, [("manufacturing_lot", "lot"), ("document_id", "document")]),
        ],
        {
            "equipment": equipment.select("equipment_id"), "scope": scope.select("location_id"),
            "document": documents.select("document_id"), "incident": s.incidents.select("incident_id"),
            "task": tasks.select("task_id"), "lot": lots.select("manufacturing_lot"),
        },
    ).withColumnRenamed("name", "relation_name")
    counted = union_all(
        rows.agg(F.lit(name).alias("relation_name"), F.count(F.lit(1)).alias("error_count"))
        for name, rows in (("SCOPE_UNKNOWN_OR_MISSING", audit.where(F.col("scope_status") == UNKNOWN)), ("EQUIPMENT_LOT_SOURCE", no_lot))
    )
    return unresolved.unionByName(counted.where(F.col("error_count") > 0))


def mapping_differences(named: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Ids that not every source holds: (key, sources that have it), one grouping over all sources."""
    names = list(named)
    parts = [df.select(F.col(key), F.lit(i).alias("_source")) for i, df in enumerate(named.values())]
    held = union_all(parts).groupBy(key).agg(
        *[F.max((F.col("_source") == i).cast("int")).alias(f"_has{i}") for i in range(len(names))]
    )
    missing_any = sum((F.col(f"_has{i}") for i in range(len(names))), F.lit(0)) < len(names)
    held_by = F.concat_ws("|", *[F.when(F.col(f"_has{i}") == 1, F.lit(n)) for i, n in enumerate(names)])
    return held.where(missing_any).select(key, held_by.alias("held_by"))
