"""JSON answers of the graph, their reading back, and the checks on them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions.text import json_object
from opslake.operators.aggregates import count_where, json_pages
from opslake.operators.sets import union_all
from opslake.plans import kg
from opslake.plans.graph import GraphSpec

# Form of an incident id and the error codes of the guard.
INCIDENT_ID = r"^INC-[0-9A-Z-]{1,24}$"
INVALID_ID, UNKNOWN_ID, REPEATED_ID = -20011, -20012, -20013

IMPACT_MEMBERS = (
    "incident_id", "affected_equipment_id", "manufacturing_lot", "related_equipment_id", "related_stage_id",
    "related_stage_name", "lot_source", "lot_assertion_status", "lot_source_reference_id", "affected_lot_source",
    "affected_lot_assertion_status", "affected_lot_source_reference_id",
)
TASK_MEMBERS = (
    "incident_id", "task_id", "task_code", "priority", "task_status", "equipment_id", "stage_id", "stage_name",
    "created_by_agent", "source_type", "source_reference_id",
)


class IncidentIdError(ValueError):
    def __init__(self, code: int, message: str):
        super().__init__(message)
        self.code = code


def check_ids(rows: DataFrame, column: str = "incident_id", pattern: str = INCIDENT_ID) -> DataFrame:
    """Add ``valid_id``: does the whole id have the expected form? NULL is not valid."""
    whole = F.regexp_extract(F.col(column), pattern, 0) == F.col(column)
    return rows.withColumn("valid_id", F.coalesce(whole, F.lit(False)))


def id_states(graph: GraphSpec, asked: DataFrame) -> DataFrame:
    """(incident_id, code): 0 for a good id, else the guard's error code; many ids at once."""
    incidents = graph.vertex("INCIDENT").df
    wanted = asked.select("incident_id").distinct()
    known = (
        incidents.join(wanted, "incident_id", "left_semi").groupBy("incident_id").agg(F.count(F.lit(1)).alias("_n"))
    )
    checked = check_ids(wanted).join(known, "incident_id", "left")
    return checked.select(
        "incident_id",
        F.when(~F.col("valid_id"), INVALID_ID)
        .when(F.col("_n").isNull(), UNKNOWN_ID)
        .when(F.col("_n") > 1, REPEATED_ID)
        .otherwise(0)
        .alias("code"),
    )


def assert_incident(graph: GraphSpec, incident_id: str | None) -> None:
    """Raise unless the id is well formed and names exactly one incident."""
    if incident_id is None or not re.fullmatch(INCIDENT_ID, incident_id):
        raise IncidentIdError(INVALID_ID, f"not an incident id: {incident_id!r}")
    found = graph.vertex("INCIDENT").df.where(F.col("incident_id") == incident_id).select("incident_id").limit(2).count()
    if found == 0:
        raise IncidentIdError(UNKNOWN_ID, f"no incident {incident_id}")
    if found > 1:
        raise IncidentIdError(REPEATED_ID, f"several incidents are called {incident_id}")


def _members(names: Sequence[str], renamed: dict[str, str] | None = None):
    renamed = renamed or {}
    return json_object([F.col(n).alias(renamed.get(n, n)) for n in names])


def impact_json(graph: GraphSpec, ids=None) -> DataFrame:
    """Impact rows per incident as ordered JSON (incident_id, page_no, members, json)."""
    order = [F.col("related_stage_id"), F.col("related_equipment_id")]
    return json_pages(kg.incident_impact(graph, ids), "incident_id", order, _members(IMPACT_MEMBERS))


def tasks_json(graph: GraphSpec, ids=None) -> DataFrame:
    """Open tasks per incident as ordered JSON; ``task_status`` is written as ``status``."""
    return json_pages(
        kg.open_tasks(graph, ids), "incident_id", list(kg.task_order()), _members(TASK_MEMBERS, {"task_status": "status"})
    )


def documents_json(graph: GraphSpec, ids=None) -> DataFrame:
    """Document paths per incident as ordered JSON with NULL members kept."""
    order = [F.col("document_id"), F.col("relation_type"), F.col("task_id")]
    return json_pages(kg.related_documents(graph, ids), "incident_id", order, _members(tuple(kg.DOCUMENT_COLUMNS)))


def answer(graph: GraphSpec, incident_id: str, pages) -> DataFrame:
    """Checked answer for one incident: (page_no, json), one page ``[]`` when nothing matches."""
    assert_incident(graph, incident_id)
    asked = graph.vertex("INCIDENT").df.where(F.col("incident_id") == incident_id).select("incident_id")
    return asked.join(pages(graph, [incident_id]), "incident_id", "left").select(
        F.coalesce("page_no", F.lit(0).cast("bigint")).alias("page_no"), F.coalesce("json", F.lit("[]")).alias("json")
    )


def json_rows(pages: DataFrame, schema: str, column: str = "json") -> DataFrame:
    """The members of JSON arrays as rows; other columns are repeated."""
    others = [c for c in pages.columns if c != column]
    parsed = F.from_json(F.col(column), f"array<struct<{schema}>>")
    return pages.select(*others, F.inline(parsed))


def array_size(column: str = "json"):
    return F.json_array_length(F.col(column)).cast("bigint")


DOCUMENT_SCHEMA = "document_id: string, document_version: string, incident_id: string, equipment_id: string, " \
    "manufacturing_lot: string, task_id: bigint, path: string, source_type: string, source_reference_id: string"


def bad_document_path():
    """A document path that lacks its version, provenance or the ids its kind of path needs."""
    always = ["document_version", "incident_id", "source_type", "source_reference_id", "path"]
    bad = F.lit(False)
    for c in always:
        bad = bad | F.col(c).isNull()
    by_task = (F.col("path") == "CREATES>USES_PROCEDURE") & F.col("task_id").isNull()
    by_lot = (F.col("path") == "AFFECTS>BELONGS_TO_LOT>GOVERNED_BY") & (
        F.col("equipment_id").isNull() | F.col("manufacturing_lot").isNull()
    )
    return bad | by_task | by_lot


def answer_sizes(graph: GraphSpec, ids=None) -> DataFrame:
    """(incident_id, members, answer) of the three answers, counted without listing pairs or building JSON."""
    impact = kg.impact_by_stage(graph, ids).groupBy("incident_id").agg(F.sum("related_equipment_count").cast("bigint").alias("members"))
    n = F.count(F.lit(1)).alias("members")
    kinds = {
        "impact": impact,
        "open_tasks": kg.open_tasks(graph, ids).groupBy("incident_id").agg(n),
        "documents": kg.related_documents(graph, ids).groupBy("incident_id").agg(n),
    }
    return union_all(df.withColumn("answer", F.lit(k)) for k, df in kinds.items())


def document_quality(graph: GraphSpec, ids=None) -> DataFrame:
    """Per incident: document paths, distinct documents and faulty paths, read back from the JSON."""
    pages = documents_json(graph, ids).select(F.col("incident_id").alias("asked_id"), "json")
    rows = json_rows(pages, DOCUMENT_SCHEMA)
    wrong = bad_document_path() | (F.col("incident_id") != F.col("asked_id"))
    return rows.groupBy("asked_id").agg(
        F.count(F.lit(1)).alias("paths"),
        F.count_distinct("document_id").alias("documents"),
        count_where(wrong).alias("bad_paths"),
    )


def postconditions(
    graph: GraphSpec, incident_id: str, affected: str, lot: str, peers: Sequence[str], documents: Sequence[str],
    sizes: dict[str, int],
) -> DataFrame:
    """(check, ok) for one incident against its expected answer.

    ``sizes`` gives the expected members of ``impact``, ``open_tasks`` and ``documents``.
    """
    ids = [incident_id]
    impact = json_rows(
        impact_json(graph, ids).select("json"),
        "affected_equipment_id: string, manufacturing_lot: string, related_equipment_id: string",
    )
    docs = json_rows(documents_json(graph, ids).select("json"), DOCUMENT_SCHEMA)
    tasks = tasks_json(graph, ids)
    good = (
        (F.col("affected_equipment_id") == affected)
        & (F.col("manufacturing_lot") == lot)
        & F.col("related_equipment_id").isin(*peers)
    )
    known = F.coalesce(F.col("document_id").isin(*documents), F.lit(False))
    of_incident = F.coalesce(F.col("incident_id") == incident_id, F.lit(False))
    spark = impact.sparkSession
    definitions = spark.range(1).select(F.lit("element definitions").alias("check"), F.lit(graph.counts() == (6, 8)).alias("ok"))
    n = F.count(F.lit(1))
    return union_all([
        definitions,
        impact.agg(F.lit("impact rows").alias("check"), (n == sizes["impact"]).alias("ok")),
        impact.agg(F.lit("impact ids").alias("check"), (count_where(~F.coalesce(good, F.lit(False))) == 0).alias("ok")),
        impact.agg(F.lit("impact peers").alias("check"), (F.count_distinct("related_equipment_id") == len(peers)).alias("ok")),
        tasks.agg(F.lit("open tasks").alias("check"), (F.coalesce(F.sum(array_size()), F.lit(0)) == sizes["open_tasks"]).alias("ok")),
        docs.agg(F.lit("document paths").alias("check"), (n == sizes["documents"]).alias("ok")),
        docs.agg(F.lit("documents found").alias("check"), (F.count_distinct(F.when(known, F.col("document_id"))) == len(documents)).alias("ok")),
        docs.agg(F.lit("documents unexpected").alias("check"), (count_where(~known) == 0).alias("ok")),
        docs.agg(F.lit("path provenance").alias("check"), (count_where(bad_document_path() | ~of_incident) == 0).alias("ok")),
    ])
