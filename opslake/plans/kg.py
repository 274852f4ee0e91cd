"""Knowledge graph of incidents: node and edge views, graph definition, questions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.functions.text import edge_id, priority_rank
from opslake.operators.joins import in_scope, overlay
from opslake.operators.sets import union_all
from opslake.plans.graph import Edge, GraphSpec, Hop, Pattern, Vertex, element_id, match

# Task states that count as open.
OPEN_STATES = ("OPEN", "IN_PROGRESS")


@dataclass(frozen=True)
class Sources:
    """Source tables of the graph. Any object with these attributes will do."""

    incidents: DataFrame
    equipment: DataFrame
    stages: DataFrame
    lot_patch: DataFrame
    tasks: DataFrame
    task_equipment: DataFrame
    task_document: DataFrame
    lot_document: DataFrame
    documents: DataFrame


def _keys_as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- vertices -------------------------------------------------------------


def incident_nodes(s: Sources) -> DataFrame:
    rows = s.incidents.select(
        "incident_id", "festival_date", "location_id", "category", "severity", "start_ts", "end_ts", "title",
        "impacted_people", "related_equipment_id", "status", "document_id", "summary",
    )
    rows = _keys_as_text(rows, "incident_id", "location_id", "related_equipment_id", "status", "document_id")
    return in_scope(rows, s.stages, "location_id", "stage_id")


def staged_equipment(s: Sources) -> DataFrame:
    """Master rows of the equipment on a stage, before the lot patch."""
    rows = s.equipment.select(
        "equipment_id", "stage_id", "equipment_category", "model_name", "serial_number", "manufacturing_lot",
        "vendor_id", "firmware_version", "installed_date", "criticality",
    )
    return in_scope(_keys_as_text(rows, "equipment_id", "stage_id", "manufacturing_lot"), s.stages, "stage_id", "stage_id")


def equipment_nodes(s: Sources) -> DataFrame:
    """Equipment on a stage; a synthetic lot patch wins over the master lot."""
    rows = staged_equipment(s)
    patch = s.lot_patch.where(F.col("assertion_status") == "SYNTHETIC")
    return overlay(
        rows, patch, "equipment_id", "manufacturing_lot",
        when_patched={
            "lot_source": F.col("source_type"),
            "lot_assertion_status": F.col("assertion_status"),
            "lot_source_reference_id": F.col("source_reference_id"),
        },
        when_master={
            "lot_source": F.lit("MASTER_CSV"),
            "lot_assertion_status": F.lit("SOURCE_RECORD"),
            "lot_source_reference_id": F.concat(F.lit("equipment_master.csv#"), F.col("equipment_id")),
        },
    )


def stage_nodes(s: Sources) -> DataFrame:
    return _keys_as_text(
        s.stages.select(
            "stage_id", "stage_name", "stage_type", "capacity", "location_zone", "network_zone", "weather_exposed_flag"
        ),
        "stage_id",
    )


def lot_nodes(equipment: DataFrame) -> DataFrame:
    return equipment.select("manufacturing_lot").where(F.col("manufacturing_lot").isNotNull()).distinct()


def task_nodes(s: Sources, incidents: DataFrame) -> DataFrame:
    rows = s.tasks.select(
        "task_id", F.concat(F.lit("TASK-"), F.col("task_id").cast("string")).alias("task_code"),
        F.col("incident_id").cast("string").alias("incident_id"), "task_title", "task_description", "priority",
        "owner_team_id", "created_by_agent", "created_at", "status",
    )
    return in_scope(rows, incidents, "incident_id", "incident_id")


def document_nodes(s: Sources) -> DataFrame:
    return _keys_as_text(
        s.documents.select("document_id", "file_name", "document_type", "version", "effective_date", "purpose"),
        "document_id",
    )


# --- edges ----------------------------------------------------------------


def affects(incidents: DataFrame, equipment: DataFrame) -> DataFrame:
    rows = in_scope(incidents, equipment, "related_equipment_id", "equipment_id")
    return rows.select(
        edge_id(F.col("incident_id"), "AFFECTS", F.col("related_equipment_id")).alias("edge_id"),
        "incident_id", F.col("related_equipment_id").alias("equipment_id"),
    )


def belongs_to_lot(equipment: DataFrame) -> DataFrame:
    return equipment.where(F.col("manufacturing_lot").isNotNull()).select(
        edge_id(F.col("equipment_id"), "LOT", F.col("manufacturing_lot")).alias("edge_id"),
        "equipment_id", "manufacturing_lot", "lot_source", "lot_assertion_status", "lot_source_reference_id",
    )


def deployed_at(equipment: DataFrame) -> DataFrame:
    """Equipment nodes are cut to known stages already, so the stage needs no second look-up."""
    return equipment.select(
        edge_id(F.col("equipment_id"), "STAGE", F.col("stage_id")).alias("edge_id"), "equipment_id", "stage_id"
    )


def documented_by(incidents: DataFrame, documents: DataFrame) -> DataFrame:
    return in_scope(incidents, documents, "document_id", "document_id").select(
        edge_id(F.col("incident_id"), "DOC", F.col("document_id")).alias("edge_id"), "incident_id", "document_id"
    )


def creates(tasks: DataFrame) -> DataFrame:
    """Task nodes are cut to known incidents already, so the incident needs no second look-up."""
    return tasks.select(
        edge_id(F.col("incident_id"), "TASK", F.col("task_id")).alias("edge_id"), "incident_id", "task_id"
    )


def targets(links: DataFrame, tasks: DataFrame, equipment: DataFrame) -> DataFrame:
    rows = in_scope(in_scope(links, tasks, "task_id", "task_id"), equipment, "equipment_id", "equipment_id")
    return rows.select(
        edge_id(F.col("task_id"), "TARGETS", F.col("equipment_id")).alias("edge_id"),
        "task_id", "equipment_id", "source_type", "source_reference_id",
    )


def uses_procedure(links: DataFrame, tasks: DataFrame, documents: DataFrame) -> DataFrame:
    rows = in_scope(in_scope(links, tasks, "task_id", "task_id"), documents, "document_id", "document_id")
    return rows.select(
        edge_id(F.col("task_id"), "USES", F.col("document_id")).alias("edge_id"),
        "task_id", "document_id", "source_type", "source_reference_id",
    )


def governed_by(links: DataFrame, lots: DataFrame, documents: DataFrame) -> DataFrame:
    rows = in_scope(in_scope(links, lots, "manufacturing_lot", "manufacturing_lot"), documents, "document_id", "document_id")
    return rows.select(
        edge_id(F.col("manufacturing_lot"), "DOC", F.col("document_id")).alias("edge_id"),
        "manufacturing_lot", "document_id", "relation_type", "source_type", "source_reference_id",
    )


# --- graph ----------------------------------------------------------------


class Nodes:
    """Node views over the sources, each made when first needed."""

    NAMES = ("incidents", "equipment", "stages", "documents", "lots", "tasks")
    # What the keys and ends of the graph take from the views that join facts.
    LINKS = {"incidents": ("incident_id", "related_equipment_id", "document_id"), "tasks": ("task_id", "incident_id")}

    def __init__(self, s: Sources):
        self._s = s

    def saved(self, spark: SparkSession, path: str, columns: Mapping[str, Sequence[str]] | None = None) -> Nodes:
        """Write each node view once below ``path`` and go on from the files.

        Later views and the edges build on the files, so the sources are read
        once however many questions the graph is asked. ``columns`` limits it to
        some views and the columns that the questions use.
        """
        for name in columns or self.NAMES:
            df, target = getattr(self, name), f"{path.rstrip('/')}/{name}"
            df = df.select(*columns[name]) if columns else df
            df.write.mode("errorifexists").parquet(target)
            setattr(self, name, spark.read.schema(df.schema).parquet(target))
        if not columns:
            self.staged = self.equipment.select("equipment_id", "stage_id")
        return self

    @cached_property
    def incidents(self) -> DataFrame:
        return incident_nodes(self._s)

    @cached_property
    def equipment(self) -> DataFrame:
        return equipment_nodes(self._s)

    @cached_property
    def staged(self) -> DataFrame:
        """Keys and stages of the equipment nodes, without the join to the lot patch."""
        return staged_equipment(self._s).select("equipment_id", "stage_id")

    @cached_property
    def stages(self) -> DataFrame:
        return stage_nodes(self._s)

    @cached_property
    def documents(self) -> DataFrame:
        return document_nodes(self._s)

    @cached_property
    def lots(self) -> DataFrame:
        return lot_nodes(self.equipment)

    @cached_property
    def tasks(self) -> DataFrame:
        return task_nodes(self._s, self.incidents)


def build_graph(s: Sources, nodes: Nodes | None = None) -> GraphSpec:
    """Six vertex tables and eight edge tables over the source tables."""
    n = nodes or Nodes(s)
    return GraphSpec(
        vertices=(
            Vertex("INCIDENTS", "INCIDENT", lambda: n.incidents, "incident_id",
                   ("festival_date", "location_id", "category", "severity", "start_ts", "end_ts", "title", "status", "document_id")),
            Vertex("EQUIPMENTS", "EQUIPMENT", lambda: n.equipment, "equipment_id",
                   ("stage_id", "equipment_category", "model_name", "serial_number", "manufacturing_lot", "firmware_version",
                    "criticality", "lot_source", "lot_assertion_status", "lot_source_reference_id")),
            Vertex("STAGES", "STAGE", lambda: n.stages, "stage_id", ("stage_name", "stage_type", "capacity")),
            Vertex("LOTS", "MANUFACTURING_LOT", lambda: n.lots, "manufacturing_lot", ()),
            Vertex("TASKS", "TASK", lambda: n.tasks, "task_id",
                   ("task_code", "incident_id", "task_title", "priority", "owner_team_id", "created_by_agent", "created_at", "status")),
            Vertex("DOCUMENTS", "DOCUMENT", lambda: n.documents, "document_id",
                   ("file_name", "document_type", "version", "effective_date", "purpose")),
        ),
        edges=(
            Edge("INCIDENT_AFFECTS", "AFFECTS", lambda: affects(n.incidents, n.staged),
                 "INCIDENTS", "incident_id", "EQUIPMENTS", "equipment_id"),
            Edge("EQUIPMENT_LOT", "BELONGS_TO_LOT", lambda: belongs_to_lot(n.equipment),
                 "EQUIPMENTS", "equipment_id", "LOTS", "manufacturing_lot",
                 properties=("lot_source", "lot_assertion_status", "lot_source_reference_id"), hub=True),
            Edge("EQUIPMENT_STAGE", "DEPLOYED_AT", lambda: deployed_at(n.staged),
                 "EQUIPMENTS", "equipment_id", "STAGES", "stage_id"),
            Edge("INCIDENT_DOCUMENT", "DOCUMENTED_BY", lambda: documented_by(n.incidents, n.documents),
                 "INCIDENTS", "incident_id", "DOCUMENTS", "document_id"),
            Edge("INCIDENT_TASK", "CREATES", lambda: creates(n.tasks), "INCIDENTS", "incident_id", "TASKS", "task_id"),
            Edge("TASK_EQUIPMENT", "TARGETS", lambda: targets(s.task_equipment, n.tasks, n.staged),
                 "TASKS", "task_id", "EQUIPMENTS", "equipment_id", properties=("source_type", "source_reference_id")),
            Edge("TASK_DOCUMENT", "USES_PROCEDURE", lambda: uses_procedure(s.task_document, n.tasks, n.documents),
                 "TASKS", "task_id", "DOCUMENTS", "document_id", properties=("source_type", "source_reference_id")),
            Edge("LOT_DOCUMENT", "GOVERNED_BY", lambda: governed_by(s.lot_document, n.lots, n.documents),
                 "LOTS", "manufacturing_lot", "DOCUMENTS", "document_id",
                 properties=("relation_type", "source_type", "source_reference_id")),
        ),
    )


# --- questions ------------------------------------------------------------

IMPACT = Pattern(
    ("i", "INCIDENT"),
    (
        Hop("a", "AFFECTS", "e1", "EQUIPMENT"),
        Hop("b1", "BELONGS_TO_LOT", "l", "MANUFACTURING_LOT"),
        Hop("b2", "BELONGS_TO_LOT", "e2", "EQUIPMENT", back=True),
        Hop("d", "DEPLOYED_AT", "s", "STAGE"),
    ),
    distinct_pairs=(("e1", "e2"),),
)

OPEN_TASKS = Pattern(
    ("i", "INCIDENT"),
    (
        Hop("c", "CREATES", "t", "TASK"),
        Hop("x", "TARGETS", "e", "EQUIPMENT"),
        Hop("d", "DEPLOYED_AT", "s", "STAGE"),
    ),
    where={"t": lambda p: p("status").isin(*OPEN_STATES)},
)


def incident_impact(graph: GraphSpec, ids=None) -> DataFrame:
    """Equipment that shares a manufacturing lot with the equipment an incident hit, and its stage."""
    return match(graph, IMPACT, lambda p: {
        "incident_id": p("i", "incident_id"),
        "affected_equipment_id": p("e1", "equipment_id"),
        "manufacturing_lot": p("l", "manufacturing_lot"),
        "related_equipment_id": p("e2", "equipment_id"),
        "related_stage_id": p("s", "stage_id"),
        "related_stage_name": p("s", "stage_name"),
        "lot_source": p("b2", "lot_source"),
        "lot_assertion_status": p("b2", "lot_assertion_status"),
        "lot_source_reference_id": p("b2", "lot_source_reference_id"),
        "affected_lot_source": p("b1", "lot_source"),
        "affected_lot_assertion_status": p("b1", "lot_assertion_status"),
        "affected_lot_source_reference_id": p("b1", "lot_source_reference_id"),
    }, ids)


def impact_by_stage(graph: GraphSpec, ids=None) -> DataFrame:
    """How many peers each incident has per lot and stage, without listing the peers.

    Equipment is counted per (lot, stage) before it meets the incidents. The
    work is linear in both sides even if one lot holds most of the equipment.
    The affected device itself is taken off the count of its own stage.
    """
    lot_of = graph.edge("BELONGS_TO_LOT").df.select("equipment_id", "manufacturing_lot")
    stage_of = graph.edge("DEPLOYED_AT").df.select("equipment_id", "stage_id")
    placed = lot_of.join(stage_of, "equipment_id")
    per_stage = placed.groupBy("manufacturing_lot", "stage_id").agg(F.count(F.lit(1)).alias("_devices"))
    hit = match(
        graph,
        Pattern(IMPACT.start, (*IMPACT.hops[:2],)),
        lambda p: {
            "incident_id": p("i", "incident_id"),
            "affected_equipment_id": p("e1", "equipment_id"),
            "manufacturing_lot": p("l", "manufacturing_lot"),
        },
        ids,
    )
    own = stage_of.select(F.col("equipment_id").alias("affected_equipment_id"), F.col("stage_id").alias("_own_stage"))
    peers = F.col("_devices") - (F.col("stage_id") == F.coalesce(F.col("_own_stage"), F.lit(""))).cast("bigint")
    names = stage_nodes_of(graph)
    return (
        hit.join(own, "affected_equipment_id", "left")
        .join(per_stage, "manufacturing_lot")
        .withColumn("related_equipment_count", peers)
        .where(F.col("related_equipment_count") > 0)
        .join(names, "stage_id")
        .select(
            "incident_id", "affected_equipment_id", "manufacturing_lot",
            F.col("stage_id").alias("related_stage_id"), F.col("stage_name").alias("related_stage_name"),
            "related_equipment_count",
        )
    )


def stage_nodes_of(graph: GraphSpec) -> DataFrame:
    return graph.vertex("STAGE").df.select("stage_id", "stage_name")


def impact_elements(graph: GraphSpec, ids=None) -> DataFrame:
    """Identities of the nine elements of every impact path."""
    of = {v.label: v for v in graph.vertices} | {e.label: e for e in graph.edges}

    def columns(_):
        return {
            "incident_vertex": element_id(of["INCIDENT"], "i"),
            "affects_edge": element_id(of["AFFECTS"], "a"),
            "affected_equipment_vertex": element_id(of["EQUIPMENT"], "e1"),
            "affected_lot_edge": element_id(of["BELONGS_TO_LOT"], "b1"),
            "lot_vertex": element_id(of["MANUFACTURING_LOT"], "l"),
            "related_lot_edge": element_id(of["BELONGS_TO_LOT"], "b2"),
            "related_equipment_vertex": element_id(of["EQUIPMENT"], "e2"),
            "deployed_at_edge": element_id(of["DEPLOYED_AT"], "d"),
            "stage_vertex": element_id(of["STAGE"], "s"),
        }

    return match(graph, IMPACT, columns, ids)


def open_tasks(graph: GraphSpec, ids=None) -> DataFrame:
    """Open tasks of an incident with the equipment they target and its stage."""
    return match(graph, OPEN_TASKS, lambda p: {
        "incident_id": p("i", "incident_id"),
        "task_id": p("t", "task_id"),
        "task_code": p("t", "task_code"),
        "priority": p("t", "priority"),
        "task_status": p("t", "status"),
        "equipment_id": p("e", "equipment_id"),
        "stage_id": p("s", "stage_id"),
        "stage_name": p("s", "stage_name"),
        "created_by_agent": p("t", "created_by_agent"),
        "source_type": p("x", "source_type"),
        "source_reference_id": p("x", "source_reference_id"),
    }, ids)


# Order of the related-document columns and the type of each.
DOCUMENT_COLUMNS = {
    "document_id": "string", "file_name": "string", "document_type": "string", "document_version": "string",
    "effective_date": "string", "incident_id": "string", "equipment_id": "string", "manufacturing_lot": "string",
    "task_id": "bigint", "task_created_by_agent": "string", "relation_type": "string", "path": "string",
    "source_type": "string", "source_reference_id": "string", "lot_source": "string", "lot_source_reference_id": "string",
}


def related_documents(graph: GraphSpec, ids=None) -> DataFrame:
    """Documents that an incident leads to, by three kinds of path, with the path and its provenance.

    The paths give ids; documents are joined once, after all kinds are put together.
    """
    described = ("file_name", "document_type", "document_version", "effective_date")

    def branch(hops: tuple[Hop, ...], extra, where=None) -> DataFrame:
        ends = lambda p: {"document_id": p("d", "document_id"), "incident_id": p("i", "incident_id")}
        rows = match(graph, Pattern(("i", "INCIDENT"), hops, where or {}), lambda p: ends(p) | extra(p), ids)
        return rows.select(
            *[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c)
              for c, t in DOCUMENT_COLUMNS.items() if c not in described]
        )

    reports = branch(
        (Hop("r", "DOCUMENTED_BY", "d", "DOCUMENT"),),
        lambda p: {
            "relation_type": F.lit("INCIDENT_REPORT"), "path": F.lit("DOCUMENTED_BY"), "source_type": F.lit("INCIDENT_CSV"),
            "source_reference_id": F.concat(F.lit("incidents.csv#"), p("i", "incident_id")),
        },
    )
    lot_guides = branch(
        (
            Hop("a", "AFFECTS", "e", "EQUIPMENT"), Hop("b", "BELONGS_TO_LOT", "l", "MANUFACTURING_LOT"),
            Hop("g", "GOVERNED_BY", "d", "DOCUMENT"),
        ),
        lambda p: {
            "equipment_id": p("e", "equipment_id"), "manufacturing_lot": p("l", "manufacturing_lot"),
            "relation_type": p("g", "relation_type"), "path": F.lit("AFFECTS>BELONGS_TO_LOT>GOVERNED_BY"),
            "source_type": p("g", "source_type"), "source_reference_id": p("g", "source_reference_id"),
            "lot_source": p("b", "lot_source"), "lot_source_reference_id": p("b", "lot_source_reference_id"),
        },
    )
    procedures = branch(
        (Hop("c", "CREATES", "t", "TASK"), Hop("u", "USES_PROCEDURE", "d", "DOCUMENT")),
        lambda p: {
            "task_id": p("t", "task_id"), "task_created_by_agent": p("t", "created_by_agent"),
            "relation_type": F.lit("TASK_PROCEDURE"), "path": F.lit("CREATES>USES_PROCEDURE"),
            "source_type": p("u", "source_type"), "source_reference_id": p("u", "source_reference_id"),
        },
        where=OPEN_TASKS.where,
    )
    documents = graph.vertex("DOCUMENT").df.select(
        F.col("document_id").alias("_document"), "file_name", "document_type", F.col("version").alias("document_version"), "effective_date"
    )
    paths = union_all([reports, lot_guides, procedures])
    return paths.join(documents, F.col("document_id") == F.col("_document")).select(
        *[F.col(c).cast(t).alias(c) for c, t in DOCUMENT_COLUMNS.items()]
    )


def task_order() -> Sequence[Column]:
    """Most urgent first, then by id."""
    return (priority_rank(F.col("priority")), F.col("task_id"))


def impact_by_joins(s: Sources, ids: Sequence[str] | None = None) -> DataFrame:
    """The impact question as plain joins over the node views, for comparison with the pattern."""
    incidents, equipment, stages = incident_nodes(s), equipment_nodes(s), stage_nodes(s)
    if ids is not None:
        incidents = incidents.where(F.col("incident_id").isin(*ids))
    hit = incidents.select("incident_id", F.col("related_equipment_id").alias("affected_equipment_id")).join(
        equipment.select(F.col("equipment_id").alias("affected_equipment_id"), "manufacturing_lot"), "affected_equipment_id"
    )
    peers = equipment.select(F.col("equipment_id").alias("related_equipment_id"), "manufacturing_lot", "stage_id")
    return (
        hit.join(peers, "manufacturing_lot")
        .where(F.col("related_equipment_id") != F.col("affected_equipment_id"))
        .join(stages.select("stage_id"), "stage_id")
        .select("incident_id", "affected_equipment_id", "manufacturing_lot", "related_equipment_id", "stage_id")
        .distinct()
    )
