import json

import pytest
from pyspark.sql import functions as F

from opslake.operators.sets import symmetric_difference
from opslake.plans import api, changes, facts, kg, quality, scope, views
from opslake.plans.graph import Edge, GraphSpec, Hop, Pattern, Vertex, endpoint_errors, key_errors, match

INC = "INC-7-A"


def make_sources(spark):
    def df(data, ddl):
        return spark.createDataFrame(data, ddl)

    inc_ddl = ("incident_id string, festival_date string, location_id string, category string, severity string, start_ts string, "
               "end_ts string, title string, impacted_people bigint, related_equipment_id string, status string, document_id string, summary string")
    eq_ddl = ("equipment_id string, stage_id string, equipment_category string, model_name string, serial_number string, "
              "manufacturing_lot string, vendor_id string, firmware_version string, installed_date string, criticality string")

    def inc(i, loc, eq=None, doc=None):
        return (i, "2026-08-08", loc, "NET", "HIGH", "2026-08-08 14:42:00", None, "t", 5, eq, "CLOSED", doc, None)

    def eq(i, stage, lot):
        return (i, stage, "SWITCH", "m", "sn-" + i, lot, "V", "1.0", "2026-01-01", "HIGH")

    return kg.Sources(
        incidents=df([inc(INC, "S1", "E1", "IR"), inc("INC-8", "S2"), inc("INC-9", "G1", "SCAN-1", "NO-DOC"), inc("INC-10", "S1", "E9")], inc_ddl),
        equipment=df([eq("E1", "S1", "L1"), eq("E2", "S2", "OLD"), eq("E3", "S3", "OLD2"), eq("E4", "S1", "L4"), eq("E5", "G1", "L1"),
                      eq("E9", "S1", None)], eq_ddl),
        stages=df([("S1", "One", "A", 10, "N", "NA", 1), ("S2", "Two", "A", 20, "N", "NA", 0), ("S3", "Three", "B", 30, "N", "NA", 0)],
                  "stage_id string, stage_name string, stage_type string, capacity bigint, location_zone string, network_zone string, weather_exposed_flag int"),
        lot_patch=df([("E2", "L1", "DEMO", "REF-1", "SYNTHETIC"), ("E3", "L1", "DEMO", "REF-1", "SYNTHETIC"), ("E4", "L1", "DEMO", "REF-2", "PROVISIONAL")],
                     "equipment_id string, manufacturing_lot string, source_type string, source_reference_id string, assertion_status string"),
        tasks=df([(1, INC, "fix E2", None, "CRITICAL", "T", "SEED", "2026-08-10", "OPEN"), (2, INC, "fix E3", None, "HIGH", "T", "SEED", "2026-08-10", "IN_PROGRESS"),
                  (3, "INC-9", "gate", None, "LOW", "T", "SEED", "2026-08-10", "OPEN")],
                 "task_id bigint, incident_id string, task_title string, task_description string, priority string, owner_team_id string, "
                 "created_by_agent string, created_at string, status string"),
        task_equipment=df([(1, "E2", "DEMO", "R"), (2, "E3", "DEMO", "R"), (3, "E5", "DEMO", "R")],
                          "task_id bigint, equipment_id string, source_type string, source_reference_id string"),
        task_document=df([(1, "SB", "DEMO", "R"), (1, "OPS", "DEMO", "R"), (2, "SB", "DEMO", "R"), (2, "OPS", "DEMO", "R")],
                         "task_id bigint, document_id string, source_type string, source_reference_id string"),
        lot_document=df([("L1", "SB", "SERVICE_BULLETIN", "DEMO", "R"), ("L1", "OPS", "OPERATING_PROCEDURE", "DEMO", "R")],
                        "manufacturing_lot string, document_id string, relation_type string, source_type string, source_reference_id string"),
        documents=df([("IR", "ir.pdf", "Report", "1.0", "2026-08-10", None), ("SB", "sb.pdf", "Bulletin", "1.1", "2026-07-12", "p"),
                      ("OPS", "ops.pdf", "Runbook", "2.1", "2026-07-20", "p"), ("OTHER", "o.pdf", "Plan", "1", "2026-07-10", "p")],
                     "document_id string, file_name string, document_type string, version string, effective_date string, purpose string"),
    )


@pytest.fixture(scope="module")
def sources(spark):
    return make_sources(spark)


@pytest.fixture(scope="module")
def graph(spark, sources, tmp_path_factory):
    return kg.build_graph(sources, kg.Nodes(sources).saved(spark, str(tmp_path_factory.mktemp("nodes"))))


def test_nodes(sources, rows):
    assert rows(kg.incident_nodes(sources), "incident_id") == [("INC-10",), (INC,), ("INC-8",)]
    lots = rows(kg.equipment_nodes(sources), "equipment_id", "manufacturing_lot", "lot_source", "lot_assertion_status", "lot_source_reference_id")
    assert lots == sorted([
        ("E1", "L1", "MASTER_CSV", "SOURCE_RECORD", "equipment_master.csv#E1"), ("E2", "L1", "DEMO", "SYNTHETIC", "REF-1"),
        ("E3", "L1", "DEMO", "SYNTHETIC", "REF-1"), ("E4", "L4", "MASTER_CSV", "SOURCE_RECORD", "equipment_master.csv#E4"),
        ("E9", None, "MASTER_CSV", "SOURCE_RECORD", "equipment_master.csv#E9")], key=repr)
    assert rows(kg.lot_nodes(kg.equipment_nodes(sources))) == [("L1",), ("L4",)]


def test_counts_and_checks(graph, sources, rows):
    assert graph.counts() == (6, 8)
    assert key_errors(graph).count() == 0 and endpoint_errors(graph).count() == 0
    sc = scope.location_scope(sources.stages, sources.equipment, "stage_id", ["G2", "S1"])
    assert rows(sc) == [("G1", "OUT_OF_SCOPE"), ("G2", "OUT_OF_SCOPE"), ("S1", "IN_SCOPE"), ("S2", "IN_SCOPE"), ("S3", "IN_SCOPE")]
    audit = scope.scope_audit(sources.incidents, sources.equipment, sources.tasks, sc)
    assert audit.count() == 4 + 6 + 3
    assert rows(audit.where("entity_type = 'TASK'"), "entity_id", "scope_status") == [("1", "IN_SCOPE"), ("2", "IN_SCOPE"), ("3", "OUT_OF_SCOPE")]
    assert rows(quality.source_errors(sources, sc, audit)) == [("EQUIPMENT_LOT_SOURCE", 1), ("TASK_EQUIPMENT_SOURCE", 1)]


def test_element_checks_find_errors(spark, rows):
    v = Vertex("V", "V", spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int"), "id", ())
    e = Edge("E", "E", spark.createDataFrame([(None, 1, 2), ("a", 1, 9), ("a", 8, 9)], "edge_id string, s int, t int"), "V", "s", "V", "t")
    g = GraphSpec((v,), (e,))
    assert rows(key_errors(g)) == [("EDGE", "E", 2), ("VERTEX", "V", 2)]
    assert rows(endpoint_errors(g)) == [("E", 2)]
    with pytest.raises(ValueError):
        GraphSpec((v,), (Edge("X", "X", e.df, "V", "s", "NOPE", "t"),))
    with pytest.raises(ValueError):
        Vertex("W", "W", v.df, "id", ("nope",)).df


def test_duplicates_multiply_and_nodes_repeat(spark, rows):
    """A match is one row per path; nothing is made distinct."""
    v = Vertex("V", "V", spark.createDataFrame([(1,), (2,), (3,)], "id int"), "id", ())
    e = Edge("E", "E", spark.createDataFrame([("x", 1, 2), ("y", 1, 2), ("z", 3, 2)], "edge_id string, s int, t int"), "V", "s", "V", "t", hub=True)
    p = Pattern(("a", "V"), (Hop("e1", "E", "b", "V"), Hop("e2", "E", "c", "V", back=True)))
    for trusted in (True, False):
        got = match(GraphSpec((v,), (e,)), p, lambda q: {"a": q("a", "id"), "c": q("c", "id")}, trusted=trusted)
        assert rows(got) == sorted([(1, 1)] * 4 + [(1, 3)] * 2 + [(3, 1)] * 2 + [(3, 3)])
    apart = Pattern(p.start, p.hops, distinct_pairs=(("a", "c"),))
    assert rows(match(GraphSpec((v,), (e,)), apart, lambda q: {"a": q("a", "id")})) == [(1,), (1,), (3,), (3,)]


def test_questions(graph, rows):
    assert rows(kg.incident_impact(graph, [INC]), "incident_id", "affected_equipment_id", "related_equipment_id", "related_stage_name", "lot_source", "affected_lot_source") == [
        (INC, "E1", "E2", "Two", "DEMO", "MASTER_CSV"), (INC, "E1", "E3", "Three", "DEMO", "MASTER_CSV")]
    assert rows(kg.impact_by_stage(graph), "related_stage_id", "related_equipment_count") == [("S2", 1), ("S3", 1)]
    tasks = kg.open_tasks(graph, [INC]).orderBy(*kg.task_order()).collect()
    assert [(t["task_id"], t["task_code"], t["equipment_id"]) for t in tasks] == [(1, "TASK-1", "E2"), (2, "TASK-2", "E3")]
    docs = rows(kg.related_documents(graph, [INC]), "document_id", "path", "task_id")
    assert len(docs) == 7 and len({d[0] for d in docs}) == 3
    ids = kg.impact_elements(graph, [INC]).first()
    assert tuple(ids["affects_edge"]) == ("INCIDENT_AFFECTS", f"{INC}|AFFECTS|E1")
    assert kg.incident_impact(graph, graph.vertex("INCIDENT").df.where("incident_id = 'INC-8'").select("incident_id")).count() == 0


def test_trusted_and_full_joins_agree(graph, rows):
    cols = lambda p: {"i": p("i", "incident_id"), "r": p("e2", "equipment_id"), "s": p("s", "stage_name")}
    assert rows(match(graph, kg.IMPACT, cols)) == rows(match(graph, kg.IMPACT, cols, trusted=False))


def test_graph_equals_joins(graph, sources):
    matched = kg.incident_impact(graph).select(
        "incident_id", "affected_equipment_id", "manufacturing_lot", "related_equipment_id", F.col("related_stage_id").alias("stage_id"))
    assert symmetric_difference(kg.impact_by_joins(sources), matched, "d", "SQL_ONLY", "GRAPH_ONLY").count() == 0


def test_json_answers(graph, rows):
    page = api.documents_json(graph, [INC]).collect()
    assert len(page) == 1
    members = json.loads(page[0]["json"])
    assert [m["document_id"] for m in members] == ["IR", "OPS", "OPS", "OPS", "SB", "SB", "SB"]
    assert all(len(m) == 16 for m in members) and members[0]["task_id"] is None
    assert [m["status"] for m in json.loads(api.tasks_json(graph, [INC]).first()["json"])] == ["OPEN", "IN_PROGRESS"]
    assert rows(api.answer(graph, "INC-8", api.impact_json)) == [(0, "[]")]
    assert api.answer(graph, INC, api.impact_json).count() == 1
    assert api.json_rows(api.impact_json(graph, [INC]).select("json"), "related_equipment_id: string").count() == 2
    assert api.impact_json(graph, [INC]).select(api.array_size().alias("n")).first()[0] == 2


@pytest.mark.parametrize("bad,code", [
    (None, -20011), ("INVALID-ID", -20011), ("inc-7-a", -20011), (INC + "\n", -20011), ("INC-UNKNOWN-999", -20012), ("INC-9", -20012)])
def test_id_guard(graph, bad, code):
    with pytest.raises(api.IncidentIdError) as e:
        api.assert_incident(graph, bad)
    assert e.value.code == code


def test_id_guard_in_bulk(spark, graph, rows):
    twice = graph.replacing(INCIDENTS=graph.vertex("INCIDENT").df.unionByName(graph.vertex("INCIDENT").df.where("incident_id = 'INC-8'")))
    asked = spark.createDataFrame([(INC,), ("INC-8",), ("x",), ("INC-0",), (INC + "\n",)], "incident_id string")
    assert rows(api.id_states(twice, asked)) == sorted([(INC, 0), ("INC-8", -20013), ("x", -20011), ("INC-0", -20012), (INC + "\n", -20011)], key=repr)
    with pytest.raises(api.IncidentIdError) as e:
        api.assert_incident(twice, "INC-8")
    assert e.value.code == -20013


def test_postconditions(graph, rows):
    got = rows(api.postconditions(
        graph, INC, "E1", "L1", ["E2", "E3"], ["IR", "SB", "OPS"], {"impact": 2, "open_tasks": 2, "documents": 7}))
    assert len(got) == 9 and all(ok for _, ok in got), got
    wrong = dict(rows(api.postconditions(graph, INC, "E1", "L1", ["E2"], ["IR"], {"impact": 3, "open_tasks": 2, "documents": 7})))
    assert not wrong["impact rows"] and not wrong["impact ids"] and not wrong["documents unexpected"] and wrong["open tasks"]


def test_what_if_counts(graph, rows):
    """Close one task, drop one guide link, drop all links to the bulletin: counts change exactly so."""
    tasks, guides, uses = graph.vertex("TASK").df, graph.edge("GOVERNED_BY").df, graph.edge("USES_PROCEDURE").df
    closed = changes.apply_update(tasks, F.col("task_id") == 1, {"status": F.lit("CLOSED")}, expected=1)
    cut = changes.apply_delete(guides, (F.col("manufacturing_lot") == "L1") & (F.col("document_id") == "SB"), expected=1)
    mine = tasks.where(F.col("incident_id") == INC).select("task_id")
    cut_uses = changes.delete_matching(uses, uses.where("document_id = 'SB'").join(mine, "task_id", "left_semi"), ["task_id", "document_id"], expected=2)
    got = rows(changes.what_if({
        "0": graph, "1": graph.replacing(TASKS=closed), "2": graph.replacing(LOT_DOCUMENT=cut),
        "3": graph.replacing(LOT_DOCUMENT=cut, TASK_DOCUMENT=cut_uses)}, [INC], bulletin="SB"),
        "case", "equipment", "tasks", "paths", "documents", "bulletin_paths", "incident_paths", "lot_paths", "task_paths")
    assert got == [("0", 2, 2, 7, 3, 3, 1, 2, 4), ("1", 2, 1, 5, 3, 2, 1, 2, 2), ("2", 2, 2, 6, 3, 2, 1, 1, 4), ("3", 2, 2, 4, 2, 0, 1, 1, 2)]
    with pytest.raises(changes.ChangeError):
        changes.apply_delete(guides, F.col("document_id") == "SB", expected=2)


def test_saved_graph(spark, graph, rows, tmp_path):
    again = graph.saved(spark, str(tmp_path / "g"))
    assert rows(kg.incident_impact(again)) == rows(kg.incident_impact(graph))


def test_facts_one_row_per_incident(spark, sources, rows):
    sensors = spark.createDataFrame(
        [("2026-08-08", "S1", "E1", "temperature_c", 91.755), ("2026-08-08", "S1", "E1", "temperature_c", 60.0), ("2026-08-07", "S1", "E1", "temperature_c", 99.0),
         ("2026-08-08", "S1", "E1", "packet_loss_pct", 19.1667), ("2026-08-08", "S1", "E1", "fan_rpm", 120.0), ("2026-08-08", "S1", "E1", "fan_rpm", None)],
        "festival_date string, stage_id string, equipment_id string, metric_name string, metric_value double").withColumn("status", F.lit("NORMAL"))
    maintenance = spark.createDataFrame(
        [("E1", "2026-07-25", "OVERDUE"), ("E1", "2026-07-01", "COMPLETED"), ("E1", "2026-08-01", "OVERDUE"), ("E5", "2026-07-01", "OVERDUE")],
        "equipment_id string, scheduled_date string, status string")
    schedule = spark.createDataFrame([(f"P{i}", "2026-08-08", "S1", "a", "t") for i in range(4)], "performance_id string, festival_date string, stage_id string, artist_name string, planned_start_ts string")
    actual = spark.createDataFrame([("P0", "t", 29, "COMPLETED", INC), ("P1", "t", 24, "COMPLETED", INC), ("P2", "t", 16, "COMPLETED", INC), ("P3", "t", 1, "COMPLETED", None)],
                                   "performance_id string, actual_start_ts string, delay_minutes bigint, status string, incident_id string")
    delays = views.stage_delay(schedule, actual, sources.stages)
    got = facts.incident_facts(kg.incident_nodes(sources), kg.equipment_nodes(sources), kg.stage_nodes(sources), sensors, maintenance, delays)
    assert len(got.columns) == 25
    assert facts.fan_out(got).count() == 0
    cols = ["daily_max_temperature_c", "daily_max_packet_loss_pct", "daily_min_fan_rpm", "maintenance_record_count", "overdue_maintenance_count",
            "earliest_overdue_scheduled_date", "affected_performance_count", "max_delay_minutes"]
    assert tuple(got.where(F.col("incident_id") == INC).select(cols).first()) == (91.755, 19.167, 120.0, 3, 2, "2026-07-25", 3, 29)
    assert rows(got, "incident_id", "equipment_stage_name") == [("INC-10", "One"), (INC, "One"), ("INC-8", None)]
