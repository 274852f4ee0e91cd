"""Knowledge-graph questions and checks on the benchmark tables."""

from pyspark.sql import functions as F

from opslake.functions.text import json_object
from opslake.operators.aggregates import count_where
from opslake.operators.sets import symmetric_difference, union_all
from opslake.plans import api, factored, kg, quality
from opslake.plans.graph import GraphSpec, Hop, Pattern, element_sizes, endpoint_errors, key_errors, match
from opslake.plans.reduced_match import match_reduced
from opslake.sources import audit
from opslake.workload.registry import SQL, Tables, query
from opslake.workload.roles import Roles, with_roles

query("g1_location_scope", with_roles("SELECT * FROM scope"))(lambda t: Roles(t).scope)
query("g2_scope_audit", with_roles("SELECT * FROM audit"))(lambda t: Roles(t).audit)
query("g3_incident_nodes", with_roles("SELECT * FROM kg_incidents"))(lambda t: kg.incident_nodes(Roles(t).sources))
query("g4_equipment_nodes", with_roles("SELECT * FROM kg_equipment"))(lambda t: kg.equipment_nodes(Roles(t).sources))
query("g5_stage_nodes", with_roles("SELECT * FROM stages"))(lambda t: kg.stage_nodes(Roles(t).sources))
query("g6_lot_nodes", with_roles("SELECT * FROM kg_lots"))(lambda t: kg.lot_nodes(kg.equipment_nodes(Roles(t).sources)))
query("g7_task_nodes", with_roles("SELECT * FROM kg_tasks"))(lambda t: Roles(t).graph.vertex("TASK").df)
query("g8_document_nodes", with_roles("SELECT * FROM docs"))(lambda t: kg.document_nodes(Roles(t).sources))

for _id, _name, _label, _cte in (
    ("g9", "affects", "AFFECTS", "e_affects"),
    ("g10", "belongs_to_lot", "BELONGS_TO_LOT", "e_lot"),
    ("g11", "deployed_at", "DEPLOYED_AT", "e_stage"),
    ("g12", "documented_by", "DOCUMENTED_BY", "e_doc"),
    ("g13", "creates", "CREATES", "e_task"),
    ("g14", "targets", "TARGETS", "e_targets"),
    ("g15", "uses_procedure", "USES_PROCEDURE", "e_uses"),
    ("g16", "governed_by", "GOVERNED_BY", "e_governed"),
):
    query(f"{_id}_{_name}", with_roles(f"SELECT * FROM {_cte}"))(
        lambda t, label=_label: Roles(t).graph.edge(label).df
    )

_ELEMENTS = (
    ("VERTEX", "INCIDENTS", "kg_incidents"), ("VERTEX", "EQUIPMENTS", "kg_equipment"), ("VERTEX", "STAGES", "stages"),
    ("VERTEX", "LOTS", "kg_lots"), ("VERTEX", "TASKS", "kg_tasks"), ("VERTEX", "DOCUMENTS", "docs"),
    ("EDGE", "INCIDENT_AFFECTS", "e_affects"), ("EDGE", "EQUIPMENT_LOT", "e_lot"), ("EDGE", "EQUIPMENT_STAGE", "e_stage"),
    ("EDGE", "INCIDENT_DOCUMENT", "e_doc"), ("EDGE", "INCIDENT_TASK", "e_task"), ("EDGE", "TASK_EQUIPMENT", "e_targets"),
    ("EDGE", "TASK_DOCUMENT", "e_uses"), ("EDGE", "LOT_DOCUMENT", "e_governed"),
)


@query("g17_graph_elements", with_roles(" UNION ALL ".join(
    f"SELECT '{k}' AS element_kind, '{n}' AS element_name, count(*) AS rows FROM {c}" for k, n, c in _ELEMENTS)))
def graph_elements(t: Tables):
    return element_sizes(Roles(t).graph)


@query("g18_open_task_documents", with_roles("""
    SELECT t.task_id, t.priority, x.equipment_id, d.document_id, d.version FROM kg_tasks t
    JOIN e_targets x ON x.task_id = t.task_id JOIN e_uses u ON u.task_id = t.task_id JOIN docs d ON d.document_id = u.document_id
    WHERE t.status = 'OPEN' AND d.document_type = 'en'"""))
def open_task_documents(t: Tables):
    """A pattern that starts at equipment and walks back to the task, then on to its document."""
    return match(Roles(t).graph, _TASK_DOCUMENTS, _task_document_columns)


@query("g18_reduced_documents", SQL["g18_open_task_documents"])
def reduced_documents(t: Tables):
    """The same pattern after a full reduction."""
    return match_reduced(Roles(t).graph, _TASK_DOCUMENTS, _task_document_columns)


_TASK_DOCUMENTS = Pattern(
    ("e", "EQUIPMENT"),
    (Hop("x", "TARGETS", "t", "TASK", back=True), Hop("u", "USES_PROCEDURE", "d", "DOCUMENT")),
    where={"t": lambda p: p("status") == "OPEN", "d": lambda p: p("document_type") == "en"},
)


def _task_document_columns(p):
    return {
        "task_id": p("t", "task_id"), "priority": p("t", "priority"), "equipment_id": p("e", "equipment_id"),
        "document_id": p("d", "document_id"), "version": p("d", "version"),
    }


query("g19_incident_impact", with_roles("SELECT * FROM impact"))(lambda t: kg.incident_impact(Roles(t).graph))


@query("g19_impact_by_stage", with_roles("""
    SELECT incident_id, affected_equipment_id, manufacturing_lot, related_stage_id, related_stage_name,
           count(*) AS related_equipment_count
    FROM impact GROUP BY ALL"""))
def impact_by_stage(t: Tables):
    return kg.impact_by_stage(Roles(t).graph)


query("g19_factored_impact", with_roles("SELECT * FROM impact"))(lambda t: factored.expand(factored.factorise(Roles(t).graph)))


@query("g19_factored_counts", with_roles("""
    SELECT incident_id, affected_equipment_id, manufacturing_lot, count(*) AS related_equipment_count FROM impact GROUP BY ALL"""))
def factored_counts(t: Tables):
    """Peers per incident and device hit from the factors, without pairs."""
    return factored.peer_counts(factored.factorise(Roles(t).graph))


@query("g19_factored_positions", with_roles("""
    SELECT p.* EXCLUDE (n) FROM (
        SELECT row_number() OVER w - 1 AS position, impact.*, count(*) OVER (PARTITION BY incident_id) AS n FROM impact
        WINDOW w AS (PARTITION BY incident_id ORDER BY affected_equipment_id, manufacturing_lot, related_stage_id, related_equipment_id)) p
    WHERE position IN (0, (n - 1) // 2, n - 1)"""))
def factored_positions(t: Tables):
    """First, middle and last pair of every incident by their numbers."""
    f = factored.factorise(Roles(t).graph)
    return factored.pairs_at(f, factored.spread_positions(f))


query("g20_open_tasks", with_roles("SELECT * FROM open_tasks"))(lambda t: kg.open_tasks(Roles(t).graph))
query("g21_related_documents", with_roles("SELECT * FROM related_documents"))(lambda t: kg.related_documents(Roles(t).graph))


@query("g22_impact_elements", with_roles("""
    SELECT incident_id AS incident, incident_id || '|AFFECTS|' || affected_equipment_id AS affects_edge,
        affected_equipment_id AS affected_equipment, affected_equipment_id || '|LOT|' || manufacturing_lot AS affected_lot_edge,
        manufacturing_lot AS lot, related_equipment_id || '|LOT|' || manufacturing_lot AS related_lot_edge,
        related_equipment_id AS related_equipment, related_equipment_id || '|STAGE|' || related_stage_id AS deployed_at_edge,
        related_stage_id AS stage, 'EQUIPMENTS' AS related_element
    FROM impact"""))
def impact_elements(t: Tables):
    return _flat_elements(kg.impact_elements(Roles(t).graph))


def _flat_elements(e):
    return e.select(
        *[F.col(f"{c}_vertex.key").alias(c) for c in ("incident", "affected_equipment", "lot", "related_equipment", "stage")],
        *[F.col(f"{c}.key").alias(c) for c in ("affects_edge", "affected_lot_edge", "related_lot_edge", "deployed_at_edge")],
        F.col("related_equipment_vertex.element").alias("related_element"),
    )


@query("g22_factored_elements", SQL["g22_impact_elements"])
def factored_elements(t: Tables):
    graph = Roles(t).graph
    return _flat_elements(factored.expand_elements(factored.factorise(graph), graph))


@query("g23_element_counts", with_roles("""
    SELECT element_kind, count(*) AS definitions, sum(n) AS rows FROM (
    """ + " UNION ALL ".join(f"SELECT '{k}' AS element_kind, count(*) AS n FROM {c}" for k, _, c in _ELEMENTS) + """)
    GROUP BY element_kind""").replace("sum(n) AS rows", "CAST(sum(n) AS BIGINT) AS rows"))
def element_counts(t: Tables):
    return element_sizes(Roles(t).graph).groupBy("element_kind").agg(
        F.count(F.lit(1)).alias("definitions"), F.sum("rows").cast("bigint").alias("rows")
    )


def raw_graph(r: Roles) -> GraphSpec:
    """The graph over link tables as delivered: lines as tasks and links, nothing cut to scope."""
    line_id = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("task_id")
    part = F.concat(F.lit("PART-"), F.col("l_partkey").cast("string")).alias("equipment_id")
    lines = r.t.lineitem.where("l_returnflag = 'R'").select(
        line_id, part, F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("edge_id"),
        F.lit("LINE").alias("source_type"), F.lit("lineitem").alias("source_reference_id"),
    )
    docs = r.task_document.withColumn("edge_id", F.concat_ws("|", F.col("task_id").cast("string"), "document_id"))
    return r.graph.replacing(TASK_EQUIPMENT=lines, TASK_DOCUMENT=docs)


_RAW = {
    "raw_targets": """SELECT l_orderkey || '|' || l_linenumber AS edge_id, l_orderkey * 8 + l_linenumber AS task_id,
        'PART-' || l_partkey AS equipment_id FROM lineitem WHERE l_returnflag = 'R'""",
    "raw_uses": "SELECT task_id || '|' || document_id AS edge_id, task_id, document_id FROM task_document",
}


@query("g24_key_errors", with_roles(
    "SELECT 'EDGE' AS element_kind, 'TASK_EQUIPMENT' AS element_name, count(*) AS error_count FROM ("
    "SELECT edge_id FROM raw_targets GROUP BY edge_id HAVING edge_id IS NULL OR count(*) > 1) HAVING count(*) > 0 UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{k}', '{n}', count(*) FROM (SELECT {key} FROM {c} GROUP BY {key} HAVING {key} IS NULL OR count(*) > 1) HAVING count(*) > 0"
        for k, n, c, key in [
            (k, n, c, {"kg_incidents": "incident_id", "kg_equipment": "equipment_id", "stages": "stage_id", "kg_lots": "manufacturing_lot",
                       "kg_tasks": "task_id", "docs": "document_id"}.get(c, "edge_id"))
            for k, n, c in _ELEMENTS if n not in ("TASK_EQUIPMENT", "TASK_DOCUMENT")
        ] + [("EDGE", "TASK_DOCUMENT", "raw_uses", "edge_id")]), **_RAW))
def g24(t: Tables):
    return key_errors(raw_graph(Roles(t)))


@query("g25_endpoint_errors", with_roles("""
    SELECT 'TASK_EQUIPMENT' AS edge_name, count(*) AS error_count FROM raw_targets e
      WHERE task_id NOT IN (SELECT task_id FROM kg_tasks) OR equipment_id NOT IN (SELECT equipment_id FROM kg_equipment) HAVING count(*) > 0
    UNION ALL SELECT 'TASK_DOCUMENT', count(*) FROM raw_uses e
      WHERE task_id NOT IN (SELECT task_id FROM kg_tasks) OR document_id NOT IN (SELECT document_id FROM docs) HAVING count(*) > 0
    UNION ALL SELECT 'EQUIPMENT_LOT', count(*) FROM e_lot
      WHERE manufacturing_lot NOT IN (SELECT manufacturing_lot FROM kg_lots) HAVING count(*) > 0""", **_RAW))
def g25(t: Tables):
    return endpoint_errors(raw_graph(Roles(t)))


def _live(t: Tables):
    """The checks after a change: at first some tasks and lines are not there, and some lines that will go are."""
    from opslake.plans.live_checks import LiveChecks, delta_of
    from opslake.sources.scratch import shared_dir

    r = Roles(t)
    r.graph = kg.build_graph(r, kg.Nodes(r).saved(t.spark, shared_dir(t.spark), kg.Nodes.LINKS)).without_properties()
    graph = raw_graph(r)
    tasks, lines = graph.vertex("TASK").df, graph.edge("TARGETS").df
    later, wrong = F.col("task_id") % 10 == 9, lines.where("task_id % 10 = 3").withColumn("equipment_id", F.lit("PART-0"))
    earlier = graph.replacing(TASKS=tasks.where(~later), TASK_EQUIPMENT=lines.where(~later).unionByName(wrong))
    change = delta_of(graph, {"TASKS": tasks.where(later), "TASK_EQUIPMENT": lines.where(later)}, {"TASK_EQUIPMENT": wrong})
    return LiveChecks.start(earlier, shared_dir(t.spark)).apply(change)


query("g24_live_key_errors", SQL["g24_key_errors"])(lambda t: _live(t).key_errors())
query("g25_live_endpoint_errors", SQL["g25_endpoint_errors"])(lambda t: _live(t).endpoint_errors())


@query("g26_source_errors", with_roles("""
    SELECT * FROM (
    SELECT 'SCOPE_UNKNOWN_OR_MISSING' AS relation_name, count(*) AS error_count FROM audit WHERE scope_status = 'UNKNOWN_OR_MISSING'
    UNION ALL SELECT 'INCIDENT_AFFECTS_SOURCE', count(*) FROM kg_incidents WHERE related_equipment_id IS NOT NULL
      AND related_equipment_id NOT IN (SELECT equipment_id FROM kg_equipment)
    UNION ALL SELECT 'EQUIPMENT_LOT_SOURCE', count(*) FROM kg_equipment WHERE manufacturing_lot IS NULL
    UNION ALL SELECT 'EQUIPMENT_STAGE_SOURCE', count(*) FROM equipment WHERE stage_id NOT IN (SELECT location_id FROM scope)
    UNION ALL SELECT 'INCIDENT_DOCUMENT_SOURCE', count(*) FROM kg_incidents WHERE document_id IS NOT NULL
      AND document_id NOT IN (SELECT document_id FROM docs)
    UNION ALL SELECT 'INCIDENT_TASK_SOURCE', count(*) FROM tasks WHERE incident_id NOT IN (SELECT incident_id FROM incidents)
    UNION ALL SELECT 'LOT_PATCH_SOURCE', count(*) FROM lot_patch WHERE equipment_id NOT IN (SELECT equipment_id FROM kg_equipment)
    UNION ALL SELECT 'TASK_EQUIPMENT_SOURCE', count(*) FROM task_equipment WHERE task_id NOT IN (SELECT task_id FROM kg_tasks)
      OR equipment_id NOT IN (SELECT equipment_id FROM kg_equipment)
    UNION ALL SELECT 'TASK_DOCUMENT_SOURCE', count(*) FROM task_document WHERE task_id NOT IN (SELECT task_id FROM kg_tasks)
      OR document_id NOT IN (SELECT document_id FROM docs)
    UNION ALL SELECT 'LOT_DOCUMENT_SOURCE', count(*) FROM lot_document WHERE manufacturing_lot NOT IN (SELECT manufacturing_lot FROM kg_lots)
      OR document_id NOT IN (SELECT document_id FROM docs)) WHERE error_count > 0"""))
def g26(t: Tables):
    r = Roles(t)
    return quality.source_errors(r.sources, r.scope, r.audit)


@query("g27_graph_equals_joins", with_roles("""
    SELECT CAST(NULL AS VARCHAR) AS difference, count(*) AS n FROM impact"""))
def g27(t: Tables):
    """The number of rows compared, and one line per kind of difference; there is none when pattern and plain joins agree."""
    r = Roles(t)
    joined = kg.impact_by_joins(r.sources)
    matched = kg.incident_impact(r.graph).select(
        "incident_id", "affected_equipment_id", "manufacturing_lot", "related_equipment_id", F.col("related_stage_id").alias("stage_id")
    )
    # Sums per incident and lot first; only the pairs of groups that differ are listed.
    keys = ["incident_id", "manufacturing_lot"]
    sums = [
        side.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n{i}"), F.sum(F.xxhash64(*side.columns).cast("decimal(38,0)")).alias(f"h{i}"))
        for i, side in enumerate((joined, matched))
    ]
    groups = sums[0].join(sums[1], keys, "full")
    unlike = groups.where(~(F.col("n0").eqNullSafe(F.col("n1")) & F.col("h0").eqNullSafe(F.col("h1")))).select(*keys)
    listed = [side.join(unlike, keys, "left_semi").select(*side.columns) for side in (joined, matched)]
    differ = symmetric_difference(*listed, "difference", "SQL_ONLY", "GRAPH_ONLY").groupBy("difference").agg(F.count(F.lit(1)).alias("n"))
    compared = sums[1].agg(F.lit(None).cast("string").alias("difference"), F.coalesce(F.sum("n1"), F.lit(0)).alias("n"))
    return compared.unionByName(differ)


def _json_sql(rows: str, members: str, order: str) -> str:
    return with_roles(f"""
        SELECT incident_id, page_no, count(*) AS members, '[' || string_agg(j, ',' ORDER BY place) || ']' AS json
        FROM (SELECT *, (place - 1) // 1000 AS page_no FROM (
            SELECT incident_id, j, row_number() OVER (PARTITION BY incident_id ORDER BY {order}, j) AS place
            FROM (SELECT *, CAST(to_json({{{members}}}) AS VARCHAR) AS j FROM {rows}))) GROUP BY incident_id, page_no""")


def _named(names, renamed=None):
    return ", ".join(f"'{(renamed or {}).get(n, n)}': {n}" for n in names)


_RANK = "CASE priority WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 4 ELSE 5 END"

query("g28_impact_json", _json_sql("impact", _named(api.IMPACT_MEMBERS), "related_stage_id, related_equipment_id"))(
    lambda t: api.impact_json(Roles(t).graph)
)
query("g28_factored_json", SQL["g28_impact_json"])(lambda t: factored.impact_pages(factored.factorise(Roles(t).graph)))
query("g29_tasks_json", _json_sql("open_tasks", _named(api.TASK_MEMBERS, {"task_status": "status"}), f"{_RANK}, task_id"))(
    lambda t: api.tasks_json(Roles(t).graph)
)
query("g30_documents_json", _json_sql(
    "related_documents", _named(kg.DOCUMENT_COLUMNS), "document_id, relation_type, task_id NULLS LAST"))(
    lambda t: api.documents_json(Roles(t).graph)
)


@query("g31_incident_id_states", with_roles("""
    SELECT a.incident_id, CASE WHEN NOT regexp_matches(a.incident_id, '^INC-[0-9A-Z-]{1,24}$') THEN -20011
        WHEN n IS NULL THEN -20012 WHEN n > 1 THEN -20013 ELSE 0 END AS code
    FROM (SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN 'inc-' ELSE 'INC-' END || o_orderkey AS incident_id FROM orders) a
    LEFT JOIN (SELECT incident_id, count(*) AS n FROM kg_incidents GROUP BY incident_id) k USING (incident_id)"""))
def g31(t: Tables):
    prefix = F.when(F.col("o_orderstatus") == "P", "inc-").otherwise("INC-")
    asked = t.orders.select(F.concat(prefix, F.col("o_orderkey").cast("string")).alias("incident_id"))
    return api.id_states(Roles(t).graph, asked)


@query("s18_graph_elements", with_roles("""
    SELECT 'kg_incidents' AS table_name, count(*) AS rows FROM kg_incidents UNION ALL SELECT 'kg_equipment', count(*) FROM kg_equipment"""))
def s18(t: Tables):
    """Catalog report of the graph: the vertex tables of incidents and devices with their rows."""
    report = audit.element_report(Roles(t).graph, ("VERTEX",))
    name = F.when(F.col("label") == "INCIDENT", "kg_incidents").when(F.col("label") == "EQUIPMENT", "kg_equipment")
    return report.select(name.alias("table_name"), "rows").where("table_name is not null")


@query("f21_error_codes", with_roles("""
    SELECT CASE WHEN n IS NULL THEN -20012 WHEN n > 1 THEN -20013 ELSE 0 END AS code, count(*) AS ids
    FROM (SELECT DISTINCT 'INC-' || o_orderkey AS incident_id FROM orders) a
    LEFT JOIN (SELECT incident_id, count(*) AS n FROM kg_incidents GROUP BY incident_id) k USING (incident_id) GROUP BY 1"""))
def f21(t: Tables):
    """Error codes as data, counted."""
    asked = t.orders.select(F.concat(F.lit("INC-"), F.col("o_orderkey").cast("string")).alias("incident_id"))
    return api.id_states(Roles(t).graph, asked).groupBy("code").agg(F.count(F.lit(1)).alias("ids"))


@query("g32_answer_quality", with_roles("""
    SELECT incident_id AS asked_id, count(*) AS paths, count(DISTINCT document_id) AS documents, CAST(0 AS BIGINT) AS bad_paths
    FROM related_documents GROUP BY incident_id"""))
def g32(t: Tables):
    return api.document_quality(Roles(t).graph)


@query("g32_postconditions", with_roles("""
    SELECT 'impact rows' AS "check", count(*) AS actual FROM i UNION ALL SELECT 'impact peers', count(DISTINCT related_equipment_id) FROM i
    UNION ALL SELECT 'open tasks', count(*) FROM open_tasks WHERE incident_id = (SELECT id FROM one)
    UNION ALL SELECT 'document paths', count(*) FROM d UNION ALL SELECT 'documents found', count(DISTINCT document_id) FROM d
    UNION ALL SELECT 'bad paths', count(*) FILTER (source_type IS NULL OR (path LIKE 'CREATES%' AND task_id IS NULL)) FROM d""",
    one="SELECT min(incident_id) AS id FROM kg_incidents WHERE related_equipment_id IS NOT NULL",
    i="SELECT * FROM impact WHERE incident_id = (SELECT id FROM one)",
    d="SELECT * FROM related_documents WHERE incident_id = (SELECT id FROM one)"))
def g32_postconditions(t: Tables):
    """The answers for one incident in numbers: the first that names a device."""
    graph, n = Roles(t).graph, F.count(F.lit(1))
    asked = graph.vertex("INCIDENT").df.where("related_equipment_id IS NOT NULL").agg(F.min("incident_id").alias("incident_id"))

    def report(rows, **checks):
        counts = rows.agg(*[c.alias(f"_{k}") for k, c in checks.items()])
        pairs = [F.struct(F.lit(k.replace("_", " ")).alias("check"), F.col(f"_{k}").alias("actual")) for k in checks]
        return counts.select(F.inline(F.array(*pairs)))

    return union_all([
        report(kg.incident_impact(graph, asked), impact_rows=n, impact_peers=F.count_distinct("related_equipment_id")),
        report(kg.open_tasks(graph, asked), open_tasks=n),
        report(kg.related_documents(graph, asked), document_paths=n, documents_found=F.count_distinct("document_id"),
               bad_paths=count_where(api.bad_document_path())),
    ])


@query("g32_answer_sizes", with_roles("""
    SELECT incident_id, count(*) AS members, 'impact' AS answer FROM impact GROUP BY incident_id
    UNION ALL SELECT incident_id, count(*), 'open_tasks' FROM open_tasks GROUP BY incident_id
    UNION ALL SELECT incident_id, count(*), 'documents' FROM related_documents GROUP BY incident_id"""))
def g32_sizes(t: Tables):
    return api.answer_sizes(Roles(t).graph)


_EXPECT = """
    SELECT 'lines without order' AS rule, count(*) AS actual, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS ok
      FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'order states', count(DISTINCT o_orderstatus), 3, count(DISTINCT o_orderstatus) = 3 FROM orders
    UNION ALL SELECT 'customers without orders', count(*), 0, count(*) = 0
      FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'regions', count(*), 5, count(*) = 5 FROM region"""


def _expectations(t: Tables):
    n = F.count(F.lit(1))
    no_order = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    no_buyer = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    return quality.expect_counts({
        "lines without order": (no_order, n, 0),
        "order states": (t.orders, F.count_distinct("o_orderstatus"), 3),
        "customers without orders": (no_buyer, n, 0),
        "regions": (t.region, n, 5),
    })


query("g33_source_prechecks", _EXPECT)(_expectations)


@query("g34_expected_counts", with_roles("""
    SELECT 'open tasks without target' AS rule, count(*) AS actual, CAST(0 AS BIGINT) AS expected, count(*) = 0 AS ok
      FROM tasks WHERE status = 'OPEN' AND task_id NOT IN (SELECT task_id FROM task_equipment)
    UNION ALL SELECT 'synthetic patches', count(*), 1, count(*) = 1 FROM lot_patch WHERE assertion_status = 'SYNTHETIC'
    UNION ALL SELECT 'lots in the guide', count(DISTINCT manufacturing_lot), 25, count(DISTINCT manufacturing_lot) = 25 FROM lot_document"""))
def g34(t: Tables):
    r, n = Roles(t), F.count(F.lit(1))
    lost = r.tasks.where("status = 'OPEN'").join(r.task_equipment, "task_id", "left_anti")
    return quality.expect_counts({
        "open tasks without target": (lost, n, 0),
        "synthetic patches": (r.lot_patch.where("assertion_status = 'SYNTHETIC'"), n, 1),
        "lots in the guide": (r.lot_document, F.count_distinct("manufacturing_lot"), 25),
    })


@query("a12_ordered_json_rows", """
    SELECT o_custkey, page_no, count(*) AS members, '[' || string_agg(j, ',' ORDER BY place) || ']' AS json
    FROM (SELECT o_custkey, place, (place - 1) // 1000 AS page_no,
            CAST(to_json({'order': o_orderkey, 'status': o_orderstatus, 'rush': CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END}) AS VARCHAR) AS j
          FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS place FROM orders))
    GROUP BY o_custkey, page_no""")
def a12(t: Tables):
    from opslake.operators.aggregates import json_pages

    payload = json_object([
        F.col("o_orderkey").alias("order"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).alias("rush"),
    ])
    return json_pages(t.orders, "o_custkey", [F.col("o_orderpriority"), F.col("o_orderkey")], payload)
