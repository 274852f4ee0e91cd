"""Changes to data on the benchmark tables."""

from pyspark.sql import functions as F

from opslake.operators.sets import union_all
from opslake.plans import changes
from opslake.workload.registry import Tables, query
from opslake.workload.roles import Roles, with_roles
from opslake.workload.shared import shared_dir


@query("d1_upsert", """
    WITH s AS (SELECT o_custkey AS k, max(o_totalprice) AS bal FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
               UNION ALL SELECT -1 - s_suppkey, s_acctbal FROM supplier)
    SELECT coalesce(c_custkey, k) AS c_custkey, CASE WHEN c_custkey IS NULL THEN 'NEW' ELSE c_name END AS c_name,
        coalesce(bal, c_acctbal) AS c_acctbal, c_mktsegment FROM customer FULL JOIN s ON k = c_custkey""")
def d1(t: Tables):
    source = (
        t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
        .unionByName(t.supplier.select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal")))
    )
    target = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return changes.upsert(target, source, ["c_custkey"], insert_defaults={"c_name": F.lit("NEW")})


@query("d2_upsert_two_keys", """
    WITH tgt AS (SELECT l_orderkey, l_linenumber, 'MASTER' AS source_type, max(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2),
    src AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('R', 'N'))
    SELECT coalesce(t.l_orderkey, s.l_orderkey) AS l_orderkey, coalesce(t.l_linenumber, s.l_linenumber) AS l_linenumber,
        CASE WHEN s.l_orderkey IS NULL THEN t.source_type ELSE 'SYNTHETIC_DEMO' END AS source_type, t.q
    FROM tgt t FULL JOIN src s ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber""")
def d2(t: Tables):
    keys = ["l_orderkey", "l_linenumber"]
    target = t.lineitem.where("l_returnflag <> 'N'").groupBy(*keys).agg(F.max("l_quantity").alias("q")).select(
        *keys, F.lit("MASTER").alias("source_type"), "q")
    source = t.lineitem.where("l_returnflag IN ('R', 'N')").select(*keys).distinct().withColumn("source_type", F.lit("SYNTHETIC_DEMO"))
    return changes.upsert(target, source, keys)


@query("d3_upsert_natural_key", with_roles("""
    SELECT CASE WHEN t.task_id IS NULL THEN 'new' ELSE CAST(t.task_id AS VARCHAR) END AS id, coalesce(t.incident_id, s.incident_id) AS incident_id,
        CASE WHEN s.incident_id IS NULL THEN t.status ELSE 'OPEN' END AS status, coalesce(s.priority, t.priority) AS priority
    FROM t3 t FULL JOIN s3 s ON s.incident_id = t.incident_id AND s.task_title = t.task_title AND s.created_by_agent = t.created_by_agent""",
    t3="SELECT min(task_id) AS task_id, incident_id, task_title, created_by_agent, min(status) AS status, min(priority) AS priority FROM tasks GROUP BY incident_id, task_title, created_by_agent",
    s3="SELECT DISTINCT incident_id, task_title, CASE WHEN priority = 'HIGH' THEN 'NEW-AGENT' ELSE created_by_agent END AS created_by_agent, 'CRITICAL' AS priority FROM tasks WHERE status = 'CLOSED'"))
def d3(t: Tables):
    natural = ["incident_id", "task_title", "created_by_agent"]
    tasks = Roles(t).tasks
    target = tasks.groupBy(*natural).agg(
        F.min("task_id").alias("task_id"), F.min("status").alias("status"), F.min("priority").alias("priority"))
    agent = F.when(F.col("priority") == "HIGH", "NEW-AGENT").otherwise(F.col("created_by_agent")).alias("created_by_agent")
    source = tasks.where("status = 'CLOSED'").select("incident_id", "task_title", agent).distinct().withColumns(
        {"priority": F.lit("CRITICAL"), "status": F.lit("OPEN")})
    out = changes.upsert_by_natural_key(target, source, natural)
    known = F.col("task_id") <= target.agg(F.max("task_id")).scalar()
    return out.select(
        F.when(known, F.col("task_id").cast("string")).otherwise("new").alias("id"), "incident_id", "status", "priority")


@query("d4_checked_insert", """
    SELECT 'inserted' AS outcome, upper(substr(o_orderpriority, 3)) AS priority, count(*) AS n, count(*) AS ids FROM orders
    WHERE upper(substr(o_orderpriority, 3)) IN ('LOW', 'MEDIUM', 'HIGH') GROUP BY 2
    UNION ALL SELECT '-20001 Invalid priority', upper(substr(o_orderpriority, 3)), count(*), 0 FROM orders
    WHERE upper(substr(o_orderpriority, 3)) NOT IN ('LOW', 'MEDIUM', 'HIGH') GROUP BY 2""")
def d4(t: Tables):
    tasks = Roles(t).tasks
    rows = t.orders.select(
        F.concat(F.lit("INC-"), F.col("o_orderkey").cast("string")).alias("incident_id"), F.lit("check").alias("task_title"),
        F.lower(F.substring("o_orderpriority", 3, 20)).alias("priority"), F.lit("API").alias("created_by_agent"))
    table, rejects = changes.insert_checked(tasks, rows)
    top = tasks.agg(F.max("task_id").alias("m"))
    added = table.where(F.col("created_by_agent") == "API").groupBy("priority").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("task_id") > top.scalar(), F.col("task_id"))).alias("ids"))
    refused = rejects.groupBy(F.col("reject_reason").alias("outcome"), F.upper("priority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("ids"))
    return added.select(F.lit("inserted").alias("outcome"), "priority", "n", "ids").unionByName(refused)


@query("d5_constraints", """
    SELECT 'key l_orderkey,l_linenumber' AS rule, count(*) AS violations FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'not null l_partkey', count(*) FILTER (l_partkey IS NULL) FROM lineitem
    UNION ALL SELECT 'not null l_tax', count(*) FILTER (l_tax IS NULL) FROM lineitem
    UNION ALL SELECT 'check l_returnflag', count(*) FILTER (l_returnflag NOT IN ('A', 'R')) FROM lineitem""")
def d5(t: Tables):
    spec = changes.Constraints(("l_orderkey", "l_linenumber"), ("l_partkey", "l_tax"), {"l_returnflag": ("A", "R")})
    return changes.constraint_violations(t.lineitem, spec)


@query("d5_relation_constraints", with_roles("""
    SELECT 'lot_patch' AS relation, 'check assertion_status' AS rule, CAST(0 AS BIGINT) AS violations
    UNION ALL SELECT 'lot_patch', 'key equipment_id', count(*) FROM (SELECT 1 FROM lot_patch GROUP BY equipment_id HAVING count(*) > 1)
    UNION ALL SELECT 'tasks', 'check priority', count(*) FILTER (priority NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) FROM tasks
    UNION ALL SELECT 'tasks', 'key task_id', count(*) FROM (SELECT 1 FROM tasks GROUP BY task_id HAVING count(*) > 1)"""))
def d5_relations(t: Tables):
    r = Roles(t)
    checks = {"lot_patch": r.lot_patch, "tasks": r.tasks}
    found = union_all(
        changes.constraint_violations(df, changes.CONSTRAINTS[name]).withColumn("relation", F.lit(name)) for name, df in checks.items())
    return found.where(~F.col("rule").startswith("not null")).select("relation", "rule", "violations")


@query("d6_update_and_delete", """
    SELECT CASE WHEN o_orderstatus = 'P' AND o_totalprice > 200000 THEN 'CLOSED' ELSE o_orderstatus END AS state, count(*) AS n
    FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'O')
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""")
def d6(t: Tables):
    orders = changes.apply_update(
        t.orders, (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000), {"o_orderstatus": F.lit("CLOSED")})
    orders = changes.apply_delete(orders, (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O"))
    gone = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    left = changes.delete_matching(orders, gone, ["o_custkey"])
    return left.groupBy(F.col("o_orderstatus").alias("state")).agg(F.count(F.lit(1)).alias("n"))


_STATE = """SELECT '{case}' AS "case", incident_id, CAST(coalesce(equipment, 0) AS BIGINT) AS equipment, CAST(coalesce(tasks, 0) AS BIGINT) AS tasks,
      CAST(coalesce(paths, 0) AS BIGINT) AS paths, CAST(coalesce(documents, 0) AS BIGINT) AS documents, CAST(coalesce(bp, 0) AS BIGINT) AS bulletin_paths,
      CAST(coalesce(ip, 0) AS BIGINT) AS incident_paths, CAST(coalesce(lp, 0) AS BIGINT) AS lot_paths, CAST(coalesce(tp, 0) AS BIGINT) AS task_paths
    FROM (SELECT incident_id, count(*) AS equipment FROM impact GROUP BY 1)
    FULL JOIN (SELECT incident_id, count(*) AS tasks FROM open_tasks WHERE {task} GROUP BY 1) USING (incident_id)
    FULL JOIN (SELECT incident_id, count(*) AS paths, count(DISTINCT document_id) AS documents, count(*) FILTER (path = 'DOCUMENTED_BY') AS ip,
        count(*) FILTER (path LIKE 'AFFECTS%') AS lp, count(*) FILTER (path LIKE 'CREATES%') AS tp,
        count(*) FILTER (document_id = (SELECT b FROM bulletin)) AS bp
      FROM related_documents WHERE {doc} GROUP BY 1) USING (incident_id)"""


@query("d7_what_if", with_roles(" UNION ALL ".join([
    _STATE.format(case="baseline", task="1 = 1", doc="1 = 1"),
    _STATE.format(case="urgent tasks closed", task="priority <> 'CRITICAL'",
                  doc="(task_id IS NULL OR task_id IN (SELECT task_id FROM tasks WHERE priority <> 'CRITICAL'))"),
    _STATE.format(case="bulletins removed", task="1 = 1", doc="relation_type <> 'SERVICE_BULLETIN'"),
    _STATE.format(case="one bulletin removed from lots and tasks", task="1 = 1",
                  doc="(document_id <> (SELECT b FROM bulletin) OR path = 'DOCUMENTED_BY')"),
]), bulletin="SELECT min(document_id) AS b FROM lot_document WHERE relation_type = 'SERVICE_BULLETIN'"))
def d7(t: Tables):
    """Answers are computed once; each case says which of their rows a change would leave."""
    r = Roles(t)
    rows = changes.what_if_rows(r.graph, r.tasks)
    bulletin = r.lot_document.where("relation_type = 'SERVICE_BULLETIN'").agg(F.min("document_id")).scalar()
    is_it = F.col("document_id") == bulletin
    document = F.col("answer") == "document"
    return changes.count_cases(rows, {
        "baseline": F.lit(True),
        "urgent tasks closed": (F.col("answer") == "equipment") | (F.col("priority").isNull()) | (F.col("priority") != "CRITICAL"),
        "bulletins removed": ~document | (F.col("relation_type") != "SERVICE_BULLETIN"),
        "one bulletin removed from lots and tasks": ~document | ~is_it | (F.col("path") == "DOCUMENTED_BY"),
    }, is_it)


@query("d8_snapshot_versions", """
    SELECT o_orderstatus, count(*) AS n FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus FROM orders) GROUP BY 1""")
def d8(t: Tables):
    """First version, a change as the second, and the latest read back."""
    root = shared_dir(t.spark)
    first = changes.create_if_absent(t.orders.select("o_orderkey", "o_orderstatus"), root)
    changes.write_snapshot(changes.apply_update(first, F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("O")}), root)
    return changes.read_snapshot(t.spark, root).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
