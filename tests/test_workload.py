"""The workload: registration, a sample against SQL, and plan shapes."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_sql import compare, duck
from opslake.workload.catalog import QUERIES, SQL
from opslake.workload.shared import shared_dir

SMALL = "/root/testdata/sf0.001"
SAMPLE = (
    "v1_stage_delay", "v2_equipment_health", "v3_gate_congestion", "v4a_stockout", "v4b_stockout_from_snapshots",
    "v5_refund_context", "v6_incident_facts", "g4_equipment_nodes", "g19_incident_impact", "g19_impact_by_stage",
    "g20_open_tasks", "g24_key_errors", "g31_incident_id_states", "a12_ordered_json_rows", "s2_day_directories", "d1_upsert",
    "d4_checked_insert", "m4_gate_metrics", "r1_refund_decisions", "n1_breaches", "x1_chunks", "x2_cosine_topk", "u3_symmetric_difference",
)


def test_registration():
    """Every query of the workload has SQL, and the driver's entry lists them all."""
    names = set(QUERIES)
    assert names == set(SQL) and names <= set(queries()) and names <= set(oracle_sql())
    assert all(re.fullmatch(r"[a-z]\d{1,2}[ab]?_[a-z0-9_]+", n) for n in names)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_equals_sql(spark, con, name):
    df = queries()[name](spark, SMALL)
    cur = con.execute(oracle_sql()[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(queries()["p4_equality_filter"](spark, SMALL))
    assert "EqualTo(l_returnflag,R)" in p and "l_extendedprice" not in p
    impact = plan(queries()["g19_incident_impact"](spark, SMALL))
    assert "EqualTo(o_orderstatus,F)" in impact and "o_totalprice" not in impact and "l_shipdate" not in impact


def test_no_python_rows_and_no_cross_join(spark):
    for name in ("g19_incident_impact", "g21_related_documents", "v6_incident_facts", "r1_refund_decisions", "x1_chunks", "d1_upsert", "n1_breaches"):
        p = plan(queries()[name](spark, SMALL))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_id_filter_reaches_the_incident_scan(spark):
    from opslake.plans import kg
    from opslake.workload.registry import Tables
    from opslake.workload.roles import Roles

    p = plan(kg.incident_impact(Roles(Tables(spark, SMALL)).graph, ["INC-17"]))
    assert re.search(r"Filter .*concat\(INC-, cast\(o_orderkey.*INC-17", p)


def test_shared_dir_is_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(f"file:{root}") and shared_dir(spark) != shared_dir(spark)
