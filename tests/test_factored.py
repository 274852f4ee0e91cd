"""Impact answers in factors against the listed pairs."""

import pytest
from pyspark.sql import functions as F

from opslake.plans import api, factored, kg
from test_graph import make_sources


def hot_graph(spark, devices=400, several=True):
    """One lot with most devices, hit by many incidents; with ``several``, one incident that hits two devices."""
    s = make_sources(spark)
    eq = [(f"H{i:03}", f"S{i % 3 + 1}", "SWITCH", "m", f"sn-{i}", "HOT" if i % 10 else f"L-{i % 40}", "V", "1.0", "d", "HIGH") for i in range(devices)]
    inc = [(f"INC-H{i}", "d", "S1", "NET", "HIGH", "t", None, "t", 5, f"H{i * 7 % devices:03}", "CLOSED", None, None) for i in range(30)]
    if several:
        inc += [("INC-H3", "d", "S1", "NET", "HIGH", "t", None, "t", 5, "H040", "CLOSED", None, None)]
    sources = kg.Sources(**{f: getattr(s, f) for f in s.__dataclass_fields__} | {
        "equipment": s.equipment.unionByName(spark.createDataFrame(eq, s.equipment.schema)),
        "incidents": s.incidents.unionByName(spark.createDataFrame(inc, s.incidents.schema)),
    })
    return kg.build_graph(sources)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    graph = hot_graph(spark)
    return graph, factored.factorise(graph, folder=str(tmp_path_factory.mktemp("factors")))


def test_expansion_equals_the_pattern(hot, rows):
    graph, f = hot
    want = rows(kg.incident_impact(graph))
    assert rows(factored.expand(f)) == want and len(want) > 9000
    assert f.hits.count() + f.members.count() < 500  # linear in hits and devices
    per_hit = kg.incident_impact(graph).groupBy("incident_id", "affected_equipment_id", "manufacturing_lot").agg(F.count("*").alias("n"))
    assert rows(factored.peer_counts(f)) == rows(per_hit)
    assert rows(factored.expand_elements(f, graph)) == rows(kg.impact_elements(graph))


def test_every_position_names_one_pair(spark, hot, rows):
    graph, f = hot
    sizes = factored.peer_counts(f).groupBy("incident_id").agg(F.sum("related_equipment_count").alias("n"))
    all_of = sizes.select("incident_id", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("position"))  # one too many each
    got = factored.pairs_at(f, all_of)
    assert rows(got.drop("position")) == rows(kg.incident_impact(graph))
    assert got.select("incident_id", "position").distinct().count() == got.count()
    beyond = spark.createDataFrame([("INC-H3", 10**12), ("INC-H3", -1), ("no such", 0), (None, 0)], "incident_id string, position long")
    assert factored.pairs_at(f, beyond).count() == 0


@pytest.mark.parametrize("page_rows", [1, 7, 1000])
def test_pages_equal_the_pages_of_pairs(hot, rows, page_rows):
    graph, f = hot
    order = [F.col("related_stage_id"), F.col("related_equipment_id")]
    wanted = f.hits.select("incident_id").distinct().where("incident_id in ('INC-7-A', 'INC-H0', 'INC-H1', 'INC-H2', 'INC-H3')")
    some = factored.Factors(f.hits.join(wanted, "incident_id", "left_semi"), f.members)
    pairs = kg.incident_impact(graph).join(wanted, "incident_id", "left_semi")
    want = api.json_pages(pairs, "incident_id", order, api._members(api.IMPACT_MEMBERS), page_rows)
    got = factored.impact_pages(some, page_rows)
    assert rows(got, "incident_id", "page_no", "members") == rows(want, "incident_id", "page_no", "members")
    single = "incident_id != 'INC-H3'"  # two lots with one order by stage
    assert rows(got.where(single)) == rows(want.where(single)) and rows(got) == rows(want)


def test_asked_incidents_and_no_answers(spark, hot, rows):
    graph, _ = hot
    f = factored.factorise(graph, ["INC-7-A"])
    assert rows(factored.expand(f)) == rows(kg.incident_impact(graph, ["INC-7-A"]))
    assert f.members.count() == 3
    none = factored.factorise(graph, ["INC-8"])
    assert [x.count() for x in (none.hits, none.members, factored.expand(none), factored.impact_pages(none))] == [0, 0, 0, 0]
