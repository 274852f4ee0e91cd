"""Matches of reduced graphs against plain matches."""

import random

import pytest
from pyspark.sql import functions as F

from opslake.plans import kg
from opslake.plans.graph import Edge, GraphSpec, Hop, Pattern, Vertex, match
from opslake.plans.reduced_match import match_reduced, reduce_graph
from test_factored import hot_graph


@pytest.fixture(scope="module")
def random_graph(spark):
    rng = random.Random(12)
    a = [(i, rng.randrange(5)) for i in range(60)]
    b = [(f"b{i}", rng.choice([None, 0, 1, 2])) for i in range(40)]
    ab = [(f"x{i}", rng.randrange(70), f"b{rng.randrange(45)}") for i in range(150)] + [("n1", None, "b1"), ("n2", 3, None)]
    aa = [(f"y{i}", rng.randrange(70), rng.choice([7] * 5 + list(range(70)))) for i in range(200)]
    df = spark.createDataFrame
    return GraphSpec(
        (Vertex("A", "A", df(a, "id int, p int"), "id", ("p",)), Vertex("B", "B", df(b, "id string, q int"), "id", ("q",))),
        (Edge("AB", "AB", df(ab, "k string, a int, b string"), "A", "a", "B", "b", key="k"), Edge("AA", "AA", df(aa, "k string, x int, y int"), "A", "x", "A", "y", key="k", hub=True)),
    )


PATTERNS = [
    Pattern(("u", "A"), (Hop("e", "AA", "v", "A"), Hop("f", "AB", "w", "B")), {"w": lambda p: p("q") == 1}),
    Pattern(("u", "A"), (Hop("e", "AA", "v", "A"), Hop("f", "AA", "w", "A", back=True), Hop("g", "AA", "t", "A")), {"u": lambda p: p("p") == 1, "t": lambda p: p("p") > 2}, (("u", "w"),)),
    Pattern(("w", "B"), (Hop("f", "AB", "v", "A", back=True), Hop("e", "AA", "u", "A")), {"v": lambda p: p("p").isin(0, 1)}),
    Pattern(("u", "A"), (), {"u": lambda p: p("p") == 4}),
]


@pytest.mark.parametrize("trusted", [True, False])
@pytest.mark.parametrize("pattern", PATTERNS)
def test_same_bag(spark, random_graph, rows, pattern, trusted):
    names = [pattern.start[0], *(h.vertex_var for h in pattern.hops)]
    columns = lambda p: {n: p(n, "id") for n in names} | {h.edge_var: p(h.edge_var, "k") for h in pattern.hops}
    want = rows(match(random_graph, pattern, columns, trusted=trusted))
    assert rows(match_reduced(random_graph, pattern, columns, trusted=trusted)) == want and want
    some = spark.createDataFrame([(1,), (7,), (7,), (9,)], "id int") if pattern.start[1] == "A" else ["b1", "b2"]
    if trusted and pattern.start[1] == "A" and pattern.hops:
        some = random_graph.vertex("A").df.select("id").where("id < 30")  # a trusted start is a vertex
        want = rows(match(random_graph, pattern, columns, some, trusted))
        assert rows(match_reduced(random_graph, pattern, columns, some, trusted)) == want
    elif not trusted:
        assert rows(match_reduced(random_graph, pattern, columns, some, trusted)) == rows(match(random_graph, pattern, columns, some, trusted))


def test_every_edge_left_stands_in_a_match(random_graph):
    for pattern in PATTERNS[:3]:
        pattern = Pattern(pattern.start, pattern.hops, pattern.where)  # without pairs that must differ
        r = reduce_graph(random_graph, pattern, trusted=False)
        answer = match(random_graph, pattern, lambda p: {h.edge_var: p(h.edge_var, "k") for h in pattern.hops}, trusted=False).cache()
        for hop in pattern.hops:
            left = {x.k for x in r.graph.edge(f"{hop.edge}.{hop.edge_var}").df.select("k").collect()}
            assert left == {x[0] for x in answer.select(hop.edge_var).collect()}
        answer.unpersist()


def test_questions_of_the_graph(spark, rows):
    graph = hot_graph(spark, 120)
    columns = lambda p: {"i": p("i", "incident_id"), "t": p("t", "task_id"), "s": p("s", "stage_name")}
    assert rows(match_reduced(graph, kg.OPEN_TASKS, columns)) == rows(match(graph, kg.OPEN_TASKS, columns))
    columns = lambda p: {"i": p("i", "incident_id"), "a": p("e1", "equipment_id"), "r": p("e2", "equipment_id"), "s": p("s", "stage_name")}
    want = rows(match(graph, kg.IMPACT, columns))
    assert rows(match_reduced(graph, kg.IMPACT, columns)) == want and len(want) > 100
