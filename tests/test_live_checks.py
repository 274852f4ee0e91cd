"""Checks kept up to date against checks of the whole graph."""

import random

import pytest

from opslake.plans.graph import Edge, GraphSpec, Vertex, endpoint_errors, key_errors
from opslake.plans.live_checks import LiveChecks, delta_of

DDL = {"A": "id string", "B": "id int", "AB": "id string, a string, b int", "AA": "id string, x string, y string"}


def spec(spark, tables):
    frames = {n: spark.createDataFrame(rows, DDL[n]) for n, rows in tables.items()}
    return GraphSpec(
        (Vertex("A", "A", frames["A"], "id", ()), Vertex("B", "B", frames["B"], "id", ())),
        (Edge("AB", "AB", frames["AB"], "A", "a", "B", "b", key="id"), Edge("AA", "AA", frames["AA"], "A", "x", "A", "y", key="id")),
    )


def agree(live, graph, rows):
    assert rows(live.key_errors()) == rows(key_errors(graph))
    assert rows(live.endpoint_errors()) == rows(endpoint_errors(graph))


def row_of(rng, name):
    a, b = lambda: rng.choice([f"a{rng.randrange(8)}", None]) if rng.random() < 0.2 else f"a{rng.randrange(8)}", lambda: rng.choice([rng.randrange(8)] * 7 + [None])
    return {"A": lambda: (a(),), "B": lambda: (b(),), "AB": lambda: (f"e{rng.randrange(30)}", a(), b()), "AA": lambda: (f"f{rng.randrange(30)}", a(), a())}[name]()


def test_fifty_random_changes_equal_full_checks(spark, rows, tmp_path):
    rng = random.Random(6)
    tables = {n: [row_of(rng, n) for _ in range(12)] for n in DDL}
    live = LiveChecks.start(spec(spark, tables), str(tmp_path / "s"), buckets=16)
    agree(live, spec(spark, tables), rows)
    for _ in range(5):
        new, old = {n: [] for n in DDL}, {n: [] for n in DDL}
        for _ in range(10):
            n = rng.choice(list(DDL))
            if tables[n] and rng.random() < 0.5:
                row = tables[n].pop(rng.randrange(len(tables[n])))
                old[n].append(row)
            else:
                row = row_of(rng, n)
                tables[n].append(row)
                new[n].append(row)
        frames = lambda x: {n: spark.createDataFrame(r, DDL[n]) for n, r in x.items() if r}
        graph = spec(spark, tables)
        live = live.apply(delta_of(graph, frames(new), frames(old)))
        agree(live, graph, rows)
    assert live.version == 5
    agree(LiveChecks.open(spark, str(tmp_path / "s"), 5), graph, rows)


def test_only_touched_buckets_are_read_and_written(spark, rows, tmp_path):
    tables = {"A": [(f"a{i}",) for i in range(3000)], "B": [(i,) for i in range(50)], "AB": [(f"e{i}", f"a{i}", i % 60) for i in range(3000)], "AA": []}
    graph = spec(spark, tables)
    live = LiveChecks.start(graph, str(tmp_path / "s"), buckets=64)
    agree(live, graph, rows)
    after = live.apply(delta_of(graph, {"B": spark.createDataFrame([(55,)], DDL["B"])}, {"A": spark.createDataFrame([("a7",)], DDL["A"])}))
    moved = lambda t: sum(v == 1 for v in after._files[t].values())
    assert moved("keys") <= 2 and moved("ends") <= 2 and len(after._files["keys"]) > 60
    read = after._read("ends", "vertex string, key string, edge string, source_vertex string, source string, target_vertex string, target string, n long, bucket int", {3})
    assert 0 < len(read.inputFiles()) <= 2
    tables["A"] = [r for r in tables["A"] if r != ("a7",)]
    tables["B"].append((55,))
    agree(after, spec(spark, tables), rows)
    agree(live, graph, rows)  # the version before stays


def test_wrong_changes_are_refused(spark, tmp_path):
    tables = {"A": [("a",)], "B": [(1,)], "AB": [("e", "a", 1)], "AA": []}
    graph = spec(spark, tables)
    live = LiveChecks.start(graph, str(tmp_path / "s"), buckets=4)
    with pytest.raises(ValueError):
        live.apply(delta_of(graph, deleted={"A": spark.createDataFrame([("b",)], DDL["A"])}))
    with pytest.raises(ValueError):
        delta_of(graph)


def test_the_first_version_counts_no_row_twice(spark, rows, tmp_path):
    tables = {"A": [("a1",), ("a1",), (None,)], "B": [(1,)], "AB": [("e", "a1", 1), ("e", "a1", 1), ("f", "a2", None)], "AA": [("g", None, "a3")]}
    graph = spec(spark, tables)
    live = LiveChecks.start(graph, str(tmp_path / "s"), buckets=4)
    agree(live, graph, rows)
    assert not {p.name for p in (tmp_path / "s" / "v0" / "work").iterdir()} & {"counted-keys", "counted-ends"}


def test_keys_are_grouped_by_the_number_of_their_element(spark, rows):
    import io
    from contextlib import redirect_stdout

    found = key_errors(spec(spark, {"A": [("1",), ("1",)], "B": [(1,), (2,)], "AB": [(None, "1", 1), ("e", "1", 1)], "AA": []}))
    assert rows(found) == [("EDGE", "AB", 1), ("VERTEX", "A", 1)] and found.columns == ["element_kind", "element_name", "error_count"]
    with redirect_stdout(io.StringIO()) as plan:
        found.explain()
    dealt = [line for line in plan.getvalue().splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("element_name" in line for line in dealt)


def test_a_change_writes_its_own_rows_only(spark, rows, tmp_path):
    tables = {"A": [(f"a{i}",) for i in range(3000)], "B": [(i,) for i in range(50)], "AB": [(f"e{i}", f"a{i}", i % 60) for i in range(3000)], "AA": [("f", "a1", "a1"), ("g", "a2", "x")]}
    live = LiveChecks.start(spec(spark, tables), str(tmp_path / "s"), buckets=4)  # each bucket holds some 750 pairs of AB
    new = {"B": [(55,)], "AB": [("h", "a1", 56)], "AA": [("k", "x", "x")]}
    old = {"A": [("a1",), ("a7",)], "AB": [("e9", "a9", 9)]}
    for name, more in new.items():
        tables[name] = tables[name] + more
    for name, gone in old.items():
        tables[name] = [r for r in tables[name] if r not in gone]
    graph, frames = spec(spark, tables), lambda x: {n: spark.createDataFrame(r, DDL[n]) for n, r in x.items()}
    live = live.apply(delta_of(graph, frames(new), frames(old)))
    agree(live, graph, rows)
    agree(LiveChecks.open(spark, str(tmp_path / "s"), 1), graph, rows)
    kept = {t: spark.read.parquet(str(tmp_path / "s" / "v1" / t)).count() for t in ("keys", "ends")}
    assert kept == {"keys": 6, "ends": 6}


def test_long_buckets_are_written_anew(spark, rows, tmp_path, monkeypatch):
    from opslake.plans import live_checks

    monkeypatch.setattr(live_checks, "MERGE", 2)
    rng = random.Random(8)
    tables = {n: [row_of(rng, n) for _ in range(15)] for n in DDL}
    live = LiveChecks.start(spec(spark, tables), str(tmp_path / "s"), buckets=2)
    for step in range(4):
        old = {n: rng.sample(tables[n], min(len(tables[n]), 8 if step == 2 else 4)) for n in DDL}
        new = {n: [row_of(rng, n) for _ in range(4)] for n in DDL}
        for n in DDL:
            for r in old[n]:
                tables[n].remove(r)
            tables[n] += new[n]
        frames = lambda x: {n: spark.createDataFrame(r, DDL[n]) for n, r in x.items() if r}
        graph = spec(spark, tables)
        live = LiveChecks.open(spark, str(tmp_path / "s"), step) if step == 3 else live
        live = live.apply(delta_of(graph, frames(new), frames(old)))
        agree(live, graph, rows)
    assert max(len(v) for t in live._files.values() for v in t.values()) <= 2 and live._files["keys"][0][0] > 0


def test_a_later_graph_may_number_its_elements_otherwise(spark, rows, tmp_path):
    tables = {"A": [("a",)], "B": [(1,)], "AB": [("e", "a", 1)], "AA": [("f", "a", "b")]}
    whole = spec(spark, tables)
    part = GraphSpec(whole.vertices[1:], ())
    live = LiveChecks.start(part, str(tmp_path / "s"), buckets=4)
    live = live.apply(delta_of(whole, {n: spark.createDataFrame(r, DDL[n]) for n, r in tables.items() if n != "B"}))
    agree(live, whole, rows)
    turned = GraphSpec(whole.vertices, (whole.edges[0], Edge("AA", "AA", whole.edges[1].df, "A", "x", "B", "y", key="id")))
    with pytest.raises(ValueError):
        live.apply(delta_of(turned, {"AA": whole.edges[1].df}))


def test_the_first_version_writes_each_side_where_it_is_looked_up(spark, rows, tmp_path):
    tables = {"A": [("a1",), ("a2",)], "B": [(1,)], "AB": [("e", "a1", 1), ("f", "a1", 1), ("g", None, 1)], "AA": [("h", "a1", "a1"), ("i", "a2", "z")]}
    graph = spec(spark, tables)
    live = LiveChecks.start(graph, str(tmp_path / "s"), buckets=4)
    agree(live, graph, rows)
    assert {p.name for p in (tmp_path / "s" / "v0" / "work").iterdir()} == {"rows"}
    ends = spark.read.parquet(str(tmp_path / "s" / "v0" / "ends")).groupBy("at_source").agg({"*": "count", "n": "sum"})
    assert rows(ends.select("at_source", "count(1)", "sum(n)")) == [(False, 4, 5), (True, 4, 5)]
    assert rows(LiveChecks.start(GraphSpec(graph.vertices, ()), str(tmp_path / "t"), buckets=4).endpoint_errors()) == []


def test_checks_need_keys_and_ends_alone(spark, rows, tmp_path):
    from opslake.plans import kg
    from test_graph import make_sources

    sources = make_sources(spark)
    whole = kg.build_graph(sources)
    nodes = kg.Nodes(sources).saved(spark, str(tmp_path / "nodes"), kg.Nodes.LINKS)
    narrow = kg.build_graph(sources, nodes).without_properties()
    assert nodes.tasks.columns == ["task_id", "incident_id"] and sorted(p.name for p in (tmp_path / "nodes").iterdir()) == ["incidents", "tasks"]
    for a, b in zip((*whole.vertices, *whole.edges), (*narrow.vertices, *narrow.edges), strict=True):
        assert rows(a.df, *b.columns) == rows(b.df, *b.columns)
    agree(LiveChecks.start(narrow, str(tmp_path / "s"), buckets=4), whole, rows)


def test_few_tasks_write_to_a_bucket(spark, rows, tmp_path, monkeypatch):
    from opslake.plans import live_checks

    monkeypatch.setattr(live_checks, "TASKS", 2)
    tables = {"A": [(f"a{i}",) for i in range(300)], "B": [(i,) for i in range(50)], "AB": [(f"e{i}", f"a{i}", i % 60) for i in range(300)], "AA": [("f", "a1", "z")]}
    graph = spec(spark, tables)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        live = LiveChecks.start(graph, str(tmp_path / "s"), buckets=4)
        live = live.apply(delta_of(graph, {"AA": spark.createDataFrame([("g", "z", "z")], DDL["AA"])}))
        tables["AA"] = tables["AA"] + [("g", "z", "z")]
        agree(live, spec(spark, tables), rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = lambda t: max(len(list(b.glob("part-*"))) for b in (tmp_path / "s" / "v0" / t).glob("bucket=*"))
    assert files("keys") <= 2 and files("ends") <= 4  # both sides of the pairs
