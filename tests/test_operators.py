import datetime as dt
import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opslake.operators import aggregates, joins, ranking, series, sets

T0 = dt.datetime(2026, 8, 7, 23, 50)


def test_flag_exists_keeps_rows(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (1, "y")], "id int, v string")
    b = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    got = rows(joins.flag_exists(a, b, F.col("id"), "k", "hit"))
    assert got == sorted([(1, "x", 1), (2, "x", 0), (3, None, 0), (1, "y", 1)], key=repr)


def test_overlay_prefers_patch(spark, rows):
    master = spark.createDataFrame([("a", "L1"), ("b", "L2"), ("c", None)], "id string, lot string")
    patch = spark.createDataFrame([("b", "P", "T"), ("z", "P", "T")], "id string, lot string, t string")
    got = rows(joins.overlay(master, patch, "id", "lot", {"src": F.col("t")}, {"src": F.lit("M")}))
    assert got == [("a", "L1", "M"), ("b", "P", "T"), ("c", None, "M")]


def test_dangling_and_unresolved(spark, rows):
    edges = spark.createDataFrame([(1, 1), (1, 9), (9, 1), (9, 9), (None, 1), (1, 1)], "s int, t int")
    nodes = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    lost = joins.dangling(edges, [("s", nodes, "id"), ("t", nodes, "id")])
    assert rows(lost) == sorted([(1, 9), (9, 1), (9, 9), (None, 1)], key=repr)
    assert rows(joins.unresolved(edges, "s", nodes, "id"), "s") == [(9,), (9,)]


def test_with_parent(spark, rows):
    t = spark.createDataFrame([("A", "", "base"), ("B", "A", "addon"), ("C", None, "base"), ("D", "Q", "x")], "id string, parent string, kind string")
    got = rows(joins.with_parent(t, "id", "parent", {"base_kind": "kind"}), "id", "base_kind")
    assert got == [("A", "base"), ("B", "base"), ("C", "base"), ("D", None)]


def test_salted_join_equals_plain_join_on_a_hot_key(spark, rows):
    rng = random.Random(5)
    left = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}") for i in range(60)] + [(99, None)]
    right = [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(600)] + [(7, "hot"), (7, "hot"), (8, None)]
    a = spark.createDataFrame(left, "l int, lk string")
    b = spark.createDataFrame(right, "r int, rk string")
    salted = joins.salted_join(a, b, "lk", "rk", share=0.05, salts=8)
    assert rows(salted) == rows(a.join(b, F.col("lk") == F.col("rk")))
    hot = joins.hot_keys(b, "rk", 0.05)
    assert rows(hot) == [("hot",)]


def test_symmetric_difference(spark, rows):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "i int, s string")
    assert rows(sets.symmetric_difference(a, b, "side", "A", "B")) == [("A", 1, None), ("B", 3, "y")]


def test_offending_keys_and_battery(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "k int, v string")
    assert rows(aggregates.offending_keys(df, ["k"])) == [(1, 2), (None, 1)]
    got = aggregates.count_battery(df, {"one": F.col("k") == 1, "none": F.col("k") > 9}).first()
    assert tuple(got) == (2, 0)


def test_failure_rate_counts_null_as_failure(spark, rows):
    df = spark.createDataFrame([("g", "SUCCESS"), ("g", "X"), ("g", None), ("h", "SUCCESS")], "gate string, r string")
    assert rows(aggregates.failure_rate(df, ["gate"], "r", "SUCCESS")) == [("g", 3, 2, 66.7), ("h", 1, 0, 0.0)]


@pytest.mark.parametrize("partitions", [2, 4, 8, 20])
def test_json_pages_do_not_depend_on_partitions(spark, partitions):
    """Every page but a key's last is full, and holds the same members for any number of partitions."""
    data = [("hot", i * 7 % 5001, i) for i in range(5000)] + [(f"k{i % 9}", i, i) for i in range(90)] + [(None, 1, 1), (None, 0, 2)]
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        pages = aggregates.json_pages(df, "k", [F.col("o")], F.to_json(F.struct("o", "v"))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by_key = {}
    for p in sorted(pages, key=lambda p: (str(p["k"]), p["page_no"])):
        assert p["members"] == len(json.loads(p["json"]))
        by_key.setdefault(p["k"], []).append(p)
    assert [p["members"] for p in by_key["hot"]] == [1000] * 5 and len(by_key) == 11
    for key, ps in by_key.items():
        assert [p["page_no"] for p in ps] == list(range(len(ps)))
        got = [(m["o"], m["v"]) for p in ps for m in json.loads(p["json"])]
        assert got == sorted((o, v) for k, o, v in data if k == key)


def test_top_k_per_group_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 9), ("b", 1, 1)], "g string, id int, v int")
    got = rows(ranking.top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 2), "g", "id", "rank")
    assert got == [("a", 1, 2), ("a", 3, 1), ("b", 1, 1)]


def brute_runs(points, min_seconds):
    out, run = [], []
    for ts, _, on in sorted(points, key=lambda p: p[:2]) + [(None, None, False)]:
        if on:
            run.append(ts)
        elif run:
            if (run[-1] - run[0]).total_seconds() >= min_seconds:
                out.append((run[0], run[-1], len(run)))
            run = []
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 200), st.sampled_from([True, True, False, None])), min_size=1, max_size=60), st.sampled_from([0, 1800]))
def test_sustained_matches_brute_force(spark, rows, readings, min_seconds):
    """Runs cross several chunk borders; equal times are ordered by id."""
    points = [(T0 + dt.timedelta(minutes=10 * m), i, on) for i, (m, on) in enumerate(readings)]
    df = spark.createDataFrame([("k", *p) for p in points], "k string, ts timestamp_ntz, id int, flag boolean")
    got = series.sustained(df, ["k"], "ts", "id", F.col("flag"), min_seconds, chunk="hour", chunk_rows=min_seconds or 2)
    assert rows(got, "start_ts", "end_ts", "readings") == sorted(brute_runs(points, min_seconds), key=repr)


def test_carry_forward_matches_brute_force(spark, rows):
    rng = random.Random(8)
    points = [(T0 + dt.timedelta(minutes=7 * i), i, rng.choice([None, None, None, "a", "b"])) for i in range(120)]
    df = spark.createDataFrame([("k", *p) for p in points], "k string, ts timestamp_ntz, id int, v string")
    got = series.carry_forward(df, ["k"], "ts", "id", {"last_v": F.col("v")}, chunk="hour")
    want, last = [], None
    for ts, i, v in points:
        last = v if v is not None else last
        want.append((i, last))
    assert rows(got, "id", "last_v") == sorted(want, key=repr)


def test_one_busy_hour_of_one_key_is_cut_by_rows(spark, rows):
    rng = random.Random(3)
    points = [(T0 + dt.timedelta(seconds=i // 3), i, rng.choice([None, None, "a", "b"])) for i in range(900)]
    df = spark.createDataFrame([(None, *p) for p in points], "k string, ts timestamp_ntz, id int, v string")
    got = series.carry_forward(df, ["k"], "ts", "id", {"last_v": F.col("v")}, chunk_rows=50)
    want, last = [], None
    for _, i, v in points:
        last = v if v is not None else last
        want.append((i, last))
    assert rows(got, "id", "last_v") == sorted(want, key=repr)
    parts = series._with_chunk(df, ["k"], F.col("ts"), "hour", 50).groupBy("_chunk").count()
    assert parts.count() >= 18 and parts.agg(F.max("count")).first()[0] <= 52
    runs = series.sustained(df, ["k"], "ts", "id", F.col("v") == "a", 1, chunk_rows=50)
    assert rows(runs, "start_ts", "end_ts", "readings") == sorted(brute_runs([(t, i, v == "a") for t, i, v in points], 1), key=repr)


def test_running_grid_marks(spark, rows):
    stock = spark.createDataFrame([("p", "2026-08-08", 5), ("q", "2026-08-08", 5)], "product_id string, festival_date string, initial_stock long")
    at = lambda h, m, s=0: dt.datetime(2026, 8, 8, h, m, s)
    sales = spark.createDataFrame(
        [("p", "2026-08-08", at(9, 0), 1), ("p", "2026-08-08", at(10, 30), 2), ("p", "2026-08-08", at(10, 30, 1), 4),
         ("p", "2026-08-08", at(11, 0, 1), 8), ("x", "2026-08-08", at(10, 0), 9)],
        "product_id string, festival_date string, sale_ts timestamp_ntz, quantity long")
    start = F.to_timestamp_ntz(F.concat(F.col("festival_date"), F.lit(" 10:00:00")))
    grid = series.running_grid(stock, sales, ["product_id", "festival_date"], start, "sale_ts", "quantity", 30, 3)
    assert rows(grid, "product_id", "mark_no", "sold") == [
        ("p", 0, 1), ("p", 1, 3), ("p", 2, 7), ("q", 0, 0), ("q", 1, 0), ("q", 2, 0)]
    assert rows(grid.where("product_id = 'q'"), "mark_ts")[-1] == (at(11, 0),)


def test_short_series_are_one_chunk(spark, rows, monkeypatch):
    t0 = dt.datetime(2024, 1, 1)
    data = [(k, t0 + dt.timedelta(minutes=7 * i), i, i % 4 != 3) for k, n in (("short", 30), (None, 30), ("long", 60)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id long, flag boolean")
    monkeypatch.setattr(series, "KEY_ROWS", 40)
    parts = series._with_chunk(df, ["k"], F.col("ts"), "hour", 100).select("k", "_cut", "_chunk").distinct().groupBy("k", "_cut").count()
    assert rows(parts) == [("long", True, 7), ("short", False, 1), (None, False, 1)]
    got = series.sustained(df, ["k"], "ts", "id", F.col("flag"), 1)
    assert rows(got.groupBy("k").agg(F.count("*"), F.sum("readings"))) == [("long", 15, 45), ("short", 8, 23), (None, 8, 23)]
    carried = series.carry_forward(df, ["k"], "ts", "id", {"_x": F.when(~F.col("flag"), F.col("id"))})
    assert all(x == (i - 3) // 4 * 4 + 3 if i >= 3 else x is None for i, x in carried.select("id", "_x").collect())
    assert set(carried.columns) == {"k", "ts", "id", "flag", "_x"}
