import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opslake.plans import changes, metrics, quality, retrieval, rules, runbook, views
from opslake.streaming import live_gate_windows, live_sensor_states

DAY = "2026-08-09"


def ts(h, m=0, s=0, d=9):
    return dt.datetime(2026, 8, d, h, m, s)


# --- views and metrics ----------------------------------------------------


def test_stage_delay_keeps_unknown_stage(spark, rows):
    schedule = spark.createDataFrame([("P1", DAY, "S1", "x", "t"), ("P2", DAY, "S?", "y", "t"), ("P3", DAY, "S1", "z", "t")],
                                     "performance_id string, festival_date string, stage_id string, artist_name string, planned_start_ts string")
    actual = spark.createDataFrame([("P1", "t", 29, "COMPLETED", "I"), ("P2", "t", 3, "ENDED_EARLY", None), ("P2", None, 0, "CANCELED", "I")],
                                   "performance_id string, actual_start_ts string, delay_minutes bigint, status string, incident_id string")
    stages = spark.createDataFrame([("S1", "One")], "stage_id string, stage_name string")
    delays = views.stage_delay(schedule, actual, stages)
    assert rows(delays, "performance_id", "stage_name", "delay_minutes") == [("P1", "One", 29), ("P2", None, 0), ("P2", None, 3)]
    assert rows(metrics.delay_metrics(delays)) == [(DAY, "S1", 29, 29.0, 1), (DAY, "S?", 3, 1.5, 1)]
    assert rows(metrics.max_delay_per_stage(delays)) == [("S1", "P1", 29), ("S?", "P2", 3)]
    assert metrics.max_delay_per_stage(delays, 1).first()["stage_id"] == "S1"
    incidents = spark.createDataFrame([("I", "storm")], "incident_id string, title string")
    assert rows(metrics.cancelled_shows(delays, incidents, DAY), "performance_id", "status", "incident_title") == [
        ("P2", "CANCELED", "storm"), ("P2", "ENDED_EARLY", None)]
    assert rows(metrics.affected_artists(delays)) == [("I", "P1", "x"), ("I", "P2", "y")]


def test_equipment_health_and_states(spark, rows):
    raw = spark.createDataFrame(
        [("E", "temperature_c", 74.9994), ("E", "temperature_c", 75.0), ("E", "temperature_c", None), ("E", "packet_loss_pct", 5.0),
         ("E", "fan_rpm", 1000.0), ("E", "fan_rpm", 999.0), ("E", "audio_dropouts_count", 3.0), ("E", "other", 1e6)],
        "equipment_id string, metric_name string, metric_value double").withColumns({"festival_date": F.lit(DAY), "stage_id": F.lit("S")})
    sensors = rules.classify(raw)
    states = rows(sensors, "metric_name", "metric_value", "status")
    assert ("temperature_c", 74.9994, "NORMAL") in states and ("temperature_c", 75.0, "CRITICAL") in states
    assert ("fan_rpm", 1000.0, "NORMAL") in states and ("audio_dropouts_count", 3.0, "WARNING") in states
    assert ("temperature_c", None, "NORMAL") in states
    health = {r["metric_name"]: r for r in views.equipment_health(sensors).collect()}
    t = health["temperature_c"]
    assert (t["avg_metric_value"], t["min_metric_value"], t["max_metric_value"], t["abnormal_event_count"]) == (75.0, 74.999, 75.0, 1)
    assert rules.classify(raw, [("temperature_c", ">=", 80.0, "CRITICAL")]).where("status <> 'NORMAL'").count() == 0
    assert rows(metrics.switch_metrics(raw)) == [(DAY, "E", 75.0, 5.0, 999)]


def test_gate_metrics_window_is_closed(spark, rows):
    scans = spark.createDataFrame(
        [("G", ts(10, 18), "SUCCESS", 10), ("G", ts(10, 51), "QR_TIMEOUT", 40), ("G", ts(10, 51, 1), "QR_TIMEOUT", 99),
         ("G", ts(10, 17, 59), "SUCCESS", 99), ("G", ts(10, 30), "QR_TIMEOUT", 30), ("H", ts(10, 30), "SUCCESS", 5)],
        "gate_id string, event_ts timestamp_ntz, result_code string, queue_estimate_minutes bigint")
    assert rows(metrics.gate_metrics(scans, ts(10, 18), ts(10, 51))) == [("G", 3, 2, 66.7, 26.7), ("H", 1, 0, 0.0, 5.0)]
    assert rules.failed_scans(scans).count() == 3


def test_small_metrics(spark, rows):
    upkeep = spark.createDataFrame([("E", "2026-07-25", "OVERDUE"), ("F", "2026-07-01", "COMPLETED")], "equipment_id string, scheduled_date string, status string")
    assert rows(metrics.overdue_days(upkeep, "2026-08-08"), "equipment_id", "overdue_days") == [("E", 14)]
    actions = spark.createDataFrame([("I", ts(10, 20), "THRESHOLD"), ("I", ts(10, 36), "FAILOVER"), ("I", ts(10, 40), "FAILOVER"), ("J", ts(1), "THRESHOLD")],
                                    "incident_id string, event_ts timestamp_ntz, action_type string")
    assert rows(metrics.failover_minutes(actions), "incident_id", "failover_minutes") == [("I", 16), ("J", None)]
    weather = spark.createDataFrame([(DAY, ts(17, 45), 10.1, 14.9), (DAY, ts(18), 10.0, 3.0), (DAY, ts(18, 15), 99.0, 15.0)],
                                    "festival_date string, observed_ts timestamp_ntz, lightning_distance_km double, wind_gust_mps double")
    assert rows(metrics.first_threshold(weather)) == [(DAY, ts(18), 2)]
    signals = spark.createDataFrame([("p", 310), ("p", 240), ("p", 140), ("q", 1)], "product_id string, predicted_units bigint")
    plan = spark.createDataFrame([("p", DAY, 690), ("q", DAY, 2)], "product_id string, festival_date string, interest_adjusted_forecast_units bigint")
    assert rows(metrics.signal_forecast(signals, plan), "product_id", "signal_units", "matches_forecast") == [("p", 690, 1), ("q", 1, 0)]
    feedback = spark.createDataFrame([("A", "NEGATIVE"), ("A", "POSITIVE"), ("B", "NEGATIVE")], "topic string, sentiment string")
    assert metrics.feedback_count(feedback, "A").first()[0] == 2
    assert metrics.feedback_count(feedback, "A", "NEGATIVE").first()[0] == 1


# --- stock ----------------------------------------------------------------


def test_stock(spark, rows):
    products = spark.createDataFrame([("p", "P", 100, 420), ("q", "Q", 9, 8), ("r", "R", 200, 0)],
                                     "product_id string, product_name string, initial_stock_day1 bigint, initial_stock_day2 bigint")
    stock = rules.initial_stock(products, {"initial_stock_day1": "2026-08-07", "initial_stock_day2": "2026-08-08"})
    sales = spark.createDataFrame(
        [("p", "2026-08-07", ts(10, 0, d=7), 90), ("p", "2026-08-07", ts(10, 31, d=7), 30), ("r", "2026-08-07", ts(10, 0, d=7), 179), ("r", "2026-08-07", ts(10, 30, d=7), 1)],
        "product_id string, festival_date string, sale_ts timestamp_ntz, quantity bigint")
    start = F.to_timestamp_ntz(F.concat(F.col("festival_date"), F.lit(" 10:00:00")))
    snaps = rules.inventory_snapshots(stock, sales, start, marks=3)
    got = rows(snaps.where("festival_date = '2026-08-07'"), "product_id", "snapshot_ts", "units_sold", "on_hand_units", "stock_status")
    at = [ts(10, 0, d=7), ts(10, 30, d=7), ts(11, 0, d=7)]
    assert got == sorted([
        ("p", at[0], 90, 10, "LOW"), ("p", at[1], 90, 10, "LOW"), ("p", at[2], 100, 0, "OUT_OF_STOCK"),  # oversold stays at 0
        ("q", at[0], 0, 9, "LOW"), ("q", at[1], 0, 9, "LOW"), ("q", at[2], 0, 9, "LOW"),
        ("r", at[0], 179, 21, "NORMAL"), ("r", at[1], 180, 20, "LOW"), ("r", at[2], 180, 20, "LOW")], key=repr)
    plan = spark.createDataFrame([("p", "2026-08-07", 80, 400, 100), ("q", "2026-08-07", 9, 9, 9)],
                                 "product_id string, festival_date string, baseline_forecast_units bigint, interest_adjusted_forecast_units bigint, planned_stock_units bigint")
    shipped = views.stockout(products, plan, sales)
    assert rows(shipped, "product_id", "stockout_ts", "units_sold") == [("p", ts(10, 31, d=7), 120), ("q", None, None)]
    assert rows(metrics.stockout_metrics(shipped), "product_id", "plan_gap_pct") == [("p", 75.0), ("q", 0.0)]
    zero = views.stockout_from_snapshots(products, plan, snaps)
    assert rows(zero, "product_id", "first_zero_stock_ts", "units_sold") == [("p", at[2], 100), ("q", None, 0)]


# --- refunds --------------------------------------------------------------

WX = "WEATHER_CANCELLATION"


@pytest.fixture(scope="module")
def refunds(spark):
    tickets = spark.createDataFrame(
        [("A", None, "DAY3", 19000), ("B", "", "VIP_THREE_DAY", 73000), ("C", "", "THREE_DAY", 39000), ("D", "A", "MG_PREMIUM", 8000),
         ("E", None, "DAY3", 19000), ("F", None, "DAY3", 19000), ("G", None, "DAY2", 18000), ("H", None, "DAY3", 19000)],
        "ticket_id string, parent_ticket_id string, ticket_type_id string, amount_jpy bigint")
    reasons = {"H": "PERSONAL_REASON"}
    requests = tickets.select(
        F.concat(F.lit("R"), "ticket_id").alias("request_id"), "ticket_id", "parent_ticket_id", F.lit("x").alias("attendee_id"),
        F.when(F.col("ticket_id") == "H", reasons["H"]).otherwise(WX).alias("reason_code"), F.lit(1).cast("bigint").alias("requested_amount_jpy"))
    scans = spark.createDataFrame(
        [("A", DAY, "QR_TIMEOUT", ts(11)), ("A", DAY, "SUCCESS", ts(12)), ("B", DAY, "SUCCESS", ts(18, 7, 59)), ("C", DAY, "SUCCESS", ts(9)),
         ("E", DAY, "SUCCESS", ts(18, 8)), ("F", "2026-08-08", "SUCCESS", ts(9, d=8)), ("F", DAY, "QR_TIMEOUT", ts(9)), ("G", DAY, "SUCCESS", ts(9)),
         ("H", DAY, "SUCCESS", ts(9))],
        "ticket_id string, festival_date string, result_code string, event_ts timestamp_ntz")
    return requests, tickets, scans


def test_refund_context_flag(refunds, rows):
    got = dict(rows(views.refund_context(*refunds, DAY), "request_id", "day3_admitted_flag"))
    assert got == {"RA": 1, "RB": 1, "RC": 1, "RD": 1, "RE": 1, "RF": 0, "RG": 1, "RH": 1}  # the add-on counts by its parent


def test_refund_decisions(refunds, rows):
    decided = rules.refund_decisions(*refunds, DAY, ts(18, 8))
    got = {r[0]: r[1:] for r in rows(decided, "request_id", "decision", "refund_amount_jpy")}
    assert got == {
        "RA": ("APPROVED", 2800), "RB": ("APPROVED", 3600), "RC": ("APPROVED", 2000), "RD": ("APPROVED", 8000),
        "RE": ("DENIED", 0), "RF": ("MANUAL_REVIEW", 0), "RG": ("DENIED", 0), "RH": ("DENIED", 0)}
    assert rows(metrics.refund_totals(decided)) == [("APPROVED", 4, 16400), ("DENIED", 3, 0), ("MANUAL_REVIEW", 1, 0)]
    assert rows(metrics.refunds_by_type(views.refund_context(*refunds, DAY)))[0] == ("DAY2", 1, 1, 1)


def test_valid_dates(spark, rows):
    types = spark.createDataFrame([("T3", "d1|d2|d3"), ("T1", "d1"), ("ADD", "")], "ticket_type_id string, valid_days string")
    tickets = spark.createDataFrame([("a", "T3"), ("b", "T1"), ("c", "ADD")], "ticket_id string, ticket_type_id string")
    assert rows(rules.valid_dates(tickets, types)) == [("a", "d1"), ("a", "d2"), ("a", "d3"), ("b", "d1")]


# --- changes --------------------------------------------------------------


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, keep string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    out = changes.upsert(target, source, ["id"], insert_defaults={"keep": F.lit("new")})
    assert rows(out) == [(1, "a", "x"), (2, "B", "y"), (3, "C", "new")]
    assert rows(changes.upsert(target, source, ["id"], update=[])) == sorted([(1, "a", "x"), (2, "b", "y"), (3, "C", None)], key=repr)
    assert rows(changes.upsert(target.limit(0), source, ["id"]), "id") == [(2,), (3,)]
    nulled = changes.upsert(target, spark.createDataFrame([(1, None)], "id int, v string"), ["id"])
    assert rows(nulled)[0] == (1, None, "x")
    for bad in ([(2, "B"), (2, "C")], [(None, "B")]):
        with pytest.raises(changes.ChangeError):
            changes.upsert(target, spark.createDataFrame(bad, "id int, v string"), ["id"])


def test_upsert_by_natural_key(spark, rows):
    ddl = "task_id bigint, incident_id string, task_title string, created_by_agent string, status string"
    tasks = spark.createDataFrame([(5, "I", "t1", "S", "CLOSED"), (9, "I", "t2", "U", "OPEN")], ddl)
    source = spark.createDataFrame([("I", "t1", "S", "OPEN"), ("I", "t2", "S", "OPEN")], "incident_id string, task_title string, created_by_agent string, status string")
    natural = ["incident_id", "task_title", "created_by_agent"]
    got = rows(changes.upsert_by_natural_key(tasks, source, natural))
    assert (5, "I", "t1", "S", "OPEN") in got and (9, "I", "t2", "U", "OPEN") in got and len(got) == 3
    assert [r for r in got if r[2:4] == ("t2", "S")][0][0] > 9
    twice = tasks.unionByName(tasks.where("task_id = 5").withColumn("task_id", F.lit(6).cast("bigint")))
    with pytest.raises(changes.ChangeError):
        changes.upsert_by_natural_key(twice, source, natural)


def test_insert_checked(spark, rows):
    ddl = ("task_id bigint, incident_id string, task_title string, task_description string, priority string, owner_team_id string, "
           "created_by_agent string, created_at timestamp, status string")
    tasks = spark.createDataFrame([(7, "I", "t", None, "LOW", None, None, None, "OPEN")], ddl)
    new = spark.createDataFrame([("I", "a", "high"), ("I", "b", "urgent"), (None, "c", "LOW"), ("I", "d", None)], "incident_id string, task_title string, priority string")
    table, rejects = changes.insert_checked(tasks, new)
    added = table.where("task_id > 7").orderBy("task_title").collect()
    assert [(r["task_title"], r["priority"], r["status"]) for r in added] == [("a", "HIGH", "OPEN"), ("d", None, "OPEN")]
    assert len({r["task_id"] for r in added}) == 2 and all(r["created_at"] for r in added)
    assert rows(rejects, "task_title", "reject_reason") == [("b", "-20001 Invalid priority"), ("c", "incident_id is NULL")]


def test_constraints_update_snapshot(spark, rows, tmp_path):
    patch = spark.createDataFrame([("E", None, "VERIFIED"), ("E", "L", "ODD"), ("F", "L", None)], "equipment_id string, manufacturing_lot string, assertion_status string")
    spec = changes.Constraints(("equipment_id",), ("manufacturing_lot",), changes.CONSTRAINTS["lot_patch"].checks)
    assert rows(changes.constraint_violations(patch, spec)) == [("check assertion_status", 1), ("key equipment_id", 1), ("not null manufacturing_lot", 1)]
    root = str(tmp_path / "snap")
    assert not changes.snapshot_exists(spark, root)
    first = changes.create_if_absent(patch, root)
    assert changes.create_if_absent(patch.limit(0), root).count() == 3
    with pytest.raises(changes.ChangeError):
        changes.apply_update(first, F.col("equipment_id") == "E", {"assertion_status": F.lit("VERIFIED")}, expected=1)
    fixed = changes.apply_update(first, F.col("assertion_status") == "ODD", {"assertion_status": F.lit("VERIFIED")}, expected=1)
    assert changes.write_snapshot(fixed, root) == 2
    assert rows(changes.read_snapshot(spark, root), "assertion_status") == sorted([("VERIFIED",), ("VERIFIED",), (None,)], key=repr)
    assert changes.read_snapshot(spark, root, 1).where("assertion_status = 'ODD'").count() == 1
    (tmp_path / "snap/version=000003").mkdir()  # an unfinished write is not seen
    assert changes.read_snapshot(spark, root).count() == 3
    with pytest.raises(changes.ChangeError):
        changes.read_snapshot(spark, root, 9)


# --- quality --------------------------------------------------------------


def test_expectations_and_mapping(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    got = rows(quality.expect_counts({"rows": (df, F.count(F.lit(1)), 3), "ids": (df, F.count_distinct("id"), 3), "none": (df.limit(0), F.max("id"), 1)}))
    assert got == sorted([("rows", 3, 3, True), ("ids", 2, 3, False), ("none", None, 1, False)], key=repr)
    other = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(quality.mapping_differences({"a": df, "b": other, "c": df}, "id")) == [(1, "a|c"), (3, "b")]
    assert rows(quality.violations(spark.createDataFrame([(1,), (None,), (5,)], "x int"), F.col("x") < 3)) == [(5,), (None,)]


# --- retrieval ------------------------------------------------------------


def brute_chunks(text, size, overlap):
    step = size - overlap
    return [(i + 1, p + 1, min(p + size, len(text)), text[p:p + size]) for i, p in enumerate(range(0, max(len(text) - overlap, 1), step))] if text else []


@pytest.mark.parametrize("size,overlap", [(1000, 140), (10, 0), (10, 3), (10, 9)])
def test_chunks_match_brute_force(spark, rows, size, overlap):
    texts = ["", None, "a", "x" * 999, "x" * 1000, "y" * 1001, "z\n" * 1500, "日本語𠮷テキスト😀" * 130, "ab" * 7]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = sorted(((i, *c) for i, t in enumerate(texts) for c in brute_chunks(t, size, overlap)), key=repr)
    assert rows(retrieval.chunk_text(docs, size=size, overlap=overlap)) == want
    with pytest.raises(ValueError):
        retrieval.chunk_text(docs, size=10, overlap=10)


def test_cosine_topk_matches_brute_force(spark, rows):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(300, 8)).round(3)
    data[50:60] = data[49]  # equal scores are settled by id
    data[7] = 0
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(900, None)], "vec_id bigint, embedding array<double>").repartition(5)
    queries = spark.createDataFrame([(i, [float(x) for x in data[i]]) for i in (0, 7, 49, 120, 200)], "query_id int, embedding array<double>")
    want = []
    for q in (0, 49, 120, 200):
        sims = {i: float(np.dot(data[q], v) / (np.linalg.norm(data[q]) * np.linalg.norm(v))) for i, v in enumerate(data) if np.any(v)}
        best = sorted(sims, key=lambda i: (-round(sims[i], 9), i))[:6]
        want += [(q, i, rank + 1) for rank, i in enumerate(best)]
    for block in (4096, 2):
        assert rows(retrieval.cosine_topk(vectors, queries, block=block), "query_id", "vec_id", "rank") == sorted(want, key=repr)
    assert retrieval.cosine_topk(vectors, queries.limit(0)).count() == 0


def test_coverage_terms_versions(spark, rows):
    chunk = lambda p: (f'{{"object_name": "{p}"}}',)
    chunks = spark.createDataFrame([chunk("docs/a.pdf"), chunk("docs/a.pdf"), chunk("b.pdf"), ("{}",)], "attributes string")
    catalog = spark.createDataFrame([("A", "1.0", "a_long.pdf")], "document_id string, version string, file_name string")
    expected = spark.createDataFrame([("A", "a.pdf"), ("C", "c.pdf")], "document_id string, file_name string")
    assert rows(retrieval.coverage(expected, catalog, chunks)) == [("A", "1.0", "a.pdf", "a_long.pdf", 2), ("C", None, "c.pdf", None, 0)]
    assert rows(retrieval.chunks_per_object(chunks)) == sorted([("b.pdf", 1), ("docs/a.pdf", 2), (None, 1)], key=repr)
    terms = spark.createDataFrame([("Gate C", "GATE-C|Riverside"), ("Term", ""), ("Gate A", "Riverside")], "term string, synonyms string")
    words = spark.createDataFrame([("GATE-C",), ("Riverside",), ("Gate C",), ("else",), (None,)], "w string")
    got = dict(rows(retrieval.canonical_term(words, "w", terms)))
    assert got == {"GATE-C": "Gate C", "Riverside": "Gate A", "Gate C": "Gate C", "else": "else", None: None}
    docs = spark.createDataFrame([("a1", "a", "1", "2026-06-01"), ("a2", "a", "2", "2026-07-01"), ("a3", "a", "3", "2026-09-01"), ("b", "b", "1", "2026-09-01")],
                                 "document_id string, family string, version string, effective_date string")
    assert rows(retrieval.version_at(docs, "family", "effective_date", "2026-08-08"), "document_id") == [("a2",)]
    assert rows(retrieval.narrow(docs, docs.where("family = 'b'").select("document_id"), "document_id"), "document_id") == [("b",)]


# --- runbook --------------------------------------------------------------


def test_breach_must_last(spark, rows):
    at = lambda s: ts(14, 0) + dt.timedelta(seconds=s)
    data = [(i, at(60 * i), v) for i, v in enumerate([6.0, 6.0, 1.0, 6.0, 6.0, 6.0, None, 3.0])]
    sensors = spark.createDataFrame([(i, t, "E", "packet_loss_pct", v) for i, t, v in data], "sensor_event_id bigint, event_ts timestamp_ntz, equipment_id string, metric_name string, metric_value double")
    got = runbook.breaches(sensors, (("packet_loss_pct", "CRITICAL", ">", 5.0, 120),))
    assert rows(got, "equipment_id", "level", "start_ts", "end_ts", "readings") == [("E", "CRITICAL", at(180), at(300), 3)]


def test_gate_levels(spark, rows):
    scans = [("G", ts(10, 5 * w, n), "SUCCESS" if n >= bad else "QR_TIMEOUT", 10 + 30 * (w == 2)) for w, bad in enumerate([0, 2, 2, 0]) for n in range(20)]
    df = spark.createDataFrame(scans, "gate_id string, event_ts timestamp_ntz, result_code string, queue_estimate_minutes bigint")
    windows = runbook.gate_windows(df)
    assert rows(windows, "window_start", "failure_pct") == sorted(
        [(ts(10, 0), 0.0), (ts(10, 5), 10.0), (ts(10, 10), 10.0), (ts(10, 15), 0.0)], key=repr)
    got = rows(runbook.gate_levels(windows), "level", "start_ts", "end_ts", "windows")
    assert ("FAILOVER", ts(10, 5), ts(10, 15), 2) in got and ("EMERGENCY", ts(10, 10), ts(10, 15), 1) in got and len(got) == 4


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([3.0, 9.0, 15.0, 25.0, None]), min_size=1, max_size=40))
def test_weather_states_match_brute_force(spark, rows, distances):
    limits = {"lightning_distance_km": {"alert": ("<=", 15.0), "suspend": ("<=", 10.0), "resume": (">=", 20.0), "quiet_seconds": 1800}}
    obs = [(i, ts(0) + dt.timedelta(minutes=45 * i), "WX", d) for i, d in enumerate(distances)]
    df = spark.createDataFrame(obs, "weather_event_id int, observed_ts timestamp_ntz, station_id string, lightning_distance_km double")
    want, state, restless = [], "OPEN", None
    for i, t, _, d in obs:
        if d is None or d < 20:
            restless = t
        if d is not None and d <= 10:
            state = "SUSPENDED"
        elif restless is None or (t - restless).total_seconds() >= 1800:
            state = "OPEN"
        want.append((i, int(d is not None and d <= 15), state))
    assert rows(runbook.weather_states(df, limits), "weather_event_id", "alert", "state") == sorted(want, key=repr)


def test_targets(spark, rows):
    df = spark.createDataFrame([("HIGH",), ("odd",)], "severity string")
    assert rows(runbook.with_target(df)) == sorted([("HIGH", 3), ("odd", None)], key=repr)


# --- streaming ------------------------------------------------------------


def test_rules_on_a_stream(spark, rows, tmp_path):
    rng = random.Random(2)
    src = str(tmp_path / "in")
    scans = [("G", ts(10, rng.randrange(30), rng.randrange(60)), rng.choice(["SUCCESS", "X"]), rng.randrange(40)) for _ in range(200)]
    ddl = "gate_id string, event_ts timestamp, result_code string, queue_estimate_minutes bigint"
    df = spark.createDataFrame(scans + [("G", ts(23), "SUCCESS", 1)], ddl)
    df.write.parquet(src)
    stream = live_gate_windows(spark.readStream.schema(ddl).parquet(src))
    q = stream.writeStream.format("memory").queryName("gate_win").outputMode("complete").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(spark.table("gate_win")) == rows(runbook.gate_windows(df))
    sensors = spark.createDataFrame([("temperature_c", 80.0)], "metric_name string, metric_value double")
    sensors.write.parquet(str(tmp_path / "s"))
    s = live_sensor_states(spark.readStream.schema(sensors.schema).parquet(str(tmp_path / "s")))
    q = s.writeStream.format("memory").queryName("states").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(spark.table("states"), "status") == [("CRITICAL",)]


def test_chunks_cut_the_text_once(spark):
    from opslake.plans import retrieval

    text = "abcdefghij" * 120
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "x" * 5)], "doc_id int, text string")
    for size, overlap in ((100, 14), (100, 60), (7, 0), (50, 49)):
        got = {(r.doc_id, r.chunk_no): (r.start_pos, r.end_pos, r.chunk) for r in retrieval.chunk_text(df, size=size, overlap=overlap).collect()}
        want = {}
        for i, t in ((1, text), (4, "x" * 5)):
            for n, a in enumerate(range(0, max(1, len(t) - overlap), size - overlap), 1):
                want[i, n] = (a + 1, min(a + size, len(t)), t[a : a + size])
        assert got == want
    plan = retrieval.chunk_text(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.index("Generate") < plan.index("regexp_extract_all")


def test_cosine_topk_skips_unusable_vectors_and_many_questions(spark, monkeypatch):
    import numpy as np

    from opslake.plans import retrieval

    monkeypatch.setattr(retrieval, "CHUNK_VECTORS", 40)
    rng = np.random.default_rng(1)
    data = rng.integers(-3, 4, (120, 4)).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(900, None), (901, [1.0, 2.0, 3.0]), (902, [0.0] * 4), (903, [1.0, None, 0.0, 0.0]), (904, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = [(i, rng.normal(size=4).tolist()) for i in range(10_000)] + [(20_000, None), (20_001, [1.0] * 5), (20_002, [0.0] * 4)]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    got = {}
    for r in retrieval.cosine_topk(vectors, queries, k=3, block=3000).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    norm = np.linalg.norm(data, axis=1)
    usable = np.flatnonzero(norm > 0)
    q = np.array([v for i, v in asked[:10_000]])
    sims = (q / np.linalg.norm(q, axis=1)[:, None]) @ (data[usable] / norm[usable][:, None]).T
    assert set(got) == set(range(10_000))
    for i in range(0, 10_000, 97):
        best = np.sort(sims[i])[::-1][:3]
        mine = [sims[i][np.searchsorted(usable, v)] for _, v in sorted(got[i])]
        assert np.allclose(best, mine) and [k for k, _ in sorted(got[i])] == [1, 2, 3]
    assert ".collect()" not in open(retrieval.__file__).read()


def test_new_ids_have_no_gaps_and_are_the_same_again(spark):
    from opslake.plans import changes

    rows = spark.range(500).select((F.col("id") % 50).alias("a"), F.lit(None).cast("long").alias("task_id"))
    old = spark.createDataFrame([(7,)], "task_id long")
    got = sorted((r.task_id, r.a) for r in changes.new_ids(rows.repartition(3), old, "task_id").collect())
    assert [i for i, _ in got] == list(range(8, 508))
    assert got == sorted((r.task_id, r.a) for r in changes.new_ids(rows.repartition(5), old, "task_id").collect())


def test_snapshot_versions_are_never_overwritten(spark, tmp_path):
    from opslake.plans import changes

    root, df = str(tmp_path / "t"), spark.range(3)
    assert [changes.write_snapshot(df.limit(n), root) for n in (1, 2, 3)] == [1, 2, 3]
    assert changes.read_snapshot(spark, root).count() == 3 and changes.read_snapshot(spark, root, 1).count() == 1


def test_carry_forward_keeps_a_null_key(spark, rows):
    import datetime as dt

    from opslake.operators import series

    at = lambda h: dt.datetime(2024, 1, 1, h)
    df = spark.createDataFrame([(None, at(0), 1, "a"), (None, at(5), 2, None), ("k", at(5), 3, None)], "k string, ts timestamp_ntz, id int, v string")
    assert rows(series.carry_forward(df, ["k"], "ts", "id", {"last": F.col("v")}), "id", "last") == [(1, "a"), (2, "a"), (3, None)]
