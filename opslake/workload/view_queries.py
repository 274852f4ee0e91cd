"""Views, facts, metrics and rules on the benchmark tables."""

from pyspark.sql import functions as F

from opslake.plans import facts, kg, metrics, rules, runbook, views
from opslake.workload.registry import Tables, avg_sql, pct_sql, query
from opslake.workload.roles import Roles, with_roles

TS = "'%Y-%m-%d %H:%M:%S'"


def _text(df, *names):
    return df.withColumns({n: F.date_format(F.col(n), "yyyy-MM-dd HH:mm:ss") for n in names})


query("v1_stage_delay", with_roles("SELECT * FROM delays"))(lambda t: Roles(t).delays)

_HEALTH = f"""SELECT festival_date, stage_id, equipment_id, metric_name, {avg_sql('metric_value', 3)} AS avg_metric_value,
    round(min(metric_value), 3) AS min_metric_value, round(max(metric_value), 3) AS max_metric_value,
    count(*) FILTER (status IN ('WARNING', 'CRITICAL')) AS abnormal_event_count FROM {{src}} GROUP BY ALL"""


@query("v2_equipment_health", f"""
    WITH s AS (SELECT strftime(ts, '%Y-%m-%d') AS festival_date, 'K' || json_extract_string(props, '$.k') AS stage_id,
        user_id AS equipment_id, event_type AS metric_name, value AS metric_value,
        CASE WHEN value >= 100 THEN 'CRITICAL' WHEN event_type = 'error' AND value >= 50 THEN 'WARNING' ELSE 'NORMAL' END AS status FROM events)
    {_HEALTH.format(src='s')}""")
def v2(t: Tables):
    v, kind = F.col("value"), F.col("event_type")
    sensors = t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("festival_date"),
        F.concat(F.lit("K"), F.get_json_object("props", "$.k")).alias("stage_id"),
        F.col("user_id").alias("equipment_id"), kind.alias("metric_name"), v.alias("metric_value"),
        F.when(v >= 100, "CRITICAL").when((kind == "error") & (v >= 50), "WARNING").otherwise("NORMAL").alias("status"),
    )
    return views.equipment_health(sensors)


query("v2_equipment_health_lines", with_roles(_HEALTH.format(src="sensors")))(lambda t: views.equipment_health(Roles(t).sensors))

query("v3_gate_congestion", with_roles(f"""
    SELECT festival_date, gate_id, result_code, count(*) AS scan_attempts, {avg_sql('scan_duration_ms', 1)} AS avg_scan_duration_ms,
        {avg_sql('queue_estimate_minutes', 1)} AS avg_queue_minutes FROM scans GROUP BY ALL"""))(
    lambda t: views.gate_congestion(Roles(t).scans)
)

_STOCKOUT = f"""SELECT p.product_id, p.product_name, ip.festival_date, ip.baseline_forecast_units, ip.planned_stock_units,
        ip.interest_adjusted_forecast_units, strftime(max(s.sale_ts), {TS}) AS stockout_ts, CAST(sum(s.quantity) AS BIGINT) AS units_sold
    FROM products p JOIN plan ip ON ip.product_id = p.product_id
    LEFT JOIN sales s ON s.product_id = p.product_id AND s.festival_date = ip.festival_date GROUP BY ALL"""


@query("v4a_stockout", with_roles(_STOCKOUT))
def v4a(t: Tables):
    r = Roles(t)
    return _text(views.stockout(r.products, r.plan, r.sales), "stockout_ts")


def _stock(r: Roles):
    return r.plan.select("product_id", "festival_date", F.col("planned_stock_units").alias("initial_stock"))


def _season_start():
    return F.concat(F.col("festival_date"), F.lit("-01-01")).cast("timestamp_ntz")


def _snapshots(r: Roles):
    return rules.inventory_snapshots(_stock(r), r.sales, _season_start(), step_minutes=43200, marks=14)


_GRID = {
    "grid": """SELECT p.product_id, p.festival_date, p.planned_stock_units AS initial_stock, m.m AS mark_no,
        CAST(p.festival_date || '-01-01' AS TIMESTAMP) + to_days(CAST(30 * m.m AS INTEGER)) AS mark_ts FROM plan p, range(0, 14) m(m)""",
    "bucketed": """SELECT product_id, festival_date,
        greatest(CAST(ceil(date_diff('second', CAST(festival_date || '-01-01' AS TIMESTAMP), sale_ts) / 2592000.0) AS INTEGER), 0) AS mark_no,
        sum(quantity) AS q FROM sales GROUP BY ALL""",
    "sold_grid": """SELECT g.*, CAST(coalesce(sum(b.q) OVER (PARTITION BY g.product_id, g.festival_date ORDER BY g.mark_no), 0) AS BIGINT) AS sold
        FROM grid g LEFT JOIN bucketed b USING (product_id, festival_date, mark_no)""",
    "snapshots": f"""SELECT product_id, festival_date, strftime(mark_ts, {TS}) AS snapshot_ts, initial_stock, least(initial_stock, sold) AS units_sold,
        greatest(initial_stock - sold, 0) AS on_hand_units,
        CASE WHEN initial_stock - sold <= 0 THEN 'OUT_OF_STOCK'
             WHEN initial_stock - sold <= greatest(10, initial_stock // 10) THEN 'LOW' ELSE 'NORMAL' END AS stock_status FROM sold_grid""",
}


@query("v4b_stockout_from_snapshots", with_roles("""
    SELECT p.product_id, p.product_name, ip.festival_date, ip.planned_stock_units, ip.interest_adjusted_forecast_units,
        min(s.snapshot_ts) FILTER (s.on_hand_units = 0) AS first_zero_stock_ts, max(s.units_sold) AS units_sold
    FROM products p JOIN plan ip ON ip.product_id = p.product_id
    LEFT JOIN snapshots s ON s.product_id = p.product_id AND s.festival_date = ip.festival_date GROUP BY ALL""", **_GRID))
def v4b(t: Tables):
    r = Roles(t)
    return views.stockout_from_snapshots(r.products, r.plan, _text(_snapshots(r), "snapshot_ts"))


_CONTEXT = """SELECT r.request_id, r.ticket_id, r.parent_ticket_id, r.attendee_id, r.reason_code, r.requested_amount_jpy,
        t.ticket_type_id, t.amount_jpy AS ticket_amount_jpy,
        CAST(EXISTS (SELECT 1 FROM scans a WHERE a.ticket_id = coalesce(nullif(r.parent_ticket_id, ''), r.ticket_id)
            AND a.festival_date = '1998' AND a.result_code = 'SUCCESS') AS INTEGER) AS day3_admitted_flag
    FROM requests r JOIN tickets t ON t.ticket_id = r.ticket_id"""


def _context(t: Tables):
    r = Roles(t)
    return views.refund_context(r.requests, r.tickets, r.scans, "1998")


query("v5_refund_context", with_roles(_CONTEXT))(_context)


def _facts(t: Tables):
    r = Roles(t)
    s = r.sources
    return facts.incident_facts(
        kg.incident_nodes(s), kg.equipment_nodes(s), kg.stage_nodes(s), r.sensors, r.maintenance, r.delays
    )


_FACTS = """
    SELECT i.incident_id, i.festival_date, i.location_id AS incident_location_id, i.category AS incident_category,
        i.severity AS incident_severity, i.start_ts AS incident_start_ts, i.end_ts AS incident_end_ts, i.title AS incident_title,
        i.status AS incident_status, i.document_id AS incident_document_id, i.related_equipment_id AS affected_equipment_id,
        e.stage_id AS equipment_stage_id, s.stage_name AS equipment_stage_name, e.manufacturing_lot, e.lot_source,
        e.lot_assertion_status, e.lot_source_reference_id, h.t AS daily_max_temperature_c, h.p AS daily_max_packet_loss_pct,
        h.f AS daily_min_fan_rpm, m.n AS maintenance_record_count, m.o AS overdue_maintenance_count,
        m.d AS earliest_overdue_scheduled_date, d.n AS affected_performance_count, d.m AS max_delay_minutes
    FROM kg_incidents i LEFT JOIN kg_equipment e ON e.equipment_id = i.related_equipment_id
    LEFT JOIN stages s ON s.stage_id = e.stage_id
    LEFT JOIN (SELECT festival_date, stage_id, equipment_id, round(max(metric_value) FILTER (metric_name = 'temperature_c'), 3) AS t,
        round(max(metric_value) FILTER (metric_name = 'packet_loss_pct'), 3) AS p,
        round(min(metric_value) FILTER (metric_name = 'fan_rpm'), 3) AS f FROM sensors GROUP BY ALL) h
      ON h.festival_date = i.festival_date AND h.stage_id = e.stage_id AND h.equipment_id = e.equipment_id
    LEFT JOIN (SELECT equipment_id, count(*) AS n, count(*) FILTER (status = 'OVERDUE') AS o,
        min(scheduled_date) FILTER (status = 'OVERDUE') AS d FROM maintenance GROUP BY equipment_id) m ON m.equipment_id = e.equipment_id
    LEFT JOIN (SELECT incident_id, count(*) AS n, max(delay_minutes) AS m FROM delays WHERE incident_id IS NOT NULL GROUP BY incident_id) d
      ON d.incident_id = i.incident_id"""

query("v6_incident_facts", with_roles(_FACTS))(_facts)
@query("v7_fan_out", with_roles("""
    SELECT 'facts' AS kind, count(*) AS n FROM kg_incidents
    UNION ALL SELECT 'fanned out', count(*) FROM (SELECT 1 FROM kg_incidents GROUP BY incident_id HAVING count(*) <> 1)"""))
def v7(t: Tables):
    """How many facts there are, and how many incidents have not exactly one."""
    rows = _facts(t)
    n = F.count(F.lit(1)).alias("n")
    return rows.agg(F.lit("facts").alias("kind"), n).unionByName(facts.fan_out(rows).agg(F.lit("fanned out").alias("kind"), n))



# --- metrics --------------------------------------------------------------

query("m1_delay_metrics", with_roles(f"""
    SELECT festival_date, stage_id, max(delay_minutes) AS max_delay_minutes, {avg_sql('delay_minutes', 1)} AS avg_delay_minutes,
        count(incident_id) AS affected_performances FROM delays GROUP BY ALL"""))(
    lambda t: metrics.delay_metrics(Roles(t).delays)
)
query("m1_affected_artists", with_roles(
    "SELECT incident_id, performance_id, artist_name FROM delays WHERE incident_id IS NOT NULL"))(
    lambda t: metrics.affected_artists(Roles(t).delays)
)
query("m2_switch_metrics", with_roles("""
    SELECT festival_date, equipment_id, round_even(max(metric_value) FILTER (metric_name = 'temperature_c'), 1) AS max_temperature_c,
        round_even(max(metric_value) FILTER (metric_name = 'packet_loss_pct'), 1) AS max_packet_loss_pct,
        CAST(round_even(min(metric_value) FILTER (metric_name = 'fan_rpm'), 0) AS BIGINT) AS min_fan_rpm
    FROM sensors GROUP BY ALL"""))(lambda t: metrics.switch_metrics(Roles(t).sensors))
query("m3_overdue_days", with_roles("""
    SELECT equipment_id, min(scheduled_date) AS scheduled_date, date_diff('day', CAST(min(scheduled_date) AS DATE), DATE '2002-01-01') AS overdue_days
    FROM maintenance WHERE status = 'OVERDUE' GROUP BY equipment_id"""))(
    lambda t: metrics.overdue_days(Roles(t).maintenance, "2002-01-01")
)
query("m4_gate_metrics", with_roles(f"""
    SELECT gate_id, count(*) AS attempts, count(*) FILTER (result_code <> 'SUCCESS') AS failures,
        {pct_sql("count(*) FILTER (result_code <> 'SUCCESS')", 'count(*)')} AS failure_rate_pct,
        {avg_sql('queue_estimate_minutes', 1)} AS avg_queue_minutes
    FROM scans WHERE event_ts BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1999-06-30' GROUP BY gate_id"""))(
    lambda t: metrics.gate_metrics(
        Roles(t).scans, F.to_timestamp_ntz(F.lit("1997-03-01 00:00:00")), F.to_timestamp_ntz(F.lit("1999-06-30 00:00:00")))
)


@query("m5_failover_minutes", f"""
    SELECT incident_id, strftime(a, {TS}) AS threshold_ts, strftime(b, {TS}) AS failover_ts,
        CAST(trunc((epoch_us(b) - epoch_us(a)) / 60000000.0) AS BIGINT) AS failover_minutes
    FROM (SELECT user_id AS incident_id, min(ts) FILTER (event_type = 'error') AS a, min(ts) FILTER (event_type = 'purchase') AS b
          FROM events WHERE event_type IN ('error', 'purchase') GROUP BY user_id)""")
def m5(t: Tables):
    kind = F.col("event_type")
    actions = t.events.select(
        F.col("user_id").alias("incident_id"), F.col("ts").alias("event_ts"),
        F.when(kind == "error", "THRESHOLD").when(kind == "purchase", "FAILOVER").otherwise("NOTE").alias("action_type"),
    )
    return _text(metrics.failover_minutes(actions), "threshold_ts", "failover_ts")


@query("m6_stockout_metrics", with_roles(f"""
    SELECT product_id, festival_date, stockout_ts, units_sold, planned_stock_units, interest_adjusted_forecast_units,
        {pct_sql('interest_adjusted_forecast_units - planned_stock_units', 'interest_adjusted_forecast_units')} AS plan_gap_pct
    FROM stock_view""", stock_view=_STOCKOUT))
def m6(t: Tables):
    return metrics.stockout_metrics(v4a(t))


@query("m7_feedback_count", "SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS feedback_count FROM labels")
def m7(t: Tables):
    feedback = t.labels.select(
        F.when(F.col("quality") == 1, "MERCH_STOCKOUT").otherwise("OTHER").alias("topic"),
        F.when(F.col("toxic") == 1, "NEGATIVE").otherwise("NEUTRAL").alias("sentiment"),
    )
    return metrics.feedback_count(feedback, "MERCH_STOCKOUT", "NEGATIVE")


query("m8_first_threshold", with_roles(f"""
    SELECT festival_date, strftime(min(observed_ts), {TS}) AS first_threshold_ts, count(*) AS observations FROM weather
    WHERE lightning_distance_km <= 10 OR wind_gust_mps >= 12 GROUP BY festival_date"""))(
    lambda t: _text(metrics.first_threshold(Roles(t).weather, 10.0, 12.0), "first_threshold_ts")
)

_DECISIONS = {
    "gate": "SELECT ticket_id, max(event_ts) AS admitted_ts FROM scans WHERE festival_date = '1998' AND result_code = 'SUCCESS' GROUP BY ticket_id",
    "decided": """SELECT r.request_id, r.ticket_id, t.ticket_type_id, t.amount_jpy, g.admitted_ts,
        CASE WHEN r.reason_code <> 'WEATHER_CANCELLATION' THEN 'denied' WHEN t.ticket_type_id = 'MG_PREMIUM' THEN 'addon'
             WHEN t.ticket_type_id = 'DAY3' AND g.admitted_ts < TIMESTAMP '1998-10-01' THEN 'day'
             WHEN t.ticket_type_id IN ('THREE_DAY', 'VIP_THREE_DAY') AND g.admitted_ts < TIMESTAMP '1998-10-01' THEN 'pass'
             WHEN g.admitted_ts IS NULL THEN 'manual' ELSE 'denied' END AS rule
        FROM requests r JOIN tickets t ON t.ticket_id = r.ticket_id
        LEFT JOIN gate g ON g.ticket_id = CASE WHEN t.ticket_type_id = 'MG_PREMIUM' THEN coalesce(nullif(r.parent_ticket_id, ''), r.ticket_id) ELSE r.ticket_id END""",
    "decisions": """SELECT request_id, ticket_id, ticket_type_id, CAST(admitted_ts IS NOT NULL AS INTEGER) AS day3_admitted_flag,
        CASE WHEN rule IN ('addon', 'day', 'pass') THEN 'APPROVED' WHEN rule = 'manual' THEN 'MANUAL_REVIEW' ELSE 'DENIED' END AS decision,
        CASE rule WHEN 'addon' THEN amount_jpy WHEN 'day' THEN CAST(round_even(amount_jpy * 0.15::DOUBLE / 100, 0) * 100 AS BIGINT)
             WHEN 'pass' THEN CAST(round_even(amount_jpy * 0.05::DOUBLE / 100, 0) * 100 AS BIGINT) ELSE 0 END AS refund_amount_jpy,
        CASE rule """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.RATIONALE.items()) + """ END AS rationale FROM decided""",
}


def _decisions(t: Tables):
    r = Roles(t)
    return rules.refund_decisions(r.requests, r.tickets, r.scans, "1998", F.to_timestamp_ntz(F.lit("1998-10-01 00:00:00")))


query("m9_refund_totals", with_roles("""
    SELECT decision, count(*) AS requests, CAST(sum(CASE WHEN decision = 'APPROVED' THEN refund_amount_jpy ELSE 0 END) AS BIGINT) AS approved_amount_jpy
    FROM decisions GROUP BY decision""", **_DECISIONS))(lambda t: metrics.refund_totals(_decisions(t)))


@query("m10_signal_forecast", with_roles("""
    SELECT p.product_id, p.festival_date, p.interest_adjusted_forecast_units, CAST(sum(s.quantity) AS BIGINT) AS signal_units, count(*) AS signals,
        CAST(sum(s.quantity) = p.interest_adjusted_forecast_units AS INTEGER) AS matches_forecast
    FROM plan p JOIN sales s ON s.product_id = p.product_id GROUP BY p.product_id, p.festival_date, p.interest_adjusted_forecast_units"""))
def m10(t: Tables):
    r = Roles(t)
    return metrics.signal_forecast(r.sales.withColumnRenamed("quantity", "predicted_units"), r.plan)


# --- rules ----------------------------------------------------------------

query("r1_refund_decisions", with_roles("SELECT * FROM decisions", **_DECISIONS))(_decisions)
query("r2_admissions", with_roles(f"""
    SELECT ticket_id, festival_date, strftime(max(event_ts), {TS}) AS admitted_ts FROM scans WHERE result_code = 'SUCCESS' GROUP BY ALL"""))(
    lambda t: _text(rules.admissions(Roles(t).scans), "admitted_ts")
)
query("r3_sensor_states", with_roles("SELECT * FROM sensors"))(lambda t: Roles(t).sensors)
query("r4_inventory_snapshots", with_roles("SELECT * FROM snapshots", **_GRID))(lambda t: _text(_snapshots(Roles(t)), "snapshot_ts"))


@query("r5_valid_dates", with_roles("""
    SELECT ticket_id, unnest(CASE ticket_type_id WHEN 'DAY3' THEN ['D3'] WHEN 'DAY2' THEN ['D2'] WHEN 'MG_PREMIUM' THEN []
        ELSE ['D1', 'D2', 'D3'] END) AS valid_date FROM tickets"""))
def r5(t: Tables):
    r = Roles(t)
    kind = F.col("ticket_type_id")
    types = r.tickets.select("ticket_type_id").distinct().withColumn(
        "valid_days", F.when(kind == "DAY3", "D3").when(kind == "DAY2", "D2").when(kind == "MG_PREMIUM", "").otherwise("D1|D2|D3")
    )
    return rules.valid_dates(r.tickets, types)


query("r6_failed_scans", with_roles("""
    SELECT ticket_id, gate_id, result_code, count(*) AS scans FROM scans WHERE result_code <> 'SUCCESS' GROUP BY ALL"""))(
    lambda t: rules.failed_scans(Roles(t).scans).groupBy("ticket_id", "gate_id", "result_code").agg(F.count(F.lit(1)).alias("scans"))
)

query("w1_running_units", with_roles(
    f"SELECT product_id, festival_date, CAST(mark_no AS INTEGER) AS mark_no, strftime(mark_ts, {TS}) AS mark_ts, sold FROM sold_grid", **_GRID))(
    lambda t: _running(t)
)


def _running(t: Tables):
    from opslake.operators.series import running_grid

    r = Roles(t)
    grid = running_grid(_stock(r), r.sales, ["product_id", "festival_date"], _season_start(), "sale_ts", "quantity", 43200, 14)
    return _text(grid.select("product_id", "festival_date", "mark_no", "mark_ts", "sold"), "mark_ts")


# --- questions over the views ----------------------------------------------

query("a16_max_delay_per_stage", with_roles("""
    SELECT stage_id, arg_min(performance_id, (-delay_minutes, performance_id)) AS performance_id, max(delay_minutes) AS max_delay_minutes
    FROM delays GROUP BY stage_id"""))(lambda t: metrics.max_delay_per_stage(Roles(t).delays))
query("a17_refunds_by_type", with_roles("""
    SELECT ticket_type_id, day3_admitted_flag, count(*) AS requests, CAST(sum(requested_amount_jpy) AS BIGINT) AS requested_amount_jpy
    FROM context GROUP BY ALL""", context=_CONTEXT))(lambda t: metrics.refunds_by_type(_context(t)))


@query("a19_cancelled_shows", with_roles("""
    SELECT d.festival_date, d.performance_id, d.stage_id, d.artist_name, d.status, d.incident_id, i.title AS incident_title
    FROM delays d LEFT JOIN incidents i ON i.incident_id = d.incident_id
    WHERE d.festival_date = '1998' AND d.status IN ('CANCELED', 'ENDED_EARLY')"""))
def a19(t: Tables):
    r = Roles(t)
    return metrics.cancelled_shows(r.delays, r.incidents, "1998")


# --- runbook --------------------------------------------------------------

_RUNS = f"""SELECT {{keys}}, {{level}} AS level, strftime(min({{s}}), {TS}) AS start_ts, strftime(max({{e}}), {TS}) AS end_ts, count(*) AS {{n}}
    FROM (SELECT *, sum(CASE WHEN flag THEN 0 ELSE 1 END) OVER (PARTITION BY {{keys}} ORDER BY {{s}}, {{tie}} ROWS UNBOUNDED PRECEDING) AS grp
          FROM (SELECT *, {{cond}} AS flag FROM {{src}}))
    WHERE flag GROUP BY {{keys}}, grp HAVING date_diff('second', min({{s}}), max({{e}})) >= {{secs}}"""
# All eight limits, with values and times that suit the benchmark events.
_N1_LIMITS = (
    ("packet_loss_pct", "WARNING", ">", 2.0, 7200), ("packet_loss_pct", "CRITICAL", ">", 5.0, 3600),
    ("temperature_c", "WARNING", ">=", 30.0, 0), ("temperature_c", "CRITICAL", ">=", 40.0, 0),
    ("fan_rpm", "WARNING", "<", 1500.0, 0), ("fan_rpm", "CRITICAL", "<", 1000.0, 86400),
    ("audio_dropouts_count", "WARNING", ">=", 2.0, 0), ("audio_dropouts_count", "CRITICAL", ">=", 3.0, 7200),
)


@query("n1_breaches", with_roles(" UNION ALL ".join(
    _RUNS.format(keys="equipment_id, metric_name", level=f"'{lv}'", s="event_ts", e="event_ts", n="readings", tie="sensor_event_id",
                 cond=f"metric_value {op} {x}", src=f"(SELECT * FROM readings WHERE metric_name = '{m}')", secs=sec)
    for m, lv, op, x, sec in _N1_LIMITS)))
def n1(t: Tables):
    return _text(runbook.breaches(Roles(t).readings, _N1_LIMITS), "start_ts", "end_ts")


_WINDOWS = {"gate_win": f"""SELECT gate_id, time_bucket(INTERVAL 1 HOUR, event_ts) AS window_start,
    time_bucket(INTERVAL 1 HOUR, event_ts) + INTERVAL 1 HOUR AS window_end, count(*) AS attempts,
    count(*) FILTER (result_code <> 'SUCCESS') AS failures, {pct_sql("count(*) FILTER (result_code <> 'SUCCESS')", 'count(*)', 4)} AS failure_pct,
    {avg_sql('queue_estimate_minutes', 4)} AS avg_queue_minutes FROM gate_events GROUP BY ALL"""}

query("n2_gate_windows", with_roles(f"SELECT * REPLACE (strftime(window_start, {TS}) AS window_start, strftime(window_end, {TS}) AS window_end) FROM gate_win", **_WINDOWS))(
    lambda t: _text(runbook.gate_windows(Roles(t).gate_events, minutes=60), "window_start", "window_end")
)
_N2_LEVELS = (("OBSERVE", 3.0, 0), ("WARNING", 5.0, 7200), ("FAILOVER", 7.0, 10800))


@query("n2_gate_levels", with_roles(" UNION ALL ".join(
    _RUNS.format(keys="gate_id", level=f"'{lv}'", s="window_start", e="window_end", n="windows", tie="window_start", cond=cond, src="gate_win", secs=sec)
    for lv, cond, sec in [(n, f"failure_pct > {p}", s) for n, p, s in _N2_LEVELS] + [("EMERGENCY", "avg_queue_minutes > 30.0", 0)]), **_WINDOWS))
def n2(t: Tables):
    windows = runbook.gate_windows(Roles(t).gate_events, minutes=60)
    return _text(runbook.gate_levels(windows, _N2_LEVELS), "start_ts", "end_ts")


_N3 = {
    "lightning_distance_km": {"alert": ("<=", 4.0), "suspend": ("<=", 1.0), "resume": (">=", 2.0), "quiet_seconds": 1800},
    "wind_gust_mps": {"alert": (">=", 11.0), "suspend": (">=", 12.0), "resume": ("<", 11.5), "quiet_seconds": 1200},
    "rainfall_mm_15m": {"alert": (">=", 4.0), "suspend": (">=", 5.0), "resume": ("<", 4.0), "quiet_seconds": 1200},
}
_W = "OVER (PARTITION BY station_id ORDER BY observed_ts, weather_event_id ROWS UNBOUNDED PRECEDING)"
_STATES = {
    "calm": "SELECT *, " + ", ".join(
        f"last_value(CASE WHEN NOT {c} {r['resume'][0]} {r['resume'][1]} THEN observed_ts END IGNORE NULLS) {_W} AS since_{i}"
        for i, (c, r) in enumerate(_N3.items())) + " FROM weather",
    "eventful": "SELECT *, CASE WHEN " + " OR ".join(f"{c} {r['suspend'][0]} {r['suspend'][1]}" for c, r in _N3.items())
    + " THEN 'SUSPENDED' WHEN " + " AND ".join(
        f"(since_{i} IS NULL OR date_diff('microsecond', since_{i}, observed_ts) // 1000000 >= {r['quiet_seconds']})" for i, r in enumerate(_N3.values()))
    + " THEN 'OPEN' END AS ev FROM calm",
    "states": "SELECT weather_event_id, station_id, observed_ts, CAST(" + " OR ".join(f"{c} {r['alert'][0]} {r['alert'][1]}" for c, r in _N3.items())
    + f" AS INTEGER) AS alert, coalesce(last_value(ev IGNORE NULLS) {_W}, 'OPEN') AS state FROM eventful",
}

query("n3_weather_states", with_roles("SELECT weather_event_id, station_id, alert, state FROM states", **_STATES))(
    lambda t: runbook.weather_states(Roles(t).weather, _N3).select("weather_event_id", "station_id", "alert", "state")
)
query("n3_suspensions", with_roles(
    "SELECT * EXCLUDE (level) FROM (" + _RUNS.format(keys="station_id", level="''", s="observed_ts", e="observed_ts", n="readings", tie="weather_event_id",
                                                     cond="state = 'SUSPENDED'", src="states", secs=0) + ")", **_STATES))(
    lambda t: _text(runbook.suspensions(runbook.weather_states(Roles(t).weather, _N3)), "start_ts", "end_ts")
)
query("n4_refund_policy_totals", with_roles("""
    SELECT ticket_type_id, rationale, count(*) AS requests, CAST(sum(refund_amount_jpy) AS BIGINT) AS amount_jpy FROM decisions GROUP BY ALL""", **_DECISIONS))(
    lambda t: _decisions(t).groupBy("ticket_type_id", "rationale").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("refund_amount_jpy").cast("bigint").alias("amount_jpy"))
)
query("n5_response_targets", with_roles("""
    SELECT incident_id, severity, CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 5 WHEN 'LOW' THEN 15 END AS response_minutes
    FROM incidents"""))(
    lambda t: runbook.with_target(Roles(t).incidents).select("incident_id", "severity", "response_minutes")
)
