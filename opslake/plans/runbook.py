"""Monitoring rules that the runbooks state in words; every limit is a parameter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions.moments import seconds_between
from opslake.functions.numeric import exact_avg, percent
from opslake.operators.aggregates import count_where
from opslake.operators.series import carry_forward, sustained

# Fixed values: (metric, level, comparison, limit, seconds it must last).
BREACH_LIMITS = (
    ("packet_loss_pct", "WARNING", ">", 2.0, 180),
    ("packet_loss_pct", "CRITICAL", ">", 5.0, 120),
    ("temperature_c", "WARNING", ">=", 70.0, 0),
    ("temperature_c", "CRITICAL", ">=", 80.0, 0),
    ("fan_rpm", "WARNING", "<", 1500.0, 0),
    ("fan_rpm", "CRITICAL", "<", 1000.0, 0),
    ("audio_dropouts_count", "WARNING", ">=", 2.0, 0),
    ("audio_dropouts_count", "CRITICAL", ">=", 3.0, 0),
)

# Gate levels by failure percent, as (level, percent above, seconds it must last).
GATE_LEVELS = (("OBSERVE", 3.0, 0), ("WARNING", 5.0, 180), ("FAILOVER", 7.0, 300))
QUEUE_EMERGENCY_MINUTES = 30.0

# Weather limits; resume needs every hazard quiet for its time.
WEATHER = {
    "lightning_distance_km": {"alert": ("<=", 15.0), "suspend": ("<=", 10.0), "resume": (">=", 20.0), "quiet_seconds": 1800},
    "wind_gust_mps": {"alert": (">=", 12.0), "suspend": (">=", 15.0), "resume": ("<", 10.0), "quiet_seconds": 1200},
    "rainfall_mm_15m": {"alert": (">=", 10.0), "suspend": (">=", 20.0), "resume": ("<", 5.0), "quiet_seconds": 1200},
}

# First response per severity, in minutes.
RESPONSE_MINUTES = {"CRITICAL": 0, "HIGH": 3, "MEDIUM": 5, "LOW": 15}


def _test(op: str, col: Column, limit: float) -> Column:
    return {">": col > limit, ">=": col >= limit, "<": col < limit, "<=": col <= limit}[op]


def _per_level(rows: DataFrame, tests: Sequence[tuple[str, Column, Column, int]]) -> DataFrame:
    """One copy of a row for each level that applies to it, so that all levels share one scan and shuffle.

    ``tests`` lists (level, does it apply, is it met, seconds it must last).
    """
    options = F.array(*[
        F.when(
            applies, F.struct(F.lit(level).alias("level"), F.coalesce(met, F.lit(False)).alias("_met"), F.lit(seconds).alias("_lasts"))
        )
        for level, applies, met, seconds in tests
    ])
    return rows.select(*rows.columns, F.inline(F.filter(options, lambda o: o.isNotNull())))


def breach_readings(sensors: DataFrame, limits: Sequence[tuple] = BREACH_LIMITS) -> tuple[DataFrame, list[str]]:
    """Readings once per limit of their metric with ``_met`` and ``_lasts`` (seconds), and the keys of a series."""
    metric, value = F.col("metric_name"), F.col("metric_value")
    tests = [(level, metric == m, _test(op, value, limit), seconds) for m, level, op, limit, seconds in limits]
    rows = sensors.select("equipment_id", "metric_name", "metric_value", "event_ts", "sensor_event_id").where(
        metric.isin(*{m for m, *_ in limits})
    )
    return _per_level(rows, tests), ["equipment_id", "metric_name", "level", "_lasts"]


def breaches(sensors: DataFrame, limits: Sequence[tuple] = BREACH_LIMITS) -> DataFrame:
    """(equipment_id, metric_name, level, start_ts, end_ts, readings) of limits broken for long enough.

    ``event_ts`` is a timestamp. Readings of a device and metric are taken in
    time order; a reading inside the limit ends the run.
    """
    rows, keys = breach_readings(sensors, limits)
    return sustained(rows, keys, "event_ts", "sensor_event_id", F.col("_met"), F.col("_lasts")).drop("_lasts")


def gate_windows(scans: DataFrame, ok: str = "SUCCESS", minutes: int = 5) -> DataFrame:
    """Failure percent and queue per gate in tumbling windows. Works on a stream with a watermark."""
    failures = count_where(F.coalesce(F.col("result_code"), F.lit("")) != ok)
    n = F.count(F.lit(1))
    return (
        scans.groupBy("gate_id", F.window("event_ts", f"{minutes} minutes").alias("_w"))
        .agg(
            n.alias("attempts"), failures.alias("failures"), percent(failures, n, 4).alias("failure_pct"),
            exact_avg(F.col("queue_estimate_minutes"), 4).alias("avg_queue_minutes"),
        )
        .select("gate_id", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                "attempts", "failures", "failure_pct", "avg_queue_minutes")
    )


def gate_levels(windows: DataFrame, levels: Sequence[tuple] = GATE_LEVELS, queue: float = QUEUE_EMERGENCY_MINUTES) -> DataFrame:
    """(gate_id, level, start_ts, end_ts, windows): consecutive windows above a level for long enough."""
    always = F.lit(True)
    tests = [(name, always, F.col("failure_pct") > pct, seconds) for name, pct, seconds in levels]
    tests.append(("EMERGENCY", always, F.col("avg_queue_minutes") > queue, 0))
    runs = sustained(
        _per_level(windows, tests), ["gate_id", "level", "_lasts"], "window_start", "window_start", F.col("_met"), F.col("_lasts"),
        end="window_end",
    )
    return runs.select("gate_id", "level", "start_ts", "end_ts", F.col("readings").alias("windows"))


def weather_states(observations: DataFrame, limits: Mapping[str, Mapping] = WEATHER) -> DataFrame:
    """Observations with ``alert`` and ``state`` (OPEN or SUSPENDED) per station.

    A suspend limit closes the stages. They stay closed until every hazard has
    been quiet for its time without a break. ``observed_ts`` is a timestamp.
    """
    alert = suspend = F.lit(False)
    restless = {}
    for column, rule in limits.items():
        alert = alert | F.coalesce(_test(*_split(rule["alert"], column)), F.lit(False))
        suspend = suspend | F.coalesce(_test(*_split(rule["suspend"], column)), F.lit(False))
        quiet = F.coalesce(_test(*_split(rule["resume"], column)), F.lit(False))
        restless[f"_since_{column}"] = F.when(~quiet, F.col("observed_ts"))
    keys, ts, tie = ["station_id"], "observed_ts", "weather_event_id"
    rows = observations.withColumn("alert", alert.cast("int")).withColumn("_suspend", suspend)
    rows = carry_forward(rows, keys, ts, tie, restless)
    calm = F.lit(True)
    for column, rule in limits.items():
        since = F.col(f"_since_{column}")
        calm = calm & (since.isNull() | (seconds_between(since, F.col(ts)) >= rule["quiet_seconds"]))
    event = F.when(F.col("_suspend"), "SUSPENDED").when(calm, "OPEN")
    rows = carry_forward(rows, keys, ts, tie, {"state": event})
    return rows.withColumn("state", F.coalesce(F.col("state"), F.lit("OPEN"))).drop("_suspend", *restless)


def _split(test: tuple, column: str) -> tuple:
    op, limit = test
    return op, F.col(column), limit


def suspensions(states: DataFrame) -> DataFrame:
    """(station_id, start_ts, end_ts, readings) of the times the stages were closed."""
    return sustained(states, ["station_id"], "observed_ts", "weather_event_id", F.col("state") == "SUSPENDED", 0)


def with_target(incidents: DataFrame, targets: Mapping[str, int] = RESPONSE_MINUTES) -> DataFrame:
    """Add the first-response target of the severity in minutes; NULL for an unknown one."""
    target = F.lit(None).cast("int")
    for severity, minutes in targets.items():
        target = F.when(F.col("severity") == severity, F.lit(minutes)).otherwise(target)
    return incidents.withColumn("response_minutes", target)
