"""Sustained runs on a file stream with late rows against the batch result."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opslake.operators.series import sustained
from opslake.plans.runbook import breaches
from opslake.streaming import live_breaches, live_sustained

T0 = dt.datetime(2026, 8, 9, 10)


def stream_of(spark, path, files, ddl):
    for i, data in enumerate(files):
        spark.createDataFrame(data, ddl).coalesce(1).write.parquet(f"{path}/in/{i:03}")
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{path}/in")


def finish(spark, live, path, name):
    q = live.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start()
    assert q.awaitTermination(280)
    return spark.table(name)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_late_rows_end_equal_to_batch(spark, rows, tmp_path, kind):
    rng, data = random.Random(5), []
    for k in ("a", "b", None):
        on = False
        for i in range(150):
            on = on if rng.random() < 0.8 else not on
            data.append((k, T0 + dt.timedelta(seconds=20 * i, microseconds=rng.choice([0, 1, 999_999])), i, on if rng.random() < 0.95 else None))
    data.append(("b", data[160][1], 7000, True))  # two readings of one time
    data.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(200)))  # late by less than the delay
    files = [data[i : i + 80] for i in range(0, len(data), 80)]
    closing = T0 + dt.timedelta(days=1)
    files += [[(k, closing, 9000, False) for k in ("a", "b", None)], [("end", closing + dt.timedelta(days=1), 9001, False)]]
    ddl = f"k string, t {kind}, id long, met boolean"
    live = live_sustained(stream_of(spark, tmp_path, files, ddl), ["k"], "t", "id", F.col("met"), 60, "10 minutes")
    got = finish(spark, live, tmp_path, f"runs_{kind}")
    want = sustained(spark.read.schema(ddl).parquet(*[f"{tmp_path}/in/{i:03}" for i in range(len(files))]), ["k"], "t", "id", F.col("met"), 60)
    assert got.dtypes == want.dtypes and rows(got) == rows(want) and want.count() > 10


def test_breaches_of_sensors(spark, rows, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    hot = [("E1", "temperature_c", 90.0, at(m), m) for m in range(30)] + [("E1", "temperature_c", 20.0, at(31), 31)]
    hot += [("E2", "packet_loss_pct", 50.0, at(m), 100 + m) for m in range(0, 30, 2)] + [("E2", "packet_loss_pct", 0.0, at(40), 140)]
    files = [hot[::2], hot[1::2], [("E9", "temperature_c", 1.0, at(9000), 999)]]
    ddl = "equipment_id string, metric_name string, metric_value double, event_ts timestamp, sensor_event_id long"
    got = finish(spark, live_breaches(stream_of(spark, tmp_path, files, ddl), late="2 hours"), tmp_path, "live_breaches_out")
    want = breaches(spark.createDataFrame(sum(files, []), ddl))
    assert rows(got) == rows(want) and want.count() >= 2
