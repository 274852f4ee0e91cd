"""Runs of readings for which a limit is broken long enough, on a stream.

The stream form of ``operators.series.sustained``. Readings of a key may come
late by up to the watermark's delay; until then they wait in the state of the
key. Readings at or before the watermark are final and are taken in time order:
a reading that breaks the limit opens or prolongs a run, one that does not closes
it, and a closed run that lasted long enough is a result. A timer at the first
reading that waits sees to keys that get no more data. The state of a key holds
the readings of one delay and the open run, however long that is.

A run is given once, when it is closed: what is open when the stream ends is
not a result. Later readings than the delay allows are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from opslake.plans.runbook import BREACH_LIMITS, breach_readings

_STATE = "start long, stop long, n long, us array<long>, tie array<string>, stops array<long>, met array<boolean>"
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _micros(c: Column, kind: str) -> Column:
    """Microseconds since 1970, without the session's zone for times that have none."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c) if kind == "timestamp_ntz" else F.unix_micros(c)


def _moment(c: Column, kind: str) -> Column:
    """The inverse; whole seconds and the rest apart, for added amounts are ints."""
    if kind != "timestamp_ntz":
        return F.timestamp_micros(c)
    seconds = F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.floor(c / 1_000_000)).cast("decimal(18,6)"))
    return seconds + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.pmod(c, F.lit(1_000_000)) / 1_000_000).cast("decimal(18,6)"))


def live_sustained(
    rows: DataFrame, keys: Sequence[str], ts: str, tie: str, flag: Column, min_seconds: int | Column, late: str = "10 minutes", end: str | None = None
) -> DataFrame:
    """(keys, start_ts, end_ts, readings) of closed runs, as ``sustained`` gives them for finished data.

    ``rows`` is a stream, ``ts`` a time without NULL, ``late`` the delay of its
    watermark. Readings of one time go by ``tie`` as text. ``min_seconds`` is a number
    or an expression of the keys.
    """
    kind = dict(rows.dtypes)[ts]
    least = min_seconds if isinstance(min_seconds, Column) else F.lit(min_seconds)
    us = _micros(F.col(ts), kind)
    base = rows.select(
        *keys, least.cast("long").alias("_least"), F.timestamp_micros(us).alias("_event"), us.alias("_us"), F.col(tie).cast("string").alias("_tie"),
        _micros(F.col(end or ts), kind).alias("_stop"), F.coalesce(flag, F.lit(False)).alias("_met"),
    ).withWatermark("_event", late)
    kinds = dict(base.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", _start long, _end long, readings long"

    def step(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, stop, n, *lists = state.get if state.exists else (None, None, 0, [], [], [], [])
        waiting = list(zip(*lists))
        for f in frames:
            waiting += zip(f["_us"].tolist(), f["_tie"].tolist(), f["_stop"].tolist(), f["_met"].tolist())
        waiting.sort(key=lambda r: (r[0], r[1] is not None, r[1] or ""))
        mark, done, at = state.getCurrentWatermarkMs(), [], 0
        for us, _, closes, met in waiting:
            if us > mark * 1000:
                break
            at += 1
            if met:
                start, stop, n = (us, closes, 1) if start is None else (start, max(stop, closes), n + 1)
            elif start is not None:
                if stop - start >= key[-1] * 1_000_000:
                    done.append((*key[:-1], start, stop, n))
                start, stop, n = None, None, 0
        waiting = waiting[at:]
        if waiting or start is not None:
            state.update((start, stop, n, *([r[i] for r in waiting] for i in range(4))))
            if waiting:
                state.setTimeoutTimestamp(max(waiting[0][0] // 1000, mark) + 1)
        elif state.exists:
            state.remove()
        if done:
            yield pd.DataFrame(done, columns=[*keys, "_start", "_end", "readings"])

    runs = base.groupBy(*keys, "_least").applyInPandasWithState(step, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return runs.select(*keys, _moment(F.col("_start"), kind).alias("start_ts"), _moment(F.col("_end"), kind).alias("end_ts"), "readings")


def live_breaches(sensors: DataFrame, limits: Sequence[tuple] = BREACH_LIMITS, late: str = "10 minutes") -> DataFrame:
    """``runbook.breaches`` on a stream of readings: every closed breach, once."""
    rows, keys = breach_readings(sensors, limits)
    return live_sustained(rows, keys, "event_ts", "sensor_event_id", F.col("_met"), F.col("_lasts"), late).drop("_lasts")
