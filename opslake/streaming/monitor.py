"""The row-wise and tumbling-window rules on a streaming source.

Input tables are finished daily files, so batch is the normal way. The same
functions accept a stream; only the watermark is added here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from opslake.plans.rules import classify
from opslake.plans.runbook import gate_windows


def live_sensor_states(sensors: DataFrame) -> DataFrame:
    """Sensor state per reading; stateless."""
    return classify(sensors)


def live_gate_windows(scans: DataFrame, late: str = "10 minutes", minutes: int = 5) -> DataFrame:
    """Failure percent per gate and window; state is dropped ``late`` after the window ends."""
    return gate_windows(scans.withWatermark("event_ts", late), minutes=minutes)
