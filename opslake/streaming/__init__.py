from opslake.streaming.monitor import live_gate_windows, live_sensor_states
from opslake.streaming.sustained import live_breaches, live_sustained

__all__ = ["live_breaches", "live_gate_windows", "live_sensor_states", "live_sustained"]
