from lacuna.streaming.ffill import latest, stream_ffill
from lacuna.streaming.stream import missing_rate_by_window, run_to_table, stream_apply

__all__ = ["latest", "missing_rate_by_window", "run_to_table", "stream_apply", "stream_ffill"]
