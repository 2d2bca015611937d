from hitsessions.streaming.scheduled import batch_windows, shard_days, start_incremental, upsert_window
from hitsessions.streaming.stateful import start_stateful

__all__ = ["batch_windows", "shard_days", "start_incremental", "start_stateful", "upsert_window"]
