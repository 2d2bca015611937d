from hitsessions.sources.export import (event_schema, read_export, events_in_window,
                                        shard_in_window, single_shard, write_export,
                                        read_sessions, default_window)
from hitsessions.sources.lens import lens_events, lens_flat, flat_events, nest_params

__all__ = ["event_schema", "read_export", "events_in_window", "shard_in_window",
           "single_shard", "write_export", "read_sessions", "default_window",
           "lens_events", "lens_flat", "flat_events", "nest_params"]
