"""Web-analytics sessions on Spark.

Turns an analytics event export (one row per hit, with a nested key/value
parameter array) into session tables with traffic-source attribution,
keeps a date-partitioned session table current through an incremental
upsert, and reports daily differences between two attribution models.
Everything is expressed with DataFrame / Spark SQL primitives.
"""

from hitsessions.operators.attribution import ChannelRules, Rule
from hitsessions.options import AS_WRITTEN, INTENDED, SessionOptions
from hitsessions.operators.both_models import both_models
from hitsessions.operators.compare import compare_models
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.operators.upsert import MODEL1_SPEC, model2_spec, upsert_sessions
from hitsessions.sources.export import read_export, read_sessions, read_shard_folders, read_window

__all__ = [
    "SessionOptions", "AS_WRITTEN", "INTENDED", "ChannelRules", "Rule",
    "first_touch_sessions", "session_start_sessions", "both_models", "compare_models",
    "upsert_sessions", "MODEL1_SPEC", "model2_spec",
    "read_export", "read_window", "read_shard_folders", "read_sessions",
]
