"""One incremental run: what changed in the export goes into the session table.

The ledger tells the shards that are new, replaced or gone; their states
are made again, and the sessions that they touch are replaced as a whole.
Only the changed shards' events are read. The ledger takes the changes
down last, so a run that fails is repeated by the next one; every step
gives the same when it is done again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitsessions.operators import states as S
from hitsessions.operators import upsert as U
from hitsessions.options import SessionOptions
from hitsessions.session import new_work_path, remove_path
from hitsessions.sources import export as X
from hitsessions.sources.ledger import REMOVED, Ledger


def _changed_events(spark: SparkSession, root: str, shards: list[str], layout: str) -> DataFrame:
    wanted = set(shards).__contains__
    if layout == "folders":
        return X.read_folders_of(spark, root, wanted)
    return X.read_shards_of(spark, root, wanted)


def refresh(spark: SparkSession, root: str, states: str, ledger: str, table: str | None = None, table2: str | None = None,
            opts: SessionOptions | None = None, layout: str = "partitioned", run_ts=None) -> dict[str, str]:
    """Bring states and session tables (Model 1, Model 2) up to date with an export; returns the changed shards.

    A shard that is gone (an intraday one superseded by its daily one)
    takes its states with it. Sessions that it alone held keep their rows,
    as the upsert deletes none; sessions that it shared are replaced where
    another changed shard touches them.
    """
    opts = opts or SessionOptions()
    book = Ledger(spark, root, ledger, layout)
    changed = book.pending()
    if changed:
        there = sorted(s for s, c in changed.items() if c != REMOVED)
        gone = sorted(s for s, c in changed.items() if c == REMOVED)
        # Sessions that changed shards held before are touched as well as those that they hold now.
        before = new_work_path(spark, "ids-before")
        S.read_states(spark, states, [*there, *gone], opts).select(S.KEY).distinct().write.parquet(before)
        S.update_states(spark, _changed_events(spark, root, there, layout), states, there, opts, removed=gone)
        held = spark.read.schema(f"{S.KEY} string").parquet(before)
        touched = S.states_of(spark, states, S.read_states(spark, states, there, opts).select(S.KEY).union(held), opts)
        m1, m2 = S.models(touched, opts, run_ts)
        for path, sessions, spec in ((table, m1, U.MODEL1_SPEC), (table2, m2, U.model2_spec(opts))):
            if path:
                U.replace_sessions(spark, path, sessions, spec, run_ts, opts)
        remove_path(spark, before)
    book.done()
    return changed
