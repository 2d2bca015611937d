"""SQL access: the session tables and the report as temporary views.

Users who ran the original SQL can keep writing SQL against the results:

    register_session_views(spark, events, "2024-01-01", "2024-01-31")
    spark.sql("SELECT session_source, count(*) FROM model1_sessions GROUP BY ALL")

The views are lazy: each query plans the DataFrame jobs behind them.
``safe_actual_ts_ms`` is registered as a SQL function too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitsessions.functions.clock import register_sql_functions
from hitsessions.operators.compare import compare_models
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.options import SessionOptions


def register_session_views(spark: SparkSession, events: DataFrame, start, end,
                           opts: SessionOptions | None = None, prefix: str = "") -> list[str]:
    opts = opts or SessionOptions()
    register_sql_functions(spark, opts.tolerance_days)
    m1 = first_touch_sessions(events, start, end, opts)
    m2 = session_start_sessions(events, start, end, opts)
    views = {
        f"{prefix}events": events,
        f"{prefix}model1_sessions": m1,
        f"{prefix}model2_sessions": m2,
        f"{prefix}model_comparison": compare_models(m1, events, start, end, opts),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
