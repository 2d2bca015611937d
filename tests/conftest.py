import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hitsessions.session import build_session  # noqa: E402
from hitsessions.sources.export import event_schema  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="hitsessions-test-warehouse-")})
    yield s


def shuffle_records(df) -> int:
    """Run ``df`` and return the records its shuffles wrote (SQL metrics
    of the executed plan)."""
    df.collect()
    out = []

    def walk(node):
        name = node.nodeName()
        if "Exchange" in name and node.metrics().contains("shuffleRecordsWritten"):
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        ch = node.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(out)


def p(key, s=None, i=None):
    """One event_params element."""
    return {"key": key, "value": {"string_value": s, "int_value": i, "float_value": None, "double_value": None}}


def make_events(spark, rows):
    """Literal export rows: dicts with event fields; params as a list of p(...)."""
    schema = event_schema(narrow=False)
    data = []
    for r in rows:
        data.append((r.get("event_date"), r.get("event_timestamp"), r.get("event_bundle_sequence_id"),
                     r.get("user_pseudo_id"), r.get("event_name"), r.get("event_params", []),
                     r.get("suffix", r.get("event_date"))))
    return spark.createDataFrame(data, schema)
