"""Plan checks: pruning and pushdown reach the scan, one shuffle per
session step, no Python evaluation anywhere."""

import pytest

from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.options import SessionOptions
from hitsessions.plans.registry import QUERIES
from hitsessions.sources.lens import lens_export
from tests.conftest import SF_SMALL

W = ("2024-01-05", "2024-01-06")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ev(spark):
    return lens_export(spark, SF_SMALL)


def test_model1_plan(spark, ev):
    s = plan(first_touch_sessions(ev, *W))
    assert "PartitionFilters: [isnotnull(suffix" in s
    assert s.count("Exchange") == 1
    assert "float_value" not in s.split("ReadSchema:")[1].split("\n")[0]   # nested pruning
    assert "Python" not in s and "ArrowEval" not in s


def test_model1_window_form_limits_before_shuffle(spark, ev):
    # Both windows are top-1: a partial WindowGroupLimit runs map-side,
    # so a hot session sends at most one row per task to the shuffle.
    lines = plan(first_touch_sessions(ev, *W, SessionOptions(form="window"))).split("\n")
    below = [lines[i + 1] for i, ln in enumerate(lines) if "Exchange hashpartitioning(unique_session_id" in ln]
    assert len(below) == 2 and all("WindowGroupLimit" in ln for ln in below)


def test_model2_pushes_event_name(spark, ev):
    s = plan(session_start_sessions(ev, *W))
    assert "EqualTo(event_name,session_start)" in s
    assert s.count("Exchange") == 1
    assert "Python" not in s


def test_extraction_in_whole_stage_codegen(spark, ev):
    df = first_touch_sessions(ev, *W)
    df.collect()   # AQE fuses codegen stages when it runs them
    s = plan(df).split("== Initial Plan ==")[0]
    # The parameter lookups sit inside a codegen stage (marked '*(n)').
    line = [ln for ln in s.split("\n") if "array_position" in ln][0]
    assert line.lstrip(" +-:").startswith("*(")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_in_registered_queries(spark, name):
    s = plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in s and "ArrowEvalPython" not in s
