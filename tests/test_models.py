"""Session models: forms agree, modes differ where the blueprint says,
rules hit every branch, invariants hold (SURVEY 5.2)."""

import pytest
from pyspark.sql import functions as F

from hitsessions.operators.compare import compare_counts, model1_channel_counts, model2_channel_rows
from hitsessions.operators.first_touch import first_touch_sessions
from hitsessions.operators.session_start import session_start_sessions
from hitsessions.options import SessionOptions
from hitsessions.sources.lens import lens_export
from tests.conftest import SF_SMALL, make_events, p

W = ("2024-01-01", "2024-01-31")
DROP = ["export_timestamp", "last_update_timestamp"]


def rows(df):
    return sorted((tuple(r) for r in df.drop(*[c for c in DROP if c in df.columns]).collect()), key=repr)


@pytest.fixture(scope="module")
def ev(spark):
    return lens_export(spark, SF_SMALL)


@pytest.mark.parametrize("mode", ["intended", "as_written"])
def test_model1_forms_agree(spark, ev, mode):
    a = first_touch_sessions(ev, *W, SessionOptions(mode=mode, form="aggregate"))
    b = first_touch_sessions(ev, *W, SessionOptions(mode=mode, form="window"))
    assert rows(a) == rows(b)


@pytest.mark.parametrize("mode", ["intended", "as_written"])
def test_model2_forms_agree(spark, ev, mode):
    a = session_start_sessions(ev, *W, SessionOptions(mode=mode, form="aggregate"))
    b = session_start_sessions(ev, *W, SessionOptions(mode=mode, form="window"))
    assert rows(a) == rows(b)


def test_one_row_per_session(spark, ev):
    for df in (first_touch_sessions(ev, *W), session_start_sessions(ev, *W)):
        assert df.count() == df.select("unique_session_id").distinct().count()
        assert df.where(F.col("unique_session_id").isNull()).count() == 0


def test_null_id_group_as_written(spark, ev):
    df = first_touch_sessions(ev, *W, SessionOptions(mode="as_written"))
    assert df.where(F.col("unique_session_id").isNull()).count() == 1


def test_model2_ids_subset_of_model1(spark, ev):
    m1 = first_touch_sessions(ev, *W).select("unique_session_id")
    m2 = session_start_sessions(ev, *W).select("unique_session_id")
    assert m2.join(m1, "unique_session_id", "left_anti").count() == 0


def test_row_order_does_not_matter(spark, ev):
    shuffled = ev.repartition(7, F.rand(3))
    assert rows(first_touch_sessions(ev, *W)) == rows(first_touch_sessions(shuffled, *W))
    assert rows(session_start_sessions(ev, *W)) == rows(session_start_sessions(shuffled, *W))


def _ev(spark, items):
    out = []
    for i, (us, name, params) in enumerate(items):
        out.append({"event_date": "20240110", "event_timestamp": us, "event_bundle_sequence_id": 100 - i,
                    "user_pseudo_id": "u", "event_name": name,
                    "event_params": [p("ga_session_id", i=1)] + params})
    return make_events(spark, out)


T0 = 1_704_880_800_000_000   # 2024-01-10 10:00 UTC


def test_model1_same_event_attribution(spark):
    # First event has no attribution, second has only medium, third full:
    # all five values come from the second event, not per column.
    ev = _ev(spark, [(T0, "page_view", []),
                     (T0 + 1_000_000, "page_view", [p("medium", s="email")]),
                     (T0 + 2_000_000, "page_view", [p("source", s="google"), p("medium", s="cpc")])])
    r = first_touch_sessions(ev, "2024-01-10", "2024-01-10").first()
    assert (r.session_source, r.session_medium, r.session_campaign) == ("(direct)", "email", "N/A")
    assert r.event_timestamp == "2024-01-10 11:00:00"


def test_model1_star_in_value_modes(spark):
    ev = _ev(spark, [(T0, "page_view", [p("source", s="a*b"), p("medium", s="m")])])
    aw = first_touch_sessions(ev, "2024-01-10", "2024-01-10", SessionOptions(mode="as_written")).first()
    it = first_touch_sessions(ev, "2024-01-10", "2024-01-10").first()
    assert (aw.session_source, aw.session_medium, aw.session_campaign) == ("a", "b", "m")
    assert (it.session_source, it.session_medium, it.session_campaign) == ("a*b", "m", "N/A")


def test_actual_timestamp_units_by_mode(spark):
    ev = _ev(spark, [(T0, "page_view", [p("actual_timestamp", i=T0 // 1000)])])
    aw = first_touch_sessions(ev, "2024-01-10", "2024-01-10", SessionOptions(mode="as_written")).first()
    it = first_touch_sessions(ev, "2024-01-10", "2024-01-10").first()
    assert aw.actual_timestamp.startswith("1970-01-20")
    assert it.actual_timestamp == "2024-01-10 11:00:00"


def test_bundle_id_breaks_ties(spark):
    # Same time: the lower bundle id comes first.
    ev = make_events(spark, [
        {"event_date": "20240110", "event_timestamp": T0, "event_bundle_sequence_id": 5, "user_pseudo_id": "u",
         "event_name": "session_start", "event_params": [p("ga_session_id", i=1), p("source", s="late")]},
        {"event_date": "20240110", "event_timestamp": T0, "event_bundle_sequence_id": 4, "user_pseudo_id": "u",
         "event_name": "session_start", "event_params": [p("ga_session_id", i=1), p("source", s="early")]},
    ])
    assert first_touch_sessions(ev, "2024-01-10", "2024-01-10").first().session_source == "early"
    assert session_start_sessions(ev, "2024-01-10", "2024-01-10").first().session_source_orig == "early"


def test_complete_ties_are_deterministic(spark):
    e = {"event_date": "20240110", "event_timestamp": T0, "event_bundle_sequence_id": 5, "user_pseudo_id": "u",
         "event_name": "session_start"}
    a = dict(e, event_params=[p("ga_session_id", i=1), p("source", s="x")])
    b = dict(e, event_params=[p("ga_session_id", i=1), p("source", s="y")])
    r1 = session_start_sessions(make_events(spark, [a, b]), "2024-01-10", "2024-01-10").first().session_source_orig
    r2 = session_start_sessions(make_events(spark, [b, a]), "2024-01-10", "2024-01-10").first().session_source_orig
    assert r1 == r2


RULE_CASES = [
    # url, source, medium, campaign -> source, medium, campaign
    ("https://x/?gclid=1", "bing", "organic", "(organic)", "google", "cpc", "N/A"),
    ("https://x/?gclid=1&utm_campaign=sale", "bing", "organic", "(referral)", "google", "cpc", "sale"),
    ("https://x/?gclid=1", None, None, "brand", "google", "cpc", "brand"),
    ("https://x/?fbclid=1", "s", "m", None, "facebook", "referral", "N/A"),
    ("https://x/?fbclid=1", "s", "m", "c", "facebook", "m", "c"),
    ("https://x/?msclid=1", "s", "m", "c", "bing", "m", "c"),
    ("https://x/?hgtid=1", "s", "m", "c", "heureka.cz", "m", "c"),
    ("https://x/", None, None, None, "direct", "(none)", "N/A"),
    ("https://x/", "", "", None, "", "", "N/A"),                  # '' is a value in Model 2
    ("https://x/", "s", None, None, "s", "N/A", "N/A"),           # source with no medium
    ("https://x/", None, "m", None, "N/A", "m", "N/A"),
    ("https://x/?dgclid=1", "s", "m", "c", "google", "cpc", "c"),  # unanchored click-id test
    ("https://x/?UTM_CAMPAIGN=Up&x", "s", "m", None, "s", "m", "Up"),
    ("https://x/?utm_campaign=", "s", "m", None, "s", "m", ""),
    (None, "s", "m", None, "s", "m", "N/A"),
]


@pytest.mark.parametrize("url,src,med,camp,e_src,e_med,e_camp", RULE_CASES)
def test_model2_rules(spark, url, src, med, camp, e_src, e_med, e_camp):
    params = [p("ga_session_id", i=1)]
    for k, v in (("page_location", url), ("source", src), ("medium", med), ("campaign", camp)):
        if v is not None:
            params.append(p(k, s=v))
    ev = _ev(spark, [(T0, "session_start", params)])
    r = session_start_sessions(ev, "2024-01-10", "2024-01-10").first()
    assert (r.session_source, r.session_medium, r.session_campaign) == (e_src, e_med, e_camp)
    assert r.ga_session_number == -1


def test_model2_reads_only_session_start(spark):
    ev = _ev(spark, [(T0, "page_view", [p("source", s="pv")]), (T0 + 1, "session_start", [p("source", s="ss")])])
    r = session_start_sessions(ev, "2024-01-10", "2024-01-10").collect()
    assert len(r) == 1 and r[0].session_source_orig == "ss"


def test_compare_fan_out_equals_product(spark, ev):
    """The as-written report equals the product join, without building it."""
    o = SessionOptions(mode="as_written")
    fe = model1_channel_counts(first_touch_sessions(ev, *W, o), *W)
    ss = model2_channel_rows(ev, *W, o).groupBy("session_date", "session_source", "session_medium",
                                                "session_campaign").agg(
        F.countDistinct("unique_session_id").alias("cnt_sessions_ss"))
    got = {r.date: (r.cnt_sessions_model2_session_start, r.cnt_sessions_model1_first_event)
           for r in compare_counts(ss, fe, o).collect()}
    prod = (ss.alias("s").join(fe.alias("f"), "session_date", "left")
            .groupBy("session_date").agg(F.sum("s.cnt_sessions_ss").alias("a"), F.sum("f.cnt_sessions_fev").alias("b")))
    want = {str(r.session_date): (r.a, r.b) for r in prod.collect()}
    assert got == want


def test_compare_day_only_in_one_model(spark):
    fe = spark.createDataFrame([("2024-01-02", "s", "m", "c", 3)],
                               "session_date string, session_source string, session_medium string, "
                               "session_campaign string, cnt_sessions_fev bigint").withColumn(
        "session_date", F.to_date("session_date"))
    ss = spark.createDataFrame([("2024-01-01", "s", "m", "c", 2)],
                               "session_date string, session_source string, session_medium string, "
                               "session_campaign string, cnt_sessions_ss bigint").withColumn(
        "session_date", F.to_date("session_date"))
    r = compare_counts(ss, fe).collect()
    assert [(x.date, x.cnt_sessions_model2_session_start, x.cnt_sessions_model1_first_event, x.diff_pct)
            for x in r] == [("2024-01-01", 2, None, None)]


@pytest.mark.parametrize("mode", ["intended", "as_written"])
def test_both_models_one_pass_equals_separate(spark, ev, mode):
    from hitsessions.operators.both_models import both_models
    o = SessionOptions(mode=mode)
    m1, m2 = both_models(spark, ev, *W, o)
    assert rows(m1) == rows(first_touch_sessions(ev, *W, o))
    assert rows(m2) == rows(session_start_sessions(ev, *W, o))


def test_model2_extra_click_id_columns(spark):
    params = [p("ga_session_id", i=1), p("page_location", s="https://x/?fbclid=F9&msclid=M9")]
    ev = _ev(spark, [(T0, "session_start", params)])
    r = session_start_sessions(ev, "2024-01-10", "2024-01-10", SessionOptions(extra_click_ids=True)).first()
    assert (r.fbclid_url, r.msclid_url, r.gclid_url) == ("F9", "M9", "N/A")


def test_report_day_one_against_fixture_notes(spark):
    """FIXTURES.md numbers for 2024-01-01 at sf0.01. Model 1 side: 4,246 as
    written (fan-out) and 193 intended. Model 2 side: 60 with Model 2's own
    order (corrected clock); the report's SQL orders by raw server time,
    which gives 61 (Q6)."""
    from hitsessions.operators.compare import compare_models
    ev = lens_export(spark, "/root/testdata/sf0.01")
    got = {}
    for mode in ("as_written", "intended"):
        o = SessionOptions(mode=mode)
        fe = first_touch_sessions(ev, *W, o)
        for clock in ("server", "safe"):
            r = compare_models(fe, ev, *W, o, clock=clock).first()
            got[(mode, clock)] = (r.date, r.cnt_sessions_model2_session_start, r.cnt_sessions_model1_first_event,
                                  r.diff_pct)
    assert got[("as_written", "safe")] == ("2024-01-01", 360, 4246, -91.52)
    assert got[("intended", "safe")] == ("2024-01-01", 60, 193, -68.91)
    assert got[("as_written", "server")] == ("2024-01-01", 366, 4246, -91.38)
    assert got[("intended", "server")] == ("2024-01-01", 61, 193, -68.39)


def test_strict_params_raise_on_duplicate_keys(spark):
    ev = _ev(spark, [(T0, "session_start", [p("source", s="a"), p("source", s="b"), p("medium", s="m")])])
    loose = first_touch_sessions(ev, "2024-01-10", "2024-01-10").first()
    assert loose.session_source == "a"        # first in array order
    strict = SessionOptions(strict_params=True)
    for build in (first_touch_sessions, session_start_sessions):
        with pytest.raises(Exception):
            build(ev, "2024-01-10", "2024-01-10", strict).collect()
    # The client clock is read with LIMIT 1: a duplicate never raises.
    ev2 = _ev(spark, [(T0, "page_view", [p("actual_timestamp", i=T0 // 1000), p("actual_timestamp", i=1)])])
    assert first_touch_sessions(ev2, "2024-01-10", "2024-01-10", strict).count() == 1


def test_compare_zero_model1_count(spark):
    """A day whose Model 1 groups count 0 sessions (only the NULL id):
    intended gives a NULL difference, as written divides by zero (error)."""
    from hitsessions.operators.compare import compare_counts
    schema = ("session_date date, session_source string, session_medium string, session_campaign string, "
              "{} bigint")
    import datetime as dt
    fe = spark.createDataFrame([(dt.date(2024, 1, 2), "s", "m", "c", 0)], schema.format("cnt_sessions_fev"))
    ss = spark.createDataFrame([(dt.date(2024, 1, 2), "s", "m", "c", 5)], schema.format("cnt_sessions_ss"))
    r = compare_counts(ss, fe, SessionOptions()).first()
    assert (r.cnt_sessions_model2_session_start, r.cnt_sessions_model1_first_event, r.diff_pct) == (5, 0, None)
    with pytest.raises(Exception):
        compare_counts(ss, fe, SessionOptions(mode="as_written")).collect()
