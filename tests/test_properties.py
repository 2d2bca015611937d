"""Property tests: column functions against a direct Python statement of
the rule, on random inputs (one Spark job per generated batch)."""

import re

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hitsessions.functions import clock as C
from hitsessions.operators import attribution as A

I64 = 2 ** 63 - 1
DAY = 86_400_000


def trunc_div(a, b):
    return -((-a) // b) if a < 0 else a // b


def py_safe(p, e_us, tol=2):
    e = None if e_us is None else trunc_div(e_us, 1000)
    c = p if p is not None else e
    if c is None or e is None:
        return c
    d = c - e
    if abs(d) > I64:
        return e
    days = abs(d) // DAY
    return e if days > tol else c


near = st.integers(min_value=-5 * DAY, max_value=5 * DAY)
ts_us = st.integers(min_value=-(2 ** 62), max_value=2 ** 62)
any_long = st.integers(min_value=-I64, max_value=I64)


@st.composite
def clock_case(draw):
    e = draw(st.one_of(st.none(), ts_us))
    kind = draw(st.sampled_from(["none", "near", "any"]))
    if kind == "none" or (kind == "near" and e is None):
        p = None if kind == "none" else draw(any_long)
    elif kind == "near":
        base = trunc_div(e, 1000)
        p = max(-I64, min(I64, base + draw(near)))
    else:
        p = draw(any_long)
    return p, e


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cases=st.lists(clock_case(), min_size=1, max_size=60), tol=st.integers(min_value=0, max_value=4))
def test_safe_clock_matches_rule(spark, cases, tol):
    df = spark.createDataFrame([(i, p, e) for i, (p, e) in enumerate(cases)], "i int, p bigint, e bigint")
    got = {r.i: r.v for r in df.select("i", C.safe_actual_ts_ms("p", "e", tol).alias("v")).collect()}
    for i, (p, e) in enumerate(cases):
        assert got[i] == py_safe(p, e, tol), (p, e, tol)


def py_rules(url, src, med, camp):
    def has(k):
        return k in url
    if has("gclid="):
        s = "google"
    elif has("fbclid="):
        s = "facebook"
    elif has("msclid="):
        s = "bing"
    elif has("hgtid="):
        s = "heureka.cz"
    elif src == "N/A" and med == "N/A":
        s = "direct"
    else:
        s = src
    if has("gclid="):
        m = "cpc"
    elif has("fbclid=") and camp == "N/A":
        m = "referral"
    elif src == "N/A" and med == "N/A":
        m = "(none)"
    else:
        m = med
    c1 = "N/A" if has("gclid=") and camp in ("(organic)", "(referral)") else camp
    hit = re.search(r"(?i)utm_campaign=([^&]*)", url)
    utm = hit.group(1) if hit else "N/A"
    c = utm if c1 == "N/A" else c1
    g = re.search(r"[?&]gclid=([^&]+)", url)
    return s, m, c, utm, (g.group(1) if g else "N/A")


pieces = st.sampled_from(["?", "&", "gclid=", "fbclid=", "msclid=", "hgtid=", "utm_campaign=", "UTM_Campaign=",
                          "x", "G1", "#f", "d", "=", "N/A"])
values = st.sampled_from(["N/A", "", "google", "cpc", "(organic)", "(referral)", "brand", "a*b"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.lists(pieces, max_size=8).map("".join), values, values, values),
                     min_size=1, max_size=60))
def test_model2_rules_match_rule_text(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, page_location string, source string, medium string, campaign string")
    ch = A.model2_channel({k: F.col(k) for k in ("page_location", "source", "medium", "campaign")})
    out = df.select("i", ch["session_source"].alias("s"), ch["session_medium"].alias("m"),
                    ch["session_campaign"].alias("c"), ch["utm_campaign_url"].alias("u"),
                    A.url_param(F.col("page_location"), "gclid_url").alias("g")).collect()
    got = {r.i: (r.s, r.m, r.c, r.u, r.g) for r in out}
    for i, r in enumerate(rows):
        assert got[i] == py_rules(*r), r


# ---------------------------------------------------------------- Model 1

from hitsessions.operators.first_touch import first_touch_sessions  # noqa: E402
from hitsessions.options import SessionOptions  # noqa: E402
from tests.conftest import make_events, p  # noqa: E402

T0 = 1_704_880_800_000_000   # 2024-01-10 10:00 UTC
DEFAULTS = ("(direct)", "(none)", "N/A", "N/A", "N/A")
KEYS = ("source", "medium", "campaign", "content", "term")


@st.composite
def m1_event(draw):
    return {
        "sid": draw(st.sampled_from([1, 2, 3, None])),
        "dt": draw(st.integers(min_value=0, max_value=5)) * 1_000_000,      # few distinct times: ties
        "bundle": draw(st.integers(min_value=0, max_value=3)),
        "act": draw(st.sampled_from([None, "same", "far"])),
        "attr": draw(st.lists(st.sampled_from([None, "", "x", "y"]), min_size=5, max_size=5)),
    }


def py_model1(events, keep_null):
    """Brute force: per id, sort by (clock, bundle, server time, name); the
    first event gives the date, the first with any value the attribution."""
    groups = {}
    for i, e in enumerate(events):
        if e["sid"] is None and not keep_null:
            continue
        us = T0 + e["dt"]
        ms = us // 1000
        clock = ms if e["act"] in (None, "far") else ms + 17
        key = (clock, e["bundle"], us, "page_view", i)
        groups.setdefault(None if e["sid"] is None else f"u-{e['sid']}", []).append((key, e))
    out = {}
    for sid, rows in groups.items():
        rows.sort(key=lambda r: r[0])
        hit = next((e for _, e in rows if any(v not in (None, "") for v in e["attr"])), None)
        vals = tuple((hit["attr"][j] if hit and hit["attr"][j] not in (None, "") else DEFAULTS[j]) for j in range(5))
        out[sid] = vals
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=st.lists(m1_event(), min_size=1, max_size=25))
def test_model1_matches_brute_force(spark, events):
    rows = []
    for e in events:
        params = [] if e["sid"] is None else [p("ga_session_id", i=e["sid"])]
        us = T0 + e["dt"]
        if e["act"] == "same":
            params.append(p("actual_timestamp", i=us // 1000 + 17))
        elif e["act"] == "far":
            params.append(p("actual_timestamp", i=us // 1000 + 4 * 86_400_000))   # falls back to server time
        params += [p(k, s=v) for k, v in zip(KEYS, e["attr"]) if v is not None]
        rows.append({"event_date": "20240110", "event_timestamp": us, "event_bundle_sequence_id": e["bundle"],
                     "user_pseudo_id": "u", "event_name": "page_view", "event_params": params})
    ev = make_events(spark, rows)
    # Ties in (clock, bundle, server time, name) have no defined winner in
    # the original; compare only sessions whose order is total.
    for mode in ("intended", "as_written"):
        want = py_model1(events, keep_null=(mode == "as_written"))
        for form in ("aggregate", "window"):
            got = {r.unique_session_id: tuple(getattr(r, f"session_{k}") for k in KEYS)
                   for r in first_touch_sessions(ev, "2024-01-10", "2024-01-10",
                                                 SessionOptions(mode=mode, form=form)).collect()}
            assert set(got) == set(want)
            for sid, vals in want.items():
                members = [e for e in events if (None if e["sid"] is None else f"u-{e['sid']}") == sid]
                keys = [(e["dt"], e["bundle"], e["act"] == "same") for e in members]
                attributed = [any(v not in (None, "") for v in e["attr"]) for e in members]
                if len(set(keys)) == len(keys) and not any("*" in str(v) for v in vals) and any(attributed):
                    assert got[sid] == vals, (mode, form, sid)


# ---------------------------------------------------------------- Model 2

from hitsessions.operators.session_start import session_start_sessions  # noqa: E402


@st.composite
def m2_event(draw):
    return {
        "sid": draw(st.sampled_from([1, 2, None])),
        "name": draw(st.sampled_from(["session_start", "session_start", "page_view"])),
        "dt": draw(st.integers(min_value=0, max_value=4)) * 1_000_000,
        "bundle": draw(st.integers(min_value=0, max_value=3)),
        "url": draw(st.lists(pieces, max_size=6).map("".join)),
        "src": draw(st.sampled_from([None, "", "google", "N/A"])),
        "med": draw(st.sampled_from([None, "", "cpc", "N/A"])),
        "camp": draw(st.sampled_from([None, "(organic)", "brand"])),
    }


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=st.lists(m2_event(), min_size=1, max_size=25))
def test_model2_matches_brute_force(spark, events):
    rows = []
    for e in events:
        params = [] if e["sid"] is None else [p("ga_session_id", i=e["sid"])]
        for k, v in (("page_location", e["url"]), ("source", e["src"]), ("medium", e["med"]), ("campaign", e["camp"])):
            if v is not None:
                params.append(p(k, s=v))
        rows.append({"event_date": "20240110", "event_timestamp": T0 + e["dt"], "event_bundle_sequence_id": e["bundle"],
                     "user_pseudo_id": "u", "event_name": e["name"], "event_params": params})
    ev = make_events(spark, rows)
    got = {r.unique_session_id: (r.session_source, r.session_medium, r.session_campaign)
           for r in session_start_sessions(ev, "2024-01-10", "2024-01-10").collect()}
    groups = {}
    for e in events:
        if e["name"] == "session_start" and e["sid"] is not None:
            groups.setdefault(f"u-{e['sid']}", []).append(e)
    assert set(got) == set(groups)
    for sid, members in groups.items():
        keys = [(e["dt"], e["bundle"]) for e in members]
        first = min(members, key=lambda e: (e["dt"], e["bundle"]))
        if keys.count((first["dt"], first["bundle"])) > 1:
            continue   # a complete tie has no defined winner in the original
        na = lambda v: "N/A" if v is None else v
        s, m, c, _, _ = py_rules(first["url"], na(first["src"]), na(first["med"]), na(first["camp"]))
        assert got[sid] == (s, m, c), (sid, first)
