"""Truth tables of the column functions."""

import pytest
from pyspark.sql import functions as F

from hitsessions.functions import clock as C
from hitsessions.functions import params as P
from hitsessions.functions import text as TX
from hitsessions.operators import attribution as A
from tests.conftest import make_events, p

DAY = 86_400_000
E_US = 1_705_000_000_000_000          # a server time in microseconds
E_MS = E_US // 1000


@pytest.mark.parametrize("param,event_us,expected", [
    (None, E_US, E_MS),                          # no client clock: server time
    (E_MS + 3 * DAY - 1, E_US, E_MS + 3 * DAY - 1),   # 1 ms under 72 h: kept
    (E_MS + 3 * DAY, E_US, E_MS),               # exactly 72 h: fallback
    (E_MS - 3 * DAY + 1, E_US, E_MS - 3 * DAY + 1),
    (E_MS - 3 * DAY, E_US, E_MS),
    (0, E_US, E_MS),                             # client clock at 1970
    (E_MS + 2 * DAY, E_US, E_MS + 2 * DAY),     # "2 days" kept
    (12345, None, 12345),                        # no server time: client passes
    (None, None, None),
    (9_223_372_036_854_775_000, E_US, E_MS),    # difference overflows: fallback
    (-9_223_372_036_854_775_000, E_US, E_MS),
])
def test_safe_actual_ts(spark, param, event_us, expected):
    df = spark.createDataFrame([(param, event_us)], "p bigint, e bigint")
    got = df.select(C.safe_actual_ts_ms("p", "e").alias("r")).first().r
    assert got == expected
    C.register_sql_functions(spark)
    df.createOrReplaceTempView("clock_case")
    assert spark.sql("SELECT safe_actual_ts_ms(p, e) AS r FROM clock_case").first().r == expected


def test_tolerance_parameter(spark):
    df = spark.createDataFrame([(E_MS + 3 * DAY, E_US)], "p bigint, e bigint")
    assert df.select(C.safe_actual_ts_ms("p", "e", tolerance_days=3).alias("r")).first().r == E_MS + 3 * DAY


def test_div_truncates_toward_zero(spark):
    r = spark.range(1).select(C.idiv(F.lit(-1500), 1000).alias("a"), C.idiv(F.lit(1500), 1000).alias("b")).first()
    assert (r.a, r.b) == (-1, 1)


@pytest.mark.parametrize("us,expected", [
    (1711846800000000, "2024-03-31 03:00:00"),   # spring forward
    (1729989000000000, "2024-10-27 02:30:00"),   # fall back, first pass
    (1729992600000000, "2024-10-27 02:30:00"),   # fall back, second pass
    (0, "1970-01-01 01:00:00"),
    (None, None),
])
def test_prague_format_any_session_zone(spark, us, expected):
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(us,)], "us bigint")
        assert df.select(C.format_micros("us").alias("f")).first().f == expected
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_whole_days_not_calendar_days(spark):
    # 71 h across the spring change is 2 whole days, not 3.
    a = 1711846800000 + 71 * 3_600_000
    r = spark.range(1).select(C.whole_days_between(F.lit(a), F.lit(1711846800000)).alias("d")).first()
    assert r.d == 2


def test_param_lookup(spark):
    ev = make_events(spark, [
        {"event_params": [p("source", s="a"), p("ga_session_id", i=7), p("source", s="b")]},
        {"event_params": []},
        {"event_params": None},
        {"event_params": [p("source", s=None, i=5)]},
    ])
    rows = ev.select(P.string_param("source").alias("s"), P.int_param("ga_session_id").alias("g"),
                     P.string_param("medium").alias("m")).collect()
    assert [tuple(r) for r in rows] == [("a", 7, None), (None, None, None), (None, None, None), (None, None, None)]


def test_param_strict_duplicates(spark):
    ev = make_events(spark, [{"event_params": [p("source", s="a"), p("source", s="b")]}])
    with pytest.raises(Exception):
        ev.select(P.string_param("source", strict=True)).collect()
    # A duplicated key that is not read does not fail a strict lookup.
    assert ev.select(P.string_param("medium", strict=True).alias("m")).first().m is None


def test_unique_session_id(spark):
    ev = make_events(spark, [
        {"user_pseudo_id": "u1", "event_params": [p("ga_session_id", i=42)]},
        {"user_pseudo_id": None, "event_params": [p("ga_session_id", i=42)]},
        {"user_pseudo_id": "u1", "event_params": []},
    ])
    got = [r.k for r in ev.select(P.unique_session_id().alias("k")).collect()]
    assert got == ["u1-42", None, None]


def test_regexp_extract_null_vs_empty(spark):
    df = spark.createDataFrame([("x?utm_campaign=",), ("x?a=1",), ("x?UTM_CAMPAIGN=Big&y",), (None,)], "u string")
    got = [r.c for r in df.select(TX.regexp_extract_or_null("u", r"(?i)utm_campaign=([^&]*)").alias("c")).collect()]
    assert got == ["", None, "Big", None]


def test_contains_fast_path_and_regex(spark):
    df = spark.createDataFrame([("a?dgclid=1",), ("a?x=1",)], "u string")
    assert [r.c for r in df.select(TX.regexp_contains("u", "gclid=").alias("c")).collect()] == [True, False]
    assert [r.c for r in df.select(TX.regexp_contains("u", "[?&]gclid=").alias("c")).collect()] == [False, False]


def test_concat_split_transport(spark):
    df = spark.createDataFrame([("a*b", "m", None, "", "t"), (None, "", None, None, ""), ("", "", "", "", "")],
                               "s string, m string, c string, n string, t string")
    cols = [F.col(c) for c in "smcnt"]
    out = df.select(A.concat_attribution(cols).alias("j")).select(
        "j", *[c.alias(f"p{i}") for i, c in enumerate(A.split_attribution(F.col("j")))]).collect()
    assert out[0].j == "a*b*m***t"
    # The '*' inside a value shifts the columns, as in the original.
    assert (out[0].p0, out[0].p1, out[0].p2, out[0].p3, out[0].p4) == ("a", "b", "m", "", "")
    assert out[1].j is None and out[1].p0 is None
    assert out[2].j is None


def test_split_keeps_trailing_empties(spark):
    df = spark.createDataFrame([("****",)], "s string")
    assert df.select(F.size(TX.split_keep_empty("s", "*")).alias("n")).first().n == 5


def test_parse_date_strict_and_lenient(spark):
    df = spark.createDataFrame([("2024013x",)], "d string")
    with pytest.raises(Exception):
        df.select(C.parse_yyyymmdd("d")).collect()
    assert df.select(C.parse_yyyymmdd("d", lenient=True).alias("x")).first().x is None
