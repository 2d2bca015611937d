"""The jobs as SQL table functions (section 2.14).

    register_table_functions(spark, "export_events")
    spark.sql("SELECT * FROM model1_sessions(DATE'2024-01-01', DATE'2024-01-31', 'intended')")

``model1_sessions``, ``model2_sessions`` and ``model_comparison`` take the
first and the last day (NULL: the default window) and the mode. Their
bodies are SQL over the view of the export's events, which Spark inlines
into the calling query: the shard filter, the pushed ``event_name`` and
the pruned parameter reads are those of a query written out, and the mode,
a literal in the call, folds away. For users who have SQL only; results
equal the DataFrame operators'.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hitsessions.functions.clock import safe_actual_ts_sql
from hitsessions.operators import attribution as A

_M2_TEXTS = ("page_location", "source", "medium", "campaign", "term", "content")


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _param(key: str, kind: str) -> str:
    return (f"get(event_params.value.{kind}_value, "
            f"CAST(array_position(event_params.key, {_q(key)}) - 1 AS INT))")


def _clock(us: str, zone: str) -> str:
    return (f"date_format(convert_timezone('UTC', {_q(zone)}, timestampadd(MICROSECOND, {us}, "
            "timestamp_ntz'1970-01-01 00:00:00')), 'yyyy-MM-dd HH:mm:ss')")


_WRITTEN = "run_mode = 'as_written'"
_ACTUAL_US = f"CASE WHEN {_WRITTEN} THEN act_ms ELSE try_multiply(act_ms, 1000) END"


def _safe(tolerance_days: int) -> str:
    return (safe_actual_ts_sql(tolerance_days).replace("param_actual_ts_ms", _param("actual_timestamp", "int"))
            .replace("event_ts_micros", "event_timestamp"))


def _events(view: str, tolerance_days: int, columns: str, where: str = "") -> str:
    """Rows of the window with a user, the order key's parts and the session id."""
    return f"""
  SELECT to_date(event_date, 'yyyyMMdd') AS session_date, event_timestamp AS evt_us, {_safe(tolerance_days)} AS act_ms,
         event_bundle_sequence_id AS bundle, event_name,
         concat(user_pseudo_id, '-', CAST({_param('ga_session_id', 'int')} AS STRING)) AS usid, {columns}
  FROM {view}
  WHERE regexp_extract(suffix, '[0-9]+', 0) BETWEEN date_format(coalesce(first_day, date_sub(current_date(), 2)), 'yyyyMMdd')
        AND date_format(coalesce(last_day, date_sub(current_date(), 1)), 'yyyyMMdd')
    AND user_pseudo_id IS NOT NULL {where}"""


def _key(clock: str, payload: str) -> str:
    first = "coalesce(act_ms, evt_us)" if clock == "safe" else "evt_us"
    # In as-written mode nothing but the named columns orders events.
    return (f"named_struct('ts', {first}, 'bundle', bundle, 'us', evt_us, 'name', event_name, "
            f"'tie', CASE WHEN {_WRITTEN} THEN 0 ELSE xxhash64({payload}) END)")


def model1_body(view: str, zone: str, tolerance_days: int) -> str:
    values = ", ".join(f"{_param(k, 'string')} AS p_{k}" for k in A.M1_KEYS)
    joined = f"concat_ws({_q(A.DELIMITER)}, " + ", ".join(f"coalesce(p_{k}, '')" for k in A.M1_KEYS) + ")"
    parts = f"CASE WHEN {_WRITTEN} THEN split({joined}, '\\\\*', -1) ELSE array({', '.join(f'p_{k}' for k in A.M1_KEYS)}) END"
    finals = ", ".join(f"coalesce(nullif(get(attr, {i}), ''), {_q(A.M1_DEFAULTS[k])}) AS session_{k}"
                       for i, k in enumerate(A.M1_KEYS))
    return f"""
WITH ev AS ({_events(view, tolerance_days, values)}
), marked AS (
  SELECT *, {parts} AS vals, {joined} <> {_q(A.EMPTY_CONCAT)} AS attributed FROM ev WHERE {_WRITTEN} OR usid IS NOT NULL
), keyed AS (
  SELECT *, {_key('safe', 'evt_us, act_ms, bundle, event_name, session_date, vals')} AS k FROM marked
), sessions AS (
  SELECT usid, min(named_struct('k', k, 'd', session_date, 'act_ms', act_ms)) AS f,
         min_by(vals, CASE WHEN attributed THEN k END) AS attr
  FROM keyed GROUP BY usid
), first_rows AS (SELECT usid, f.d AS session_date, f.k.us AS evt_us, f.act_ms AS act_ms, attr FROM sessions)
SELECT session_date, usid, {_clock('evt_us', zone)}, {_clock(_ACTUAL_US, zone)}, {finals} FROM first_rows"""


def _fold(rules: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {otherwise} END"


def _channel() -> tuple[str, str, str]:
    """Source, medium and campaign (step 1) by the built-in rules."""
    has = {n: f"contains(page_location, {_q(p)})" for n, p in A.CLICK_ID_PATTERNS.items()}
    na = _q(A.NA)
    unlabelled = f"source = {na} AND medium = {na}"
    return (_fold([(has["gclid"], "'google'"), (has["fbclid"], "'facebook'"), (has["msclid"], "'bing'"),
                   (has["hgtid"], "'heureka.cz'"), (unlabelled, "'direct'")], "source"),
            _fold([(has["gclid"], "'cpc'"), (f"{has['fbclid']} AND campaign = {na}", "'referral'"),
                   (unlabelled, "'(none)'")], "medium"),
            _fold([(f"{has['gclid']} AND campaign IN ('(organic)', '(referral)')", na)], "campaign"))


def _url(name: str) -> str:
    p = _q(A.URL_PATTERNS[name])
    return f"CASE WHEN page_location RLIKE {p} THEN regexp_extract(page_location, {p}, 1) ELSE {_q(A.NA)} END"


def _model2_rows(view: str, tolerance_days: int, clock: str) -> str:
    """CTEs up to ``ruled``: the first session_start row of each id with its channel."""
    texts = ", ".join(f"coalesce({_param(k, 'string')}, {_q(A.NA)}) AS {k}" for k in _M2_TEXTS)
    number = f"coalesce({_param('ga_session_number', 'int')}, -1) AS gsn"
    payload = "session_date, evt_us, act_ms, gsn, " + ", ".join(_M2_TEXTS)
    carried = ", ".join(f"'{c}', {c}" for c in ("session_date", "evt_us", "act_ms", "gsn", *_M2_TEXTS))
    source, medium, campaign = _channel()
    return f"""
WITH ev AS ({_events(view, tolerance_days, f'{number}, {texts}', "AND event_name = 'session_start'")}
), keyed AS (
  SELECT *, {_key(clock, payload)} AS k FROM ev WHERE {_WRITTEN} OR usid IS NOT NULL
), sessions AS (
  SELECT usid, min(named_struct('k', k, {carried})) AS f FROM keyed GROUP BY usid
), first_rows AS (SELECT usid, f.* FROM sessions
), ruled AS (
  SELECT *, {source} AS s_source, {medium} AS s_medium, {campaign} AS s_campaign, {_url('utm_campaign_url')} AS utm FROM first_rows
)"""


_CAMPAIGN = f"CASE WHEN s_campaign = {_q(A.NA)} THEN utm ELSE s_campaign END"


def model2_body(view: str, zone: str, tolerance_days: int) -> str:
    return f"""{_model2_rows(view, tolerance_days, 'safe')}
SELECT session_date, usid, {_clock('evt_us', zone)}, {_clock(_ACTUAL_US, zone)}, gsn, page_location, source, s_source,
       medium, s_medium, campaign, {_CAMPAIGN}, term, content, utm, {_url('gclid_url')} FROM ruled"""


def comparison_body(view: str, tolerance_days: int, model1: str) -> str:
    channel = "session_source, session_medium, session_campaign"
    first = "coalesce(first_day, date_sub(current_date(), 2))"
    last = "coalesce(last_day, date_sub(current_date(), 1))"
    return f"""{_model2_rows(view, tolerance_days, 'server')}, ss AS (
  SELECT session_date AS d, sum(n) AS total, count(*) AS channels FROM (
    SELECT session_date, s_source, s_medium, {_CAMPAIGN} AS s_final, count(DISTINCT usid) AS n
    FROM ruled GROUP BY session_date, s_source, s_medium, {_CAMPAIGN}) GROUP BY session_date
), fe AS (
  SELECT session_date AS d, sum(n) AS total, count(*) AS channels FROM (
    SELECT session_date, {channel}, count(DISTINCT unique_session_id) AS n FROM {model1}(first_day, last_day, run_mode)
    WHERE session_date BETWEEN {first} AND {last} GROUP BY session_date, {channel}) GROUP BY session_date
), both AS (
  -- As written, each side is counted once per channel row of the other side.
  SELECT ss.d, CASE WHEN {_WRITTEN} THEN ss.total * coalesce(fe.channels, 1) ELSE ss.total END AS n2,
         CASE WHEN {_WRITTEN} THEN fe.total * ss.channels ELSE fe.total END AS n1
  FROM ss LEFT JOIN fe ON ss.d = fe.d
)
SELECT date_format(d, 'yyyy-MM-dd'), CAST(n2 AS BIGINT), CAST(n1 AS BIGINT), round((try_divide(n2, n1) - 1) * 100, 2) FROM both"""


_M1_OUT = ("session_date DATE, unique_session_id STRING, event_timestamp STRING, actual_timestamp STRING, "
           + ", ".join(f"session_{k} STRING" for k in A.M1_KEYS))
_M2_OUT = ("session_date DATE, unique_session_id STRING, event_timestamp STRING, actual_timestamp STRING, "
           "ga_session_number BIGINT, page_location STRING, session_source_orig STRING, session_source STRING, "
           "session_medium_orig STRING, session_medium STRING, session_campaign_orig STRING, session_campaign STRING, "
           "session_term STRING, session_content STRING, utm_campaign_url STRING, gclid_url STRING")
_REPORT_OUT = ("date STRING, cnt_sessions_model2_session_start BIGINT, cnt_sessions_model1_first_event BIGINT, "
               "diff_pct DOUBLE")


def register_table_functions(spark: SparkSession, events_view: str, zone: str = "Europe/Prague", tolerance_days: int = 2,
                             prefix: str = "") -> list[str]:
    """Create the three table functions over a view of export events; returns their names."""
    bodies = {
        f"{prefix}model1_sessions": (_M1_OUT, model1_body(events_view, zone, tolerance_days)),
        f"{prefix}model2_sessions": (_M2_OUT, model2_body(events_view, zone, tolerance_days)),
        f"{prefix}model_comparison": (_REPORT_OUT, comparison_body(events_view, tolerance_days, f"{prefix}model1_sessions")),
    }
    for name, (returns, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(first_day DATE, last_day DATE, "
                  f"run_mode STRING DEFAULT 'intended') RETURNS TABLE({returns}) RETURN {body}")
    return list(bodies)
