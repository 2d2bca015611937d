"""Client clock correction (J2) and time formatting.

All arithmetic is on integers, so results never depend on the session
time zone of Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a, b) -> Column:
    """Integer division truncated toward zero (``DIV``)."""
    return F.call_function("div", _col(a), b if isinstance(b, Column) else F.lit(b))


def whole_days_between(a_ms, b_ms) -> Column:
    """Whole 24-hour periods from ``b`` to ``a``, truncated toward zero.

    Not ``timestampdiff(DAY, ...)``: that counts calendar days in the
    session time zone, so 71 h across a daylight-saving change counts 3.
    NULL when the difference overflows.
    """
    return idiv(F.try_subtract(_col(a_ms), _col(b_ms)), MS_PER_DAY)


def safe_actual_ts_ms(param_ms, event_us, tolerance_days: int = 2) -> Column:
    """Client time in ms if it lies within the tolerance of the server
    time, else the server time in ms.

    ``c = coalesce(param, event_us div 1000)``; the client value is kept
    while ``|c - e|`` is under ``(tolerance_days + 1) * 24 h`` (whole days
    are truncated before the comparison). With no server time the client
    value passes, with neither the result is NULL. A difference too large
    for a bigint counts as too far.
    """
    e = idiv(_col(event_us), 1000)
    c = F.coalesce(_col(param_ms), e)
    days = whole_days_between(c, e)
    too_far = F.abs(days) > F.lit(tolerance_days)
    overflow = days.isNull() & c.isNotNull() & e.isNotNull()
    return F.when(too_far | overflow, e).otherwise(c)


def safe_actual_ts_sql(tolerance_days: int = 2) -> str:
    """Body of the SQL form of :func:`safe_actual_ts_ms`."""
    return (
        "CASE WHEN abs(div(try_subtract(coalesce(param_actual_ts_ms, div(event_ts_micros, 1000)), "
        "div(event_ts_micros, 1000)), 86400000)) > {t} "
        "OR (try_subtract(coalesce(param_actual_ts_ms, div(event_ts_micros, 1000)), div(event_ts_micros, 1000)) IS NULL "
        "AND param_actual_ts_ms IS NOT NULL AND event_ts_micros IS NOT NULL) "
        "THEN div(event_ts_micros, 1000) "
        "ELSE coalesce(param_actual_ts_ms, div(event_ts_micros, 1000)) END"
    ).format(t=int(tolerance_days))


def register_sql_functions(spark, tolerance_days: int = 2) -> None:
    """``safe_actual_ts_ms(param_actual_ts_ms, event_ts_micros)`` for SQL users."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION safe_actual_ts_ms("
        "param_actual_ts_ms BIGINT, event_ts_micros BIGINT) RETURNS BIGINT "
        f"RETURN {safe_actual_ts_sql(tolerance_days)}"
    )


def micros_to_utc_ntz(us) -> Column:
    """Epoch microseconds as a UTC wall-clock ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", _col(us), F.expr(EPOCH_NTZ))


def format_micros(us, zone: str = "Europe/Prague", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch microseconds formatted as wall-clock time in ``zone``.

    ``timestamp_micros`` + ``from_utc_timestamp`` would shift twice when
    the session zone is not UTC; working on ``timestamp_ntz`` keeps the
    result independent of it.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), micros_to_utc_ntz(us))
    return F.date_format(local, fmt)


def micros_to_date(us) -> Column:
    """UTC calendar date of an epoch-microsecond instant."""
    return F.to_date(micros_to_utc_ntz(us))


def parse_yyyymmdd(s, lenient: bool = False) -> Column:
    """``PARSE_DATE('%Y%m%d', s)``: an error on bad text unless ``lenient``."""
    fn = F.try_to_date if lenient else F.to_date
    return fn(_col(s), "yyyyMMdd")


def yyyymmdd(d) -> Column:
    return F.date_format(_col(d), "yyyyMMdd")


def iso_date(d) -> Column:
    return F.date_format(_col(d), "yyyy-MM-dd")
