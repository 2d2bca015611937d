from hitsessions.functions.params import (event_param, int_param, string_param,
                                          unique_session_id)
from hitsessions.functions.clock import (safe_actual_ts_ms, register_sql_functions,
                                         format_micros, micros_to_date, parse_yyyymmdd,
                                         yyyymmdd, iso_date, idiv, whole_days_between)
from hitsessions.functions.text import (regexp_contains, regexp_extract_or_null,
                                        split_keep_empty)

__all__ = [
    "event_param", "int_param", "string_param", "unique_session_id",
    "safe_actual_ts_ms", "register_sql_functions", "format_micros", "micros_to_date",
    "parse_yyyymmdd", "yyyymmdd", "iso_date", "idiv", "whole_days_between",
    "regexp_contains", "regexp_extract_or_null", "split_keep_empty",
]
