"""Lookups into the repeated key/value parameter record (N1-N4) and the
unique session id (J1).

The record is ``array<struct<key, value: struct<string_value, int_value, ...>>>``.
A key that is absent is not in the array and reads as NULL. The array is
not turned into a map: ``map_from_entries`` fails on a duplicated key of
*any* name, even one that is never read.

A lookup is ``get(event_params.value.X, array_position(event_params.key, K) - 1)``:
the field extraction through the array, ``array_position`` (first match,
0 when absent) and ``get`` (NULL out of range) are all code-generated,
where a ``filter`` lambda would fall back to interpreted evaluation and
break the whole-stage codegen of its operator. Reading only
``event_params.key`` and ``event_params.value.X`` also lets nested schema
pruning narrow the Parquet read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAMS = "event_params"

# Keys read by the session models, with the value member each one uses.
INT_KEYS = ("actual_timestamp", "ga_session_id", "ga_session_number")
STRING_KEYS = ("page_location", "source", "medium", "campaign", "content", "term")
ATTRIBUTION_KEYS = ("source", "medium", "campaign", "content", "term")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_param(key: str, kind: str = "string", params="event_params", strict: bool = False) -> Column:
    """Value of parameter ``key``; NULL when absent.

    ``kind`` names the value member (``string``, ``int``, ``float``,
    ``double``). With several entries of the same key the first in array
    order wins, unless ``strict`` asks for an error instead.
    """
    arr = _col(params)
    keys = arr["key"]
    pos = F.array_position(keys, F.lit(key))
    value = F.get(arr["value"][f"{kind}_value"], (pos - F.lit(1)).cast("int"))
    if strict:
        return F.when(key_count(key, arr) > 1,
                      F.raise_error(F.lit(f"parameter {key!r} occurs more than once"))
                      ).otherwise(value)
    return value


def int_param(key: str, params="event_params", strict: bool = False) -> Column:
    return event_param(key, "int", params, strict)


def string_param(key: str, params="event_params", strict: bool = False) -> Column:
    return event_param(key, "string", params, strict)


def key_count(key: str, params="event_params") -> Column:
    """Entries of ``key`` in the array: the size drop when all of them are removed (0 without an array)."""
    keys = _col(params)["key"]
    return F.coalesce(F.size(keys) - F.size(F.array_remove(keys, F.lit(key))), F.lit(0))


def duplicate_counts(events: DataFrame, keys, params: str = "event_params") -> DataFrame:
    """key, n_events, n_duplicated: events with the key, and with more than one entry of it.

    What a strict lookup would raise on, before a run with it; one pass.
    """
    counts = [(k, key_count(k, params)) for k in keys]
    one = events.agg(*[f(n).alias(f"{p}_{i}") for i, (_, n) in enumerate(counts)
                       for p, f in (("e", lambda n: F.count_if(n > 0)), ("d", lambda n: F.count_if(n > 1)))])
    rows = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"e_{i}").alias("n_events"), F.col(f"d_{i}").alias("n_duplicated"))
                     for i, (k, _) in enumerate(counts)])
    return one.select(F.inline(rows))


def unique_session_id(user_pseudo_id="user_pseudo_id", ga_session_id=None) -> Column:
    """``user_pseudo_id || '-' || ga_session_id``; NULL if either is NULL.

    The session number alone is not unique across users, so the user id
    is put in front of it.
    """
    sid = int_param("ga_session_id") if ga_session_id is None else _col(ga_session_id)
    return F.concat(_col(user_pseudo_id), F.lit("-"), sid.cast("string"))
