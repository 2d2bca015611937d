"""The fixture lens: the driver's ``events`` table seen as an analytics
export (see FIXTURES.md section 2).

A deterministic projection, so Spark and an independent SQL engine can
both evaluate it. Timestamps are cut to the hour so the bundle-id
tie-break matters; session ids are two-day buckets shifted by 12 h so
sessions cross midnight; parameter values cover the attribution rules.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitsessions.functions.clock import micros_to_date, yyyymmdd

# Fixed values of the lens (FIXTURES.md section 2).
HOUR_US = 3_600_000_000
SOURCES = {1: "google", 2: "google", 4: "newsletter", 6: "", 7: "a*b"}
MEDIUMS = {1: "organic", 2: "cpc", 4: "email", 6: "", 7: "referral"}
CAMPAIGNS = {1: "(organic)", 2: "summer", 5: "brand", 7: "(referral)"}
CONTENTS = {2: "ad1"}
TERMS = {2: "shoes"}
URL_PREFIX = "https://shop.example/p/"
URL_TAILS = {
    1: "", 2: "?gclid=G1", 3: "?fbclid=F1", 4: "?msclid=M1", 5: "?hgtid=H1",
    6: "?UTM_Campaign=Promo&x=1", 7: "?utm_campaign=", 8: "?utm_campaign=a#frag",
    9: "?x=1&gclid=G2&utm_campaign=g", 10: "?dgclid=zz&fbclid=F2", 11: "?utm_source=q",
}

# Parameter keys in the order they are put into the array.
LENS_INT_KEYS = ("ga_session_id", "ga_session_number", "actual_timestamp")
LENS_STRING_KEYS = ("page_location", "source", "medium", "campaign", "content", "term")


def _case(c: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(F.lit(None).cast("string"))


def _idiv(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def flat_events(events: DataFrame) -> DataFrame:
    """The flat lens: one column ``p_<key>`` per parameter."""
    e, u = F.col("event_id"), F.col("user_id")
    # Whole hours since the epoch of the ``timestamp_ntz`` column, from its
    # date and hour fields: no cast to a zoned timestamp, so the result
    # does not depend on the session time zone.
    hours = F.datediff(F.to_date(F.col("ts")), F.lit("1970-01-01").cast("date")).cast("long") * 24 \
        + F.hour(F.col("ts")).cast("long")
    us = hours * HOUR_US
    b = events.select(e.alias("e"), u.alias("u"), "event_type", us.alias("us"))
    c = b.select("*", _idiv(F.col("us"), 1000).alias("ms"),
                 (_idiv(F.col("e"), 12) % 8).alias("si"), (F.col("e") % 12).alias("pi"))
    e, u, us, ms, si, pi = (F.col(x) for x in ("e", "u", "us", "ms", "si", "pi"))
    user = F.when(u % 50 == 49, F.lit(None).cast("string")).otherwise(
        F.concat(u.cast("string"), F.lit("."), (u * 7919).cast("string")))
    name = (F.when(F.col("event_type") == "view", F.lit("session_start"))
            .when(F.col("event_type") == "signup", F.lit("page_view"))
            .otherwise(F.col("event_type")))
    sid = F.when(e % 97 == 0, F.lit(None).cast("long")).otherwise(
        _idiv(_idiv(us, 1_000_000) + 43200, 172800))
    snum = F.when(e % 19 == 0, F.lit(None).cast("long")).otherwise(1 + e % 5)
    act = (F.when(e % 5 == 0, F.lit(None).cast("long"))
           .when(e % 11 == 0, ms + 259_200_000)
           .when(e % 13 == 0, ms - 259_199_999)
           .when(e % 17 == 0, F.lit(0).cast("long"))
           .otherwise(ms - e % 2000))
    url = F.when(pi == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(URL_PREFIX), e.cast("string"), _case(pi, URL_TAILS)))
    day = micros_to_date(us)
    return c.select(
        e.alias("event_id"),
        us.alias("event_timestamp"),
        (F.lit(10_000_000) - e).alias("event_bundle_sequence_id"),
        user.alias("user_pseudo_id"),
        name.alias("event_name"),
        sid.alias("p_ga_session_id"),
        snum.alias("p_ga_session_number"),
        act.alias("p_actual_timestamp"),
        _case(si, SOURCES).alias("p_source"),
        _case(si, MEDIUMS).alias("p_medium"),
        _case(si, CAMPAIGNS).alias("p_campaign"),
        _case(si, CONTENTS).alias("p_content"),
        _case(si, TERMS).alias("p_term"),
        url.alias("p_page_location"),
        yyyymmdd(day).alias("event_date"),
        yyyymmdd(day).alias("suffix"),
    )


def nest_params(flat: DataFrame) -> DataFrame:
    """Turn each non-null ``p_<key>`` into one element of ``event_params``."""
    from hitsessions.sources.export import params_type
    empty = F.array().cast(params_type(narrow=False))

    def entry(key, s=None, i=None):
        # A one-element array when the value is present, else an empty one;
        # concatenated below. (No lambda, so the projection stays in codegen.)
        v = s if s is not None else i
        e = F.struct(F.lit(key).alias("key"),
                     F.struct((s if s is not None else F.lit(None).cast("string")).alias("string_value"),
                              (i if i is not None else F.lit(None).cast("long")).alias("int_value"),
                              F.lit(None).cast("float").alias("float_value"),
                              F.lit(None).cast("double").alias("double_value")).alias("value"))
        return F.when(v.isNotNull(), F.array(e)).otherwise(empty)
    entries = ([entry(k, i=F.col(f"p_{k}")) for k in LENS_INT_KEYS]
               + [entry(k, s=F.col(f"p_{k}")) for k in LENS_STRING_KEYS])
    present = F.concat(*entries)
    return flat.select("event_id", "event_date", "event_timestamp", "event_bundle_sequence_id",
                       "user_pseudo_id", "event_name", present.alias("event_params"), "suffix")


def lens_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested, export-shaped events derived from ``<sf_dir>/events.parquet``."""
    return nest_params(flat_events(spark.read.parquet(f"{sf_dir}/events.parquet")))


def lens_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


_EXPORTS: dict = {}
EVENT_ID = (T.StructField("event_id", T.LongType()),)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def lens_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lens written once per session as a sharded export, read back.

    Queries then start from Parquet shards like a real export: partition
    pruning on ``suffix``, pushed filters, nested pruning of
    ``event_params``, and short plans (the lens expressions are not
    inlined into every downstream filter).
    """
    from hitsessions.session import new_work_path
    from hitsessions.sources.export import read_export, write_export

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    path = _EXPORTS.get(key)
    # The committer moves output into place at job commit, so an existing
    # folder is a complete one.
    if path is None or not _exists(spark, path):
        path = new_work_path(spark, "lens-export")
        write_export(lens_events(spark, sf_dir), path)
        _EXPORTS[key] = path
    return read_export(spark, path, narrow=False, extra=EVENT_ID)
