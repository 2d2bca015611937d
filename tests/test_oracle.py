"""Every registered query against its DuckDB oracle, on the small fixture."""

import math

import duckdb
import pytest

from hitsessions.plans.registry import ORACLES, QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
                   "int": "INTEGER"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.sql(ORACLES[name])
    idx = {c: i for i, c in enumerate(res.columns)}
    assert sorted(res.columns) == cols
    spark_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == dict(zip(res.columns, map(str, res.types)))
    want = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in res.fetchall()), key=repr)
    assert len(got) > 0
    assert got == want
