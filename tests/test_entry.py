"""Driver contract: entry(), queries(), oracle_sql() - and every query with an
oracle compared to DuckDB on sf0.001."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "pct_price_change" in df.columns


def test_every_query_has_oracle_or_is_listed():
    assert set(E.QUERIES) <= set(E.queries())
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon(dcols, cur.fetchall())


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_types_match_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    duck = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for f in sdf.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck[f.name], (name, f.name)
