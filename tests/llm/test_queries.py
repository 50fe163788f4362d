"""Registered queries: the SQL of those that have it, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerframe.llm import queries

from .conftest import rows_of

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES) <= set(E.queries())
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(queries.ORACLE[name])
    cols = sorted(d[0] for d in cur.description)
    want = [dict(zip([d[0] for d in cur.description], r, strict=True)) for r in cur.fetchall()]
    got = rows_of(queries.QUERIES[name](spark, SF))
    assert sorted(got[0]) == cols
    key = lambda r: [str(r[c]) for c in cols]
    assert sorted(map(key, got)) == sorted(map(key, want))
