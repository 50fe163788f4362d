import hashlib
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from ledgerframe.llm import exact_dedup as D

from .conftest import rows_of


def sha(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


@pytest.mark.parametrize("support", [0.001, 0.1, 0.5])
def test_report_matches_brute_force(edge_docs, support):
    groups = defaultdict(list)
    for r in edge_docs.collect():
        groups[sha(r.text)].append(r.doc_id)
    got = rows_of(D.exact_duplicates(edge_docs, support=support))
    assert len(got) == edge_docs.count()
    by_sha = defaultdict(list)
    for r in got:
        by_sha[r["text_sha256"]].append(r)
    assert set(by_sha) == set(groups)
    for s, ids in groups.items():
        rows = by_sha[s]
        keep = max((i for i in ids if i is not None), default=None)
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, ids))
        assert {r["keep_id"] for r in rows} == {keep}
        assert {r["group_size"] for r in rows} == {len(ids)}
        assert [r["doc_id"] for r in rows if r["kept"]] == [keep]


def test_heavy_digest_is_found_and_settled_before_the_shuffle(edge_docs):
    rows = D.digests(edge_docs)
    heavy = rows_of(D.heavy_digests(rows, 0.2))
    assert [(h["sha"], h["top_id"], h["heavy_size"]) for h in heavy] \
        == [(sha("copied text of a hot group"), 139, 40)]


def test_light_digests_are_not_heavy(spark):
    rows = spark.range(5000).selectExpr("id", "sha2(cast(id as string), 256) as sha")
    assert D.heavy_digests(rows, 0.01).count() == 0


def test_drop_keeps_one_whole_row_of_each_text(edge_docs):
    kept = D.drop_exact_duplicates(edge_docs, support=0.2)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    assert sorted(sha(r.text) for r in rows) == sorted({sha(r.text) for r in edge_docs.collect()})
    assert {r.doc_id for r in rows if r.text == "copied text of a hot group"} == {139}


def test_empty_table(no_docs):
    assert D.exact_duplicates(no_docs).count() == 0
    assert D.drop_exact_duplicates(no_docs).count() == 0


def test_no_python_in_the_plan(edge_docs):
    plan = D.exact_duplicates(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("hot_id", [7, None])
def test_rows_that_repeat_id_and_text_are_settled_without_a_shuffle(spark, hot_id):
    """A third of the rows is one row repeated: one stays, and the shuffled part of the
    report holds none of them."""
    rows = [(hot_id, "hot")] * 300 + [(i, f"text {i % 400}") for i in range(10, 610)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    report = D.exact_duplicates(docs, support=0.1)
    got = rows_of(report)
    hot = [r for r in got if r["text_sha256"] == sha("hot")]
    assert len(got) == 900 and len(hot) == 300 and sum(r["kept"] for r in hot) == 1
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in hot} == {(hot_id, hot_id, 300)}
    assert sum(r["kept"] for r in got) == 401
    numbered = D.digests(docs).withColumn("number", F.monotonically_increasing_id())
    found = D.heavy_digests(numbered, 0.1)
    assert found.count() == D._with_stay(numbered, found).count() == 1
