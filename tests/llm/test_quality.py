import zlib

import numpy as np
import pandas as pd

from ledgerframe.llm import quality as Q

from .conftest import rows_of

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in rows_of(Q.score(docs, Q.train(docs, labels)))}
    assert set(got) == set(pd.read_parquet(f"{SF}/documents.parquet")["doc_id"])
    marks = pd.read_parquet(f"{SF}/labels.parquet")
    held = [(i, q) for i, q in zip(marks["doc_id"], marks["quality"]) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i, _ in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert np.mean([got[i]["predicted"] == q for i, q in held]) > 0.95
    assert np.mean([got[i]["predicted"] for i, q in held if q == 1]) > 0.97


def test_blocked_products_equal_brute_force():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(np.frombuffer(b"abc d!EF\n", np.uint8), rng.integers(1, 400))) for _ in range(90)]
    counts = Q.term_counts(texts)
    labels = rng.integers(0, 2, 60).astype(float)
    model = Q.fit(counts[:60], labels, rank=8)
    for t, got in zip(texts[60:], model.score(texts[60:])):
        v = Q.weights(Q.term_counts([t])) * model.idf @ model.space
        cosine = (model.vectors @ (v[0] / np.linalg.norm(v[0]))).astype(float)
        near = np.argsort(-cosine)[:Q.NEIGHBOURS]
        w = np.exp(Q.SHARPNESS * (cosine[near] - 1))
        assert abs(got - (w * labels[near]).sum() / w.sum()) < 1e-3


def test_score_does_not_depend_on_company():
    texts = [b"one two three", b"The The The", b"A!! B!!", b"x"]
    model = Q.fit(Q.term_counts(texts * 5), np.array([1, 0, 0, 1] * 5, float))
    together = model.score(texts)
    assert np.allclose(together, [model.score([t])[0] for t in texts])


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality "
                                         "else quality end as quality")
    a, b = (sorted((r["doc_id"], round(r["score"], 6)) for r in rows_of(Q.score(docs, Q.train(docs, x))))
            for x in (labels, turned))
    assert a == b


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (8, None), (None, 1), (11, 0)],
                                   "doc_id long, quality int")
    model = Q.train(edge_docs, labels)
    got = rows_of(Q.score(edge_docs, model))
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    empty = [r["score"] for r in got if r["doc_id"] in (4, 5)]
    assert empty == [model.prior] * 2
    assert Q.score(no_docs, model).count() == 0
    unlabelled = Q.train(edge_docs, labels.limit(0))
    assert {r["score"] for r in rows_of(Q.score(edge_docs, unlabelled))} == {0.5}
    kept = Q.keep_good(edge_docs, unlabelled)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
