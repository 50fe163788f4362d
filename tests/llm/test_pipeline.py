"""The pipeline against each stage's own brute force, on the smallest tables."""

import hashlib

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline as P
from ledgerframe.llm import quality

from .conftest import rows_of
from .test_jaccard import brute

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    table, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(table, labels)
    scores = model.score([t.encode() for t in docs["text"]])
    rows = [(i, t) for i, t, s in zip(docs["doc_id"], docs["text"], scores) if s >= quality.THRESHOLD]
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = [(i, t) for i, t in rows if last[t] == i]
    _, comps = brute(rows)
    rows = [r for r, c in zip(rows, comps) if c is None or c == r[0]]
    items = [t for t in pd.read_parquet(f"{SF}/benchmark.parquet")["text"] if len(t.split()) >= 13]
    rows = [(i, t) for i, t in rows if not any(x in t for x in items)]
    library = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want = []
    for i, t in rows:
        ids = np.array(library.encode(t, add_special_tokens=False).ids, "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    got = rows_of(P.run(spark, SF))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(want)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "exact", "near", "leaks", "tokens"]
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs.limit(50), SF).columns == docs.columns, name
