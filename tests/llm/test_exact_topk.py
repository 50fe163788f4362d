import math
import random

import numpy as np
import pytest

from ledgerframe.llm import exact_topk as X

from .conftest import rows_of

SCHEMA = "vec_id long, embedding array<float>, score int, `row` string, `a.b` int"


def brute(rows, k=5, every=50):
    used = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, q) in enumerate(used):
        if i is None or i % every:
            continue
        found = sorted([(-sum(a * b for a, b in zip(q, c)), j is None, j or 0)
                        for n, (j, c) in enumerate(used) if n != at])
        out += [(i, rank, None if null else j, -s) for rank, (s, null, j) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def table(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(parts)


def found(df):
    return sorted([(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows_of(df)], key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(-100, 500)]
    rows += [(1000 + i, [0.25] * 8) for i in range(300)]          # a third of all rows, ids 1000, 1050 ... among them
    rows += [(50, [0.1] * 8), (50, [0.1] * 8), (7, [0.25] * 8), (None, [0.25] * 8), (None, [0.9] * 8)]
    rows += [(2000, None), (2050, [0.1] * 7 + [None]), (2100, [float("nan")] * 8), (2150, [float("inf")] + [0.0] * 7)]
    rows += [(2200, []), (2250, [0.5, 0.5]), (2201, [0.0] * 8), (2300, [-0.001] * 8)]
    return rows


def test_equals_brute_force(spark, vectors):
    assert found(X.top_k(table(spark, vectors))) == brute(vectors)


def test_waves_blocks_and_bins_change_nothing(spark, vectors, monkeypatch):
    monkeypatch.setattr(X, "HELD", 3)
    assert found(X.top_k(table(spark, vectors, 7), k=3, wave=4)) == brute(vectors, 3)


def test_few_rows_and_empty_tables(spark, vectors):
    few = [(0, [0.5, 0.1]), (50, [0.5, 0.2]), (3, [0.1, 0.1])]
    assert found(X.top_k(table(spark, few))) == brute(few)
    assert found(X.top_k(table(spark, few[:1]))) == []
    assert found(X.top_k(table(spark, few[2:]))) == []
    empty = X.top_k(table(spark, few).limit(0))
    assert found(empty) == [] and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_large_components_use_wider_numbers_or_stop(spark):
    for scale in (1e2, 1e5, 3e5):
        rows = [(i, [scale * (i % 13), -scale * (i % 7), scale]) for i in range(0, 130)]
        assert found(X.top_k(table(spark, rows))) == brute(rows), scale
    with pytest.raises(ArithmeticError):
        X.top_k(table(spark, [(0, [1e30]), (1, [1.0])]))


def test_the_histogram_sends_only_bins_that_can_hold_the_kth_score():
    rng = np.random.default_rng(1)
    queries = [{"row": i, "id": i, "x": rng.integers(-200, 200, 8).tolist()} for i in range(3)]
    wave = X.Wave(queries, 8, np.float32, 19, 5)
    import pyarrow as pa

    rows = rng.integers(-200, 200, (4000, 8))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(10, 4010), pa.int64()), pa.array(range(4000), pa.int64()),
         pa.array(rows.tolist(), pa.list_(pa.int64()))], names=["row", "id", "x"])
    sent = next(wave.histogram(iter([batch]))).to_pydict()
    for q in range(3):
        scores = np.sort(rows @ np.array(queries[q]["x"]))[::-1]
        bins = (scores + (1 << 19)) >> wave.shift
        mine = [(b, n) for i, b, n in zip(sent["query"], sent["bin"], sent["n"]) if i == q]
        assert sorted(mine) == sorted((b, int((bins == b).sum())) for b in set(bins[:5].tolist()))
