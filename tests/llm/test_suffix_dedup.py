import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerframe.llm import suffix_dedup as X

from .conftest import prose, rows_of


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept_sha256) of texts in document order."""
    seen, out = set(), []
    for raw in texts:
        gone = bytearray(len(raw))
        for s in range(len(raw) - X.LENGTH + 1):
            w = raw[s:s + X.LENGTH]
            if w in seen:
                gone[s:s + X.LENGTH] = b"\1" * X.LENGTH
            seen.add(w)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(10, 60)) for _ in range(5)]
    out = []
    for _ in range(n):
        parts = [rng.choice([*passages, prose(rng, rng.randint(3, 60)), "a" * rng.randint(1, 250),
                             "ab" * rng.randint(1, 120), "line\n" * rng.randint(1, 60), "é" * rng.randint(1, 90)])
                 for _ in range(rng.randint(0, 5))]
        t = " ".join(parts)
        if out and rng.random() < 0.3:
            t = rng.choice(out)
            if t and rng.random() < 0.7:
                k = rng.randrange(len(t))
                t = t[:k] + "#" + t[k + rng.randint(0, 3):]
        out.append(t)
    return [t.encode() for t in out]


def test_suffix_array_and_common_prefixes_equal_brute_force():
    rng = random.Random(2)
    for _ in range(40):
        segments = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 6))]
        symbols, start = [], []
        for s in segments:
            start.append(len(symbols))
            symbols += [ord(c) - 95 for c in s] + [0]
        # ends differ from each other, in text order
        ends = [i for i, x in enumerate(symbols) if x == 0]
        unique = [x + 1000 if x else ends.index(i) for i, x in enumerate(symbols)]
        want = sorted(range(len(symbols)), key=lambda i: unique[i:])
        sa = X.suffix_array(np.array(symbols, np.uint16))
        assert sa.tolist() == want
        lcp = X.common_prefixes(np.array(symbols, np.uint16), sa, np.array(start),
                                np.array([len(s) for s in segments]))
        for k in range(1, len(want)):
            a, b, n = unique[want[k - 1]:], unique[want[k]:], 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert lcp[k] == (0 if symbols[want[k]] == 0 else n)


def local_run(texts, buckets=3, split=10, per_task=7, common=None):
    """The steps of ``repeated_ranges`` in one process."""
    common = np.zeros(1 << 20, bool) if common is None else common
    rows = [(i, i, hash(t) & 0xFFFF, i * 7 % buckets, t.decode()) for i, t in enumerate(texts)]
    docs = pa.table({k: pa.array(c, kind) for k, c, kind in zip(
        ("doc_id", "id", "xx", "db", "text"), zip(*rows),
        (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()))})

    def group(tables, *keys):
        whole, out = pa.concat_tables([t for t in tables if len(t)] or tables[:1]), {}
        for at, key in enumerate(zip(*(whole.column(k).to_pylist() for k in keys))):
            out.setdefault(key, []).append(at)
        return {key: whole.take(pa.array(at)) for key, at in out.items()}

    blocks = [pa.Table.from_batches([b]) for lo in range(0, len(texts), per_task) for b in X.find_segments(
        buckets, common)(iter(docs.slice(lo, per_task).combine_chunks().to_batches()))]
    found = [X.settle_bucket(split)(t) for t in group(blocks, "bucket").values()]
    by_db = group([docs], "db")
    kinds = group(found, "kind", "db")
    cuts = [X.cut_segments(by_db[db,], t) for (kind, db), t in kinds.items() if kind == "fetch"]
    judged = [X.judge_shard(buckets)(t) for t in group(cuts, "shard", "part").values()] if cuts else []
    again = group(judged, "kind", "db") if judged else {}
    merged = [X.merge_shards(t) for (kind, _), t in again.items() if kind == "window"]
    every = group([*found, *judged, *merged], "kind", "db")
    out = {}
    for (db,), t in by_db.items():
        r = X.cut_documents(t, every.get(("range", db), X.found_table([]))).to_pydict()
        for i, n, g, s, sha in zip(*r.values()):
            out[i] = (n, g, len(s), sha)
    parts = {p for t in cuts for p in t.column("part").to_pylist()}
    return [out[i] for i in range(len(texts))], parts


@pytest.mark.parametrize("seed", range(6))
def test_steps_equal_brute_force(seed, monkeypatch):
    texts = corpus(seed)
    monkeypatch.setattr(X, "GATHERED", 50)
    monkeypatch.setattr(X, "PIECE", 400)
    common = np.zeros(1 << 20, bool)
    if seed % 2:
        common[np.random.default_rng(seed).integers(0, 1 << 20, 1 << 19)] = True
    got, parts = local_run(texts, split=1 + seed, common=common)
    assert got == brute(texts)
    assert seed > 1 or max(parts) > 1  # windows of several shards were merged


def test_query_over_edge_rows(spark, edge_docs):
    extra = [(2000 + i, t.decode()) for i, t in enumerate(corpus(11, 40))]
    docs = edge_docs.select("doc_id", "text", "id", "uid").unionByName(
        spark.createDataFrame([(i, t, 1, 2) for i, t in extra], "doc_id long, text string, id int, uid int"))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    whole = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    unique = [r for r in whole if [x[0] for x in whole].count(r[0]) == 1]
    got = rows_of(X.report(docs))
    assert len(got) == len(rows)
    want = dict(zip([i for i, _ in whole], brute([t.encode() for _, t in whole])))
    mine = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got}
    for i, _ in unique:
        assert mine[i] == want[i], i


def test_texts_without_repeats_and_empty_table(spark, no_docs):
    docs = spark.createDataFrame([(1, "b" + "x" * 150), (2, "short"), (3, None)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in rows_of(X.drop_repeats(docs))}
    assert out == {1: "bx", 2: "short", 3: ""}
    assert X.report(no_docs).count() == 0


def test_text_output_has_each_row_once_whatever_its_id(spark):
    rng = random.Random(12)
    shared = prose(rng, 40)
    texts = [(None, "a " + shared), (None, "b " + prose(rng, 30)), (5, "c " + shared + " end"), (5, "d " + shared),
             (6, "e " + shared), (6, "e " + shared), (7, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = [(str(r["doc_id"]), r["kept_sha256"]) for r in rows_of(X.report(docs))]
    got = [(str(r["doc_id"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows_of(X.drop_repeats(docs))]
    assert len(got) == len(texts) and sorted(got) == sorted(want)
