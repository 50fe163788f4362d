import random
import re
from collections import defaultdict

import numpy as np

from ledgerframe.llm import jaccard as J

from .conftest import prose, rows_of

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NONE_MARKED = np.zeros(1 << 20, bool)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))


def links(a, b):
    both = len(a & b)
    return both > 0 and 100 * both >= 75 * len(a | b)


def brute(rows):
    """{position: smallest id of its component}"""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x]}:
            if links(s, sets[j]):
                parent[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sets, [least.get(find(i)) for i in range(len(rows))]


def variant(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_shingle_sets_equal_brute_force():
    rng = random.Random(1)
    texts = ["", "one", "One TWO", "a b c d", "a b c d e", "a b c d e f a b c d e", " x\x0b\x0cy ", "É é", "  "]
    texts += [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    of, key = J.shingle_sets([t.encode() for t in texts])
    names = {}
    for i, t in enumerate(texts):
        mine = set(key[of == i].tolist())
        assert len(mine) == len(shingles(t))
        assert names.setdefault(frozenset(mine), shingles(t)) == shingles(t)


def test_linked_sets_always_share_a_signature():
    """Sets of every size up to 60 and some large ones, at the least similarity that
    links, with and without frequent shingles."""
    rng = np.random.default_rng(3)
    marked = rng.random(1 << 20) < 0.5
    sizes = [*range(1, 60), 63, 64, 65, 96, 127, 128, 200, 255, 256, 500]
    for frequent in (NONE_MARKED, marked):
        for s in sizes:
            for _ in range(6):
                union = rng.integers(0, 2 ** 63, int(s / 0.75), dtype=np.uint64)
                gone = int(len(union) * 0.25)
                side = rng.integers(0, gone + 1)
                order = rng.permutation(len(union))
                a, b = union[order[side:]], np.delete(union[order], np.arange(side, gone))
                a, b = np.unique(a), np.unique(b)
                assert 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
                of = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
                owner, sig = J.signatures(of, np.concatenate([a, b]), np.array([len(a), len(b)]), frequent)
                assert np.intersect1d(sig[owner == 0], sig[owner == 1]).size, (s, len(a), len(b))


def test_histograms_bound_the_difference():
    rng = random.Random(5)
    texts = [prose(rng, 200)]
    texts += [variant(rng, texts[0], k) for k in range(0, 40)] + [prose(rng, n) for n in range(1, 300, 7)]
    of, key = J.shingle_sets([t.encode() for t in texts])
    size = np.bincount(of, minlength=len(texts))
    hist = J.histograms(of, key, size)
    for i in range(1, len(texts)):
        bins = 2 * min(len(hist[0]), len(hist[i]))
        a, b = (J.bin_rows([hist[k]], bins).astype(int) for k in (0, i))
        assert a.sum() == size[0] and b.sum() == size[i]
        assert np.abs(a - b).sum() <= len(shingles(texts[0]) ^ shingles(texts[i]))
        if links(shingles(texts[0]), shingles(texts[i])):
            assert J.close([hist[0]], [hist[i]], size[:1], size[i:i + 1]).all()
    assert not J.close(hist[:1], hist[-1:], size[:1], size[-1:]).any()


def test_a_histogram_that_does_not_fit_is_never_a_reason():
    key = np.arange(40, dtype=np.uint64)
    assert J.histograms(np.zeros(40, int), key, np.array([40])) == [b""]
    assert J.close([b""], [b"\1\1"], np.array([40]), np.array([4])).all()


def test_linked_equals_brute_force():
    rng = random.Random(6)
    base = prose(rng, 90)
    texts = [base, "", "a b", "A b", "x"] + [variant(rng, base, k % 9) for k in range(40)]
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(300)]
    got = J.linked([a.encode() for a, _ in pairs], [b.encode() for _, b in pairs])
    want = [links(shingles(a), shingles(b)) or (not shingles(a) and not shingles(b)) for a, b in pairs]
    assert got.tolist() == want


def test_components_equal_brute_force(spark, edge_docs, monkeypatch):
    """Families of near copies, chains, a passage shared by many, and the edge rows."""
    rng = random.Random(7)
    passage = prose(rng, 60)
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for f in range(6):
        base = prose(rng, rng.randint(20, 160))
        rows += [(1000 + 100 * f + k, variant(rng, base, rng.randint(0, 5))) for k in range(12)]
    chain = prose(rng, 150)
    for k in range(25):  # neighbours link, ends do not
        chain = variant(rng, chain, 2)
        rows.append((3000 - k, chain))
    rows += [(4000 + k, passage + " " + prose(rng, rng.randint(5, 80))) for k in range(60)]
    hot = prose(rng, 100)
    rows += [(5000 + k, variant(rng, hot, rng.randint(1, 4))) for k in range(80)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, id int, n int") \
        .repartition(5)
    sets, comps = brute(rows)
    want = sorted((str(i), len(s), str(c if s else i)) for (i, _), s, c in zip(rows, sets, comps, strict=True))
    got = rows_of(J.near_duplicates(docs))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want
    kept = J.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) \
        == sorted(str(i) for (i, _), s, c in zip(rows, sets, comps, strict=True)
                  if i is None or not s or i == c)


def test_pairs_between_blocks_meet_once():
    import pyarrow as pa

    n, blocks = 60, 3
    block = np.arange(n) % blocks
    tables = []
    for low in range(blocks):
        for high in range(low, blocks):
            at = np.nonzero((block == low) | (block == high))[0]
            tables.append(J.pairs_between(pa.table({
                "centre": np.zeros(len(at), int), "class": at, "comp": at % 50, "n": np.full(len(at), 10),
                "hist": pa.array([bytes(4)] * len(at), pa.binary()), "block": block[at],
                "centres": [[0]] * len(at),
                "low": np.full(len(at), low), "high": np.full(len(at), high)})))
    got = [tuple(p) for t in tables for p in zip(*t.to_pydict().values(), strict=True)]
    assert len(got) == len(set(got))
    assert set(got) == {(i, j) for i in range(n) for j in range(i + 1, n) if i % 50 != j % 50}


def test_a_pair_of_several_groups_is_given_once():
    import pyarrow as pa

    groups = {1: [10, 11, 12], 2: [10, 11, 13], 5: [11, 12, 13]}
    rows = [(c, m) for c, ms in groups.items() for m in ms]
    held = {m: [c for c, ms in groups.items() if m in ms] for _, m in rows}
    got = J.pairs_between(pa.table({
        "centre": [c for c, _ in rows], "class": [m for _, m in rows], "comp": [m for _, m in rows],
        "n": [10] * len(rows), "hist": pa.array([bytes(4)] * len(rows), pa.binary()),
        "centres": [held[m] for _, m in rows], "block": [0] * len(rows), "low": [0] * len(rows),
        "high": [0] * len(rows)})).to_pydict()
    assert sorted(zip(got["a"], got["b"])) == [(10, 11), (10, 12), (10, 13), (11, 12), (11, 13), (12, 13)]


def test_components_of_links(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(7, 7)]
    edges += [(rng.randrange(500, 560), rng.randrange(500, 560)) for _ in range(50)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["class"]: r["comp"] for r in rows_of(J.components(spark.createDataFrame(edges, "a long, b long")))}
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_empty_table(no_docs):
    assert J.near_duplicates(no_docs).count() == 0
    assert J.drop_near_duplicates(no_docs).count() == 0


def test_sampled_texts_come_once_with_their_number(spark):
    from pyspark.sql import functions as F

    from ledgerframe.llm.common import sampled_texts
    docs = spark.createDataFrame([("hot",)] * 300 + [("b",), ("c" * 70_000,)], "text string") \
        .withColumn("xx", F.xxhash64("text"))
    texts, times = sampled_texts(docs, 1)
    assert dict(zip(texts, times.tolist(), strict=True)) == {b"hot": 300, b"b": 1}
    assert [len(x) for x in sampled_texts(docs.limit(0), 1)] == [0, 0]


def test_frequent_shingles_are_counted_in_small_steps(monkeypatch):
    """The sample is counted on the driver: its arrays must not grow with the sample."""
    from ledgerframe.llm import textops
    rng = random.Random(3)
    texts = [(("often seen words of all texts " if i % 3 else "") + " ".join(
        str(rng.random()) for _ in range(200))).encode() for i in range(1200)]
    times = np.array([1 + i % 4 for i in range(len(texts))], np.int64)
    monkeypatch.setattr(J, "sampled_texts", lambda rows, every: (texts, times))
    assert sum(map(len, texts)) > 4 * textops.STEP_BYTES
    marks = []
    for step in (textops.STEP_BYTES, 10 ** 9):
        monkeypatch.setattr(textops, "STEP_BYTES", step)
        monkeypatch.setattr(textops, "_POWERS", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
        marks.append(J.frequent_shingles(None, 1))
        if len(marks) == 1:
            assert len(textops._POWERS[0]) < 1.1 * step
    assert marks[0].any() and (marks[0] == marks[1]).all()
    monkeypatch.setattr(J, "sampled_texts", lambda rows, every: ([], np.zeros(0, np.int64)))
    assert not J.frequent_shingles(None, 1).any()


def test_tasks_begin_without_other_caches_and_give_memory_back(spark, monkeypatch):
    from ledgerframe.llm import bpe, common

    class Frame:
        sparkSession = spark

        def mapInArrow(self, task, schema):
            return task

    calls = []
    real = common.give_back
    monkeypatch.setattr(common, "give_back", lambda caches=False: (calls.append(caches), real(caches)))
    monkeypatch.setitem(bpe._CODECS, b"vocabulary", object())
    task = common.map_arrow(Frame(), lambda batches: ((b, len(bpe._CODECS)) for b in batches), "x long")
    assert list(task([1, 2])) == [(1, 1), (2, 1)] and calls == [False]
    task = common.map_arrow(Frame(), lambda batches: ((b, len(bpe._CODECS)) for b in batches), "x long", alone=True)
    assert list(task([1, 2])) == [(1, 0), (2, 0)] and calls == [False, True, False]
