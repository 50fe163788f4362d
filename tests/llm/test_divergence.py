import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from ledgerframe.llm import divergence as D

from .conftest import prose, rows_of


def brute(rows, min_docs=10, ranks=10):
    """rows: (text, lang, source)."""
    docs = [(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""), la or "", s or "") for t, la, s in rows]
    words = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t), la, s) for t, la, s in docs]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for w, la, s in words:
        seen[la].update(set(w))
        count[la, s].update(w)
    kept = {la: [t for t, n in c.items() if n >= min_docs] for la, c in seen.items()}
    groups = sorted({(la, s) for _, la, s in docs})

    def shares(c, terms):
        of = sum(c[t] for t in terms) + 2 * len(terms)
        return {t: 1 + 10 ** 9 * (c[t] + 2) // of for t in terms}

    p = {g: shares(count[g], kept.get(g[0], [])) for g in groups}
    q = {la: shares(sum((count[g] for g in groups if g[0] == la), Counter()), kept.get(la, []))
         for la in {g[0] for g in groups}}

    def f(a, b):
        return (a - b) ** 2 // (a + b)

    out = []
    for g in groups:
        pairs = [(sum(f(p[g][t], p[h][t]) for t in kept.get(g[0], [])), h[1]) for h in groups
                 if h[0] == g[0] and h != g]
        terms = [(f(p[g][t], q[g[0]][t]), t) for t in kept.get(g[0], [])
                 if count[g][t] > 0 and p[g][t] > q[g[0]][t]]
        for part, found in (("pair", pairs), ("term", terms)):
            found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
            out += [(*g, part, item, v, i) for i, (v, item) in enumerate(found, 1) if part == "pair" or i <= ranks]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in D.RANKED) for r in rows_of(df))


def corpus(n, seed=1):
    rng = random.Random(seed)
    extra = ["Ünï", "ÜNÏ", "日本", "it's", "MIXED Case", "a_b1c", "", "\x80x"]
    rows = [(prose(rng, rng.randint(0, 40)) + " " + rng.choice(extra), rng.choice(["en", "de", None, "fr"]),
             rng.choice(["hot", "hot", "hot", "s1", "s2", "", None, "ß", "Z"])) for _ in range(n)]
    return rows + [(None, "en", "hot"), ("", "xx", "only"), ("1 2 3", "yy", "a"), ("", "yy", "b")] + [rows[0]] * 20


def test_equals_brute_force(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(i, *r, 1, 2) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n int, `p.q` int").repartition(5)
    want = brute(rows)
    assert len({r[2] for r in want}) == 2 and any(r[4] > 0 for r in want)
    assert found(D.audit(docs)) == want


def test_small_chunks_blocks_and_tables_change_nothing(spark, monkeypatch):
    rows = corpus(300, 2)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    monkeypatch.setattr(D, "HELD", 20)
    assert found(D.audit(docs, chunk_terms=60, sources=3)) == brute(rows)


def test_edge_rows_and_empty_tables(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert found(D.audit(docs)) == brute(rows)
    assert found(D.audit(docs, min_docs=10 ** 6)) == brute(rows, 10 ** 6)
    empty = D.audit(no_docs.withColumn("lang", F.lit("en")))
    assert found(empty) == [] and empty.columns == D.RANKED


def test_counts_beyond_a_long_product_are_exact(spark):
    df = spark.createDataFrame([(9 * 10 ** 15, 10 ** 16, 5 * 10 ** 6)], "n long, total long, v long") \
        .select(D.share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    assert df.first()["p"] == 1 + 10 ** 9 * (9 * 10 ** 15 + 2) // (10 ** 16 + 10 ** 7)


def test_runs_give_the_sum_over_all_terms():
    rng = np.random.default_rng(3)
    shares = rng.integers(1, 4, (3, 500)) * 10 ** 8
    runs = [np.concatenate([[0], np.flatnonzero(np.diff(c)) + 1]) for c in shares]
    for i in range(3):
        for j in range(3):
            p, q = shares[i], shares[j]
            assert D.difference(shares, runs, i, j) == int(((p - q) ** 2 // (p + q)).sum())
