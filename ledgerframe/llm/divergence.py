"""Source divergence audit: how far the word counts of the sources of a language lie apart.

Terms are the runs of ASCII letters and characters from U+0080 on, A-Z as a-z.  A
language keeps the terms that at least ``min_docs`` of its documents hold.  A group
(lang, source) and a language give each kept term the share
``p = 1 + floor(10**9 * (count + 2) / (N + 2 V))``; two shares differ by
``floor((p - q)**2 / (p + q))``.  All of it is exact integer arithmetic.

Plan: every task counts the terms of its documents by group in a bounded table and
Spark adds the counts up, so a hot term or source is one row of a task; one stored
table of counts, one of kept terms.  The pairs are computed by run-length columns: the
vocabulary of a language is dealt into chunks of about ``CHUNK_TERMS`` terms; inside a
chunk the terms are reordered so that equal counts lie together, each source's column
becomes runs, and for two sources the boundaries of their runs are intersected and
each difference is multiplied by the length of its run.  The sums of the chunks are
added by Spark.  More than ``SOURCES`` sources of one language are paired block by
block, so neither a large vocabulary nor many sources make a large task.

Rows: NULL text, lang and source are empty strings; empty texts and repeated rows count
as any other; every (lang, source) that occurs is a group even without terms; an empty
table gives an empty result; other columns, whatever their names, are not read.  Ties
of a value go by the item in UTF-8 order.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, importable, map_arrow, stored, text_or_empty
from .textops import slices

#: Documents of its language that a kept term occurs in, at least.
MIN_DOCS = 10
#: Terms listed for each group.
TERM_RANKS = 10
#: About so many terms are laid out in one task, for at most two blocks of sources.
CHUNK_TERMS, SOURCES = 16_384, 128
#: Counts a task holds before it hands them on.
HELD = 200_000
SCALE = 1_000_000_000

TERM = re.compile(rb"[a-z\x80-\xff]+")
COUNTS = "lang string, source string, term string, n long, docs long"
RANKED = ["lang", "source", "part", "item", "value", "rank"]


def count_terms(batches):
    """``mapInArrow`` body: (lang, source, text) -> counts by group and term.  A row
    with an empty term names each group seen."""
    held = defaultdict(lambda: (Counter(), Counter()))

    def rows():
        for (lang, source), (n, docs) in held.items():
            terms = [b"", *n]
            size = len(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array([0, *n.values()], pa.int64()),
                 pa.array([0, *map(docs.__getitem__, n)], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch, texts in slices(batches):
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for group, text in zip(groups, texts, strict=True):
            n, docs = held[group]
            size -= len(n)
            words = TERM.findall(text.lower())      # bytes.lower changes A-Z only
            n.update(words)
            docs.update(set(words))
            size += len(n)
            if size >= HELD:
                yield from rows()
                size = 0
    yield from rows()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents); each group also has one
    row with an empty term."""
    rows = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"),
                       text_or_empty(text_col).alias("text"))
    importable(docs.sparkSession)
    return map_arrow(rows, count_terms, COUNTS).groupBy("lang", "source", "term") \
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (n + 2) / (total + 2 terms)), exact for any long."""
    whole = F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)"))
    of = total.cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)") * terms.cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", whole, of)


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def difference(shares: np.ndarray, runs: list[np.ndarray], i: int, j: int) -> int:
    """Sum over all terms of the difference of columns ``i`` and ``j``: one step for
    each run of both."""
    start = np.union1d(runs[i], runs[j])
    length = np.diff(start, append=shares.shape[1])
    p, q = shares[i, start], shares[j, start]
    return int(((p - q) ** 2 // (p + q) * length).sum())


def pair_chunk(key, groups: pa.Table, terms: pa.Table) -> pa.Table:
    """One chunk of a language's vocabulary: the summed difference of every pair of
    its sources (of two blocks of sources, where there are many)."""
    lang, _, first, second = (k.as_py() for k in key)
    sources = groups.column("source").to_pylist()
    block = groups.column("block").to_numpy()
    at = {s: i for i, s in enumerate(sources)}
    out = {"s": [], "t": [], "value": []}
    left, right = np.nonzero(block == first)[0], np.nonzero(block == second)[0]
    shares = runs = None
    n = groups.column("size")[0].as_py()
    if n:
        # terms that none of these sources has keep the share of no occurrence
        words = terms.column("term").combine_chunks().dictionary_encode()
        shares = np.repeat(groups.column("p0").to_numpy()[:, None], n, axis=1)
        mine = np.fromiter((at[s] for s in terms.column("source").to_pylist()), np.int64, terms.num_rows)
        shares[mine, words.indices.to_numpy()] = terms.column("p").to_numpy()
        # equal counts together: sorted by the fullest column, then the next one
        by_size = np.argsort(np.bincount(mine, minlength=len(sources)), kind="stable")
        shares = shares[:, np.lexsort(shares[by_size])]
        runs = [np.concatenate([[0], np.flatnonzero(np.diff(c)) + 1]) for c in shares]
    for i in left:
        for j in (right[right > i] if first == second else right):
            out["s"].append(sources[i])
            out["t"].append(sources[j])
            out["value"].append(difference(shares, runs, i, j) if runs else 0)
    return pa.table({"lang": pa.array([lang] * len(out["s"]), pa.string()),
                     "s": pa.array(out["s"], pa.string()), "t": pa.array(out["t"], pa.string()),
                     "value": pa.array(out["value"], pa.int64())})


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))


class Audit:
    """The tables of one audit: ``counts``, ``vocabulary``, ``groups`` and ``kept``
    (kept terms of each group with both shares), and the two parts made from them."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, chunk_terms: int = CHUNK_TERMS,
                 sources: int = SOURCES, **columns: str):
        self.chunk_terms, self.sources = chunk_terms, sources
        with arrow_rows(docs.sparkSession, 500):
            self.counts = stored(term_counts(docs, **columns), "term-counts")
        used = self.counts.where("term <> ''")
        self.vocabulary = stored(
            used.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).select("lang", "term", "total"), "vocabulary")
        rows = used.select("lang", "source", "term", "n").join(self.vocabulary, ["lang", "term"])
        langs = self.vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("all_n"))
        names = self.counts.where("term = ''").select("lang", "source")
        self.groups = stored(
            names.join(rows.groupBy("lang", "source").agg(F.sum("n").alias("group_n")),
                       ["lang", "source"], "left").join(langs, "lang", "left")
            .fillna(0, ["group_n", "v", "all_n"]), "groups")
        self.kept = stored(
            rows.join(self.groups, ["lang", "source"]).select(
                "lang", "source", "term", "v", share(F.col("n"), F.col("group_n"), F.col("v")).alias("p"),
                share(F.col("total"), F.col("all_n"), F.col("v")).alias("q")), "shares")

    def terms(self, ranks: int = TERM_RANKS) -> DataFrame:
        """The terms that a group has more of than its language: the first ``ranks``."""
        above = self.kept.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                                apart(F.col("p"), F.col("q")).alias("value"))
        return _ranked(above, "term").where(F.col("rank") <= ranks)

    def pairs(self) -> DataFrame:
        """Every other source of a group's language, all ranks."""
        each = Window.partitionBy("lang").orderBy("source")
        chunks = F.greatest(F.lit(1), F.ceil(F.col("v") / F.lit(self.chunk_terms))).cast("int")
        number = F.row_number().over(each) - 1
        of_all = Window.partitionBy("lang")
        groups = self.groups.select(
            "lang", "source", "v", chunks.alias("chunks"),
            F.when(F.col("v") > 0, share(F.lit(0), F.col("group_n"), F.col("v")))
            .otherwise(F.lit(0).cast("long")).alias("p0"),
            F.floor(number / self.sources).cast("int").alias("block"),
            F.floor((F.count("*").over(of_all) - 1) / self.sources).cast("int").alias("last"))

        def blocks(df: DataFrame) -> DataFrame:
            other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
            return df.select("*", other) \
                .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))

        chunk = F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk")
        sizes = self.vocabulary.join(groups.select("lang", "chunks").distinct(), "lang") \
            .select("lang", chunk).groupBy("lang", "chunk").agg(F.count("*").cast("int").alias("size"))
        left = blocks(groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))) \
            .join(sizes, ["lang", "chunk"], "left").fillna(0, ["size"]) \
            .select("lang", "chunk", "first", "second", "source", "p0", "block", "size")
        right = blocks(self.kept.join(groups.select("lang", "source", "chunks", "block", "last"),
                                      ["lang", "source"]).select("*", chunk)) \
            .select("lang", "chunk", "first", "second", "source", "term", "p")
        key = ["lang", "chunk", "first", "second"]
        importable(self.groups.sparkSession)
        sums = left.groupBy(*key).cogroup(right.groupBy(*key)) \
            .applyInArrow(pair_chunk, "lang string, s string, t string, value long") \
            .groupBy("lang", "s", "t").agg(F.sum("value").alias("value"))
        both = F.explode(F.array(F.struct(F.col("s").alias("source"), F.col("t").alias("item")),
                                 F.struct(F.col("t").alias("source"), F.col("s").alias("item")))).alias("e")
        return _ranked(sums.select("lang", "value", both).select("lang", "e.source", "e.item", "value"), "pair")


def audit(docs: DataFrame, **options) -> DataFrame:
    """lang, source, part, item, value, rank of both parts."""
    done = Audit(docs, **options)
    return done.pairs().select(*RANKED).unionByName(done.terms().select(*RANKED))
