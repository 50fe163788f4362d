"""Exact top-k search by distributed histogram selection.

A vector becomes integers, ``floor(256 * x)`` of each component; the score of two
vectors is their integer inner product.  Queries are a stated part of the rows (here
every id divisible by ``every``), candidates are all rows but the query's own row.

The queries come in waves of at most ``WAVE`` rows and ``WAVE_BYTES`` bytes, each a
broadcast of that proven size.  For a wave, every task scores all its candidates in
blocks and counts the scores of each query in a histogram; Spark adds
the histograms, the bin that holds the kth score becomes the next round's range, and
the rounds end when a bin is one integer wide: the kth score itself.  A last pass keeps
what lies above it and, of the rows that tie with it, the smallest ids.

What leaves a task is small and still exact: bins below those that already hold k of
the task's own scores cannot hold the kth, and of its ties only the first k ids can be
among the first k of all.  A vector that a third of all rows share therefore costs k
rows a task and query.  Which rows are read never depends on the scores.

Rows: a vector that is NULL or holds a NULL, NaN or infinite component takes no part;
components missing from a shorter vector count as 0.  A NULL id is no query; as a
candidate it comes after all ids of its score.  Rows that repeat an id are rows of their
own: each is a query, and each a candidate for the other.  Scores beyond a 64-bit
integer raise an error.  An empty table gives an empty result; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, importable, shared_dir, stored

#: Queries that one broadcast holds: rows, and bytes of their components.
WAVE, WAVE_BYTES = 8_192, 32_000_000
#: A histogram has at most 2**BIN_BITS bins.
BIN_BITS = 9
#: Candidates and queries scored at once.
ROWS, CHUNK = 2_048, 1_024
#: Ties a task holds before it keeps the first ones of each query.
HELD = 500_000
RESULT = "query_id long, rank int, vec_id long, score long"


def components(vector: Column) -> Column:
    """floor(256 x) of each component, NULL where the vector takes no part."""
    x = vector.cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(usable, F.transform(x, lambda v: F.floor(F.lit(256.0) * v).cast("long")))


def matrix(column: pa.ListArray, width: int, dtype) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    size = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (size == width).all():
        return values.reshape(len(column), width).astype(dtype)
    out = np.zeros((len(column), width), dtype)
    out[np.arange(width) < size[:, None]] = values
    return out


class Wave:
    """A block of queries and, for each, the range that its kth score lies in."""

    def __init__(self, rows: list, width: int, dtype, bits: int, k: int):
        self.row = np.array([r["row"] for r in rows], np.int64)
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.vectors = np.zeros((len(rows), width), dtype)
        for i, r in enumerate(rows):
            self.vectors[i, :len(r["x"])] = r["x"]
        self.whole = np.int32 if dtype == np.float32 else np.int64
        self.k = k
        #: The range: ``bins`` bins, each 2**shift wide, from ``low`` on; at first it holds
        #: all scores.
        self.low = np.full(len(rows), -(1 << bits), np.int64)
        self._range(bits + 1)
        #: Candidates above the range; fewer than k of all: every one is a result.
        self.above = np.zeros(len(rows), np.int64)
        self.all = np.zeros(len(rows), bool)

    def _range(self, width_bits: int) -> None:
        self.shift = max(0, width_bits - BIN_BITS)
        self.bins = 1 << (width_bits - self.shift)

    def scores(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(ids, number of the first query, scores, own) of blocks of candidates; ``own``
        holds the places where a query meets its own row.  Candidates by id, NULL last."""
        order = np.argsort(self.row)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                ids = part.column("id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                by_id = np.lexsort((ids, null))
                x = matrix(part.column("x"), self.vectors.shape[1], self.vectors.dtype)[by_id]
                rows = part.column("row").to_numpy()[by_id]
                place = np.searchsorted(self.row, rows, sorter=order) if len(order) else rows
                place = order[np.minimum(place, len(order) - 1)]
                mine = np.nonzero(self.row[place] == rows)[0]
                for first in range(0, len(self.row), CHUNK):
                    found = (x @ self.vectors[first:first + CHUNK].T).astype(self.whole)
                    here = mine[(place[mine] >= first) & (place[mine] < first + CHUNK)]
                    own = (here, place[here] - first)
                    yield (ids[by_id], null[by_id]), first, found, own

    def histogram(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(query, bin, n): from the highest bin down to where this task alone has k."""
        counts = np.zeros((len(self.row), self.bins), np.int64)
        for _, first, found, own in self.scores(batches):
            width = found.shape[1]
            bins = (found - self.low[first:first + width].astype(self.whole)) >> self.shift
            inside = (bins >= 0) & (bins < self.bins)
            inside[own] = False
            at = (bins + np.arange(width) * self.bins)[inside]
            counts[first:first + width] += np.bincount(at, minlength=width * self.bins).reshape(width, -1)
        higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        query, bin_ = np.nonzero((counts > 0) & (higher < (self.k - self.above)[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int32()), pa.array(bin_, pa.int32()), pa.array(counts[query, bin_], pa.int64())],
            names=["query", "bin", "n"])

    def narrow(self, kth: list) -> None:
        """The next range of each query: the bin of its kth score."""
        reached = np.zeros(len(self.row), bool)
        for r in kth:
            q = r["query"]
            reached[q] = True
            self.low[q] += r["bin"] << self.shift
            self.above[q] += r["higher"]
        self.all |= ~reached
        self.done = self.shift == 0
        self._range(self.shift)

    def results(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(query, query_id, vec_id, score): what lies above the kth score, and the first
        ties."""
        lowest = np.iinfo(self.whole).min
        bar = np.where(self.all, lowest, self.low).astype(self.whole)
        need = np.where(self.all, 0, self.k - self.above)
        ties: list[tuple] = []
        held = 0

        def rows(query, ids, null, score):
            return pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int32()), pa.array(self.ids[query], pa.int64()),
                 pa.array(ids, pa.int64(), mask=null), pa.array(score, pa.int64())],
                names=["query", "query_id", "vec_id", "score"])

        def first_ties() -> list[tuple]:
            query, ids, null = (np.concatenate(c) for c in zip(*ties, strict=True))
            by = np.lexsort((ids, null, query))
            query, ids, null = query[by], ids[by], null[by]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            keep = rank < need[query]
            return [(query[keep], ids[keep], null[keep])]

        for (ids, null), first, found, own in self.scores(batches):
            width = found.shape[1]
            here = bar[first:first + width]
            more = found > here
            more[own] = False
            i, j = np.nonzero(more)
            if len(i):
                yield rows(first + j, ids[i], null[i], found[i, j])
            same = found == here
            same[own] = False
            same &= ~self.all[first:first + width]
            if same.any():
                same &= np.cumsum(same, axis=0) <= need[first:first + width]
                i, j = np.nonzero(same)
                ties.append((first + j, ids[i], null[i]))
                held += len(i)
                if held > HELD:
                    ties = first_ties()
                    held = len(ties[0][0])
        if ties:
            query, ids, null = first_ties()[0]
            yield rows(query, ids, null, bar[query])


def _exact_type(bound: int):
    """The cheapest numbers that hold every score, and every part of its sum, exactly."""
    for dtype, digits in ((np.float32, 24), (np.float64, 53), (np.int64, 62)):
        if bound < 1 << digits:
            return dtype
    raise ArithmeticError(f"scores up to {bound} do not fit a 64-bit integer")


def _waves(queries: DataFrame, size: int) -> list[tuple[int, int]]:
    """Ranges of ``at`` that hold at most ``size`` queries each.  ``at`` numbers the rows
    of every written partition without gaps."""
    sizes = queries.groupBy(F.shiftright("at", 33).alias("p")).agg(F.count("*").alias("n")) \
        .orderBy("p").collect()
    out, start, room = [], None, size
    for r in sizes:
        base, done = r["p"] << 33, 0
        while done < r["n"]:
            start = base + done if start is None else start
            take = min(room, r["n"] - done)
            done, room = done + take, room - take
            if room == 0:
                out.append((start, base + done - 1))
                start, room = None, size
    if start is not None:
        out.append((start, (sizes[-1]["p"] << 33) + sizes[-1]["n"] - 1))
    return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
          vector_col: str = "embedding", wave: int = WAVE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores of each query, ties to
    the smaller id."""
    spark = vectors.sparkSession
    importable(spark)
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), col(id_col).cast("long").alias("id"),
                          components(col(vector_col)).alias("x")).where("x is not null")
    rows = stored(rows, "vectors")
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    sizes = rows.agg(F.max(F.size("x")).alias("width"), F.max(square).alias("square")).first()
    width = sizes["width"] or 0
    bound = int((sizes["square"] or 0) * (1 + 1e-9)) + 1     # no score is larger (Cauchy-Schwarz)
    dtype, bits = _exact_type(bound), bound.bit_length()
    queries = stored(rows.where(F.col("id") % every == 0)
                     .withColumn("at", F.monotonically_increasing_id()), "queries")
    size = max(1, min(wave, WAVE_BYTES // (max(width, 1) * 8)))
    path = f"{shared_dir(spark)}/ledgerframe-llm/topk-{uuid.uuid4().hex}"
    for lo, hi in _waves(queries, size):
        block = Wave(queries.where(F.col("at").between(lo, hi)).collect(), width, dtype, bits, k)
        while True:
            kth = _kth_bins(rows, block)
            block.narrow(kth)
            if block.done or block.all.all():
                break
        _results(rows, block).write.mode("append").parquet(path)
    if not len(queries.head(1)):
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(path)


def _kth_bins(rows: DataFrame, block: Wave) -> list:
    """query, bin, higher: the bin that holds the kth score of each query, where there
    are k candidates, and how many lie above that bin in the present range.  At most k
    bins of a query reach the driver."""
    sent = rows.sparkSession.sparkContext.broadcast(block)
    counts = rows.mapInArrow(lambda batches: sent.value.histogram(batches), "query int, bin int, n long") \
        .groupBy("query", "bin").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("query").orderBy(F.desc("bin")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = counts.withColumn("upto", F.sum("n").over(down)) \
        .select("query", "bin", "upto", (F.col("upto") - F.col("n")).alias("higher")) \
        .where(F.col("higher") < block.k).collect()
    sent.destroy()
    need = block.k - block.above
    return [r for r in found if r["higher"] < need[r["query"]] <= r["upto"]]


def _results(rows: DataFrame, block: Wave) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(block)
    found = rows.mapInArrow(lambda batches: sent.value.results(batches),
                            "query int, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= block.k) \
        .select("query_id", "rank", "vec_id", "score")
