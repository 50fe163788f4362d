"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms of a text are its byte pairs and the shapes of its words (length, kinds of
the first and last characters, case, whether the word repeats the one before),
hashed into ``DIMS`` columns; a word that repeats the one before counts as that
alone, in columns of its own.  The weight is the logarithm of the count, scaled by
text length, times the inverse document frequency.  A truncated singular value
decomposition of labelled rows (subspace iteration) gives the latent space.  Their vectors are
broadcast (at most ``MAX_LABELLED`` x ``RANK`` numbers); every document gets its
exact cosine with all of them, in blocks, and the ``NEIGHBOURS`` nearest labels
are averaged with weights that grow with the similarity.

Fitting uses a bounded sample of labelled rows (``MAX_LABELLED``, those with the
smallest hashes); scoring reads every whole text once and shuffles nothing.
Inputs of a score are the text alone.

Defined cases: NULL or empty texts, or a table without labels, get the share of
label 1 among the labelled rows (0.5 without any); a row labelled more than once
counts by its mean label, half rounding up; NULL labels are left out; repeated
rows get equal scores; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, give_back, importable, map_arrow, stored, text_or_empty
from .textops import Buffer, RangeHash, mixed, slices

MAX_LABELLED = 2000
RANK = 64
NEIGHBOURS = 25
SHARPNESS = 12.0
THRESHOLD = 0.3
PAIR_DIMS, SHAPE_DIMS, REPEAT_DIMS = 2048, 1024, 64
DIMS = PAIR_DIMS + SHAPE_DIMS + REPEAT_DIMS

_PAIR = (mixed(np.arange(65536, dtype=np.uint64)) % np.uint64(PAIR_DIMS)).astype(np.int64)
#: Kind of each byte: lower, upper, digit, space, other ASCII one by one, above ASCII.
_KIND = np.full(256, 1, np.uint64)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 2, 3, 4
for _b in [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]:
    _KIND[_b] = _b


def term_counts(texts: list[bytes]) -> np.ndarray:
    """float32 matrix of term counts, a row for each text."""
    b = Buffer(texts)
    n = len(texts)
    start, end, of = b.words()
    key = RangeHash(b.buf)(start, end)
    again = np.zeros(len(start), bool)
    again[1:] = (key[1:] == key[:-1]) & (of[1:] == of[:-1])
    repeats = np.bincount(of[again], minlength=n)
    edge = np.zeros(len(b.buf) + 1, np.int8)
    edge[start[again]] += 1
    edge[end[again]] -= 1
    new = np.cumsum(edge[:-1], dtype=np.int8)[:-1] == 0
    new[b.end[:-1]] = False  # the space between two texts and the next text's first byte
    pair = (b.buf[:-1].astype(np.int64) << 8) | b.buf[1:]
    doc = np.repeat(np.arange(n), b.size + 1)
    counts = np.bincount((doc[:-1] * DIMS + _PAIR[pair])[new], minlength=n * DIMS)
    start, end, of = start[~again], end[~again], of[~again]
    shape = _KIND[b.buf[start]]
    for part in (_KIND[b.buf[np.minimum(start + 1, end - 1)]], _KIND[b.buf[end - 1]],
                 _KIND[b.buf[np.maximum(end - 2, start)]], np.minimum(end - start, 12).astype(np.uint64)):
        shape = shape * np.uint64(131) + part
    dim = PAIR_DIMS + (mixed(shape) % np.uint64(SHAPE_DIMS)).astype(np.int64)
    counts += np.bincount(of * DIMS + dim, minlength=n * DIMS)
    counts = counts.reshape(n, DIMS)
    counts[:, PAIR_DIMS + SHAPE_DIMS:] = repeats[:, None]
    return counts.astype(np.float32)


def weights(counts: np.ndarray) -> np.ndarray:
    """Logarithm of the counts per thousand terms."""
    total = np.maximum(counts[:, :PAIR_DIMS + SHAPE_DIMS + 1].sum(axis=1, keepdims=True), 1)
    out = counts * (1000 / total).astype(np.float32)
    return np.log1p(out, out=out)


@dataclass
class Model:
    idf: np.ndarray
    space: np.ndarray  # DIMS x rank
    vectors: np.ndarray  # labelled rows x rank, unit length
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        v = (weights(counts) * self.idf) @ self.space
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        some = np.array([len(t) > 0 for t in texts], bool)
        if not len(self.labels) or not some.any():
            return out
        v = self.project(term_counts([t for t in texts if t]))
        cosine = v @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.exp(SHARPNESS * (np.take_along_axis(cosine, near, axis=1) - 1.0)).astype(np.float64)
        out[some] = np.clip((w * self.labels[near]).sum(axis=1) / w.sum(axis=1), 0.0, 1.0)
        return out


def fit(counts: np.ndarray, labels: np.ndarray, rank: int = RANK) -> Model:
    """Latent space and vectors of the labelled rows."""
    prior = float(labels.mean()) if len(labels) else 0.5
    if not len(labels):
        return Model(np.ones(DIMS, np.float32), np.zeros((DIMS, 1), np.float32),
                     np.zeros((0, 1), np.float32), labels, prior)
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    a = weights(counts)
    a *= idf
    found = np.random.default_rng(5).standard_normal((DIMS, min(rank + 16, *a.shape))).astype(np.float32)
    for _ in range(5):
        found, _ = np.linalg.qr(a.T @ (a @ found))
    _, _, right = np.linalg.svd(a @ found, full_matrices=False)
    space = (found @ right[:rank].T).astype(np.float32)
    model = Model(idf, space, np.zeros((0, 0), np.float32), labels.astype(np.float64), prior)
    model.vectors = model.project(counts).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
          label_col: str = "quality", most: int = MAX_LABELLED) -> Model:
    """Model from at most ``most`` labelled rows that are not held out."""
    chosen = (labels.select(col(id_col).alias("doc_id"), col(label_col).alias("label"))
              .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()
                     & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    chosen = stored(chosen, "labelled")
    rows = docs.select(col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")) \
        .where(F.length("text") > 0).join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for b, texts in slices(batches, most=256):
            counts = np.minimum(term_counts(texts), 65535).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("label"), pa.array([c.tobytes() for c in counts], pa.binary())],
                names=["doc_id", "label", "counts"])

    # a repeated doc_id could bring more rows than labels were chosen
    got = stored(map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                      "label int, counts binary"), "labelled-terms")
    model = fit(*_read_terms(got.orderBy(F.xxhash64("doc_id"), F.xxhash64("counts")).limit(most).toPandas()))
    give_back()
    return model


def _read_terms(got: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of the rows."""
    labels, counts = got["label"].to_numpy(np.float64), np.empty((len(got), DIMS), np.float32)
    for row, block in zip(counts, got.pop("counts"), strict=True):
        row[:] = np.frombuffer(block, np.uint16)
    return counts, labels


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(col(id_col).alias("doc_id"), held_out(col(id_col)).alias("held_out"),
                       text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b, texts in slices(batches, most=256):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(shared.value.score(texts), pa.float64())],
                names=["doc_id", "held_out", "score"])

    scored = map_arrow(rows, run, f"doc_id {id_type}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, decided where they are read."""
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score_of(text: pd.Series) -> pd.Series:
        rows = pa.RecordBatch.from_arrays([pa.array(text, pa.string())], names=["text"])
        return pd.Series(np.concatenate([shared.value.score(t) for _, t in slices([rows], most=256)]))

    return docs.where(score_of(text_or_empty(text_col)) >= threshold)
