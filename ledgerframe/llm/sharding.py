"""Sharding by sampled splitters, under the law ``bytes`` (sizes near equal).

1. A slim table (id, size, crc, hash of the text, a unique row number) is
   written once; texts are read once and never shuffled.
2. Rows are sampled with a probability proportional to their size, by a hash of
   the row (repeatable); the sample, about ``samples_per_range`` per range, gives
   size-weighted quantiles: the splitters of the key (hash, id, row number).
3. Ranges that turn out overfull get splitters from a denser sample of their
   own rows.  The key is unique, so a group of copies of any size is split.
4. Bytes and rows of the ranges (a bounded list) give every range its offset;
   a window inside each range gives every row its exact place in the whole.
   The shard is the place of the row's middle byte, so shard sizes differ from
   the mean by less than one record.  Equal texts that together fill less than
   ``group_share`` of a shard are placed as one.

Defined cases: a NULL text has no bytes (size is the overhead alone), crc of the
empty string; NULL ids sort first; repeated rows are told apart by the row
number; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, importable, stored, text_or_empty

OVERHEAD = 16
RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 32
#: A range holding more than this many times the mean is subdivided.
OVERFULL = 2.0
KEY = ["h", "k", "uid"]


def slim_rows(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(
        col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(col(text_col)), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.coalesce(F.xxhash64(col(id_col)), F.lit(-2 ** 63)).alias("k"),
        F.monotonically_increasing_id().alias("uid"))


def weighted_sample(rows: DataFrame, want: int, total: int) -> np.ndarray:
    """Keys and weights (columns h, k, uid, weight), in key order; each row is
    taken with probability ``want * size / total``.  At most about ``want`` rows
    plus those larger than ``total / want``, themselves at most ``want``."""
    unit = (F.shiftrightunsigned(F.xxhash64(*KEY, F.lit(7)), 11).cast("double") / F.lit(float(2 ** 53)))
    got = rows.where(unit * float(total) < F.col("size").cast("double") * want) \
        .select(*KEY, F.greatest("size", F.lit(total // want)).alias("weight")).toPandas()
    return got.sort_values(KEY).to_numpy(np.int64) if len(got) else np.zeros((0, 4), np.int64)


def quantiles(sample: np.ndarray, parts: int) -> np.ndarray:
    """``parts - 1`` splitters at most, at equal shares of the sample's weight."""
    if not len(sample):
        return np.zeros((0, 3), np.int64)
    cum = np.cumsum(sample[:, 3])
    at = np.searchsorted(cum, cum[-1] * np.arange(1, parts) / parts)
    return sample[np.unique(np.minimum(at, len(sample) - 1)), :3]


def with_range(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``rows`` with ``r``, the number of splitters at or below the row's key."""
    edges = np.asarray(splitters, np.int64).reshape(-1, 3)
    edges = edges[np.lexsort((edges[:, 2], edges[:, 1], edges[:, 0]))]

    @F.pandas_udf("long")
    def place(h: pd.Series, k: pd.Series, uid: pd.Series) -> pd.Series:
        n = len(edges)
        keys = [np.concatenate([edges[:, i], s.to_numpy(np.int64)]) for i, s in enumerate((h, k, uid))]
        edge = np.arange(n + len(h)) < n
        order = np.lexsort((~edge, keys[2], keys[1], keys[0]))  # a splitter opens its range
        below = np.empty(n + len(h), np.int64)
        below[order] = np.cumsum(edge[order])
        return pd.Series(below[n:])

    return rows.withColumn("r", place(*KEY)) if len(edges) else rows.withColumn("r", F.lit(0).cast("long"))


def range_sizes(ranged: DataFrame) -> pd.DataFrame:
    return ranged.groupBy("r").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")) \
        .toPandas().sort_values("r").reset_index(drop=True)


def find_ranges(rows: DataFrame, n_ranges: int, total: int) -> tuple[DataFrame, pd.DataFrame]:
    """Rows with their range, and the sizes of the ranges."""
    edges = quantiles(weighted_sample(rows, n_ranges * SAMPLES_PER_RANGE, total), n_ranges)
    edges[:, 1:] = np.iinfo(np.int64).min  # between texts: copies share a range unless it is overfull
    for _ in range(4):
        ranged = with_range(rows, edges)
        sizes = range_sizes(ranged)
        fat = sizes[(sizes["bytes"] > OVERFULL * total / n_ranges) & (sizes["rows"] > 1)]
        if fat.empty:
            break
        inside = ranged.where(F.col("r").isin(*map(int, fat["r"])))
        fat_bytes = int(fat["bytes"].sum())
        more = weighted_sample(inside, int(fat_bytes * n_ranges / total + 1) * 4 * SAMPLES_PER_RANGE,
                               fat_bytes)
        added = quantiles(more, int(2 * fat_bytes * n_ranges / total) + 2)
        if not len(added):
            break
        # only a text that several splitters fall into is cut
        _, at, times = np.unique(added[:, 0], return_inverse=True, return_counts=True)
        added[times[at] == 1, 1:] = np.iinfo(np.int64).min
        edges = np.unique(np.concatenate([edges, added]), axis=0)
    return ranged, sizes


def shard(docs: DataFrame, shards: int = 40, text_col: str = "text", id_col: str = "doc_id",
          group_share: float = 0.01) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot,
    grown_shard (NULL: only the law ``key`` has one)."""
    spark = docs.sparkSession
    importable(spark)
    rows = stored(slim_rows(docs, text_col, id_col), "shard-rows")
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    if not total:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
    ranged, sizes = find_ranges(rows, shards * RANGES_PER_SHARD, total)
    sizes["before"] = sizes["bytes"].cumsum() - sizes["bytes"]
    sizes["rows_before"] = sizes["rows"].cumsum() - sizes["rows"]
    offsets = spark.createDataFrame(sizes[["r", "before", "rows_before"]],
                                    "r long, before long, rows_before long")
    order = Window.partitionBy("r").orderBy(*KEY)
    same = Window.partitionBy("r", "h")
    placed = (ranged
              .withColumn("cum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("n", F.row_number().over(order))
              .withColumn("g_end", F.max("cum").over(same))
              .withColumn("g_bytes", F.sum("size").over(same))
              .join(F.broadcast(offsets), "r"))
    whole = F.col("g_bytes") * shards <= total * group_share
    middle = F.col("before") + F.when(whole, F.col("g_end") - F.col("g_bytes") / 2) \
        .otherwise(F.col("cum") - F.col("size") / 2)
    placed = stored(placed.select(
        "doc_id", "size", "text_crc32", (F.col("rows_before") + F.col("n")).alias("nth"),
        F.least(F.lit(shards - 1), F.floor(middle * shards / total)).cast("int").alias("shard")),
        "shard-places")
    first = placed.groupBy("shard").agg(F.min("nth").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("nth") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """Write ``docs`` as one folder per shard, in slot order, and return the
    placement.  Ids must be unique and not NULL here."""
    placed = stored(shard(docs, shards, text_col, id_col), "shard-result")
    (docs.join(placed.select(F.col("doc_id").alias(id_col), "shard", "slot"), id_col)
     .repartition(shards, "shard").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
    return placed
