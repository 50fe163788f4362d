"""Exact deduplication by a heavy-hitter split.

1. Every row gets the SHA-256 of its text (nothing normalised).
2. ``freqItems`` - Spark's implementation of the Misra-Gries / Karp-Shenker-
   Papadimitriou counters - proposes at most ``1 / support`` digests; every
   digest held by more than ``support`` of the rows is among them.
3. The proposals are counted exactly; those that do hold ``support`` of the rows
   are the winners.  At most ``1 / support`` rows, so they can be broadcast.
4. The report settles all rows of a winner map-side: rows are numbered once, in the
   stored digests, and of the rows with the winning id the one with the largest
   number stays, so rows that repeat id and text together meet in no task.  All other
   rows (each remaining group is below ``support`` of the input) go through one
   ordinary shuffle on the digest.

Only DataFrame functions are used; whole texts are never shuffled for the
report.

Defined cases: a NULL text counts as empty; of equal texts the row with the
largest id stays, NULL ids last; of rows that repeat both id and text exactly
one stays; an empty table gives an empty result; extra columns travel in a
struct and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, row_struct, stored, text_or_empty, unpack

#: Share of all rows from which a digest counts as heavy.
SUPPORT = 0.001


def digests(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, sha) of every row; sha is the lowercase hex SHA-256 of the UTF-8 text."""
    return docs.select(col(id_col).alias("id"),
                       F.sha2(text_or_empty(text_col), 256).alias("sha"))


def heavy_digests(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(sha, top_id, heavy_size) of the digests held by at least ``support`` of
    ``rows`` and by two rows or more: at most ``1 / support`` rows."""
    least = max(2, int(rows.count() * support))
    proposed = (rows.stat.freqItems(["sha"], support)
                .select(F.explode("sha_freqItems").alias("sha")).distinct())
    return (rows.join(F.broadcast(proposed), "sha", "left_semi")
            .groupBy("sha").agg(F.max("id").alias("top_id"), F.count("*").alias("heavy_size"))
            .where(F.col("heavy_size") >= least))


def exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(digests(docs, text_col, id_col)
                  .withColumn("number", F.monotonically_increasing_id()), "digests")
    heavy = stored(_with_stay(rows, stored(heavy_digests(rows, support), "heavy")), "winners")
    marked = rows.join(F.broadcast(heavy), "sha", "left")
    settled = marked.where(F.col("heavy_size").isNotNull()).select(
        F.col("id").alias("doc_id"), F.col("top_id").alias("keep_id"),
        F.col("heavy_size").alias("group_size"), (F.col("number") == F.col("stay")).alias("kept"),
        F.col("sha").alias("text_sha256"))
    same = Window.partitionBy("sha")
    shuffled = marked.where(F.col("heavy_size").isNull()).select(
        F.col("id").alias("doc_id"), F.max("id").over(same).alias("keep_id"),
        F.count("*").over(same).alias("group_size"),
        (F.row_number().over(same.orderBy(F.col("id").desc_nulls_last())) == 1).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return settled.unionByName(shuffled)


def _with_stay(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """``heavy`` with the number of the row that stays (``stay``), found by partial
    aggregation; as many rows as ``heavy``."""
    last = (rows.join(F.broadcast(heavy), "sha")
            .where(F.col("id").eqNullSafe(F.col("top_id")))
            .groupBy("sha").agg(F.max("number").alias("stay")))
    return heavy.join(last, "sha")


def drop_exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                          support: float = SUPPORT) -> DataFrame:
    """``docs`` without the rows that :func:`exact_duplicates` drops.  Rows of
    heavy digests go before the shuffle, so no task gets a large group."""
    heavy = heavy_digests(stored(digests(docs, text_col, id_col), "digests"), support)
    rows = docs.select(F.sha2(text_or_empty(text_col), 256).alias("sha"),
                       col(id_col).alias("id"), row_struct(docs).alias("row"))
    rest = (rows.join(F.broadcast(stored(heavy, "heavy")), "sha", "left")
            .where(F.col("heavy_size").isNull() | F.col("id").eqNullSafe(F.col("top_id"))))
    first = Window.partitionBy("sha").orderBy(F.col("id").desc_nulls_last())
    kept = rest.withColumn("place", F.row_number().over(first)).where(F.col("place") == 1)
    return unpack(kept, "row", docs.columns)
