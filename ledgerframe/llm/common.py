"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only
    in local mode.  Executors of a cluster could not read each other's folders."""
    named = spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="ledgerframe-shared-")
    return _FALLBACK[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: the
    lineage ends there, and a lost executor costs no recomputation of what lies
    before.  The tables stay until the cluster clears its checkpoint folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ledgerframe-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def col(name: str) -> Column:
    """Column by its exact name (dots and odd characters included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_struct(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, so that no name can clash with an
    operator's own columns."""
    return F.struct(*[col(c) for c in df.columns])


def unpack(df: DataFrame, struct_name: str, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(struct_name).getField(c).alias(c) for c in columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.  A
    cluster installs it on its executors or gets it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def sampled_texts(rows: DataFrame, every: int) -> tuple[list[bytes], np.ndarray]:
    """The texts whose hash is a multiple of ``every``, once each, and how many rows
    have them."""
    found = rows.where((F.pmod("xx", F.lit(every)) == 0) & (F.octet_length("text") <= 65_536)) \
        .groupBy("xx").agg(F.max("text").alias("text"), F.count("*").alias("n")).collect()
    return [r["text"].encode() for r in found], np.array([r["n"] for r in found], np.int64)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the jobs run inside, so that rows
    with long texts don't add up to large batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: What a worker process keeps from task to task and can build again.
CACHES: list[dict] = []


def give_back(caches: bool = False) -> None:
    """Return freed memory of this process to the system: workers outlive their tasks, the
    driver its sample or model, and the allocators would hold the largest one's memory.
    ``caches``: what other operators keep goes as well."""
    if caches:
        for kept in CACHES:
            kept.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, run, schema: str, alone: bool = False) -> DataFrame:
    """``mapInArrow`` whose tasks return their memory; ``alone``: they begin without the
    caches of other operators."""
    importable(df.sparkSession)

    def task(batches):
        if alone:
            give_back(caches=True)
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)
