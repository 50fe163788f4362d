"""K1-K3, T14, T15.

Raw tables and marts are written as Parquet partitioned by
``_reference_period``: later reads filtered on a month prune whole
directories, and with ``partitionOverwriteMode=dynamic`` a run that lands one
new month rewrites only that month's partition (``full_refresh=True``
replaces the table, as the statement loader does on every run; the old one stays
readable until the new one is complete).  Rows are
clustered inside each partition (``sortWithinPartitions``) so the mart's
reading order costs no global sort at write time.
"""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

P = "_reference_period"
OLD, NEW = ".old", ".new-"          # suffixes of a table being replaced


def _files(spark: SparkSession, path: str):
    """The file system of a path, and what makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def exists(spark: SparkSession, path: str) -> bool:
    fs, make = _files(spark, path)
    return bool(fs.exists(make(path)))


def recover(spark: SparkSession, path: str) -> str:
    """Put back a table whose replacement was interrupted between its two renames."""
    fs, make = _files(spark, path)
    if not fs.exists(make(path)) and fs.exists(make(path + OLD)):
        fs.rename(make(path + OLD), make(path))
    return path


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Replace the table at ``path`` by what ``write`` writes: into a folder beside it,
    which takes the table's place by renaming once it is complete.  A run that ends
    before leaves the old table as it was; one that ends between the renames leaves it
    under a name that :func:`recover` knows.  Leftovers of such runs are removed here.
    (One writer at a time, as for any overwrite; on an object store, whose renames
    copy, the old table is missing while they do.)"""
    new = _beside(spark, path)
    write(new)
    return publish(spark, path, new)


def _beside(spark: SparkSession, path: str) -> str:
    """A new folder beside a table; those that ended runs left are removed."""
    fs, make = _files(spark, path)
    recover(spark, path)
    target = make(path)
    if target.getParent() is not None and fs.exists(target.getParent()):
        for left in fs.listStatus(target.getParent()):
            if left.getPath().getName().startswith(target.getName() + NEW):
                fs.delete(left.getPath(), True)
    return f"{path}{NEW}{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, new: str) -> str:
    """Let the complete table at ``new`` (of :func:`stage_table`) take the place of ``path``."""
    fs, make = _files(spark, path)
    target, old = make(path), make(path + OLD)
    if fs.exists(target):
        fs.delete(old, True)
        if not fs.rename(target, old):
            raise OSError(f"cannot rename {path}")
    if not fs.rename(make(new), target):
        raise OSError(f"cannot rename {new}")
    fs.delete(old, True)
    return path


Watcher = Callable[[DataFrame], DataFrame]


def _writer(df: DataFrame, partition_by: Sequence[str], sort_within: Sequence[str],
            watch: Watcher | None, mode: str) -> Callable[[str], None]:
    # (rows are only clustered inside each written partition; no global sort)
    parts = [c for c in partition_by if c in df.columns]
    out = df
    if parts:
        # cluster rows by period so each task writes few files, but through a
        # rebalance: AQE splits a period holding a large share of the rows
        # over several tasks instead of sending it to one
        out = out.hint("rebalance", *parts)
    if sort_within:
        out = out.sortWithinPartitions(*[c for c in sort_within if c in df.columns])
    if watch is not None:
        out = watch(out)

    def write(to: str) -> None:
        writer = out.write.mode("overwrite")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.option("partitionOverwriteMode", mode).parquet(to)

    return write


def stage_table(df: DataFrame, path: str, partition_by: Sequence[str] = (P,),
                sort_within: Sequence[str] = (), watch: Watcher | None = None) -> str:
    """Write a complete copy of a table beside ``path`` and return where it is: it can be
    read and checked before :func:`publish` lets readers see it.  A copy that is never
    published is removed by the next run."""
    new = _beside(df.sparkSession, path)
    _writer(df, partition_by, sort_within, watch, "static")(new)
    return new


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (P,),
                sort_within: Sequence[str] = (), full_refresh: bool = True,
                watch: Watcher | None = None) -> str:
    """Write one table; ``full_refresh`` replaces it (:func:`replace`), otherwise only
    the partitions present in ``df`` are overwritten.  ``watch`` sees the rows as they
    are written (:class:`..operators.quality.Watch`)."""
    if full_refresh:
        return replace(df.sparkSession, path, _writer(df, partition_by, sort_within, watch, "static"))
    _writer(df, partition_by, sort_within, watch, "dynamic")(recover(df.sparkSession, path))
    return path


def write_tables(tables, root: str, order: dict | None = None,
                 full_refresh: bool = True, partition_by: Sequence[str] = (P,),
                 watch: dict[str, Watcher] | None = None) -> dict[str, str]:
    order, watch = order or {}, watch or {}
    return {name: write_table(tables[name], f"{root}/{name}", partition_by=partition_by,
                              sort_within=order.get(name, ()), full_refresh=full_refresh,
                              watch=watch.get(name))
            for name in tables}


def read_table(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """Read a written table; pass the schema it was written with so that an
    empty table (no data files under its partition directories) reads back
    typed instead of failing schema inference."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(recover(spark, f"{root}/{name}"))


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write an aggregate that several models read under the cluster's shared folder
    (``spark.checkpoint.dir``; a temporary one only in local mode) and read it back."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerframe-")
    path = f"{root.rstrip('/')}/ledgerframe-models/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_report(sections: dict[str, DataFrame], root: str, csv: bool = False) -> dict[str, str]:
    """K3: one dataset per report section.  The optional CSV copy is made from the
    Parquet just written, in as many files as that has."""
    paths = {}
    for name, df in sections.items():
        path, spark = f"{root}/{name}", df.sparkSession
        replace(spark, path, lambda to, df=df: df.write.parquet(to))
        if csv:
            copy = spark.read.schema(df.schema).parquet(path)
            replace(spark, f"{path}_csv", lambda to, df=copy: df.write.option("header", "true").csv(to))
        paths[name] = path
    return paths
