"""Landing only the statement files that are new or have changed.

The rows of every landing are appended under a batch number, and a manifest
names, for each file that is there now, the batch that holds its rows.  A file
counts as changed when its modification time or length differs, whatever its
age; its older rows, and those of files that are gone, are simply no longer
named.  The current rows therefore equal those of a full reload.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from . import workbook as WB

MANIFEST_SCHEMA = "path string, modificationTime timestamp, length long, source_file string, batch long"


def _last_manifest(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """Number and rows of the last complete manifest (-1 and none at first)."""
    try:
        all_ = spark.read.schema(f"{MANIFEST_SCHEMA}, version long").parquet(f"{root}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return -1, spark.createDataFrame([], MANIFEST_SCHEMA)
    last = all_.agg(F.max("version")).first()[0]
    return (-1, spark.createDataFrame([], MANIFEST_SCHEMA)) if last is None \
        else (last, all_.where(F.col("version") == last).drop("version"))


@F.pandas_udf(T.StringType())
def _names(path: pd.Series, root: pd.Series) -> pd.Series:
    """The name of each file, as the parser gives it."""
    return pd.Series([WB.file_name_of(*p) for p in zip(path, root)], dtype=object)


def land_changes(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """Decode the files that the last manifest does not know as they are, and
    return the landed rows of all files that are there now."""
    version, known = _last_manifest(spark, root)
    batch, identity = version + 1, ["path", "modificationTime", "length"]
    here = files.select(*identity, _names("path", "root").alias("source_file"))
    new = files.join(known.select(*identity), identity, "left_anti")
    WB.land_workbooks(new).write.mode("overwrite").partitionBy("table_name") \
        .parquet(f"{root}/rows/batch={batch}")
    here.join(known.select(*identity, "batch"), identity, "left") \
        .withColumn("batch", F.coalesce("batch", F.lit(batch))) \
        .write.mode("overwrite").parquet(f"{root}/manifest/version={batch}")
    return batches(spark, root).join(manifest(spark, root), ["source_file", "batch"], "left_semi") \
        .select(*WB.LANDED_SCHEMA.names)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(source_file, batch): the batch that holds the rows of each file there is now."""
    return _last_manifest(spark, root)[1].select("source_file", "batch")


def batches(spark: SparkSession, root: str) -> DataFrame:
    """The landed rows of every batch, old ones too, with its number."""
    schema = T.StructType([*WB.LANDED_SCHEMA.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).parquet(f"{root}/rows")
