"""Raw statement tables landed as CSV or Parquet (instead of workbooks).

A file's cells are taken **by the names of its own header**, never by position: files of
one folder may have their columns in any order, other headers or more of them.  Headers
are cleaned as those of workbooks are (I6, I10), so the landed rows have the workbook
landing's shape (:data:`.workbook.LANDED_SCHEMA`) and share everything after it: typing,
sparse rows, ``_extra_columns``, ``_rejected``, ``key=value`` folders and the landing
checks.

CSV plan: one text pass finds the first line of each file, a small table of headers (one
row for each file) is cleaned, and the rows, read once with their first line left out,
are joined to it by file.  Spark broadcasts the headers only while they are small; a
larger table is a sort-merge join in which AQE splits a file that holds most rows.
Parquet columns have names already; files of different columns are merged by name, and
where the types of a column differ between files they are read as text, file schema by
file schema.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .workbook import (BEYOND, CLASH, LANDED_SCHEMA, MISSING_TEXT, _headers, conform_raw, file_name_of,
                       landing_root, path_keys)

HEADER_SCHEMA = "path string, source_file string, keys map<string,string>, columns array<string>, " \
                "width int, clashes string"


def clean_headers(headers: Sequence[str | None]) -> tuple[list[str | None], dict[str, list[str]]]:
    """Clean name of each position (None: no name, its cells are left out) and the
    headers of each clean name that several clean to."""
    names, clashes = _headers({i: h for i, h in enumerate(headers) if h is not None and h.strip()})
    return [names.get(i) for i in range(len(headers))], clashes


def by_header(names: Column, values: Column) -> Column:
    """Cells of one row as a map from its own header: ``names[i]`` names ``values[i]``.
    A NULL name drops its cell; cells beyond the header are kept under their position;
    missing-value texts are no cells."""
    named = F.transform(values, lambda v, i: F.struct(
        F.when(i < F.size(names), F.get(names, i)).otherwise(F.concat(F.lit(BEYOND), i.cast("string")))
        .alias("k"), v.alias("v")))
    kept = F.filter(named, lambda e: e["k"].isNotNull() & e["v"].isNotNull()
                    & ~e["v"].isin(*sorted(MISSING_TEXT)))
    return F.map_from_entries(kept)


def _scan(spark: SparkSession, pattern: str, nested: bool):
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(nested).lower())


def csv_headers(spark: SparkSession, folder: str, sep: str = ",", pattern: str = "*.csv",
                nested: bool = False) -> DataFrame:
    """The cleaned header of every file: one row a file."""
    lines = (_scan(spark, pattern, nested).text(folder)
             .select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_block_start").alias("at"), "value",
                     F.monotonically_increasing_id().alias("line"))
             .filter((F.col("at") == 0) & (F.trim("value") != ""))
             .groupBy("path").agg(F.min_by("value", "line").alias("header")))
    root = landing_root(spark, folder)

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, header in zip(batch["path"], batch["header"]):
                columns, clashes = clean_headers(next(csv.reader([header.lstrip("﻿")], delimiter=sep)))
                name = file_name_of(path, root)
                rows.append((path, name, path_keys(name), columns, sum(c is not None for c in columns),
                             json.dumps(clashes, ensure_ascii=False)))
            yield pd.DataFrame(rows, columns=["path", "source_file", "keys", "columns", "width", "clashes"])

    return lines.mapInPandas(clean, HEADER_SCHEMA)


def _clash_rows(headers: DataFrame, table: str) -> DataFrame:
    """Headers that clean to one name, as the workbook landing reports them."""
    found = headers.select("source_file", "keys", F.explode(
        F.from_json("clashes", "map<string,array<string>>")).alias("column", "headers"))
    return _landed(found, CLASH, F.lit(0), F.create_map(
        F.lit("table"), F.lit(table), F.lit("column"), F.col("column"),
        F.lit("headers"), F.array_join("headers", " | ")))


def _landed(rows: DataFrame, table: str, width: Column, cells: Column) -> DataFrame:
    return rows.select(
        F.col("source_file"), F.lit(table).alias("table_name"), F.lit(None).cast("string").alias("sheet_name"),
        F.lit(None).cast("int").alias("row_index"), width.cast("int").alias("header_width"),
        F.lit(None).cast("string").alias("date_epoch"), F.col("keys"), cells.alias("cells"))


def land_csv(spark: SparkSession, folder: str, table: str, sep: str = ",", pattern: str = "*.csv",
             nested: bool = False, multi_line: bool = False) -> DataFrame:
    """Landed rows of the CSV files of a folder; none -> an empty DataFrame.  A header is
    one line; ``multi_line`` allows line ends inside quoted cells."""
    headers = csv_headers(spark, folder, sep, pattern, nested)
    widest = headers.agg(F.max(F.size("columns"))).first()[0] or 0
    # one column more than any header, so that a row too long for all of them shows
    cells = [f"c{i}" for i in range(widest + 1)]
    rows = (_scan(spark, pattern, nested).schema(T.StructType([T.StructField(c, T.StringType()) for c in cells]))
            .option("header", "true").option("enforceSchema", "true").option("sep", sep)
            .option("escape", '"').option("multiLine", str(multi_line).lower()).csv(folder)
            .select(F.col("_metadata.file_path").alias("path"), F.array(*cells).alias("v")))
    named = rows.join(headers.select("path", "source_file", "keys", "columns", "width"), "path")
    landed = _landed(named, table, F.col("width"), by_header(F.col("columns"), F.col("v")))
    return landed.unionByName(_clash_rows(headers, table))


def _parquet_parts(spark: SparkSession, folder: str, nested: bool) -> list[DataFrame]:
    """One DataFrame with the columns of all files; where two files give a column types
    that do not merge, one for each file schema."""
    try:
        return [_scan(spark, "*.parquet", nested).option("mergeSchema", "true").parquet(folder)]
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    by_schema: dict[str, list[str]] = {}
    for r in _scan(spark, "*.parquet", nested).format("binaryFile").load(folder).select("path").collect():
        by_schema.setdefault(spark.read.parquet(r["path"]).schema.json(), []).append(r["path"])
    return [spark.read.parquet(*paths) for paths in by_schema.values()]


def land_parquet(spark: SparkSession, folder: str, table: str, nested: bool = False) -> DataFrame:
    """Landed rows of the Parquet files of a folder, by column name.  A row is sparse
    when it has no value at all: a Parquet file has no header row to compare with."""
    root = landing_root(spark, folder)

    @F.pandas_udf("source_file string, keys map<string,string>")
    def named(path: pd.Series) -> pd.DataFrame:
        names = [file_name_of(p, root) for p in path]
        return pd.DataFrame({"source_file": names, "keys": [path_keys(n) for n in names]})

    parts = []
    for df in _parquet_parts(spark, folder, nested):
        columns, clashes = clean_headers(df.columns)
        values = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns]) if df.columns \
            else F.array().cast("array<string>")
        files = df.select(F.col("_metadata.file_path").alias("path"), values.alias("v"))
        names = files.select("path").distinct().select("path", named("path").alias("f")).select("path", "f.*")
        rows = files.join(names, "path")
        parts.append(_landed(rows, table, F.lit(1), by_header(F.array(*[F.lit(c) for c in columns]), F.col("v"))))
        if clashes:
            one = spark.createDataFrame([(folder, {}, json.dumps(clashes, ensure_ascii=False))],
                                        "source_file string, keys map<string,string>, clashes string")
            parts.append(_clash_rows(one, table))
    return reduce(DataFrame.unionByName, parts)


def land_table(spark: SparkSession, folder: str, table: str, fmt: str = "parquet", nested: bool = False,
               **options) -> DataFrame:
    land = {"csv": land_csv, "parquet": land_parquet}[fmt]
    return land(spark, folder, table, nested=nested, **options).select(*LANDED_SCHEMA.names)


def read_raw_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet",
                   keys: Sequence[str] = (), **options) -> DataFrame:
    """The typed raw table of a folder.  ``keys``: columns of the data or ``key=value``
    folders of the path.  Its losses: :func:`.workbook.landing_checks` of the table and
    of :func:`land_table`'s rows."""
    options.setdefault("nested", bool(keys))
    return conform_raw(land_table(spark, path, table, fmt, **options), table, keys, extension=fmt,
                       own_lineage=True)
