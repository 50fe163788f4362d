"""Statement landing (I1-I14): monthly ``.xlsx`` workbooks -> raw tables.

Plan::

    binaryFile(*.xlsx)                      I1  one row per workbook
      -> mapInPandas(parse_workbooks)       I3 I4 I6 I10  one row per sheet row,
                                            cells as MAP<header, text>
      -> conform_raw(rows, table)           I2 I5 I7 I8 I9 I11 I13  typed columns
                                            from the declared schema

A workbook is a zip archive, so each file is opened by exactly one task; the
files themselves are spread over all tasks.  Only the zip/XML decoding runs
in Python (stdlib, no workbook library), row by row: a task holds a chunk of
``CHUNK_ROWS`` sheet rows and the workbook's shared strings, never a whole
sheet.  Header cleaning, numeric coercion, the sparse-row filter, period
extraction and typing are Spark expressions.

Nothing is lost in silence: text that does not parse stays in ``_rejected``, a
second header that cleans to a name already taken keeps its cells under a name
of its own, a file that cannot be decoded gives no rows at all, and each of
these is counted by :func:`landing_checks`, which stops a gated run.
"""

from __future__ import annotations

import datetime as dt
import itertools
import posixpath
import re
import unicodedata
import urllib.parse
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce
from io import BytesIO
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.numeric import parse_decimal_comma
from ..functions.periods import period_from_filename
from ..functions.text import blank_key, sanitize_header_py
from ..schemas import RAW_SCHEMAS

# --- fixed values: statement sheet names and their raw tables ---------------
SHEET_TABLES = {
    "Posição - Ações": "raw_stock_positions",
    "Posição - ETF": "raw_etf_positions",
    "Posição - Renda Fixa": "raw_fixed_income",
    "Posição - Tesouro Direto": "raw_treasury_bonds",
    "Proventos Recebidos": "raw_dividends",
    "Negociações": "raw_trades",
    "Posição - Empréstimos": "raw_stock_lending",
}
# Text cells the statement reader takes as missing (the default missing-value
# markers of the spreadsheet reader the statements were loaded with).
MISSING_TEXT = frozenset({
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
})
UNNAMED_PREFIX = "Unnamed"
# Built-in number formats that display a date or time (ECMA-376, 18.8.30).
BUILTIN_DATE_FORMATS = frozenset(range(14, 23)) | frozenset({45, 46, 47})
EXCEL_EPOCH = "1899-12-30"
EXCEL_MAX_SERIAL = 2958465          # 9999-12-31
UNREADABLE = "_unreadable"          # table_name of a row reporting a file that failed to parse
CLASH = "_header_clash"             # table_name of a row reporting headers that clean to one name
# ---------------------------------------------------------------------------
# The column that names a row of each kind: staging leaves out rows without it.
KEY_COLUMNS = {
    "raw_stock_positions": "Codigo_de_Negociacao", "raw_etf_positions": "Codigo_de_Negociacao",
    "raw_trades": "Codigo_de_Negociacao", "raw_fixed_income": "Produto", "raw_treasury_bonds": "Produto",
    "raw_dividends": "Produto", "raw_stock_lending": "Produto",
}
BEYOND = "_cell_"                   # cells further right than their header: name and position
CHUNK_ROWS = 2000

LANDED_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("sheet_name", T.StringType()),
    T.StructField("row_index", T.IntegerType()),
    T.StructField("header_width", T.IntegerType()),
    T.StructField("date_epoch", T.StringType()),
    T.StructField("keys", T.MapType(T.StringType(), T.StringType())),
    T.StructField("cells", T.MapType(T.StringType(), T.StringType())),
])

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


# ------------------------------------------------------- per-file helpers ---
def file_name_of(path: str, root: str = "") -> str:
    """The name a file is known by: its path below ``root`` (the landing folder, see
    :func:`landing_root`), URL-decoded and NFC-normalised (a name may arrive
    decomposed, e.g. ``c`` + combining cedilla), so that no two files of a landing
    share a name.  ``key=value`` folders that end the root belong to the name.  A path
    that is not below the root keeps its base name and the ``key=value`` folders it
    lies in."""
    path, root = (unicodedata.normalize("NFC", urllib.parse.unquote(p)) for p in (path, root))
    parts = path.split("/")
    above = root.split("/") if root and path.startswith(root + "/") else parts[:-1]
    keys = [*itertools.takewhile(lambda p: "=" in p, reversed(above))][::-1]
    return "/".join(keys + parts[len(above):])


def path_keys(name: str) -> dict[str, str]:
    """``owner=a/2023/report.xlsx`` -> ``{"owner": "a"}``."""
    return dict(p.split("=", 1) for p in name.split("/")[:-1] if "=" in p)


def match_sheets(sheet_names: list[str]) -> dict[str, str]:
    """The sheet of each kind.  A sheet and a kind belong together when one
    name contains the other, in any case; of several sheets the first counts."""
    related = [(table, sheet) for sheet in sheet_names for kind, table in SHEET_TABLES.items()
               if kind.lower() in sheet.lower() or sheet.lower() in kind.lower()]
    return dict(reversed(related))


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    """Text of a shared or inline string: its own ``<t>``, or the ``<t>`` of
    each rich-text run; phonetic guides (``<rPh>``) are not cell text."""
    if node is None:
        return ""
    t = node.find("m:t", _NS)
    if t is not None:
        return t.text or ""
    return "".join(r.findtext("m:t", default="", namespaces=_NS) for r in node.findall("m:r", _NS))


_QUOTED = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')


def _is_date_format(code: str) -> bool:
    """A custom number format shows a date when, outside quoted text,
    brackets and escapes, it has day/month/year/hour/second tokens."""
    return bool(re.search(r"[dmyhs]", _QUOTED.sub("", code.lower())))


def _date_styles(zf: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell formats (``s`` attribute) that display dates."""
    try:
        root = ET.fromstring(zf.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {int(f.get("numFmtId")): f.get("formatCode", "")
              for f in root.iter(f"{{{_NS['m']}}}numFmt")}
    xfs = root.find("m:cellXfs", _NS)
    out = set()
    for i, xf in enumerate(xfs.findall("m:xf", _NS) if xfs is not None else []):
        fmt = int(xf.get("numFmtId", "0"))
        if fmt in BUILTIN_DATE_FORMATS or (fmt in custom and _is_date_format(custom[fmt])):
            out.add(i)
    return out


def _serial_to_iso(value: str, epoch: dt.datetime) -> str:
    """An Excel date serial as ISO text (date, or date and time); a serial beyond
    the calendar stays as it is."""
    try:
        stamp = epoch + dt.timedelta(days=float(value))
    except OverflowError:
        return value
    if stamp.hour or stamp.minute or stamp.second:
        return stamp.strftime("%Y-%m-%d %H:%M:%S")
    return stamp.strftime("%Y-%m-%d")


def _elements(zf: zipfile.ZipFile, part: str, tag: str) -> Iterator[ET.Element]:
    """The elements ``tag`` of one part, one at a time; each is dropped from the
    tree once it has been used."""
    wanted, open_ = f"{{{_NS['m']}}}{tag}", []
    with zf.open(part) as f:
        for event, node in ET.iterparse(f, ("start", "end")):
            if event == "start":
                open_.append(node)
                continue
            open_.pop()
            if node.tag == wanted:
                yield node
                if open_:
                    open_[-1].remove(node)


def _read_sheet(zf: zipfile.ZipFile, target: str, shared: list[str],
                date_styles: frozenset[int] | set[int] = frozenset(),
                epoch: dt.datetime = dt.datetime(1899, 12, 30)) -> Iterator[dict[int, str]]:
    """Rows of a worksheet as ``{column index: text}``, in sheet order;
    numbers in a date format become ISO dates."""
    last = 0
    for row in _elements(zf, target, "row"):
        cells: dict[int, str] = {}
        for pos, c in enumerate(row.findall("m:c", _NS)):
            ref = c.get("r")
            m = _CELL_REF.match(ref) if ref else None
            col = _col_index(m.group(1)) if m else pos
            kind = c.get("t")
            if kind == "inlineStr":
                value = _text(c.find("m:is", _NS))
            else:
                v = c.find("m:v", _NS)
                if v is None or v.text is None:
                    continue
                value = v.text
                if kind == "s":
                    value = shared[int(value)]
                elif kind == "b":
                    value = "true" if value == "1" else "false"
                elif kind in (None, "n") and c.get("s") and int(c.get("s")) in date_styles:
                    value = _serial_to_iso(value, epoch)
            is_text = kind in ("s", "inlineStr", "str", "e")
            if value != "" and not (is_text and value in MISSING_TEXT):
                cells[col] = value
        number = int(row.get("r") or last + 1)
        if number <= last:
            raise ValueError(f"row {number} after row {last}")
        last = number
        yield cells


def _workbook_sheets(zf: zipfile.ZipFile) -> tuple[list[tuple[str, str]], bool]:
    """Sheet names with their part paths, in workbook order, and whether the
    workbook counts dates from 1904."""
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    pr = wb.find("m:workbookPr", _NS)
    date1904 = pr is not None and pr.get("date1904", "0").lower() in ("1", "true")
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels.iter(_PKG_REL)}
    out = []
    for s in wb.iter(f"{{{_NS['m']}}}sheet"):
        target = targets[s.get(_REL_NS)]
        target = target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target)
        out.append((unicodedata.normalize("NFC", s.get("name")), target))
    return out, date1904


def _headers(header_cells: dict[int, str]) -> tuple[dict[int, str], dict[str, list[str]]]:
    """Header row -> clean name of each column that has one (I6, I10), and the
    headers of each clean name that several clean to.  A repeated header gets
    ``.1``, ``.2``; a clean name already taken gets ``__2``, ``__3``."""
    names, seen, taken = {}, {}, {}
    for i, h in sorted(header_cells.items()):
        if h.startswith(UNNAMED_PREFIX):
            continue
        seen[h] = seen.get(h, -1) + 1
        h = f"{h}.{seen[h]}" if seen[h] else h
        same = taken.setdefault(sanitize_header_py(h), [])
        same.append(h)
        names[i] = sanitize_header_py(h) + (f"__{len(same)}" if len(same) > 1 else "")
    return names, {c: h for c, h in taken.items() if len(h) > 1}


def parse_workbook(name: str, content: bytes) -> Iterator[tuple]:
    """Rows of every matched, non-empty sheet of one workbook."""
    keys = path_keys(name)
    with zipfile.ZipFile(BytesIO(content)) as zf:
        parts = set(zf.namelist())
        shared = [_text(si) for si in _elements(zf, "xl/sharedStrings.xml", "si")] \
            if "xl/sharedStrings.xml" in parts else []
        sheets, date1904 = _workbook_sheets(zf)
        epoch = dt.datetime(1904, 1, 1) if date1904 else dt.datetime(1899, 12, 30)
        date_styles = _date_styles(zf)
        targets = dict(sheets)
        for table, sheet in match_sheets([s for s, _ in sheets]).items():
            rows = _read_sheet(zf, targets[sheet], shared, date_styles, epoch)
            names, clashes = _headers(next(rows, {}))
            for idx, r in enumerate(rows, start=1):
                if idx == 1:
                    for clean, headers in clashes.items():
                        yield (name, CLASH, sheet, 0, 0, str(epoch.date()), keys,
                               {"table": table, "column": clean, "headers": " | ".join(headers)})
                yield (name, table, sheet, idx, len(names), str(epoch.date()), keys,
                       {names[i]: v for i, v in r.items() if i in names})


def parse_workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``mapInPandas`` body: ``(path, content)`` batches -> landed rows, in chunks.
    A file that cannot be decoded, for whatever reason, yields one ``_unreadable``
    row with the error; rows it gave before are left out by :func:`readable`."""
    cols = [f.name for f in LANDED_SCHEMA.fields]
    for batch in batches:
        for path, root, content in zip(batch["path"], batch["root"], batch["content"]):
            name = file_name_of(path, root)
            rows = parse_workbook(name, bytes(content))
            while True:
                chunk, error = [], None
                try:
                    for row in itertools.islice(rows, CHUNK_ROWS):
                        chunk.append(row)
                except Exception as e:  # noqa: BLE001 - any fault of one file is reported, not fatal
                    error = (name, UNREADABLE, None, 0, 0, None, path_keys(name),
                             {"error": f"{type(e).__name__}: {e}"})
                if error:
                    yield pd.DataFrame([error], columns=cols)
                elif chunk:
                    yield pd.DataFrame(chunk, columns=cols)
                if error or len(chunk) < CHUNK_ROWS:
                    break


# ------------------------------------------------------------ Spark side ---
def landing_root(spark: SparkSession, folder: str) -> str:
    """A landing folder as Spark writes the paths of its files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return str(fs.makeQualified(path).toString()).rstrip("/")


def list_workbooks(spark: SparkSession, folder: str, pattern: str = "*.xlsx",
                   nested: bool = False) -> DataFrame:
    """The workbooks of a folder (``nested``: and of the folders in it, such as
    ``owner=a/`` or ``2023/``); none -> ``FileNotFoundError``.  ``root`` is the folder
    that the files are named from."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", str(nested).lower()).load(folder))
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no {pattern} files in {folder}")
    return files.withColumn("root", F.lit(landing_root(spark, folder)))


def land_workbooks(files: DataFrame) -> DataFrame:
    """I4: one row per data row of every matched sheet."""
    return files.select("path", "root", "content").mapInPandas(parse_workbooks, LANDED_SCHEMA)


def unreadable_workbooks(landed: DataFrame) -> DataFrame:
    """Files that could not be decoded, with the error."""
    return (landed.filter(F.col("table_name") == UNREADABLE)
            .select("source_file", F.col("cells").getItem("error").alias("error")))


def readable(landed: DataFrame) -> DataFrame:
    """The sheet rows of all files that could be decoded to their end."""
    bad = unreadable_workbooks(landed).select("source_file").distinct()
    return landed.filter(~F.col("table_name").isin(UNREADABLE, CLASH)) \
        .join(bad, "source_file", "left_anti").select(*landed.columns)


def _date_cell(text: Column, epoch: Column | None = None) -> Column:
    """A date cell: an Excel serial number, ``dd/MM/yyyy`` or ISO text."""
    epoch = F.coalesce(epoch, F.lit(EXCEL_EPOCH)) if epoch is not None else F.lit(EXCEL_EPOCH)
    serial = text.try_cast("double")
    in_range = (serial >= 1) & (serial <= EXCEL_MAX_SERIAL)
    return F.coalesce(
        F.when(in_range, F.date_add(epoch.cast("date"), F.floor(serial).cast("int"))),
        F.try_to_timestamp(text, F.lit("dd/MM/yyyy")).cast("date"),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("date"))


def typed_cell(cells: Column, name: str, dtype: T.DataType, epoch: Column | None = None) -> Column:
    """I7/I8 with a declared type: text keeps every character (``00123``
    stays), numbers accept a decimal comma, dates accept serials and text;
    what does not parse is NULL here and kept by :func:`rejected_cells`."""
    raw = cells.getItem(name)
    if isinstance(dtype, T.DoubleType):
        return parse_decimal_comma(raw)
    if isinstance(dtype, T.DateType):
        return _date_cell(raw, epoch)
    return raw.cast(dtype)


def rejected_cells(cells: Column, fields: Sequence[T.StructField], epoch: Column | None = None) -> Column:
    """Map of the declared number and date columns whose text does not parse, with
    that text."""
    typed = [f for f in fields if isinstance(f.dataType, (T.DoubleType, T.DateType))]
    if not typed:
        return F.create_map().cast("map<string,string>")
    entries = F.create_map(*[x for f in typed for x in (
        F.lit(f.name), F.when(typed_cell(cells, f.name, f.dataType, epoch).isNull(), cells.getItem(f.name)))])
    return F.map_filter(entries, lambda k, v: v.isNotNull())


def sparse_row_kept(cells: Column, header_width: Column) -> Column:
    """At least ``max(width // 2, 1)`` non-empty cells."""
    filled = F.size(F.map_filter(cells, lambda k, v: v.isNotNull()))
    return filled >= F.greatest(F.floor(header_width / 2).cast("int"), F.lit(1))


def conform_raw(landed: DataFrame, table: str, keys: Sequence[str] = (), extension: str = "xlsx",
                own_lineage: bool = False) -> DataFrame:
    """Landed rows of one kind -> the typed raw table.

    Columns missing from a workbook are NULL (schema evolution), columns
    not declared are kept as ``_extra_columns`` and texts that do not parse as
    ``_rejected`` (string maps); a kind with no rows is an empty DataFrame with
    the full declared schema.  ``keys`` come from ``key=value`` folders of the
    file's path, else from a column of that name in the sheet.  ``extension`` is that
    of the files; with ``own_lineage`` columns named like the lineage columns are them."""
    schema = RAW_SCHEMAS[table]
    declared = [f for f in schema.fields if not f.name.startswith("_")]
    lineage = ["_source_file", "_reference_period"] if own_lineage else []
    names = F.array(*[F.lit(n) for n in [*(f.name for f in declared), *keys, *lineage]])
    cells, epoch = F.col("cells"), F.col("date_epoch")
    rows = readable(landed).filter((F.col("table_name") == table) &
                                   sparse_row_kept(cells, F.col("header_width")))
    source, given = F.col("source_file"), lambda name: cells.getItem(name) if own_lineage else F.lit(None)
    source = F.coalesce(given("_source_file"), source)
    period = F.coalesce(given("_reference_period"),
                        period_from_filename(F.substring_index(source, "/", -1), extension))
    return rows.select(
        *[typed_cell(cells, f.name, f.dataType, epoch).alias(f.name) for f in declared],
        *[F.coalesce(F.col("keys").getItem(k), cells.getItem(k)).alias(k) for k in keys],
        source.alias("_source_file"),
        period.alias("_reference_period"),
        F.map_filter("cells", lambda k, v: ~F.array_contains(names, k)).alias("_extra_columns"),
        rejected_cells(cells, declared, epoch).alias("_rejected"))


class RawTables(dict):
    """Raw tables by name, all of one landing: ``landed`` is what they are conformed
    from, so that the losses of all kinds can be counted in one pass over it."""

    def __init__(self, tables: dict[str, DataFrame], landed: DataFrame):
        super().__init__(tables)
        self.landed = landed


def land_raw_tables(landed: DataFrame, keys: Sequence[str] = ()) -> RawTables:
    """All seven raw tables from one landing pass (cache ``landed`` when
    several are written)."""
    return RawTables({table: conform_raw(landed, table, keys) for table in RAW_SCHEMAS}, landed)


def typed_columns() -> list[tuple[str, T.DataType, list[str]]]:
    """The declared number and date columns: name, type, and the raw tables with them."""
    found: dict[tuple[str, str], tuple[str, T.DataType, list[str]]] = {}
    for table, schema in RAW_SCHEMAS.items():
        for f in schema.fields:
            if isinstance(f.dataType, (T.DoubleType, T.DateType)):
                found.setdefault((f.name, f.dataType.simpleString()), (f.name, f.dataType, []))[2].append(table)
    return [found[k] for k in sorted(found)]


def coercion_rejects(landed: DataFrame) -> DataFrame:
    """I8 report: per file, sheet and declared numeric/date column, how many
    non-empty cells there are and how many parse.  ``all_parse`` is the
    all-or-nothing decision the statement loader takes for a column.  One
    aggregate over the landed rows for all columns of all tables."""
    cells, epoch, table = F.col("cells"), F.col("date_epoch"), F.col("table_name")
    columns = typed_columns()
    counts = [x for i, (name, dtype, tables) in enumerate(columns) for x in (
        F.count(F.when(table.isin(*tables), cells.getItem(name))).alias(f"n{i}"),
        F.count(F.when(table.isin(*tables), typed_cell(cells, name, dtype, epoch))).alias(f"p{i}"))]
    agg = readable(landed).groupBy("source_file", "sheet_name", "table_name").agg(*counts)
    rows = F.array(*[F.struct(F.col(f"n{i}").alias("n_values"), F.col(f"p{i}").alias("n_parsed"),
                              F.lit(name).alias("column_name")) for i, (name, _, _) in enumerate(columns)])
    return (agg.select("source_file", "sheet_name", "table_name", F.inline(rows))
            .filter(F.col("n_values") > 0)
            .withColumn("all_parse", F.col("n_values") == F.col("n_parsed")))


def rejects(raw: dict[str, DataFrame]) -> DataFrame:
    """Every text that did not parse: table, file, column, text."""
    parts = [df.select(F.lit(t).alias("table_name"), "_source_file",
                       F.explode("_rejected").alias("column_name", "text"))
             for t, df in raw.items() if "_rejected" in df.columns]
    return reduce(DataFrame.unionByName, parts) if parts else None


def column_manifest(landed: DataFrame) -> DataFrame:
    """Which columns each sheet of each file has: source_file, table_name, sheet_name,
    column_name, n_values.  One aggregate over the landed rows."""
    return readable(landed).select("source_file", "table_name", "sheet_name",
                                   F.explode(F.map_keys("cells")).alias("column_name")) \
        .groupBy("source_file", "table_name", "sheet_name", "column_name").agg(F.count("*").alias("n_values"))


def _key_column(table: Column) -> Column:
    """The key column of a row's kind, NULL for other rows."""
    return F.coalesce(*[F.when(table == t, F.lit(c)) for t, c in KEY_COLUMNS.items()])


def missing_key_columns(landed: DataFrame) -> DataFrame:
    """Sheets whose rows would all be dropped by staging: none has a value in the key
    column of its kind (another header, or an empty column).  source_file, table_name,
    sheet_name, column_name, rows."""
    key = F.col("cells")[F.col("key")]
    return (readable(landed).filter(sparse_row_kept(F.col("cells"), F.col("header_width")))
            .withColumn("key", _key_column(F.col("table_name"))).filter("key is not null")
            .groupBy("source_file", "table_name", "sheet_name", F.col("key").alias("column_name"))
            .agg(F.count("*").alias("rows"), F.count_if(~blank_key(key)).alias("named"))
            .filter("named = 0").drop("named"))


def _losses(landed: DataFrame, parsed: bool) -> DataFrame:
    """Check results of the landed rows: one aggregate by file, kind and sheet counts all
    of them in one pass; which files can be decoded is settled on its few rows.
    ``parsed``: texts that do not parse as well."""
    cells, table, epoch = F.col("cells"), F.col("table_name"), F.col("date_epoch")
    clash, kept, key = table == CLASH, F.col("kept"), _key_column(table)
    columns = typed_columns() if parsed else []
    rows = landed.select(
        "source_file", "table_name", "sheet_name", "date_epoch", "cells",
        sparse_row_kept(cells, F.col("header_width")).alias("kept"),
        F.exists(F.map_keys(cells), lambda k: k.startswith(BEYOND)).alias("longer"),
        F.when(clash, cells.getItem("table")).alias("clash_table"),
        F.when(clash, cells.getItem("column")).alias("clash_column"))
    agg = rows.groupBy("source_file", "table_name", "sheet_name", "clash_table", "clash_column").agg(
        F.count("*").alias("rows"), F.count_if("longer").alias("longer"),
        F.count_if(kept).alias("kept"), F.count_if(kept & ~blank_key(cells[key])).alias("named"),
        *[F.count_if(table.isin(*tables) & kept & cells.getItem(name).isNotNull()
                     & typed_cell(cells, name, dtype, epoch).isNull()).alias(f"r{i}")
          for i, (name, dtype, tables) in enumerate(columns)])
    unreadable = table == UNREADABLE
    good = ~unreadable & ~clash & (F.col("source_file").isNull() | ~F.col("bad"))

    def loss(name: str, of: Column, column: Column, failures: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), of.alias("table_name"), column.alias("column_name"),
                        failures.alias("failures"))

    found = F.array(
        loss("unreadable_workbook", F.lit("landing"), F.col("source_file"), F.when(unreadable, F.col("rows"))),
        loss("headers_clean_to_one_name", F.col("clash_table"), F.col("clash_column"), F.when(clash, F.col("rows"))),
        loss("missing_key_column", table, key, F.when(good & key.isNotNull() & (F.col("named") == 0), kept)),
        loss("row_longer_than_header", table, F.lit(""), F.col("longer")),
        *[loss("text_does_not_parse", table, F.lit(name), F.when(good, F.col(f"r{i}")))
          for i, (name, _, _) in enumerate(columns)])
    return (agg.withColumn("bad", F.max(unreadable).over(Window.partitionBy("source_file")))
            .select(F.inline(found)).filter("failures > 0")
            .groupBy("check_name", "table_name", "column_name").agg(F.sum("failures").alias("failures")))


def landing_checks(raw: dict[str, DataFrame], landed: DataFrame | None = None) -> DataFrame | None:
    """Losses of the landing as check results (``check_name, table_name,
    column_name, failures``): texts that do not parse by column, files that cannot
    be decoded, headers that clean to one name, rows of sheets without their key column,
    rows with cells beyond their header.  NULL without anything to check.  Raw tables
    conformed from ``landed`` itself are checked in the one pass over its rows."""
    parts = []
    together = landed is not None and isinstance(raw, RawTables) and raw.landed is landed \
        and raw.keys() == RAW_SCHEMAS.keys()
    lost = None if together else rejects(raw)
    if lost is not None:
        parts.append(lost.groupBy("table_name", "column_name").agg(F.count("*").alias("failures"))
                     .select(F.lit("text_does_not_parse").alias("check_name"), "table_name",
                             "column_name", "failures"))
    if landed is not None:
        parts.append(_losses(landed, parsed=together))
    return reduce(DataFrame.unionByName, parts) if parts else None


def column_coercion(cells: DataFrame, group: list[str], value: str = "value") -> DataFrame:
    """I8 on long-form text cells: per group, the count of non-NULL values,
    of values that parse as numbers (decimal comma accepted), and whether
    the column becomes numeric (every non-NULL value parses, at least one)."""
    v = F.col(value)
    return (cells.groupBy(*group)
            .agg(F.count(v).alias("n_values"), F.count(parse_decimal_comma(v)).alias("n_numeric"))
            .withColumn("decision",
                        F.when((F.col("n_values") > 0) &
                               (F.col("n_numeric") == F.col("n_values")), F.lit("numeric"))
                        .otherwise(F.lit("text"))))


def column_coercion_wide(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """:func:`column_coercion` for text columns side by side: one aggregate
    per group for all columns, unpivoted afterwards, so only aggregated rows
    are multiplied by the number of columns."""
    agg = df.groupBy(*group).agg(*[
        x for c in columns for x in (F.count(F.col(c)).alias(f"_n_{c}"),
                                     F.count(parse_decimal_comma(F.col(c))).alias(f"_p_{c}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"),
                              F.col(f"_n_{c}").alias("n_values"),
                              F.col(f"_p_{c}").alias("n_numeric")) for c in columns])
    return (agg.select(*group, F.inline(rows))
            .withColumn("decision",
                        F.when((F.col("n_values") > 0) &
                               (F.col("n_numeric") == F.col("n_values")), F.lit("numeric"))
                        .otherwise(F.lit("text"))))


SUMMARY_SCHEMA = "table_name string, row_count bigint"


def load_summary(raw: dict[str, DataFrame]) -> DataFrame:
    """Row count per raw table (one aggregate per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(t))
             for t, df in raw.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "row_count")
