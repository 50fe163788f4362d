"""A full run: land -> raw tables -> staging checks -> shared intermediates
-> marts -> checks -> report sections, each stage read back from what the
previous one wrote.

Writing the raw tables and marts and reading them back is also the lineage
cut: a lost executor recomputes from the last written table, never from the
workbooks.  Quality gates (Q11) run after the landing (nothing may be lost), the
staging models, the intermediates and the marts, each model once on what is stored,
and stop the run on any failure.  Marts are written beside the old ones and take
their places only after they passed.  Row counts (I14) and row checks of what a run
writes are observed by the writes, without a scan.  All results are written to
``<out_dir>/checks``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..operators import benchmarks as B
from ..operators import quality as Q
from ..operators import report as R
from ..operators import transforms as T
from ..schemas import RAW_SCHEMAS
from ..sinks import exists, publish, read_table, replace, stage_table, write_report, write_tables
from ..sources import landing as LA
from ..sources import workbook as WB
from ..sources.incremental import land_changes
from .maintained import maintain
from .marts import build_marts


@dataclass
class RunResult:
    load_summary: DataFrame
    checks: DataFrame
    marts: dict[str, str]
    report: dict[str, str]


def read_raw(spark: SparkSession, root: str, schemas: dict | None = None) -> dict[str, DataFrame]:
    schemas = schemas or {}
    return {t: read_table(spark, root, t, schemas.get(t, RAW_SCHEMAS[t])) for t in RAW_SCHEMAS}


def benchmark_sections(wallet: DataFrame, rates: DataFrame | None, prices: DataFrame | None,
                       keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """B1-B7 on the stored wallet: the periods are its (few) rows, so the
    fetch windows and alignments never touch position data.  A missing
    series gives zeros (B6)."""
    spark = wallet.sparkSession
    periods = wallet.select(*keys, "_reference_period")
    rates = rates if rates is not None else spark.createDataFrame([], "date date, rate_pct double")
    prices = prices if prices is not None else spark.createDataFrame(
        [], "symbol string, date date, close double")
    closes = B.month_end_close(prices)
    cdi = B.cumulative_rate(B.monthly_rate_returns(rates), periods, keys)
    idx = B.forward_fill_returns(B.index_returns_for_periods(closes, periods, keys), keys)
    return {"cdi_cumulative": cdi, "index_returns": idx,
            "performance_vs_benchmarks": B.benchmark_comparison(wallet, rates, closes, keys)}


def run(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str,
        keys: Sequence[str] = (), gate: bool = True, csv_report: bool = False,
        sales_threshold: float = R.SALES_EXEMPTION_LIMIT,
        rates: DataFrame | None = None, prices: DataFrame | None = None,
        landed: DataFrame | None = None, sums: dict[str, DataFrame] | None = None) -> RunResult:
    """Run everything from raw tables already in memory or on storage.
    ``landed``: the workbook rows they come from, for the landing checks.  ``sums``:
    maintained sums of them (:mod:`.maintained`) that the models read in their place.
    ``rates`` ``(date, rate_pct)`` and ``prices`` ``(symbol, date, close)``
    are the landed benchmark series (see :mod:`ledgerframe.sources.series`)."""
    raw_root, mart_root = f"{out_dir}/raw", f"{out_dir}/marts"
    landing = {t: Q.Watch(t) for t in raw}
    write_tables(raw, raw_root, watch=landing)                         # K1
    stored_raw = read_raw(spark, raw_root, {t: df.schema for t, df in raw.items()})
    summary = spark.createDataFrame([(t, w.rows) for t, w in landing.items()],
                                    WB.SUMMARY_SCHEMA).coalesce(1)     # I14

    results: list = []

    def check(found: DataFrame | None, observed: Sequence[Q.Watch] = ()) -> None:
        """One row per check: compute once, write all so far, stop on failures."""
        new = [r for w in observed for r in w.results()]
        new += found.select(*Q.RESULT_COLUMNS).collect() if found is not None else []
        if not new:
            return
        results.extend(new)
        so_far = spark.createDataFrame(results, Q.RESULT_SCHEMA).coalesce(1)
        replace(spark, f"{out_dir}/checks", lambda to: so_far.write.parquet(to))
        if gate:
            Q.stop_on_failures(new)

    check(WB.landing_checks(stored_raw, landed))
    marts = build_marts(stored_raw, keys, sums)
    models = marts.tables()
    row_local = [n for n in models if n.startswith("stg_") or n == "int_trades_clean"]
    check(Q.run_checks({n: models[n] for n in row_local}, keys))

    # The weighted price (ticker grain) and the equity positions (ticker x
    # month grain) feed several marts and checks: write them once and let
    # every consumer read the small stored aggregate instead of re-scanning
    # the position and trade tables.
    shared = {"int_weighted_avg_price": marts.weighted_avg_price,
              "int_all_equity_positions": marts.equity_positions}
    watches = {n: Q.Watch(n) for n in shared}
    write_tables(shared, f"{out_dir}/intermediate", partition_by=(), watch=watches)
    marts = marts.with_stored({n: read_table(spark, f"{out_dir}/intermediate", n, df.schema)
                               for n, df in shared.items()})
    models = marts.tables()
    check(Q.run_checks({n: models[n] for n in models if n.startswith("int_") and n not in row_local}, keys,
                       watched=list(shared)), list(watches.values()))

    mart_dfs = dict(marts.mart_tables())
    order = {m: [*keys, *cols[1:]] for m, cols in T.MART_ORDER.items()}
    watches = {m: Q.Watch(m) for m in mart_dfs}
    staged = {m: stage_table(df, f"{mart_root}/{m}", sort_within=order.get(m, ()), watch=watches[m])
              for m, df in mart_dfs.items()}
    check(Q.run_checks({m: spark.read.schema(mart_dfs[m].schema).parquet(to) for m, to in staged.items()},
                       keys, watched=list(staged)), list(watches.values()))
    mart_paths = {m: publish(spark, f"{mart_root}/{m}", to) for m, to in staged.items()}
    stored = {m: read_table(spark, mart_root, m, mart_dfs[m].schema) for m in mart_paths}  # K2
    stored_marts = marts.with_stored(stored)

    sections = R.build_sections(stored_marts, keys=keys, sales_threshold=sales_threshold)
    sections.update(benchmark_sections(stored["fct_monthly_wallet"], rates, prices, keys))
    report_paths = write_report(sections, f"{out_dir}/report", csv=csv_report)   # K3
    return RunResult(summary, spark.read.schema(Q.RESULT_SCHEMA).parquet(f"{out_dir}/checks"),
                     mart_paths, report_paths)


def run_workbooks(spark: SparkSession, folder: str, out_dir: str, keys: Sequence[str] = (),
                  incremental: bool = False, nested: bool = False, **kw) -> RunResult:
    """Entry point A: a folder of monthly statement workbooks.

    Every workbook is decoded once: the landed sheet rows are written (by
    raw table) and the seven raw tables are conformed from that copy, which
    also cuts the lineage back to the files.  ``incremental`` decodes only the
    files that are new or changed since the last run (:mod:`..sources.incremental`) and
    adds only their rows up for the models (:mod:`.maintained`).
    With ``keys`` (or ``nested``) files of folders below count too, ``key=value`` or
    others such as ``2023/``.  Files that cannot be
    decoded are listed in ``<out_dir>/unreadable_workbooks``, texts that do not
    parse in ``<out_dir>/rejects``, sheets without their key column in
    ``<out_dir>/missing_keys``; each stops a gated run, as the statement loader would
    stop.  ``<out_dir>/columns`` names the columns of every sheet."""
    files = WB.list_workbooks(spark, folder, nested=nested or bool(keys))
    if incremental:
        stored = land_changes(spark, files, f"{out_dir}/landing")
        kw["sums"] = maintain(spark, f"{out_dir}/landing", keys)
    else:
        landed_path = f"{out_dir}/landed_rows"
        rows = WB.land_workbooks(files)
        replace(spark, landed_path, lambda to: rows.write.partitionBy("table_name").parquet(to))
        stored = spark.read.schema(WB.LANDED_SCHEMA).parquet(landed_path)
    return _run_landed(spark, stored, WB.land_raw_tables(stored, keys), out_dir, keys, **kw)


def run_tables(spark: SparkSession, folder: str, out_dir: str, fmt: str = "csv", keys: Sequence[str] = (),
               options: dict | None = None, **kw) -> RunResult:
    """Entry point B: a folder with one folder of CSV or Parquet files for each raw
    table (``raw_trades/`` ...; absent ones are empty kinds).  Files are read by their
    own headers (:mod:`..sources.landing`); their losses are checked, listed and gated as
    those of workbooks."""
    there = [t for t in RAW_SCHEMAS if exists(spark, f"{folder}/{t}")]
    if not there:
        raise FileNotFoundError(f"no folder of a raw table in {folder}")
    landed = reduce(DataFrame.unionByName, [
        LA.land_table(spark, f"{folder}/{t}", t, fmt, nested=bool(keys), **(options or {})) for t in there])
    path = f"{out_dir}/landed_rows"
    replace(spark, path, lambda to: landed.write.partitionBy("table_name").parquet(to))
    stored = spark.read.schema(WB.LANDED_SCHEMA).parquet(path)
    raw = {t: WB.conform_raw(stored, t, keys, extension=fmt, own_lineage=True) for t in RAW_SCHEMAS}
    return _run_landed(spark, stored, raw, out_dir, keys, **kw)


def _run_landed(spark: SparkSession, stored: DataFrame, raw: dict[str, DataFrame], out_dir: str,
                keys: Sequence[str], **kw) -> RunResult:
    for name, df in (("unreadable_workbooks", WB.unreadable_workbooks(stored)), ("rejects", WB.rejects(raw)),
                     ("columns", WB.column_manifest(stored)), ("missing_keys", WB.missing_key_columns(stored))):
        replace(spark, f"{out_dir}/{name}", lambda to, df=df: df.write.parquet(to))
    return run(spark, raw, out_dir, keys=keys, landed=stored, **kw)
