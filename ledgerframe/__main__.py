"""Command line: run the statement job.

    python -m ledgerframe run (--workbooks DIR [--nested] | --tables DIR [--tables-format csv|parquet])
        --out DIR [--rates FILE.json]
        [--prices PATH] [--daily-prices PATH] [--prices-format parquet|csv]
        [--keys owner] [--incremental] [--no-gate] [--csv]
        [--sales-threshold 20000] [--cluster]

Works under ``spark-submit`` as well: the session comes from the submitting
environment, and executors get the package as a wheel installed on them or with
``--py-files``.  ``--cluster`` adds the cluster sizing profile.
"""

from __future__ import annotations

import argparse
import json
import sys

from .operators.report import SALES_EXEMPTION_LIMIT
from .session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m ledgerframe")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="land workbooks and build marts, checks and report")
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--workbooks", help="folder of .xlsx statements")
    source.add_argument("--tables", help="folder with one folder of files for each raw table")
    run.add_argument("--tables-format", default="csv", choices=["csv", "parquet"])
    run.add_argument("--nested", action="store_true", help="also workbooks in folders below")
    run.add_argument("--out", required=True)
    run.add_argument("--rates", help="landed rate series (JSON array of {data, valor})")
    run.add_argument("--prices", help="landed index prices (symbol, date, close|adj_close)")
    run.add_argument("--daily-prices", help="prices of symbols that --prices does not have")
    run.add_argument("--prices-format", default="parquet", choices=["parquet", "csv"])
    run.add_argument("--keys", nargs="*", default=[], help="portfolio key columns")
    run.add_argument("--incremental", action="store_true", help="decode only new and changed files")
    run.add_argument("--no-gate", action="store_true", help="go on although checks fail")
    run.add_argument("--csv", action="store_true", help="also write CSV copies of the report")
    run.add_argument("--sales-threshold", type=float, default=SALES_EXEMPTION_LIMIT)
    run.add_argument("--cluster", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(cluster=args.cluster)
    from .plans.statement_run import run_tables, run_workbooks
    from .sources import series as SR
    rates = SR.read_landed_rates(spark, args.rates) if args.rates else None
    prices = SR.read_prices(spark, args.prices, args.prices_format) if args.prices else None
    if args.daily_prices:
        prices = SR.monthly_then_daily(prices, SR.read_prices(spark, args.daily_prices, args.prices_format))
    common = dict(keys=args.keys, gate=not args.no_gate, csv_report=args.csv,
                  sales_threshold=args.sales_threshold, rates=rates, prices=prices)
    if args.tables:
        res = run_tables(spark, args.tables, args.out, args.tables_format, **common)
    else:
        res = run_workbooks(spark, args.workbooks, args.out, incremental=args.incremental,
                            nested=args.nested, **common)
    summary = {r.table_name: r.row_count for r in res.load_summary.collect()}  # 7 rows
    print(json.dumps({"raw_rows": summary, "marts": res.marts, "report": sorted(res.report)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
