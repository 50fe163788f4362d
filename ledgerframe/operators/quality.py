"""Data-quality checks (Q1-Q11).

Every check returns a DataFrame ``(check_name, table_name, column_name,
failures BIGINT)``; ``failures`` counts what a failing test would return:

* ``not_null``            rows where the column is NULL;
* ``unique``              non-NULL values that occur more than once;
* ``unique_combination``  key combinations that occur more than once;
* ``accepted_values``     distinct non-NULL values outside the list;
* ``accepted_range``      rows where ``not (col > min)`` (``>=`` when inclusive),
                          NULL passes;
* singular checks         rows breaking a business invariant.

All row-level checks of one table (not-null, ranges, accepted values and the
singular invariants) run as a single aggregate pass over that table, and
each uniqueness key set as one grouped pass; a table with one key set and no
accepted values needs that grouped pass only, whose groups carry the row counts.
Nothing is collected until :func:`gate` reads the small result (one row per check).

Row checks of a table that is being written cost no pass at all: :class:`Watch`
counts them while the rows go by (``Observation``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, functions as F

from .transforms import traded

P = "_reference_period"
RESULT_COLUMNS = ("check_name", "table_name", "column_name", "failures")
RESULT_SCHEMA = "check_name string, table_name string, column_name string, failures bigint"


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    columns: tuple[str, ...]
    values: tuple = ()
    min_value: float | None = None
    inclusive: bool = True
    name: str = field(default="")


# Whole-string match of YYYY-MM (\A...\z: "$" would accept a trailing newline).
PERIOD_FORMAT = r"\A\d{4}-\d{2}\z"


PRICE_TOLERANCE = 0.01


# --------------------------------------------------------- declared tests ----
def _nn(table: str, *cols: str) -> Check:
    return Check("not_null", table, cols)


# The checks declared for each model.
GENERIC_CHECKS: tuple[Check, ...] = (
    _nn("stg_stock_positions", "ticker", "quantity", "closing_price", "current_value", P),
    _nn("stg_etf_positions", "ticker", "quantity", "closing_price", P),
    _nn("stg_fixed_income", "product_name", P),
    _nn("stg_treasury_bonds", "product_name", "invested_value", "current_value", P),
    _nn("stg_dividends", "product_name", "event_type", "net_value", P),
    _nn("stg_trades", "ticker", P),
    _nn("stg_stock_lending", P),
    _nn("int_trades_clean", "ticker", "buy_quantity", "avg_buy_price", "total_buy_cost", P),
    _nn("int_weighted_avg_price", "ticker", "total_shares_bought", "weighted_avg_price"),
    _nn("int_all_equity_positions", "ticker", "asset_type", "total_quantity",
        "total_current_value", P),
    _nn("int_monthly_portfolio_value", "asset_class", "total_value", P),
    _nn("fct_monthly_wallet", P, "total_portfolio_value", "total_invested"),
    _nn("fct_stock_detail", "ticker", P, "total_quantity", "current_closing_price",
        "total_current_value"),
    _nn("fct_dividend_summary", "ticker", "event_type", "total_income", P),
    _nn("fct_treasury_summary", "product_name", P, "total_invested", "total_current_value"),
    _nn("fct_fixed_income_summary", "product_name", P, "total_curva_value"),
    Check("unique", "int_weighted_avg_price", ("ticker",)),
    Check("unique", "fct_monthly_wallet", (P,)),
    Check("unique_combination", "int_all_equity_positions", ("ticker", P)),
    Check("unique_combination", "fct_monthly_wallet", (P,)),
    Check("unique_combination", "fct_stock_detail", ("ticker", P)),
    Check("unique_combination", "fct_dividend_summary", ("ticker", P, "event_type")),
    Check("accepted_values", "int_all_equity_positions", ("asset_type",), ("stock", "etf")),
    Check("accepted_values", "int_monthly_portfolio_value", ("asset_class",),
          ("equity", "treasury", "fixed_income")),
    Check("accepted_range", "int_weighted_avg_price", ("total_shares_bought",), min_value=0,
          inclusive=False),
    Check("accepted_range", "int_weighted_avg_price", ("weighted_avg_price",), min_value=0,
          inclusive=False),
    Check("accepted_range", "int_all_equity_positions", ("total_quantity",), min_value=0,
          inclusive=False),
    Check("accepted_range", "fct_monthly_wallet", ("total_portfolio_value",), min_value=0,
          inclusive=True),
    Check("accepted_range", "fct_stock_detail", ("total_quantity",), min_value=0,
          inclusive=False),
    Check("accepted_range", "fct_stock_detail", ("current_closing_price",), min_value=0,
          inclusive=False),
    Check("accepted_range", "fct_dividend_summary", ("total_income",), min_value=0,
          inclusive=False),
)


# A row-level metric: (check name, table name, column name, aggregate counting failures).
Metric = tuple[str, str, str, Column]


def _row_metrics(check: Check, among: Column | None = None) -> list[Metric]:
    """``among``: count only the rows that it holds for."""
    def count(failing: Column) -> Column:
        return F.count_if(failing if among is None else among & failing)

    t, c = check.table, check.columns[0]
    if check.kind == "not_null":
        return [("not_null", t, c, count(F.col(c).isNull())) for c in check.columns]
    if check.kind == "accepted_range":
        ok = (F.col(c) >= F.lit(check.min_value)) if check.inclusive else \
            (F.col(c) > F.lit(check.min_value))
        return [("accepted_range", t, c, count(~ok))]
    if check.kind == "accepted_values":
        other = ~F.col(c).isin(*check.values)
        return [("accepted_values", t, c,
                 F.count_distinct(F.when(other if among is None else among & other, F.col(c))))]
    return []


def _singular_metrics(table: str) -> list[Metric]:
    def period_format() -> Metric:
        return "reference_period_format", table, P, F.count_if(~F.col(P).rlike(PERIOD_FORMAT))

    t = F.col("ticker")
    expected = F.try_divide(F.col("total_invested"), F.col("total_shares_bought"))
    return {
        "stg_trades": [("no_f_suffix_in_trades", table, "ticker",
                        F.count_if(t.like("%F") & (F.length(t) > 1)))],
        "int_all_equity_positions": [("no_negative_quantities", table, "total_quantity",
                                      F.count_if(F.col("total_quantity") < 0))],
        "fct_monthly_wallet": [("portfolio_value_positive", table, "total_portfolio_value",
                                F.count_if(F.col("total_portfolio_value") < 0)), period_format()],
        "fct_stock_detail": [period_format()],
        "fct_dividend_summary": [period_format()],
        "int_weighted_avg_price": [(
            "weighted_avg_price_consistent", table, "weighted_avg_price",
            F.count_if((F.col("total_shares_bought") > 0) &
                       (F.abs(F.col("weighted_avg_price") - expected) > PRICE_TOLERANCE)))],
    }.get(table, [])


def _one_pass(df: DataFrame, metrics: list[Metric]) -> DataFrame:
    """All row-level metrics over one DataFrame in a single aggregate, returned as
    one result row per metric."""
    agg = df.agg(*[m.alias(f"_m{i}") for i, (_, _, _, m) in enumerate(metrics)])
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                              F.lit(col).alias("column_name"),
                              F.col(f"_m{i}").cast("bigint").alias("failures"))
                     for i, (name, table, col, _) in enumerate(metrics)])
    return agg.select(F.inline(rows))


def _duplicates(df: DataFrame, table: str, checks: list[Check], keys: Sequence[str],
                rows: Sequence[Metric] = ()) -> DataFrame:
    """Uniqueness checks of one table that group by the same columns, from one
    grouped pass: groups of two rows or more (``unique`` leaves NULL out).  ``rows``:
    row-level metrics that are counts, added up by group in the same pass."""
    columns = checks[0].columns
    twice = F.col("_group_rows") > 1
    metrics = [(name, t, col, F.coalesce(F.sum(f"_group_{i}"), F.lit(0)))
               for i, (name, t, col, _) in enumerate(rows)]
    metrics += [("unique", table, columns[0], F.count_if(twice & F.col(columns[0]).isNotNull()))
               if c.kind == "unique" else
               ("unique_combination_of_columns", table, ",".join([*keys, *columns]), F.count_if(twice))
               for c in checks]
    groups = df.groupBy(*keys, *columns).agg(
        F.count(F.lit(1)).alias("_group_rows"),
        *[m.alias(f"_group_{i}") for i, (_, _, _, m) in enumerate(rows)])
    return _one_pass(groups, metrics)


class Watch:
    """Row count and row-level checks of one table, counted while it is written.

    ``write_table(..., watch=Watch(name))`` counts in the last operator of the write, so in
    its result stage: Spark adds the metrics of a result task once, however often a lost
    executor makes it run.  Checks that count distinct values, and uniqueness, are not
    additive and stay with :func:`batched_checks`."""

    def __init__(self, table: str, declared: Sequence[Check] = GENERIC_CHECKS):
        self.table = table
        self.metrics = [m for c in declared if c.table == table and c.kind != "accepted_values"
                        for m in _row_metrics(c)] + _singular_metrics(table)
        self._seen = Observation()

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"),
                          *[m.alias(f"_m{i}") for i, (_, _, _, m) in enumerate(self.metrics)])

    @property
    def rows(self) -> int:
        """Rows written (waits for the write)."""
        return self._seen.get["rows"]

    def results(self) -> list[Row]:
        """The checks' rows (RESULT_COLUMNS)."""
        return [Row(check_name=name, table_name=t, column_name=col, failures=self._seen.get[f"_m{i}"])
                for i, (name, t, col, _) in enumerate(self.metrics)]


def batched_checks(tables: dict[str, DataFrame], kinds: Sequence[str] | None = None,
                   singular: bool | str = True, keys: Sequence[str] = (),
                   declared: Sequence[Check] = GENERIC_CHECKS,
                   watched: Sequence[str] = ()) -> DataFrame | None:
    """Declared checks (and the singular ones, or the one named) with one scan per
    table for every row-level check, plus one grouped pass per uniqueness key set (see
    above for when one pass does both).  T1 keeps rows of S6 as they are, so both are
    checked in one pass.  ``watched``: tables whose rows a :class:`Watch` has counted.
    None if nothing is left to check."""
    def of(table: str) -> list[Check]:
        return [c for c in declared if c.table == table and (kinds is None or c.kind in kinds)]

    parts: list[DataFrame] = []
    together = "stg_trades" in tables and "int_trades_clean" in tables
    for table in tables:
        if together and table == "int_trades_clean":
            continue
        counts = [] if table in watched else [
            *[m for c in of(table) if c.kind != "accepted_values" for m in _row_metrics(c)],
            *[m for m in _singular_metrics(table) if singular in (True, m[0])]]
        metrics = counts + [m for c in of(table) if c.kind == "accepted_values" for m in _row_metrics(c)]
        also = [m for c in of("int_trades_clean") for m in _row_metrics(c, traded())] \
            if together and table == "stg_trades" else []
        unique = [c for c in of(table) if c.kind in ("unique", "unique_combination")]
        if not also and metrics == counts and len({c.columns for c in unique}) == 1:
            parts.append(_duplicates(tables[table], table, unique, keys, counts))
            continue
        if metrics or also:              # tables without checks are never built
            df = tables[table]
            if also:
                df = df.withColumn("total_buy_cost", F.col("buy_quantity") * F.col("avg_buy_price"))
            parts.append(_one_pass(df, metrics + also))
        for columns in dict.fromkeys(c.columns for c in unique):
            parts.append(_duplicates(tables[table], table, [c for c in unique if c.columns == columns],
                                     keys))
    # every part has RESULT_COLUMNS in order: a positional union is enough
    return reduce(DataFrame.union, [p.select(*RESULT_COLUMNS) for p in parts]) if parts else None


def generic_checks(tables: dict[str, DataFrame], kind: str | None = None,
                   keys: Sequence[str] = ()) -> DataFrame:
    """The declared checks of the given kind over the tables provided (checks
    of tables not in ``tables`` are skipped, so a stage can be gated alone)."""
    kinds = [kind] if kind else None
    return batched_checks(tables, kinds, singular=False, keys=keys)


def run_checks(tables: dict[str, DataFrame], keys: Sequence[str] = (),
               watched: Sequence[str] = ()) -> DataFrame | None:
    """Q11 input: every generic and singular check over the given models,
    batched per table."""
    return batched_checks(tables, keys=keys, watched=watched)


def singular_check(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """One singular check (Q6-Q10) over the models it is declared for."""
    return batched_checks(tables, kinds=(), singular=name)


class QualityGateError(RuntimeError):
    pass


def stop_on_failures(rows: Iterable) -> None:
    failing = [r for r in rows if r.failures > 0]
    if failing:
        lines = [f"{r.check_name} {r.table_name}.{r.column_name}: {r.failures}" for r in failing]
        raise QualityGateError("data-quality checks failed:\n" + "\n".join(lines))


def gate(results: DataFrame) -> DataFrame:
    """Q11: stop the run when any check has failures.  Only the failing
    rows of the (small, one row per check) result reach the driver."""
    stop_on_failures(results.filter(F.col("failures") > 0).collect())
    return results
