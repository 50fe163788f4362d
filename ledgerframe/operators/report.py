"""Report sections (R1-R19) as DataFrames over the marts.

Each section is a small derived table (one row per month, ticker, event type
or latest position) computed with aggregates and window/scalar subqueries;
nothing is collected.  Sections that carry a total row return it as an extra
row with ``is_total = true`` (other key columns NULL), computed by a global
aggregate over the same rows.  A section over empty input is empty,
including its total row.

Pandas-style NULL rules of the report are kept where they differ from SQL:
group keys that are NULL are dropped, and a sum over only NULLs is 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.periods import period_label

P = "_reference_period"

# --- fixed values: report labels ---------------------------------------------
ASSET_TYPE_LABELS = {"etf": "ETF", "other": "Ação"}
CLASS_LABELS = (("equity_value", "Ações & ETFs"), ("treasury_value", "Tesouro Direto"),
                ("fixed_income_value", "Renda Fixa"))
EXEMPT_INCOME_PATTERN = "(?i)Dividendo"
TAXABLE_INCOME_PATTERN = "(?i)JCP|Juros"
SALES_EXEMPTION_LIMIT = 20000.0
ABOVE_LIMIT, NOT_ABOVE_LIMIT = "SIM", "NÃO"
# ---------------------------------------------------------------------------


def _sum0(c: str | Column) -> Column:
    """Sum that is 0 over no or only-NULL values (pandas ``sum``)."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def latest_rows(df: DataFrame, keys: Sequence[str] = (), year: str | None = None,
                months: DataFrame | None = None) -> DataFrame:
    """Rows at the latest period (per ``keys``); with ``year``, the last
    period of that year; with ``months``, the latest period found there.  Without
    keys the latest period is a scalar subquery (one value, planned once); with
    keys it is a per-key aggregate joined back on the keys."""
    scope = df.filter(F.col(P).startswith(f"{year}-")) if year else df
    months = scope if months is None else months
    if not keys:
        return scope.filter(F.col(P) == months.select(F.max(P)).scalar())
    last = months.groupBy(*keys).agg(F.max(P).alias("_latest"))
    return (scope.join(last, on=list(keys))
            .filter(F.col(P) == F.col("_latest")).drop("_latest"))


def with_total_row(detail: DataFrame, sum_cols: Sequence[str],
                   keys: Sequence[str] = ()) -> DataFrame:
    """``detail`` plus one total row (per keys) summing ``sum_cols``; the
    total row is produced only when there are detail rows."""
    totals = (detail.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in sum_cols])
              .filter(F.col("_n") > 0).drop("_n"))
    body = detail.withColumn("is_total", F.lit(False))
    return body.unionByName(totals.withColumn("is_total", F.lit(True)),
                            allowMissingColumns=True).select(*body.columns)


def grouped_with_total(df: DataFrame, group_cols: Sequence[str], sums: Sequence[str],
                       firsts: Sequence[str] = (), keys: Sequence[str] = (),
                       sum_exprs: dict[str, Column] | None = None) -> DataFrame:
    """Groups of ``group_cols`` (per ``keys``) and one total row per ``keys``
    in a single aggregation (GROUPING SETS): ``sums`` are summed in both,
    ``firsts`` are carried for the groups and NULL on the total row.  Used
    where ``group_cols`` identify the rows (a latest-position section) or the
    section is itself an aggregate; one pass over the input instead of two."""
    sum_exprs = sum_exprs or {}
    agg = (df.groupingSets([[*keys, *group_cols], list(keys)], *keys, *group_cols)
           .agg(*[sum_exprs.get(c, F.sum(c)).alias(c) for c in sums],
                *[F.first(c).alias(c) for c in firsts],
                F.grouping_id().alias("_gid")))
    total = F.col("_gid") != 0
    return agg.select(*keys, *group_cols, *sums,
                      *[F.when(total, F.lit(None)).otherwise(F.col(c)).alias(c) for c in firsts],
                      total.alias("is_total"))


def asset_type_label(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "etf", F.lit(ASSET_TYPE_LABELS["etf"])).otherwise(
        F.lit(ASSET_TYPE_LABELS["other"]))


# ------------------------------------------------------------- summary -----
def _latest_month(wallet: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The given columns of the latest month: one aggregate over the wallet, which
    has one row per month (and keys)."""
    last = wallet.groupBy(*keys).agg(F.max_by(F.struct(P, *columns), P).alias("_last"))
    return last.filter(F.col("_last").isNotNull()).select(*keys, "_last.*")


def latest_kpis(wallet: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Value, invested, gain of the latest month; return as a fraction."""
    columns = ["total_portfolio_value", "total_invested", "absolute_gain_loss", "pct_return"]
    return _latest_month(wallet, columns, keys).withColumn("pct_return", F.col("pct_return") / 100)


def allocation_by_class(wallet: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """R2: the latest month split in three classes with each class's share
    of the total (0 when the total is not positive)."""
    latest = _latest_month(wallet, [c for c, _ in CLASS_LABELS], keys)
    total = sum((F.col(c) for c, _ in CLASS_LABELS), F.lit(0.0))
    rows = F.array(*[F.struct(
        F.lit(label).alias("asset_class"), F.col(c).alias("value"),
        F.when(total > 0, F.col(c) / total).otherwise(F.lit(0.0)).alias("share"))
        for c, label in CLASS_LABELS])
    return latest.select(*keys, P, F.inline(rows))


def dividends_by_type(dividends: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Income and payments per event type (NULL types left out of
    the groups) and a total over all rows (NULL types included)."""
    out = grouped_with_total(
        dividends.select(*keys, "event_type", F.col("total_income").alias("total"),
                         F.col("num_payments").alias("payments")),
        ["event_type"], ["total", "payments"], keys=keys,
        sum_exprs={"total": _sum0("total")})
    # the NULL event type is a group of its own in SQL; here it only counts
    # in the total
    return out.filter(F.col("is_total") | F.col("event_type").isNotNull())


def wallet_evolution(wallet: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every month with its label; return as a fraction."""
    return wallet.select(*keys, P, period_label(P).alias("period_label"),
                         "total_portfolio_value", "equity_value", "treasury_value",
                         "fixed_income_value", "total_invested", "absolute_gain_loss",
                         (F.col("pct_return") / 100).alias("pct_return"))


# -------------------------------------------------------------- equity -----
def latest_equity_detail(stock_detail: DataFrame, keys: Sequence[str] = (),
                         is_latest: bool = False) -> DataFrame:
    """Positions of the latest month and a total row (quantity,
    invested, value, gain).  ``is_latest``: no other month is in the input."""
    latest = (stock_detail if is_latest else latest_rows(stock_detail, keys)).withColumn(
        "pct_price_change", F.col("pct_price_change") / 100)
    out = grouped_with_total(
        latest, ["ticker", "asset_type"],
        ["total_quantity", "total_invested", "total_current_value", "unrealized_gain_loss"],
        ["mean_purchase_price", "current_closing_price", "pct_price_change"], keys)
    return out.select(
        *keys, "ticker",
        F.when(F.col("is_total"), F.lit(None)).otherwise(asset_type_label("asset_type"))
        .alias("asset_type"),
        "total_quantity", "mean_purchase_price", "current_closing_price", "total_invested",
        "total_current_value", "unrealized_gain_loss", "pct_price_change", "is_total")


# ------------------------------------------------------------- income ------
def dividends_by_ticker(dividends: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """R7 (read it ordered by total, descending)."""
    return (dividends.filter(F.col("ticker").isNotNull()).groupBy(*keys, "ticker")
            .agg(_sum0("total_income").alias("total"), F.sum("num_payments").alias("payments")))


def dividend_detail(dividends: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """R8."""
    return dividends.select(*keys, "ticker", P, period_label(P).alias("period_label"),
                            "event_type", "total_income", "total_shares", "num_payments")


# ------------------------------------------------------------- trades ------
def _positive(c: Column) -> Column:
    """Non-positive or NULL measures are shown as a dash: NULL here."""
    return F.when(c > 0, c)


def trades_listing(stg_trades: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every staged trade lot (unfiltered) with costs recomputed, dashes
    as NULL, and a total of buy quantity/cost and sell quantity/value."""
    bq, bp = F.col("buy_quantity"), F.col("avg_buy_price")
    sq, sp = F.col("sell_quantity"), F.col("avg_sell_price")
    detail = stg_trades.select(
        *keys, "ticker", P, period_label(P).alias("period_label"), "institution",
        _positive(bq).alias("buy_quantity"), _positive(bp).alias("avg_buy_price"),
        _positive(bq * bp).alias("total_buy_cost"),
        _positive(sq).alias("sell_quantity"), _positive(sp).alias("avg_sell_price"),
        _positive(sq * sp).alias("total_sell_value"))
    return with_total_row(detail, ["buy_quantity", "total_buy_cost", "sell_quantity",
                                   "total_sell_value"], keys)


def monthly_trade_volume(stg_trades: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bought cost and sold value per month."""
    return (stg_trades.filter(F.col(P).isNotNull()).groupBy(*keys, P)
            .agg(_sum0(F.col("buy_quantity") * F.col("avg_buy_price")).alias("total_compras"),
                 _sum0(F.col("sell_quantity") * F.col("avg_sell_price")).alias("total_vendas")))


def monthly_sales_flag(stg_trades: DataFrame, threshold: float = SALES_EXEMPTION_LIMIT,
                       keys: Sequence[str] = ()) -> DataFrame:
    """Months with sales, their sold value and whether it is strictly
    above the exemption limit.  All asset types together."""
    sells = stg_trades.filter((F.col("sell_quantity") > 0) & F.col(P).isNotNull())
    return (sells.groupBy(*keys, P)
            .agg(_sum0(F.col("sell_quantity") * F.col("avg_sell_price"))
                 .alias("total_sell_value"))
            .withColumn("above_threshold",
                        F.when(F.col("total_sell_value") > F.lit(float(threshold)),
                               F.lit(ABOVE_LIMIT)).otherwise(F.lit(NOT_ABOVE_LIMIT))))


# ---------------------------------------------------- treasury / fixed -----
def latest_treasury(treasury_summary: DataFrame, keys: Sequence[str] = (),
                    is_latest: bool = False) -> DataFrame:
    """Latest positions (one per product, indexer, maturity) and totals."""
    out = grouped_with_total(
        treasury_summary if is_latest else latest_rows(treasury_summary, keys), ["product_name", "index_type", "maturity_date", P],
        ["total_invested", "total_gross", "total_net", "total_current_value", "gain_loss"],
        ["total_quantity"], keys)
    return out.select(*keys, "product_name", "index_type", "maturity_date", P, "total_quantity",
                      "total_invested", "total_gross", "total_net", "total_current_value",
                      "gain_loss", "is_total")


def treasury_evolution(treasury_summary: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """R12."""
    return (treasury_summary.filter(F.col(P).isNotNull()).groupBy(*keys, P)
            .agg(_sum0("total_invested").alias("investido"),
                 _sum0("total_current_value").alias("atual")))


def latest_fixed_income(fixed_income_summary: DataFrame,
                        keys: Sequence[str] = (), is_latest: bool = False) -> DataFrame:
    """Latest positions (one per the eight keys) and the curve-value total."""
    group = ["product_name", "issuer", "code", "index_type", "regime_type", "issue_date",
             "maturity_date", P]
    rows = fixed_income_summary if is_latest else latest_rows(fixed_income_summary, keys)
    out = grouped_with_total(rows, group,
                             ["total_curva_value"], ["total_quantity"], keys)
    return out.select(*keys, *group, "total_quantity", "total_curva_value", "is_total")


# ----------------------------------------------------------------- tax -----
def tax_assets(stock_detail: DataFrame, keys: Sequence[str] = (),
               year: str | None = None, is_latest: bool = False) -> DataFrame:
    """Holdings at the latest period (or the last period of ``year``)
    at their mean cost, with the total cost."""
    rows = stock_detail if is_latest else latest_rows(stock_detail, keys, year)
    out = grouped_with_total(rows, ["ticker", "asset_type"],
                             ["total_invested"], ["total_quantity", "mean_purchase_price"], keys)
    return out.select(
        *keys, "ticker",
        F.when(F.col("is_total"), F.lit(None)).otherwise(asset_type_label("asset_type"))
        .alias("asset_type"),
        "total_quantity", "mean_purchase_price", "total_invested", "is_total")


def _income_matching(dividends: DataFrame, pattern: str, keys: Sequence[str]) -> DataFrame:
    match = F.coalesce(F.col("event_type").rlike(pattern), F.lit(False))
    return grouped_with_total(dividends.filter(match & F.col("ticker").isNotNull()), ["ticker"],
                              ["total_income"], keys=keys,
                              sum_exprs={"total_income": _sum0("total_income")})


def tax_exempt_income(dividends: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Dividends (exempt) per ticker, all years together, and total."""
    return _income_matching(dividends, EXEMPT_INCOME_PATTERN, keys)


def tax_taxable_income(dividends: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Interest on equity (taxable) per ticker and total."""
    return _income_matching(dividends, TAXABLE_INCOME_PATTERN, keys)


def report_periods(wallet: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The distinct months of the wallet (read it sorted)."""
    return wallet.select(*keys, P).filter(F.col(P).isNotNull()).distinct()


# ------------------------------------------------------------ ordering -----
# Reading order per section; a leading '-' means descending.
SECTION_ORDER: dict[str, tuple[str, ...]] = {
    "latest_kpis": ("_reference_period",),
    "allocation_by_class": ("asset_class",),
    "dividends_by_type": ("is_total", "event_type"),
    "wallet_evolution": ("_reference_period",),
    "latest_equity_detail": ("is_total", "ticker"),
    "dividends_by_ticker": ("-total", "ticker"),
    "dividend_detail": ("_reference_period", "ticker"),
    "trades_listing": ("is_total", "_reference_period", "ticker"),
    "monthly_trade_volume": ("_reference_period",),
    "latest_treasury": ("is_total", "product_name"),
    "treasury_evolution": ("_reference_period",),
    "latest_fixed_income": ("is_total", "product_name"),
    "tax_assets": ("is_total", "ticker"),
    "tax_exempt_income": ("is_total", "-total_income", "ticker"),
    "tax_taxable_income": ("is_total", "-total_income", "ticker"),
    "monthly_sales_flag": ("_reference_period",),
    "report_periods": ("_reference_period",),
}


def build_sections(marts, stg_trades: DataFrame | None = None, keys: Sequence[str] = (),
                   sales_threshold: float = SALES_EXEMPTION_LIMIT,
                   tax_year: str | None = None) -> dict[str, DataFrame]:
    """Every report section from a :class:`~ledgerframe.plans.marts.Marts`."""
    trades = stg_trades if stg_trades is not None else marts.staging["stg_trades"]
    w, dv = marts.monthly_wallet, marts.dividend_summary
    last = {m: marts.latest(m) for m in ("fct_stock_detail", "fct_treasury_summary",
                                         "fct_fixed_income_summary")}
    return {
        "latest_kpis": latest_kpis(w, keys),
        "allocation_by_class": allocation_by_class(w, keys),
        "dividends_by_type": dividends_by_type(dv, keys),
        "wallet_evolution": wallet_evolution(w, keys),
        "latest_equity_detail": latest_equity_detail(last["fct_stock_detail"], keys, is_latest=True),
        "dividends_by_ticker": dividends_by_ticker(dv, keys),
        "dividend_detail": dividend_detail(dv, keys),
        "trades_listing": trades_listing(trades, keys),
        "monthly_trade_volume": monthly_trade_volume(trades, keys),
        "latest_treasury": latest_treasury(last["fct_treasury_summary"], keys, is_latest=True),
        "treasury_evolution": treasury_evolution(marts.treasury_summary, keys),
        "latest_fixed_income": latest_fixed_income(last["fct_fixed_income_summary"], keys,
                                                   is_latest=True),
        "tax_assets": tax_assets(marts.stock_detail if tax_year else last["fct_stock_detail"], keys,
                                 tax_year, is_latest=not tax_year),
        "tax_exempt_income": tax_exempt_income(dv, keys),
        "tax_taxable_income": tax_taxable_income(dv, keys),
        "monthly_sales_flag": monthly_sales_flag(trades, sales_threshold, keys),
        "report_periods": report_periods(w, keys),
    }


def ordered_section(df: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    order = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in SECTION_ORDER[name]]
    return df.orderBy(*[F.col(k) for k in keys], *order)

