"""Intermediate and mart transforms.

All aggregations are plain ``groupBy().agg()`` so Spark runs a partial
(map-side) aggregate before each shuffle: a hot ticker or a hot month costs
one row per map task, not one row per trade.  Joins are equi-joins on the
aggregated ticker grain; Spark/AQE picks broadcast only when the runtime size
of the small side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and falls back to a sort-merge join otherwise.

``keys`` adds owner-style columns to every grouping and join key so many
portfolios are processed in one job; results per key equal a single-owner run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import safe_ratio
from ..functions.text import ticker_from_product

P = "_reference_period"
ASSET_CLASSES = ("equity", "treasury", "fixed_income")


#: The file that a row comes from, where staging carries it.
FILE = "_source_file"


def _k(keys: Sequence[str]) -> list[str]:
    return list(keys)


def _lineage(df: DataFrame) -> list[str]:
    return [FILE] if FILE in df.columns else []


# ---------------------------------------------------------------- trades ----
def traded() -> Column:
    """T1 keeps lots with a buy or a sell."""
    return (F.col("buy_quantity") > 0) | (F.col("sell_quantity") > 0)


def int_trades_clean(stg_trades: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Lots with a buy or a sell; cost and sale value per lot."""
    return (stg_trades
            .filter(traded())
            .select(*_k(keys), "ticker", P, "institution", "buy_quantity", "avg_buy_price",
                    "sell_quantity", "avg_sell_price",
                    (F.col("buy_quantity") * F.col("avg_buy_price")).alias("total_buy_cost"),
                    (F.col("sell_quantity") * F.col("avg_sell_price")).alias("total_sell_value")))


def purchases(trades_clean: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What T2 adds up: shares and cost of every lot bought at a price."""
    bought = trades_clean.filter((F.col("buy_quantity") > 0) & (F.col("avg_buy_price") > 0))
    return bought.select(*_k(keys), "ticker", F.col("buy_quantity").alias("total_shares_bought"),
                         F.col("total_buy_cost").alias("total_invested"), *_lineage(bought))


def weighted_price(bought: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """T2 of :func:`purchases`, or of sums of them."""
    return (bought.groupBy(*_k(keys), "ticker")
            .agg(F.sum("total_shares_bought").alias("total_shares_bought"),
                 F.sum("total_invested").alias("total_invested"))
            .select("*", safe_ratio(F.col("total_invested"), F.col("total_shares_bought"))
                    .alias("weighted_avg_price")))


def int_weighted_avg_price(trades_clean: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Whole-history weighted average purchase price per ticker (sells
    never reduce it)."""
    return weighted_price(purchases(trades_clean, keys), keys)


# ------------------------------------------------------------- positions ----
def holdings(stg_stock: DataFrame, stg_etf: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What T3 adds up: stocks and ETFs stacked."""
    def tagged(df: DataFrame, asset_type: str) -> DataFrame:
        return df.select(*_k(keys), "ticker", F.lit(asset_type).alias("asset_type"), P,
                         F.col("quantity").alias("total_quantity"),
                         (F.col("closing_price") * F.col("quantity")).alias("close_x_quantity"),
                         F.col("current_value").alias("total_current_value"), *_lineage(df))

    return tagged(stg_stock, "stock").unionByName(tagged(stg_etf, "etf"))


def positions(held: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """T3 of :func:`holdings`, or of sums of them."""
    return (held.groupBy(*_k(keys), "ticker", "asset_type", P)
            .agg(F.sum("total_quantity").alias("total_quantity"),
                 F.sum("close_x_quantity").alias("_close_x_qty"),
                 F.sum("total_current_value").alias("total_current_value"))
            .select(*_k(keys), "ticker", "asset_type", P, "total_quantity",
                    safe_ratio(F.col("_close_x_qty"), F.col("total_quantity"))
                    .alias("avg_closing_price"),
                    "total_current_value"))


def int_all_equity_positions(stg_stock: DataFrame, stg_etf: DataFrame,
                             keys: Sequence[str] = ()) -> DataFrame:
    """Stocks and ETFs stacked, then per ticker x type x month: quantity,
    quantity-weighted close, current value."""
    return positions(holdings(stg_stock, stg_etf, keys), keys)


def _class_rows(equity: DataFrame, stg_treasury: DataFrame, stg_fixed: DataFrame,
                keys: Sequence[str], equity_invested: Column | None = None) -> DataFrame:
    """Long form ``(keys, period, asset_class, value, invested)`` of the three
    asset classes, one row per input row (aggregated by the caller)."""
    eq_inv = equity_invested if equity_invested is not None else F.lit(None).cast("double")
    eq = equity.select(*_k(keys), P, F.lit("equity").alias("asset_class"),
                       F.col("total_current_value").cast("double").alias("value"),
                       eq_inv.cast("double").alias("invested"))
    tr = stg_treasury.select(*_k(keys), P, F.lit("treasury").alias("asset_class"),
                             F.col("current_value").alias("value"),
                             F.col("invested_value").alias("invested"))
    fi = stg_fixed.select(*_k(keys), P, F.lit("fixed_income").alias("asset_class"),
                          F.col("curva_value").alias("value"),
                          F.col("curva_value").alias("invested"))
    return eq.unionByName(tr).unionByName(fi)


def int_monthly_portfolio_value(equity_positions: DataFrame, stg_treasury: DataFrame,
                                stg_fixed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """T4: per month and asset class, the summed value (long form, <=3 rows/month)."""
    return (_class_rows(equity_positions, stg_treasury, stg_fixed, keys)
            .groupBy(*_k(keys), P, "asset_class")
            .agg(F.sum("value").alias("total_value")))


def _sum_if(cls: str, col: str) -> Column:
    return F.sum(F.when(F.col("asset_class") == cls, F.col(col)))


def _value_by_class(cls: str) -> Column:
    # ``sum(case when class = c then value else 0 end)``: a month without the
    # class gives 0, a class whose values are all NULL gives NULL only when no
    # other class is present in that month.
    return F.sum(F.when(F.col("asset_class") == cls, F.col("value")).otherwise(F.lit(0.0)))


def monthly_value_by_class(monthly_value: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """T5 + T6 in one aggregate: month total and the three class columns
    (missing class -> 0)."""
    return (monthly_value.groupBy(*_k(keys), P).agg(
        F.sum("total_value").alias("total_portfolio_value"),
        *[F.sum(F.when(F.col("asset_class") == c, F.col("total_value")).otherwise(F.lit(0.0)))
          .alias(f"{c}_value") for c in ASSET_CLASSES]))


def _with_price(equity_positions: DataFrame, avg_price: DataFrame,
                keys: Sequence[str]) -> DataFrame:
    return equity_positions.join(
        avg_price.select(*_k(keys), "ticker", "weighted_avg_price"),
        on=[*_k(keys), "ticker"], how="left")


def equity_invested(equity_positions: DataFrame, avg_price: DataFrame,
                    keys: Sequence[str] = ()) -> DataFrame:
    """Per month, quantity x whole-history weighted price (0 if never bought)."""
    return (_with_price(equity_positions, avg_price, keys)
            .groupBy(*_k(keys), P)
            .agg(F.sum(F.col("total_quantity") *
                       F.coalesce(F.col("weighted_avg_price"), F.lit(0.0)))
                 .alias("total_equity_invested")))


def other_invested(stg_treasury: DataFrame, stg_fixed: DataFrame,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Invested amount per month of treasury (applied value) and fixed
    income (curve value), long form ``(period, asset_class, total_invested)``."""
    tr = (stg_treasury.groupBy(*_k(keys), P).agg(F.sum("invested_value").alias("total_invested"))
          .withColumn("asset_class", F.lit("treasury")))
    fi = (stg_fixed.groupBy(*_k(keys), P).agg(F.sum("curva_value").alias("total_invested"))
          .withColumn("asset_class", F.lit("fixed_income")))
    return tr.unionByName(fi).select(*_k(keys), P, "asset_class", "total_invested")


def fct_monthly_wallet(equity_positions: DataFrame, avg_price: DataFrame,
                       stg_treasury: DataFrame, stg_fixed: DataFrame,
                       keys: Sequence[str] = ()) -> DataFrame:
    """One row per month with value by class, invested, gain and return.

    Instead of aggregating each measure separately and joining them on the
    month (four joins), every input row is tagged with its class and the
    whole wallet is one conditional aggregate: a single shuffle of
    pre-aggregated rows keyed by month.
    """
    priced = _with_price(equity_positions, avg_price, keys)
    inv = F.col("total_quantity") * F.coalesce(F.col("weighted_avg_price"), F.lit(0.0))
    rows = _class_rows(priced, stg_treasury, stg_fixed, keys, equity_invested=inv)
    agg = rows.groupBy(*_k(keys), P).agg(
        F.sum("value").alias("total_portfolio_value"),
        *[_value_by_class(c).alias(f"_{c}_value") for c in ASSET_CLASSES],
        *[_sum_if(c, "invested").alias(f"_{c}_invested") for c in ASSET_CLASSES])
    # A NULL month never matches the month joins of the model: class values
    # stay NULL and nothing counts as invested.
    null_month = F.col(P).isNull()
    invested = sum((F.coalesce(F.col(f"_{c}_invested"), F.lit(0.0)) for c in ASSET_CLASSES),
                   F.lit(0.0))
    invested = F.when(null_month, F.lit(0.0)).otherwise(invested)
    gain = F.col("total_portfolio_value") - F.col("total_invested")
    return (agg.select(
        *_k(keys), P, "total_portfolio_value",
        *[F.when(null_month, F.lit(None).cast("double")).otherwise(F.col(f"_{c}_value"))
          .alias(f"{c}_value") for c in ASSET_CLASSES],
        invested.alias("total_invested"))
        .withColumns({"absolute_gain_loss": gain,
                      "pct_return": F.when(F.col("total_invested") > 0,
                                           gain / F.col("total_invested") * 100)
                      .otherwise(F.lit(0.0))}))


def fct_stock_detail(equity_positions: DataFrame, avg_price: DataFrame,
                     keys: Sequence[str] = ()) -> DataFrame:
    """Position per ticker and month against its mean purchase price."""
    wap = F.col("weighted_avg_price")
    invested = F.col("total_quantity") * F.coalesce(wap, F.lit(0.0))
    return (_with_price(equity_positions, avg_price, keys).select(
        *_k(keys), "ticker", "asset_type", P, "total_quantity",
        wap.alias("mean_purchase_price"),
        F.col("avg_closing_price").alias("current_closing_price"),
        "total_current_value",
        invested.alias("total_invested"),
        (F.col("total_current_value") - invested).alias("unrealized_gain_loss"),
        F.when(F.coalesce(wap, F.lit(0.0)) > 0,
               (F.col("avg_closing_price") - wap) / wap * 100).otherwise(F.lit(0.0))
        .alias("pct_price_change")))


# ----------------------------------------------------------------- income ----
def payments(stg_div: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What T11 adds up: income and shares of every payment."""
    return stg_div.select(*_k(keys), ticker_from_product("product_name").alias("ticker"), P, "event_type",
                          F.col("net_value").alias("total_income"), F.col("quantity").alias("total_shares"),
                          F.lit(1).cast("long").alias("num_payments"), *_lineage(stg_div))


def dividend_summary(paid: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """T11 of :func:`payments`, or of sums of them."""
    return (paid.groupBy(*_k(keys), "ticker", P, "event_type")
            .agg(*[F.sum(c).alias(c) for c in ("total_income", "total_shares", "num_payments")]))


def fct_dividend_summary(stg_div: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Income per ticker x month x event type."""
    return dividend_summary(payments(stg_div, keys), keys)


def _by(staged: DataFrame, keys: Sequence[str], columns: Sequence[str], aggregates: list[Column]) -> DataFrame:
    """Groups of ``columns``.  Dates that came as text (``_date_text``, NULL dates)
    stay apart by that text, which is not a column of the result."""
    text = [c for c in ("_date_text",) if c in staged.columns]
    return staged.groupBy(*_k(keys), *columns, *text).agg(*aggregates).drop(*text)


def fct_treasury_summary(stg_treasury: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """T12."""
    return _by(stg_treasury, keys, ["product_name", "index_type", "maturity_date", P], [
        F.sum("quantity").alias("total_quantity"), F.sum("invested_value").alias("total_invested"),
        F.sum("gross_value").alias("total_gross"), F.sum("net_value").alias("total_net"),
        F.sum("current_value").alias("total_current_value"),
    ]).withColumn("gain_loss", F.col("total_current_value") - F.col("total_invested"))


FIXED_INCOME_KEYS = ("product_name", "issuer", "code", "index_type", "regime_type",
                     "issue_date", "maturity_date", P)


def fct_fixed_income_summary(stg_fixed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """NULL keys form their own group, as in SQL."""
    return _by(stg_fixed, keys, FIXED_INCOME_KEYS, [
        F.sum("quantity").alias("total_quantity"), F.sum("curva_value").alias("total_curva_value")])


# --------------------------------------------------------------- ordering ----
MART_ORDER = {
    "fct_monthly_wallet": (P,),
    "fct_stock_detail": (P, "ticker"),
    "fct_dividend_summary": (P, "ticker"),
    "fct_treasury_summary": (P, "product_name"),
    "fct_fixed_income_summary": (P, "product_name"),
}


def ordered(df: DataFrame, mart: str, keys: Sequence[str] = ()) -> DataFrame:
    """The mart's reading order (applied on read, never before a write)."""
    return df.orderBy(*_k(keys), *MART_ORDER[mart])
