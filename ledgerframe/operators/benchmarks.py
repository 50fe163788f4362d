"""Benchmark returns (B1-B7): compounding of a rate series, month-end index
closes, returns since the first observation, and the comparison with the
portfolio's own return.

The running windows (cumulative product, forward fill) run on month-grain
tables only - one row per period (per owner with ``keys``) - never on
observations, so a window partition holds at most a few hundred rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.periods import period_first_day, period_of

P = "_reference_period"
RATE_WINDOW_LAST_DAY = 28

# --- fixed values: index symbols and their report columns -------------------
SYMBOL_COLUMNS = {"^BVSP": "ibov_return", "DIVO11.SA": "divo11_return"}
# ---------------------------------------------------------------------------


def _running(keys: Sequence[str]) -> Window:
    return (Window.partitionBy(*keys).orderBy(P)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _compound(rate_pct: Column) -> Column:
    """(prod(1 + r/100) - 1) * 100; ``product`` keeps rates <= -100 exact
    where exp(sum(log1p)) would fail."""
    return (F.product(F.lit(1.0) + rate_pct / 100) - 1) * 100


def monthly_rate_returns(rates: DataFrame) -> DataFrame:
    """B1: compound the observations of each month.  Also returns the
    compounding of days 1-28 only, used for the last period of a portfolio
    (its rate window ends on day 28)."""
    return (rates.filter(F.col("date").isNotNull())
            .groupBy(period_of("date").alias(P))
            .agg(_compound(F.col("rate_pct")).alias("cdi_monthly_return"),
                 _compound(F.when(F.dayofmonth("date") <= RATE_WINDOW_LAST_DAY,
                                  F.col("rate_pct")).otherwise(F.lit(0.0)))
                 .alias("_return_to_day28")))


def cumulative_rate(monthly: DataFrame, periods: DataFrame,
                    keys: Sequence[str] = ()) -> DataFrame:
    """B2: align the monthly returns to the portfolio periods (missing -> 0)
    and compound them over the sorted periods."""
    whole = Window.partitionBy(*keys)
    # a period that is not a real month makes the whole series unavailable
    # (zeros), as a failed fetch does
    valid = F.min(period_first_day(P).isNotNull().cast("int")).over(whole) == 1
    aligned = (periods.select(*keys, P)
               .withColumn("_is_last", F.col(P) == F.max(P).over(whole))
               .withColumn("_valid", valid)
               .join(monthly, on=P, how="left"))
    r = F.when(~F.col("_valid"), F.lit(0.0)).otherwise(F.coalesce(
        F.when(F.col("_is_last"), F.col("_return_to_day28"))
        .otherwise(F.col("cdi_monthly_return")), F.lit(0.0)))
    return (aligned.select(*keys, P, r.alias("cdi_monthly_return"))
            .withColumn("cdi_cumulative",
                        (F.product(F.lit(1.0) + F.col("cdi_monthly_return") / 100)
                         .over(_running(keys)) - 1) * 100))


def month_end_close(prices: DataFrame) -> DataFrame:
    """Last non-NULL close of each symbol and month; a month whose closes
    are all NULL is kept with a NULL close."""
    has_close = F.col("close").isNotNull()
    return (prices.groupBy("symbol", period_of("date").alias(P))
            .agg(F.max_by(F.col("close"), F.when(has_close, F.col("date"))).alias("close")))


def index_returns(month_close: DataFrame) -> DataFrame:
    """Close / first month's close of the series - 1, in percent."""
    series = (Window.partitionBy("symbol").orderBy(P)
              .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    base = F.first("close").over(series)
    return month_close.withColumn("return_pct",
                                  (F.try_divide(F.col("close"), base) - 1) * 100)


def _by_symbol(rows: DataFrame, group: str, name: str) -> DataFrame:
    """One row per month: a map of the symbols that have a row and their closes."""
    return rows.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct("symbol", "close"))).alias(name))


def base_closes(month_close: DataFrame) -> DataFrame:
    """As-of side of the returns: ``(symbol, _start, close)`` with a symbol's close in its
    first price month at or after the month ``_start``, for every month after the
    symbol's first one up to its last.  A price month is the base of the months that
    follow the price month before it, so the as-of join becomes an equi-join on the
    start month; a symbol has one row for each month it spans."""
    before = F.lag(P).over(Window.partitionBy("symbol").orderBy(P))
    months = F.sequence(F.add_months(period_first_day("_before"), 1), period_first_day(P),
                        F.expr("interval 1 month"))
    return (month_close.withColumn("_before", before).filter(F.col("_before").isNotNull())
            .select("symbol", "close", F.explode(months).alias("_month"))
            .select("symbol", period_of("_month").alias("_start"), "close"))


def _with_closes(rows: DataFrame, month_close: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Adds to month rows with ``_start`` (the portfolio's first period) the closes of
    their month and the base closes of their start, each a map by symbol, by two
    month-grain joins.  A start at or before a symbol's first price month has that
    month's close as its base (``_first``: one entry for each symbol)."""
    listed = month_close.filter(F.col("symbol").isin(*symbols))
    first = listed.groupBy("symbol").agg(F.min_by(F.struct(P, "close"), P).alias("f")) \
        .agg(F.map_from_entries(F.collect_list(F.struct("symbol", "f")))).scalar()
    return (rows.join(_by_symbol(listed, P, "_closes"), P, "left")
            .join(_by_symbol(base_closes(listed), "_start", "_bases"), "_start", "left")
            .withColumn("_first", first))


def _raw_return(symbol: Column) -> Column:
    """Return of one symbol since its base, NULL where there is no price."""
    first = F.try_element_at("_first", symbol)
    base = F.when(F.col("_start") <= first[P], first["close"]).otherwise(F.try_element_at("_bases", symbol))
    return F.when(F.col("_valid"), (F.try_divide(F.try_element_at("_closes", symbol), base) - 1) * 100)


def _with_index_returns(rows: DataFrame, month_close: DataFrame,
                        symbols: dict[str, str]) -> DataFrame:
    """Adds one raw return column per symbol to month rows that carry
    ``_start`` and ``_valid``."""
    return _with_closes(rows, month_close, list(symbols)) \
        .withColumns({c: _raw_return(F.lit(s)) for s, c in symbols.items()}) \
        .drop("_closes", "_bases", "_first")


def index_returns_long(month_close: DataFrame, periods: DataFrame, symbols: Sequence[str],
                       keys: Sequence[str] = ()) -> DataFrame:
    """B4 + B5 in long form for any list of symbols: ``(keys, period, symbol,
    return_pct)``, the last known return carried forward, 0 before the first one."""
    rows = _with_closes(_portfolio_months(periods, keys), month_close, symbols)
    each = rows.withColumn("symbol", F.explode(F.array(*[F.lit(s) for s in symbols])))
    return each.select(*keys, P, "symbol", F.coalesce(
        F.last(_raw_return(F.col("symbol")), ignorenulls=True).over(_running([*keys, "symbol"])),
        F.lit(0.0)).alias("return_pct"))


def _portfolio_months(periods: DataFrame, keys: Sequence[str], *extra: str) -> DataFrame:
    whole = Window.partitionBy(*keys)
    return (periods.select(*keys, P, *extra)
            .withColumn("_start", F.min(P).over(whole))
            .withColumn("_is_last", F.col(P) == F.max(P).over(whole))
            .withColumn("_valid",
                        F.min(period_first_day(P).isNotNull().cast("int")).over(whole) == 1))


def index_returns_for_periods(month_close: DataFrame, periods: DataFrame,
                              keys: Sequence[str] = (),
                              symbols: dict[str, str] | None = None) -> DataFrame:
    """B4 with the price window of each portfolio, one column per symbol:
    the base of a symbol's returns is its close in the first price month at
    or after the portfolio's first period, so a portfolio (``keys``) that
    starts later gets its own base.  Returns ``(keys, period, <symbol
    columns>)`` on the portfolio's periods, NULL where there is no price;
    any period that is not a real month gives NULL throughout (no window)."""
    symbols = symbols or SYMBOL_COLUMNS
    rows = _with_index_returns(_portfolio_months(periods, keys), month_close, symbols)
    return rows.select(*keys, P, *symbols.values())


def forward_fill_returns(wide: DataFrame, keys: Sequence[str] = (),
                         symbols: dict[str, str] | None = None) -> DataFrame:
    """B5 on per-portfolio returns: carry the last known value forward over
    the sorted periods; leading gaps and absent symbols -> 0 (B6)."""
    symbols = symbols or SYMBOL_COLUMNS
    return wide.select(*keys, P, *[
        F.coalesce(F.last(c, ignorenulls=True).over(_running(keys)), F.lit(0.0)).alias(c)
        for c in symbols.values()])


def benchmark_comparison(wallet: DataFrame, rates: DataFrame, month_close: DataFrame,
                         keys: Sequence[str] = (),
                         symbols: dict[str, str] | None = None) -> DataFrame:
    """B2 + B4-B7 in one chain over the wallet's own month rows: the wallet
    is read once and is its own period table; the rate and price series join
    it at month grain.  Same result as composing :func:`cumulative_rate`,
    :func:`index_returns_for_periods`, :func:`forward_fill_returns` and
    :func:`performance_vs_benchmarks`."""
    symbols = symbols or SYMBOL_COLUMNS
    rows = _portfolio_months(wallet, keys, "pct_return").join(
        monthly_rate_returns(rates), on=P, how="left")
    r = F.when(~F.col("_valid"), F.lit(0.0)).otherwise(F.coalesce(
        F.when(F.col("_is_last"), F.col("_return_to_day28"))
        .otherwise(F.col("cdi_monthly_return")), F.lit(0.0)))
    rows = _with_index_returns(rows.withColumn("_r", r), month_close, symbols)
    run = _running(keys)
    return rows.select(
        *keys, P, "pct_return",
        ((F.product(F.lit(1.0) + F.col("_r") / 100).over(run) - 1) * 100).alias("cdi_cumulative"),
        *[F.coalesce(F.last(c, ignorenulls=True).over(run), F.lit(0.0)).alias(c)
          for c in symbols.values()])


def performance_vs_benchmarks(wallet: DataFrame, cdi: DataFrame, indices: DataFrame,
                              keys: Sequence[str] = ()) -> DataFrame:
    """B7 (+B6): the portfolio's simple return per month next to the
    benchmarks; missing benchmark values are 0."""
    on = [*keys, P]
    out = (wallet.select(*on, "pct_return")
           .join(cdi.select(*on, "cdi_cumulative"), on=on, how="left")
           .join(indices, on=on, how="left"))
    bench = ["cdi_cumulative", *SYMBOL_COLUMNS.values()]
    return out.select(*on, "pct_return",
                      *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in bench])
