"""Benchmark series sources.

The rate API and the market-data provider are not called from here: their
answers are landed as files (JSON array of ``{data, valor}`` records; price
tables with a close or adjusted-close column) and read with ``spark.read``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.periods import period_day, period_first_day
from ..schemas import RATES_LANDED_SCHEMA

P = "_reference_period"
RATE_DATE_FORMAT = "dd/MM/yyyy"
RATE_WINDOW_LAST_DAY = 28      # the rate window ends on day 28 of the last period
PRICE_WINDOW_EXTRA_DAYS = 5    # the price window ends 5 days after that (exclusive)


def read_landed_rates(spark: SparkSession, path: str, json_array: bool = True) -> DataFrame:
    """Records ``{"data": "dd/MM/yyyy", "valor": "0.04"}`` - one JSON
    array per file as the rate API answers (``json_array=True``), or one
    record per line."""
    reader = spark.read.schema(RATES_LANDED_SCHEMA)
    if json_array:
        reader = reader.option("multiLine", "true")
    return conform_rates(reader.json(path))


def conform_rates(landed: DataFrame) -> DataFrame:
    """Text date and value -> ``(date DATE, rate_pct DOUBLE)``; unparsable -> NULL."""
    return landed.select(
        F.try_to_timestamp(F.col("data").cast("string"), F.lit(RATE_DATE_FORMAT))
        .cast("date").alias("date"),
        F.col("valor").cast("string").try_cast("double").alias("rate_pct"))


def read_prices(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """I16: a price table with ``symbol, date`` and ``close`` or ``adj_close``."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "true")
    return conform_prices(reader.load(path))


def conform_prices(prices: DataFrame) -> DataFrame:
    """Use the ``close`` column when the table has one, else ``adj_close``
    (a schema-level choice, as a provider returns one or the other)."""
    close_col = "close" if "close" in prices.columns else "adj_close"
    return prices.select(F.col("symbol").cast("string").alias("symbol"),
                         F.col("date").cast("date").alias("date"),
                         F.col(close_col).cast("double").alias("close"))


def monthly_then_daily(monthly: DataFrame | None, daily: DataFrame) -> DataFrame:
    """I16: the monthly prices of each symbol that has any close there, the daily
    ones of every other symbol."""
    if monthly is None:
        return daily
    priced = monthly.filter(F.col("close").isNotNull()).select("symbol").distinct()
    return monthly.join(priced, "symbol", "left_semi").unionByName(
        daily.join(priced, "symbol", "left_anti")).select("symbol", "date", "close")


def _bounds(periods: DataFrame) -> tuple[Column, Column]:
    """First day of the first period and day 28 of the last one: one scalar
    subquery (a struct) over the period table, read twice.  If any period is
    not a real month the window is empty (NULL bounds), as a failed
    benchmark fetch gives no benchmark data at all."""
    first = period_first_day(P)
    any_invalid = F.count_if(first.isNull()) > 0
    b = periods.select(F.struct(
        F.when(any_invalid, F.lit(None)).otherwise(F.min(first)).alias("lo"),
        F.when(any_invalid, F.lit(None)).otherwise(
            F.max(period_day(P, RATE_WINDOW_LAST_DAY))).alias("hi"))).scalar()
    return b.getField("lo"), b.getField("hi")


def rate_window(rates: DataFrame, periods: DataFrame) -> DataFrame:
    """I17 for rates: first day of the first period .. day 28 of the last."""
    lo, hi = _bounds(periods)
    return rates.filter((F.col("date") >= lo) & (F.col("date") <= hi))


def price_window(prices: DataFrame, periods: DataFrame) -> DataFrame:
    """I17 for prices: first day of the first period .. 5 days after day 28
    of the last period (exclusive)."""
    lo, hi = _bounds(periods)
    return prices.filter((F.col("date") >= lo) &
                         (F.col("date") < F.date_add(hi, PRICE_WINDOW_EXTRA_DAYS)))
