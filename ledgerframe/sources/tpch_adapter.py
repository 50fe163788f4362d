"""Adapter from the driver's TPC-H-style tables to the raw statement tables.

The checks of this repository run on ``region nation customer supplier part
orders lineitem events ...`` Parquet files, not on brokerage workbooks.  This
module maps them onto the seven raw tables and the two benchmark inputs, so
that every operator runs over whole driver tables and its work grows with
them.  Mapping (identical in the DuckDB oracle):

* trades     - lineitem x part; code = brand-type (+ ``F`` when linestatus F);
               returnflag R and every lot of ``Brand#3`` is a sale (that brand
               is held but never bought), anything else a purchase.
* positions  - lineitem x part; types ECONOMY/STANDARD/SMALL are stocks, the
               rest ETFs.
* treasury   - orders with status P;   fixed income - orders F/O x customer.
* dividends  - events, one ticker per user; lending - lineitem x part, every lot,
               the returnflag as its nature.
* rates      - one observation per order date; prices - one symbol per order
               priority (the two highest are the index symbols).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.periods import period_of
from ..plans.lazy import LazyTables

# --- fixed values of the adapter -------------------------------------------
NEVER_BOUGHT_BRAND = "Brand#3"
STOCK_TYPES = ("ECONOMY", "STANDARD", "SMALL")
EVENT_TYPE_MAP = {  # events.event_type -> statement event type; others NULL
    "purchase": "Dividendo",
    "view": "Juros Sobre Capital Proprio",
    "click": "JCP",
    "signup": "Rendimento",
}
PRICE_SYMBOLS = {"1-URGENT": "^BVSP", "2-HIGH": "DIVO11.SA"}
# days before its listing belong to a symbol of their own
LATE_LISTED_SYMBOL, LISTING_DATE, UNLISTED_SYMBOL = "DIVO11.SA", "1996-01-01", "DIVO11.PRE"
# ---------------------------------------------------------------------------


_READS: dict[tuple[int, str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One DataFrame per (session, table): every further use of the table
    reuses the resolved relation instead of listing the file and inferring
    its Parquet schema again (a small Spark job each time)."""
    key = (id(spark), sf_dir, name)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        _READS[key] = df
    return df


def _source_file(period: Column) -> Column:
    return F.concat(F.lit("statement-"), period, F.lit(".xlsx"))


def _lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x part.  Text that depends only on the part (the ticker, its
    odd-lot variant, the lending product) is built on the part side, once
    per part, before the join - not once per line item."""
    li = read_table(spark, sf_dir, "lineitem")
    pt = read_table(spark, sf_dir, "part")
    ticker = F.concat(F.col("p_brand"), F.lit("-"), F.col("p_type"))
    pt = pt.select("*", ticker.alias("_ticker"),
                   F.concat(ticker, F.lit("F")).alias("_ticker_odd_lot"),
                   F.concat(ticker, F.lit(" - "), F.col("p_name")).alias("_lending_product"))
    return li.join(pt, li["l_partkey"] == pt["p_partkey"])


def _ticker() -> Column:
    return F.col("_ticker")


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    sell = (F.col("l_returnflag") == "R") | (F.col("p_brand") == NEVER_BOUGHT_BRAND)
    buy_q = F.when(sell, F.lit(0.0)).otherwise(F.col("l_quantity"))
    sell_q = F.when(sell, F.col("l_quantity")).otherwise(F.lit(0.0))
    period = period_of("l_shipdate")
    return (_lots(spark, sf_dir).select(
        F.when(F.col("l_linestatus") == "F", F.col("_ticker_odd_lot")).otherwise(_ticker())
        .alias("Codigo_de_Negociacao"),
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("Periodo_Inicial"),
        F.last_day(F.col("l_shipdate").cast("date")).alias("Periodo_Final"),
        F.col("l_suppkey").cast("string").alias("Instituicao"),
        buy_q.alias("Quantidade_Compra"),
        sell_q.alias("Quantidade_Venda"),
        (buy_q - sell_q).alias("Quantidade_Liquida"),
        F.when(sell, F.lit(0.0)).otherwise(F.col("p_retailprice")).alias("Preco_Medio_Compra"),
        F.when(sell, F.col("p_retailprice")).otherwise(F.lit(0.0)).alias("Preco_Medio_Venda"),
        _source_file(period).alias("_source_file"),
        period.alias("_reference_period")))


def _positions(spark: SparkSession, sf_dir: str, stocks: bool) -> DataFrame:
    is_stock = F.col("p_type").isin(*STOCK_TYPES)
    period = period_of("l_shipdate")
    return (_lots(spark, sf_dir).filter(is_stock if stocks else ~is_stock).select(
        _ticker().alias("Codigo_de_Negociacao"),
        F.col("p_name").alias("Produto"),
        F.col("l_suppkey").cast("string").alias("Instituicao"),
        F.col("l_orderkey").cast("string").alias("Conta"),
        F.col("p_type").alias("Tipo"),
        F.col("l_quantity").alias("Quantidade"),
        (F.col("l_quantity") * (F.lit(1.0) - F.col("l_discount"))).alias("Quantidade_Disponivel"),
        F.col("p_retailprice").alias("Preco_de_Fechamento"),
        F.col("l_extendedprice").alias("Valor_Atualizado"),
        _source_file(period).alias("_source_file"),
        period.alias("_reference_period")))


def raw_stock_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(spark, sf_dir, stocks=True)


def raw_etf_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(spark, sf_dir, stocks=False)


def raw_treasury_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    period = period_of("o_orderdate")
    price = F.col("o_totalprice")
    return o.select(
        F.col("o_orderpriority").alias("Produto"),
        F.lit("TESOURO NACIONAL").alias("Instituicao"),
        F.concat(F.lit("BRSTN"), F.col("o_custkey").cast("string")).alias("Codigo_ISIN"),
        F.col("o_orderstatus").alias("Indexador"),
        F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).alias("Vencimento"),
        F.lit(1.0).alias("Quantidade"),
        price.alias("Valor_Aplicado"),
        (price * F.lit(1.10)).alias("Valor_bruto"),
        (price * F.lit(1.08)).alias("Valor_liquido"),
        (price * F.lit(1.05)).alias("Valor_Atualizado"),
        _source_file(period).alias("_source_file"),
        period.alias("_reference_period"))


def raw_fixed_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("F", "O"))
    c = read_table(spark, sf_dir, "customer")
    period = period_of("o_orderdate")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("c_mktsegment").alias("Produto"),
        F.col("c_nationkey").cast("string").alias("Instituicao"),
        F.col("o_orderpriority").alias("Emissor"),
        F.col("c_nationkey").cast("string").alias("Codigo"),
        F.col("o_orderstatus").alias("Indexador"),
        F.lit("CURVA").alias("Tipo_de_regime"),
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("Data_de_Emissao"),
        F.make_date(F.year("o_orderdate") + 2, F.lit(12), F.lit(31)).alias("Vencimento"),
        F.lit(1.0).alias("Quantidade"),
        F.col("o_totalprice").alias("Preco_Atualizado_CURVA"),
        F.col("o_totalprice").alias("Valor_Atualizado_CURVA"),
        _source_file(period).alias("_source_file"),
        period.alias("_reference_period"))


def raw_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    period = period_of("ts")
    event = F.lit(None).cast("string")
    for src, dst in reversed(list(EVENT_TYPE_MAP.items())):
        event = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(event)
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string"),
                 F.lit(" - "), F.col("event_type")).alias("Produto"),
        F.col("ts").cast("date").alias("Pagamento"),
        event.alias("Tipo_de_Evento"),
        F.lit("CORRETORA").alias("Instituicao"),
        F.get_json_object("props", "$.k").cast("double").alias("Quantidade"),
        F.col("value").alias("Preco_unitario"),
        F.col("value").alias("Valor_liquido"),
        _source_file(period).alias("_source_file"),
        period.alias("_reference_period"))


def raw_stock_lending(spark: SparkSession, sf_dir: str) -> DataFrame:
    period = period_of("l_shipdate")
    ship = F.col("l_shipdate").cast("date")
    return (_lots(spark, sf_dir).select(
        F.col("_lending_product").alias("Produto"),
        F.col("l_suppkey").cast("string").alias("Instituicao"),
        F.col("l_returnflag").alias("Natureza"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("Numero_de_Contrato"),
        F.col("l_discount").alias("Taxa"),
        F.col("l_quantity").alias("Quantidade"),
        F.col("p_retailprice").alias("Preco_de_Fechamento"),
        F.col("l_extendedprice").alias("Valor_Atualizado"),
        ship.alias("Data_de_registro"),
        F.date_add(ship, 90).alias("Data_de_vencimento"),
        _source_file(period).alias("_source_file"),
        period.alias("_reference_period")))


RAW_BUILDERS = {
    "raw_stock_positions": raw_stock_positions,
    "raw_etf_positions": raw_etf_positions,
    "raw_fixed_income": raw_fixed_income,
    "raw_treasury_bonds": raw_treasury_bonds,
    "raw_dividends": raw_dividends,
    "raw_trades": raw_trades,
    "raw_stock_lending": raw_stock_lending,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """All seven raw tables, each built when first used."""
    return LazyTables({name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in RAW_BUILDERS.items()})


def landed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate observations as the rate API lands them: text date ``dd/MM/yyyy``
    and a percent value, one per order date (``count % 10`` hundredths)."""
    o = read_table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("d"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.date_format("d", "dd/MM/yyyy").alias("data"),
                    ((F.col("n") % 10).cast("double") / 100).cast("string").alias("valor")))


def landed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes of one symbol per order priority; the close ignores pending
    orders, so a day with only pending orders has a NULL close.  One index symbol
    starts late: its days before the listing carry another symbol."""
    symbol = F.col("o_orderpriority")
    for src, dst in PRICE_SYMBOLS.items():
        symbol = F.when(F.col("o_orderpriority") == src, F.lit(dst)).otherwise(symbol)
    date = F.col("o_orderdate").cast("date")
    symbol = F.when((symbol == LATE_LISTED_SYMBOL) & (date < F.lit(LISTING_DATE).cast("date")),
                    F.lit(UNLISTED_SYMBOL)).otherwise(symbol)
    return (read_table(spark, sf_dir, "orders").groupBy(symbol.alias("symbol"), date.alias("date"))
            .agg(F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))).alias("close")))
