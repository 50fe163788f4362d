"""Staging (S1-S7): trim, type and key-filter each raw statement table.

Every function is a lazy projection + filter over one raw table, so Catalyst
pushes the key predicate into the scan and prunes unused columns.  ``keys``
names extra grouping columns (e.g. a portfolio owner) carried through
unchanged; empty by default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import half_even_int
from ..functions.text import blank_key, strip_odd_lot_suffix, ticker_from_product

LINEAGE = ("_source_file", "_reference_period")


def _trim(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def _dbl(name: str) -> Column:
    return F.col(name).cast("double")


def _keep(raw: DataFrame, key: str, cols: list[Column], keys: Sequence[str]) -> DataFrame:
    return (raw.filter(~blank_key(key))
               .select(*[F.col(k) for k in keys], *cols, *[F.col(c) for c in LINEAGE]))


def _date_text(raw: DataFrame, *columns: str) -> list[Column]:
    """The texts of date cells that are no date, where the landing kept any."""
    if "_rejected" not in raw.columns:
        return []
    text = F.map_filter("_rejected", lambda k, v: k.isin(*columns))
    return [F.when(F.size(text) > 0, F.to_json(text)).alias("_date_text")]


def _positions(raw: DataFrame, subtype_name: str, keys: Sequence[str]) -> DataFrame:
    return _keep(raw, "Codigo_de_Negociacao", [
        _trim("Codigo_de_Negociacao").alias("ticker"),
        _trim("Produto").alias("product_name"),
        _trim("Instituicao").alias("institution"),
        F.col("Conta").cast("string").alias("account"),
        _trim("Tipo").alias(subtype_name),
        half_even_int("Quantidade").alias("quantity"),
        half_even_int("Quantidade_Disponivel").alias("quantity_available"),
        _dbl("Preco_de_Fechamento").alias("closing_price"),
        _dbl("Valor_Atualizado").alias("current_value"),
    ], keys)


def stg_stock_positions(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """S1."""
    return _positions(raw, "stock_type", keys)


def stg_etf_positions(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """S2."""
    return _positions(raw, "etf_type", keys)


def stg_fixed_income(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """S3."""
    return _keep(raw, "Produto", [
        _trim("Produto").alias("product_name"),
        _trim("Instituicao").alias("institution"),
        _trim("Emissor").alias("issuer"),
        _trim("Codigo").alias("code"),
        _trim("Indexador").alias("index_type"),
        _trim("Tipo_de_regime").alias("regime_type"),
        F.col("Data_de_Emissao").alias("issue_date"),
        F.col("Vencimento").alias("maturity_date"),
        _dbl("Quantidade").alias("quantity"),
        _dbl("Preco_Atualizado_CURVA").alias("curva_price"),
        _dbl("Valor_Atualizado_CURVA").alias("curva_value"),
        *_date_text(raw, "Data_de_Emissao", "Vencimento"),
    ], keys)


def stg_treasury_bonds(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """S4."""
    return _keep(raw, "Produto", [
        _trim("Produto").alias("product_name"),
        _trim("Instituicao").alias("institution"),
        _trim("Codigo_ISIN").alias("isin_code"),
        _trim("Indexador").alias("index_type"),
        F.col("Vencimento").alias("maturity_date"),
        _dbl("Quantidade").alias("quantity"),
        _dbl("Valor_Aplicado").alias("invested_value"),
        _dbl("Valor_bruto").alias("gross_value"),
        _dbl("Valor_liquido").alias("net_value"),
        _dbl("Valor_Atualizado").alias("current_value"),
        *_date_text(raw, "Vencimento"),
    ], keys)


def stg_dividends(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """S5."""
    return _keep(raw, "Produto", [
        _trim("Produto").alias("product_name"),
        F.col("Pagamento").alias("payment_date"),
        _trim("Tipo_de_Evento").alias("event_type"),
        _trim("Instituicao").alias("institution"),
        _dbl("Quantidade").alias("quantity"),
        _dbl("Preco_unitario").alias("unit_price"),
        _dbl("Valor_liquido").alias("net_value"),
    ], keys)


def stg_trades(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ticker without one trailing odd-lot ``F``."""
    return _keep(raw, "Codigo_de_Negociacao", [
        strip_odd_lot_suffix("Codigo_de_Negociacao").alias("ticker"),
        F.col("Periodo_Inicial").alias("period_start"),
        F.col("Periodo_Final").alias("period_end"),
        _trim("Instituicao").alias("institution"),
        _dbl("Quantidade_Compra").alias("buy_quantity"),
        _dbl("Quantidade_Venda").alias("sell_quantity"),
        _dbl("Quantidade_Liquida").alias("net_quantity"),
        _dbl("Preco_Medio_Compra").alias("avg_buy_price"),
        _dbl("Preco_Medio_Venda").alias("avg_sell_price"),
    ], keys)


def stg_stock_lending(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ticker is the text before the first ``' - '`` of the product."""
    return _keep(raw, "Produto", [
        ticker_from_product("Produto").alias("ticker"),
        _trim("Produto").alias("product_name"),
        _trim("Instituicao").alias("institution"),
        _trim("Natureza").alias("nature"),
        _trim("Numero_de_Contrato").alias("contract_number"),
        _dbl("Taxa").alias("rate"),
        half_even_int("Quantidade").alias("quantity"),
        _dbl("Preco_de_Fechamento").alias("closing_price"),
        _dbl("Valor_Atualizado").alias("current_value"),
        F.col("Data_de_registro").alias("registration_date"),
        F.col("Data_de_vencimento").alias("maturity_date"),
    ], keys)


STAGING = {
    "raw_stock_positions": ("stg_stock_positions", stg_stock_positions),
    "raw_etf_positions": ("stg_etf_positions", stg_etf_positions),
    "raw_fixed_income": ("stg_fixed_income", stg_fixed_income),
    "raw_treasury_bonds": ("stg_treasury_bonds", stg_treasury_bonds),
    "raw_dividends": ("stg_dividends", stg_dividends),
    "raw_trades": ("stg_trades", stg_trades),
    "raw_stock_lending": ("stg_stock_lending", stg_stock_lending),
}


def stage_all(raw, keys: Sequence[str] = ()):
    """Apply S1-S7 to a mapping of raw tables; returns a mapping
    ``{stg_name: DataFrame}`` whose entries are built when first used."""
    from ..plans.lazy import LazyTables
    return LazyTables({name: (lambda fn=fn, table=table: fn(raw[table], keys))
                       for table, (name, fn) in STAGING.items()})
