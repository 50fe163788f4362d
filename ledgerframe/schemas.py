"""Declared schemas of the raw statement tables and the benchmark inputs.

The landing layer conforms every workbook sheet to these types, so an
all-digit text column (an account number) keeps its zeros and a sheet kind
that never occurs still yields a fully typed, empty DataFrame.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, DT = T.StringType(), T.DoubleType(), T.DateType()

LINEAGE = [T.StructField("_source_file", S), T.StructField("_reference_period", S)]


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols] + LINEAGE)


_POSITION_COLUMNS = (
    ("Codigo_de_Negociacao", S), ("Produto", S), ("Instituicao", S), ("Conta", S),
    ("Tipo", S), ("Quantidade", D), ("Quantidade_Disponivel", D),
    ("Preco_de_Fechamento", D), ("Valor_Atualizado", D),
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_stock_positions": _struct(*_POSITION_COLUMNS),
    "raw_etf_positions": _struct(*_POSITION_COLUMNS),
    "raw_fixed_income": _struct(
        ("Produto", S), ("Instituicao", S), ("Emissor", S), ("Codigo", S),
        ("Indexador", S), ("Tipo_de_regime", S), ("Data_de_Emissao", DT),
        ("Vencimento", DT), ("Quantidade", D), ("Preco_Atualizado_CURVA", D),
        ("Valor_Atualizado_CURVA", D),
    ),
    "raw_treasury_bonds": _struct(
        ("Produto", S), ("Instituicao", S), ("Codigo_ISIN", S), ("Indexador", S),
        ("Vencimento", DT), ("Quantidade", D), ("Valor_Aplicado", D),
        ("Valor_bruto", D), ("Valor_liquido", D), ("Valor_Atualizado", D),
    ),
    "raw_dividends": _struct(
        ("Produto", S), ("Pagamento", DT), ("Tipo_de_Evento", S), ("Instituicao", S),
        ("Quantidade", D), ("Preco_unitario", D), ("Valor_liquido", D),
    ),
    "raw_trades": _struct(
        ("Codigo_de_Negociacao", S), ("Periodo_Inicial", DT), ("Periodo_Final", DT),
        ("Instituicao", S), ("Quantidade_Compra", D), ("Quantidade_Venda", D),
        ("Quantidade_Liquida", D), ("Preco_Medio_Compra", D), ("Preco_Medio_Venda", D),
    ),
    "raw_stock_lending": _struct(
        ("Produto", S), ("Instituicao", S), ("Natureza", S), ("Numero_de_Contrato", S),
        ("Taxa", D), ("Quantidade", D), ("Preco_de_Fechamento", D),
        ("Valor_Atualizado", D), ("Data_de_registro", DT), ("Data_de_vencimento", DT),
    ),
}

RAW_TABLES = tuple(RAW_SCHEMAS)

# Benchmark inputs: a rate series as landed from the rate API (text date
# dd/MM/yyyy, value in percent per observation) and index prices.
RATES_LANDED_SCHEMA = T.StructType([T.StructField("data", S), T.StructField("valor", S)])
RATES_SCHEMA = T.StructType([T.StructField("date", DT), T.StructField("rate_pct", D)])
PRICES_SCHEMA = T.StructType([
    T.StructField("symbol", S), T.StructField("date", DT),
    T.StructField("close", D), T.StructField("adj_close", D),
])
