"""Small hand-made raw tables (FIXTURES.md section 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerframe.schemas import RAW_SCHEMAS


def raw_df(spark: SparkSession, table: str, rows: list[dict], period: str | None = None) -> DataFrame:
    schema = RAW_SCHEMAS[table]
    data = []
    for r in rows:
        r = dict(r)
        if period is not None:
            r.setdefault("_reference_period", period)
        r.setdefault("_source_file", f"statement-{r.get('_reference_period')}.xlsx")
        data.append(tuple(r.get(f.name) for f in schema.fields))
    return spark.createDataFrame(data, schema)


def raw_set(spark: SparkSession, **tables: list[dict]) -> dict[str, DataFrame]:
    return {t: raw_df(spark, t, tables.get(t, [])) for t in RAW_SCHEMAS}


def pos(ticker, qty, close, value, period, inst="XP"):
    return {"Codigo_de_Negociacao": ticker, "Produto": ticker, "Instituicao": inst,
            "Quantidade": float(qty), "Quantidade_Disponivel": float(qty),
            "Preco_de_Fechamento": close, "Valor_Atualizado": value, "_reference_period": period}


def trade(code, buy, buy_px, sell, sell_px, period, inst="XP"):
    return {"Codigo_de_Negociacao": code, "Instituicao": inst, "Quantidade_Compra": buy,
            "Preco_Medio_Compra": buy_px, "Quantidade_Venda": sell, "Preco_Medio_Venda": sell_px,
            "Quantidade_Liquida": None if buy is None or sell is None else buy - sell,
            "_reference_period": period}
