"""S1-S7 and T1-T13 on the row-level edge cases of FIXTURES.md section 4."""

import pytest

from fixtures import pos, raw_df, raw_set, trade
from ledgerframe.operators import staging as S
from ledgerframe.operators import transforms as T
from ledgerframe.plans import build_marts


def rows(df, *key):
    return {tuple(getattr(r, k) for k in key): r for r in df.collect()}


def test_trade_suffix_and_weighted_price(spark):
    raw = raw_set(spark, raw_trades=[
        trade("BBAS3F ", 100.0, 10.0, 0.0, 0.0, "2024-01"),
        trade("BBAS3", 50.0, 13.0, 0.0, 0.0, "2024-02"),
        trade("ABCFF", 1.0, 1.0, 0.0, 0.0, "2024-01"),
        trade("F", 1.0, 1.0, 0.0, 0.0, "2024-01"),
        trade("abcf", 1.0, 1.0, 0.0, 0.0, "2024-01"),
        trade("SELL3", 0.0, 0.0, 10.0, 12.0, "2024-01"),     # kept by T1, not by T2
        trade("NONE3", 0.0, 0.0, 0.0, 0.0, "2024-01"),       # dropped by T1
        trade("FREE3", 5.0, 0.0, 0.0, 0.0, "2024-01"),       # kept by T1, not by T2
    ])
    m = build_marts(raw)
    tickers = sorted(r.ticker for r in m.staging["stg_trades"].collect())
    assert tickers == ["", "ABCF", "BBAS3", "BBAS3", "FREE3", "NONE3", "SELL3", "abcf"]
    clean = rows(m.trades_clean, "ticker")
    assert ("NONE3",) not in clean and ("SELL3",) in clean and ("FREE3",) in clean
    wap = rows(m.weighted_avg_price, "ticker")
    assert wap[("BBAS3",)].weighted_avg_price == pytest.approx(11.0)
    assert wap[("BBAS3",)].total_shares_bought == 150.0
    assert ("SELL3",) not in wap and ("FREE3",) not in wap


def test_blank_keys_dropped_tab_kept(spark):
    raw = raw_df(spark, "raw_stock_positions", [
        pos(None, 1, 1.0, 1.0, "2024-01"), pos("", 1, 1.0, 1.0, "2024-01"),
        pos("   ", 1, 1.0, 1.0, "2024-01"), pos("\t", 1, 1.0, 1.0, "2024-01"),
        pos(" OK3 ", 1, 1.0, 1.0, "2024-01")])
    got = sorted(r.ticker for r in S.stg_stock_positions(raw).collect())
    assert got == ["\t", "OK3"]


def test_positions_weighted_close_and_stock_detail(spark):
    raw = raw_set(
        spark,
        raw_stock_positions=[pos("ITUB4", 10, 20.0, 200.0, "2024-01", "A"),
                             pos("ITUB4", 30, 24.0, 720.0, "2024-01", "B"),
                             pos("GIFT3", 5, 10.0, 50.0, "2024-01")],
        raw_etf_positions=[pos("ITUB4", 1, 1.0, 1.0, "2024-01")],
        raw_trades=[trade("ITUB4", 40.0, 20.0, 0.0, 0.0, "2024-01")])
    m = build_marts(raw)
    eq = rows(m.equity_positions, "ticker", "asset_type")
    assert eq[("ITUB4", "stock")].total_quantity == 40
    assert eq[("ITUB4", "stock")].avg_closing_price == pytest.approx(23.0)
    assert ("ITUB4", "etf") in eq                          # two rows: Q3 must flag it
    det = rows(m.stock_detail, "ticker", "asset_type")
    gift = det[("GIFT3", "stock")]                         # never bought
    assert gift.mean_purchase_price is None and gift.total_invested == 0
    assert gift.pct_price_change == 0 and gift.unrealized_gain_loss == 50.0
    itub = det[("ITUB4", "stock")]
    assert itub.total_invested == pytest.approx(800.0)
    assert itub.pct_price_change == pytest.approx(15.0)


def test_wallet_class_zeros_and_invested(spark):
    raw = raw_set(
        spark,
        raw_stock_positions=[pos("ITUB4", 10, 25.0, 250.0, "2024-01")],
        raw_trades=[trade("ITUB4", 10.0, 20.0, 0.0, 0.0, "2024-01")],
        raw_treasury_bonds=[
            {"Produto": "Tesouro Selic", "Valor_Aplicado": 100.0, "Valor_Atualizado": 110.0,
             "_reference_period": "2024-02"},
            {"Produto": "Tesouro IPCA", "Valor_Aplicado": None, "Valor_Atualizado": 50.0,
             "_reference_period": "2024-03"}],
        raw_fixed_income=[{"Produto": "CDB", "Emissor": None, "Valor_Atualizado_CURVA": 70.0,
                           "Quantidade": 1.0, "_reference_period": "2024-01"},
                          {"Produto": "CDB", "Emissor": None, "Valor_Atualizado_CURVA": 30.0,
                           "Quantidade": 1.0, "_reference_period": "2024-01"}])
    m = build_marts(raw)
    w = rows(m.monthly_wallet, "_reference_period")
    jan, feb, mar = w[("2024-01",)], w[("2024-02",)], w[("2024-03",)]
    assert jan.total_portfolio_value == 350.0 and jan.treasury_value == 0.0
    assert jan.total_invested == pytest.approx(300.0)       # 200 equity + 100 fixed income
    assert jan.pct_return == pytest.approx(50 / 300 * 100)
    assert feb.equity_value == 0.0 and feb.fixed_income_value == 0.0
    assert feb.total_invested == 100.0
    assert mar.total_invested == 0.0 and mar.pct_return == 0.0   # invested 0 -> pct 0
    tr = rows(m.treasury_summary, "product_name")
    assert tr[("Tesouro IPCA",)].gain_loss is None
    fi = m.fixed_income_summary.collect()
    assert len(fi) == 1 and fi[0].total_curva_value == 100.0     # NULL issuer: one group


def test_dividend_ticker_and_null_event(spark):
    raw = raw_set(spark, raw_dividends=[
        {"Produto": "ITSA4 - ITAUSA S.A. - PN", "Tipo_de_Evento": "DIVIDENDO",
         "Valor_liquido": 10.0, "Quantidade": 100.0, "_reference_period": "2024-01"},
        {"Produto": "ITSA4", "Tipo_de_Evento": "DIVIDENDO", "Valor_liquido": 5.0,
         "Quantidade": 50.0, "_reference_period": "2024-01"},
        {"Produto": "ITSA4", "Tipo_de_Evento": None, "Valor_liquido": 1.0,
         "Quantidade": 1.0, "_reference_period": "2024-01"}])
    d = rows(build_marts(raw).dividend_summary, "ticker", "event_type")
    assert d[("ITSA4", "DIVIDENDO")].total_income == 15.0
    assert d[("ITSA4", "DIVIDENDO")].num_payments == 2
    assert d[("ITSA4", None)].total_income == 1.0


def test_lending_ticker(spark):
    raw = raw_df(spark, "raw_stock_lending", [
        {"Produto": "PETR4 - PETROBRAS", "Quantidade": 2.5, "_reference_period": "2024-01"},
        {"Produto": "VALE3", "Quantidade": 1.0, "_reference_period": "2024-01"}])
    got = {r.ticker: r.quantity for r in S.stg_stock_lending(raw).collect()}
    assert got == {"PETR4": 2, "VALE3": 1}


def test_mart_order(spark):
    raw = raw_set(spark, raw_stock_positions=[pos("B", 1, 1.0, 1.0, "2024-02"),
                                              pos("A", 1, 1.0, 1.0, "2024-02"),
                                              pos("C", 1, 1.0, 1.0, "2024-01")])
    got = [(r._reference_period, r.ticker)
           for r in T.ordered(build_marts(raw).stock_detail, "fct_stock_detail").collect()]
    assert got == [("2024-01", "C"), ("2024-02", "A"), ("2024-02", "B")]


def test_with_stored_rebuilds_dependents(spark):
    from pyspark.sql import functions as F
    raw = raw_set(spark, raw_stock_positions=[pos("ITUB4", 10, 25.0, 250.0, "2024-01")],
                  raw_trades=[trade("ITUB4", 10.0, 20.0, 0.0, 0.0, "2024-01")])
    m = build_marts(raw)
    assert m.stock_detail.first().total_invested == 200.0          # built and cached
    stored_price = m.weighted_avg_price.withColumn("weighted_avg_price", F.lit(30.0))
    m2 = m.with_stored({"int_weighted_avg_price": stored_price})
    assert m2.stock_detail.first().total_invested == 300.0          # rebuilt on the override
    assert m.stock_detail.first().total_invested == 200.0           # original untouched
