"""R1-R19 on hand-made marts."""

import pytest
from pyspark.sql import functions as F

from fixtures import pos, raw_set, trade
from ledgerframe.functions.periods import period_label
from ledgerframe.operators import report as R
from ledgerframe.plans import build_marts


@pytest.fixture()
def marts(spark):
    return build_marts(raw_set(
        spark,
        raw_stock_positions=[pos("ITUB4", 10, 25.0, 250.0, "2024-01"),
                             pos("ITUB4", 10, 30.0, 300.0, "2024-02"),
                             pos("GIFT3", 5, 10.0, 50.0, "2024-02")],
        raw_etf_positions=[pos("BOVA11", 2, 100.0, 200.0, "2024-02")],
        raw_trades=[trade("ITUB4", 10.0, 20.0, 0.0, 0.0, "2024-01"),
                    trade("BOVA11", 2.0, 90.0, 0.0, 0.0, "2024-01"),
                    trade("ITUB4", 0.0, 0.0, 1000.0, 20.0, "2024-02"),
                    trade("ITUB4", 0.0, 0.0, 1000.0, 20.00001, "2024-01"),
                    trade("VALE3", None, None, 0.0, 0.0, "2024-02")],
        raw_treasury_bonds=[{"Produto": "Selic", "Valor_Aplicado": 100.0, "Valor_bruto": 101.0,
                             "Valor_liquido": 100.5, "Valor_Atualizado": 102.0,
                             "_reference_period": "2024-02"}],
        raw_dividends=[
            {"Produto": "ITUB4 - ITAU", "Tipo_de_Evento": "Dividendo", "Valor_liquido": 10.0,
             "_reference_period": "2024-01"},
            {"Produto": "ITUB4 - ITAU", "Tipo_de_Evento": "jcp", "Valor_liquido": 4.0,
             "_reference_period": "2024-01"},
            {"Produto": "BBDC4", "Tipo_de_Evento": "Juros Sobre Capital Próprio",
             "Valor_liquido": 6.0, "_reference_period": "2024-02"},
            {"Produto": "MXRF11", "Tipo_de_Evento": "Rendimento", "Valor_liquido": 2.0,
             "_reference_period": "2024-02"},
            {"Produto": "BBDC4", "Tipo_de_Evento": None, "Valor_liquido": 1.0,
             "_reference_period": "2024-02"}]))


def test_period_labels(spark):
    df = spark.createDataFrame([("2024-06",), ("2024-00",), ("extrato.xlsx",), ("12345-01",)], "p string")
    assert [r[0] for r in df.select(period_label("p")).collect()] == \
        ["Jun/24", "00/24", "extrato.xlsx", "Jan/345"]


def test_latest_kpis_and_allocation(marts):
    k = R.latest_kpis(marts.monthly_wallet).collect()
    assert len(k) == 1 and k[0]._reference_period == "2024-02"
    alloc = {r.asset_class: r for r in R.allocation_by_class(marts.monthly_wallet).collect()}
    total = 300.0 + 50.0 + 200.0 + 102.0
    assert alloc["Tesouro Direto"].share == pytest.approx(102.0 / total)
    assert alloc["Renda Fixa"].value == 0.0 and alloc["Renda Fixa"].share == 0.0


def test_dividends_by_type_null_event(marts):
    got = {(r.event_type, r.is_total): r.total for r in R.dividends_by_type(marts.dividend_summary).collect()}
    assert (None, False) not in got                        # NULL type is not a group
    assert got[(None, True)] == pytest.approx(23.0)        # but counts in the total
    assert got[("Dividendo", False)] == 10.0


def test_tax_income_patterns(marts):
    ex = {r.ticker: r.total_income for r in R.tax_exempt_income(marts.dividend_summary).collect()}
    assert ex == {"ITUB4": 10.0, None: 10.0}
    tx = {r.ticker: r.total_income for r in R.tax_taxable_income(marts.dividend_summary).collect()}
    assert tx == {"ITUB4": 4.0, "BBDC4": 6.0, None: 10.0}


def test_trades_listing_dashes_and_totals(marts):
    rows = R.trades_listing(marts.staging["stg_trades"]).collect()
    total = [r for r in rows if r.is_total][0]
    assert len(rows) == 6
    assert total.buy_quantity == 12.0 and total.total_buy_cost == pytest.approx(380.0)
    vale = [r for r in rows if r.ticker == "VALE3"][0]
    assert vale.buy_quantity is None and vale.sell_quantity is None


def test_sales_flag_strict_threshold(marts):
    got = {r._reference_period: (r.total_sell_value, r.above_threshold)
           for r in R.monthly_sales_flag(marts.staging["stg_trades"]).collect()}
    assert got["2024-02"] == (20000.0, "NÃO")
    assert got["2024-01"][1] == "SIM"


def test_latest_equity_detail_total_and_tax_year(marts):
    det = R.latest_equity_detail(marts.stock_detail).collect()
    total = [r for r in det if r.is_total][0]
    assert total.total_quantity == 17 and total.total_current_value == 550.0
    gift = [r for r in det if r.ticker == "GIFT3"][0]
    assert gift.asset_type == "Ação" and gift.pct_price_change == 0.0
    jan = R.tax_assets(marts.stock_detail, year="2024").collect()
    assert {r.ticker for r in jan if not r.is_total} == {"ITUB4", "GIFT3", "BOVA11"}
    assert [r for r in R.latest_treasury(marts.treasury_summary).collect() if r.is_total][0] \
        .gain_loss == 2.0


def test_empty_inputs_give_empty_sections(spark):
    m = build_marts(raw_set(spark))
    for name, df in R.build_sections(m).items():
        assert df.count() == 0, name


def test_sections_ordering(marts):
    s = R.build_sections(marts)
    by_ticker = R.ordered_section(s["dividends_by_ticker"], "dividends_by_ticker").collect()
    assert [r.ticker for r in by_ticker] == ["ITUB4", "BBDC4", "MXRF11"]
    assert R.ordered_section(s["report_periods"], "report_periods") \
        .agg(F.collect_list("_reference_period")).first()[0] == ["2024-01", "2024-02"]
