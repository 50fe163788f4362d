"""Q1-Q11."""

import pytest

from fixtures import pos, raw_set, trade
from ledgerframe.operators import quality as Q
from ledgerframe.plans import build_marts


def failures(df):
    return {(r.check_name, r.table_name, r.column_name): r.failures for r in df.collect()}


def test_checks_find_planted_failures(spark):
    m = build_marts(raw_set(
        spark,
        raw_stock_positions=[pos("ITUB4", 1, 1.0, 1.0, "2024-01"),
                             pos("NEG3", -5, 1.0, 1.0, "2024-01"),
                             pos("BAD4", 1, 1.0, None, "2024-1")],
        raw_etf_positions=[pos("ITUB4", 1, 1.0, 1.0, "2024-01")],
        raw_trades=[trade("ABCFF", 1.0, 1.0, 0.0, 0.0, "2024-01"),
                    trade("F", 1.0, 1.0, 0.0, 0.0, "2024-01")]))
    got = failures(Q.run_checks(m.tables()))
    assert len(got) == 79   # 57 + 2 + 4 + 2 + 7 generic; 7 singular rows (Q9 has 3)
    assert got[("not_null", "stg_stock_positions", "current_value")] == 1
    assert got[("unique_combination_of_columns", "int_all_equity_positions",
                "ticker,_reference_period")] == 1
    assert got[("no_f_suffix_in_trades", "stg_trades", "ticker")] == 1
    assert got[("no_negative_quantities", "int_all_equity_positions", "total_quantity")] == 1
    assert got[("accepted_range", "int_all_equity_positions", "total_quantity")] == 1
    assert got[("reference_period_format", "fct_stock_detail", "_reference_period")] == 1
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.run_checks(m.tables()))


def test_clean_data_passes_gate(spark):
    m = build_marts(raw_set(spark, raw_stock_positions=[pos("ITUB4", 1, 1.0, 1.0, "2024-01")],
                            raw_trades=[trade("ITUB4", 1.0, 1.0, 0.0, 0.0, "2024-01")],
                            raw_dividends=[{"Produto": "X", "Tipo_de_Evento": "Dividendo",
                                            "Valor_liquido": 1.0, "_reference_period": "2024-01"}]))
    Q.gate(Q.run_checks(m.tables()))


def test_period_format_rejects_trailing_newline(spark):
    df = spark.createDataFrame([("2024-01\n",), ("2024-00",), (None,)], "_reference_period string")
    got = Q.singular_check({t: df for t in ("fct_monthly_wallet", "fct_stock_detail",
                                            "fct_dividend_summary")}, "reference_period_format").collect()
    assert [r.failures for r in got] == [1, 1, 1]


def test_clean_trades_are_checked_with_the_staged_ones(spark):
    m = build_marts(raw_set(spark, raw_trades=[
        trade("A", 1.0, None, 0.0, 0.0, "2024-01"), trade("B", 0.0, None, 0.0, None, "2024-01"),
        trade("C", 0.0, None, 1.0, 1.0, "2024-01")]))
    both = failures(Q.run_checks({t: m.tables()[t] for t in ("stg_trades", "int_trades_clean")}))
    alone = failures(Q.run_checks({"int_trades_clean": m.tables()["int_trades_clean"]}))
    assert {k: v for k, v in both.items() if k[1] == "int_trades_clean"} == alone
    assert alone[("not_null", "int_trades_clean", "avg_buy_price")] == 2


def test_unique_checks_of_one_key_share_a_pass(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    out = Q.batched_checks({"t": df}, declared=[Q.Check("unique", "t", ("k",)),
                                                Q.Check("unique_combination", "t", ("k",))])
    assert failures(out) == {("unique", "t", "k"): 1, ("unique_combination_of_columns", "t", "k"): 2}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
