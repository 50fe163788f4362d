"""Models as SQL views: the report's input queries and the singular checks,
written as SQL against relation names, run on Spark unchanged."""

from fixtures import pos, raw_set, trade
from ledgerframe.plans import build_marts

REPORT_INPUTS = [
    "SELECT * FROM fct_monthly_wallet ORDER BY _reference_period",
    "SELECT * FROM fct_stock_detail ORDER BY _reference_period, ticker",
    "SELECT * FROM fct_dividend_summary ORDER BY _reference_period, ticker",
    "SELECT * FROM fct_treasury_summary ORDER BY _reference_period, product_name",
    "SELECT * FROM fct_fixed_income_summary ORDER BY _reference_period, product_name",
    """SELECT ticker, _reference_period, institution,
              buy_quantity, avg_buy_price, buy_quantity * avg_buy_price AS total_buy_cost,
              sell_quantity, avg_sell_price, sell_quantity * avg_sell_price AS total_sell_value
       FROM stg_trades ORDER BY _reference_period, ticker""",
    "SELECT * FROM int_weighted_avg_price ORDER BY ticker",
]


def test_models_queryable_by_name(spark):
    m = build_marts(raw_set(
        spark,
        raw_stock_positions=[pos("ITUB4", 10, 25.0, 250.0, "2024-01")],
        raw_trades=[trade("ITUB4F", 10.0, 20.0, 0.0, 0.0, "2024-01")]))
    names = m.register_views()
    assert "fct_monthly_wallet" in names and "stg_trades" in names
    counts = [spark.sql(q).count() for q in REPORT_INPUTS]
    assert counts == [1, 1, 0, 0, 0, 1, 1]
    bad = spark.sql("SELECT ticker FROM stg_trades WHERE ticker LIKE '%F' AND length(ticker) > 1")
    assert bad.count() == 0
    w = spark.sql("SELECT total_invested FROM fct_monthly_wallet").first()
    assert w.total_invested == 200.0
