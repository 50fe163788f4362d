"""Multi-portfolio runs: with ``keys=["owner"]`` every owner's result equals
a run over that owner's data alone."""


import pytest
from pyspark.sql import DataFrame, functions as F

from fixtures import pos, raw_set, trade
from ledgerframe.operators import benchmarks as B
from ledgerframe.operators import report as R
from ledgerframe.plans import build_marts

OWNER_A = dict(
    raw_stock_positions=[pos("ITUB4", 10, 25.0, 250.0, "2024-01"),
                         pos("ITUB4", 10, 30.0, 300.0, "2024-02")],
    raw_trades=[trade("ITUB4", 10.0, 20.0, 0.0, 0.0, "2024-01")],
    raw_treasury_bonds=[{"Produto": "Selic", "Valor_Aplicado": 100.0, "Valor_Atualizado": 110.0,
                         "_reference_period": "2024-02"}],
)
OWNER_B = dict(
    raw_stock_positions=[pos("ITUB4", 3, 26.0, 78.0, "2024-01"), pos("WEGE3", 1, 40.0, 40.0, "2024-03")],
    raw_trades=[trade("ITUB4", 3.0, 30.0, 0.0, 0.0, "2024-01"),
                trade("WEGE3", 1.0, 35.0, 0.0, 0.0, "2024-03")],
    raw_dividends=[{"Produto": "ITUB4 - X", "Tipo_de_Evento": "Dividendo", "Valor_liquido": 1.0,
                    "_reference_period": "2024-03"}],
)


def _tag(raw: dict, owner: str) -> dict:
    return {t: df.withColumn("owner", F.lit(owner)) for t, df in raw.items()}


def _rows(df: DataFrame, drop=()):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture()
def runs(spark):
    a, b = raw_set(spark, **OWNER_A), raw_set(spark, **OWNER_B)
    ta, tb = _tag(a, "A"), _tag(b, "B")
    both = {t: ta[t].unionByName(tb[t]) for t in ta}
    return build_marts(a), build_marts(b), build_marts(both, keys=["owner"])


@pytest.mark.parametrize("attr", ["monthly_wallet", "stock_detail", "weighted_avg_price",
                                  "dividend_summary", "treasury_summary"])
def test_marts_per_owner(runs, attr):
    a, b, both = runs
    for owner, single in (("A", a), ("B", b)):
        keyed = getattr(both, attr).filter(F.col("owner") == owner).drop("owner")
        assert _rows(keyed) == _rows(getattr(single, attr))


@pytest.mark.parametrize("section", ["latest_kpis", "allocation_by_class", "latest_equity_detail",
                                     "dividends_by_type", "tax_assets", "report_periods"])
def test_sections_per_owner(runs, section):
    a, b, both = runs
    keyed = R.build_sections(both, keys=["owner"])[section]
    for owner, single in (("A", a), ("B", b)):
        assert _rows(keyed.filter(F.col("owner") == owner).drop("owner")) == \
            _rows(R.build_sections(single)[section])


def test_cumulative_rate_per_owner(spark, runs):
    a, b, both = runs
    rates = spark.createDataFrame([("2024-01-02", 1.0), ("2024-02-02", 2.0), ("2024-03-30", 3.0)],
                                  "date string, rate_pct double").withColumn("date", F.to_date("date"))
    monthly = B.monthly_rate_returns(rates)
    keyed = B.cumulative_rate(monthly, both.monthly_wallet.select("owner", "_reference_period"),
                              keys=["owner"])
    for owner, single in (("A", a), ("B", b)):
        solo = B.cumulative_rate(monthly, single.monthly_wallet.select("_reference_period"))
        assert _rows(keyed.filter(F.col("owner") == owner).drop("owner")) == _rows(solo)


def test_index_returns_per_owner(spark, runs):
    a, b, both = runs
    import datetime as dt
    prices = spark.createDataFrame(
        [("^BVSP", dt.date(2024, 1, 5), 100.0), ("^BVSP", dt.date(2024, 2, 5), 110.0),
         ("^BVSP", dt.date(2024, 3, 5), 121.0), ("DIVO11.SA", dt.date(2024, 3, 5), 10.0)],
        "symbol string, date date, close double")
    closes = B.month_end_close(prices)
    keyed = B.forward_fill_returns(B.index_returns_for_periods(
        closes, both.monthly_wallet.select("owner", "_reference_period"), ["owner"]), ["owner"])
    for owner, single in (("A", a), ("B", b)):
        solo = B.forward_fill_returns(B.index_returns_for_periods(
            closes, single.monthly_wallet.select("_reference_period")))
        assert _rows(keyed.filter(F.col("owner") == owner).drop("owner")) == _rows(solo)
    # an owner starting a month later gets that month's close as the base
    periods = spark.createDataFrame([("X", "2024-01"), ("X", "2024-02"), ("X", "2024-03"),
                                     ("Y", "2024-02"), ("Y", "2024-03")],
                                    "owner string, _reference_period string")
    late = B.forward_fill_returns(B.index_returns_for_periods(closes, periods, ["owner"]), ["owner"])
    got = {(r.owner, r._reference_period): r.ibov_return for r in late.collect()}
    assert got[("X", "2024-03")] == pytest.approx(21.0)
    assert got[("Y", "2024-02")] == pytest.approx(0.0)
    assert got[("Y", "2024-03")] == pytest.approx(10.0)
