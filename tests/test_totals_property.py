"""Latest-position sections with totals (grouping sets) against pandas: rows
of the latest month only, values carried unchanged, one total row whose
summed columns skip NULLs and whose other columns are NULL."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerframe.operators import report as R

num = st.one_of(st.none(), st.integers(-20, 200).map(lambda i: i / 4))
detail = st.lists(st.tuples(st.sampled_from(["AAA3", "BBB4", "CCC11", "DDD3"]),
                            st.sampled_from(["stock", "etf"]),
                            st.sampled_from(["2024-01", "2024-02"]),
                            st.integers(1, 100), num, num, num, num, num, num),
                  max_size=8, unique_by=lambda r: (r[0], r[1], r[2]))
COLS = ["ticker", "asset_type", "_reference_period", "total_quantity", "mean_purchase_price",
        "current_closing_price", "total_current_value", "total_invested", "unrealized_gain_loss",
        "pct_price_change"]


def _eq(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and not (isinstance(b, float) and math.isnan(b)) and math.isclose(a, b, abs_tol=1e-9)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(detail)
def test_latest_equity_detail_totals(spark, rows):
    df = spark.createDataFrame(rows, "ticker string, asset_type string, _reference_period string, "
                               "total_quantity bigint, mean_purchase_price double, "
                               "current_closing_price double, total_current_value double, "
                               "total_invested double, unrealized_gain_loss double, "
                               "pct_price_change double")
    got = R.latest_equity_detail(df).collect()
    if not rows:
        assert got == []
        return
    pdf = pd.DataFrame(rows, columns=COLS)
    latest = pdf[pdf["_reference_period"] == pdf["_reference_period"].max()]
    body = {(r.ticker, r.asset_type): r for r in got if not r.is_total}
    assert set(body) == {(t, "ETF" if a == "etf" else "Ação")
                         for t, a in zip(latest["ticker"], latest["asset_type"])}
    for _, x in latest.iterrows():
        r = body[(x["ticker"], "ETF" if x["asset_type"] == "etf" else "Ação")]
        assert r.total_quantity == x["total_quantity"]
        assert _eq(r.total_invested, x["total_invested"])
        pct = x["pct_price_change"]
        assert _eq(r.pct_price_change, None if pd.isna(pct) else pct / 100)
    total = [r for r in got if r.is_total]
    assert len(total) == 1 and total[0].ticker is None and total[0].mean_purchase_price is None
    for c in ("total_quantity", "total_invested", "total_current_value", "unrealized_gain_loss"):
        s = latest[c].dropna()
        assert _eq(getattr(total[0], c), float(s.sum()) if len(s) else None), c
