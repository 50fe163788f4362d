"""Benchmark comparison against a pandas statement of the same algorithm on
random rate and price series."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerframe.operators import benchmarks as B

ALL_MONTHS = ["2023-11", "2023-12", "2024-01", "2024-02", "2024-03", "2024-04"]
days = st.dates(dt.date(2023, 11, 1), dt.date(2024, 5, 3))
rates = st.lists(st.tuples(days, st.integers(0, 20).map(lambda i: i / 100)), max_size=12)
prices = st.lists(st.tuples(st.sampled_from(["^BVSP", "DIVO11.SA"]), days,
                            st.one_of(st.none(), st.integers(50, 150).map(float))), max_size=12)
periods = st.lists(st.sampled_from(ALL_MONTHS[1:5]), min_size=1, max_size=4, unique=True)


def pandas_reference(period_list, rate_rows, price_rows):
    periods = sorted(period_list)
    start = dt.date(int(periods[0][:4]), int(periods[0][5:]), 1)
    end = dt.date(int(periods[-1][:4]), int(periods[-1][5:]), 28)
    out = pd.DataFrame({"_reference_period": periods})
    r = pd.DataFrame(rate_rows, columns=["date", "valor"])
    r = r[(r["date"] >= start) & (r["date"] <= end)]
    if r.empty:
        out["cdi"] = 0.0
    else:
        r["ym"] = [d.strftime("%Y-%m") for d in r["date"]]
        m = r.groupby("ym")["valor"].apply(lambda x: ((1 + x / 100).prod() - 1) * 100)
        out = out.merge(m.rename("m").reset_index().rename(columns={"ym": "_reference_period"}),
                        on="_reference_period", how="left")
        out["m"] = out["m"].fillna(0)
        out["cdi"] = ((1 + out["m"] / 100).cumprod() - 1) * 100
    for sym, col in B.SYMBOL_COLUMNS.items():
        p = pd.DataFrame([x for x in price_rows if x[0] == sym], columns=["s", "date", "close"])
        p = p[(p["date"] >= start) & (p["date"] < end + dt.timedelta(days=5))].sort_values("date")
        if p.empty:
            out[col] = 0.0
            continue
        p["ym"] = [d.strftime("%Y-%m") for d in p["date"]]
        monthly = p.groupby("ym")["close"].last()        # last non-null close of the month
        ret = (monthly / monthly.iloc[0] - 1) * 100
        merged = out[["_reference_period"]].merge(
            ret.rename(col).reset_index().rename(columns={"ym": "_reference_period"}),
            on="_reference_period", how="left")
        out[col] = merged[col].ffill().fillna(0).values
    return {row["_reference_period"]: (row["cdi"], row["ibov_return"], row["divo11_return"])
            for _, row in out.iterrows()}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(periods, rates, prices)
def test_benchmark_comparison_matches_pandas(spark, period_list, rate_rows, price_rows):
    wallet = spark.createDataFrame([(p, 1.0) for p in period_list],
                                   "_reference_period string, pct_return double")
    r = spark.createDataFrame(rate_rows, "date date, rate_pct double")
    p = spark.createDataFrame(price_rows, "symbol string, date date, close double")
    got = {row._reference_period: (row.cdi_cumulative, row.ibov_return, row.divo11_return)
           for row in B.benchmark_comparison(wallet, r, B.month_end_close(p)).collect()}
    want = pandas_reference(period_list, rate_rows, price_rows)
    assert set(got) == set(want)
    for k in want:
        for a, b in zip(got[k], want[k]):
            b = 0.0 if pd.isna(b) else float(b)
            assert abs(a - b) <= 1e-9 * max(1.0, abs(b)), (k, got[k], want[k])
