"""Report sections keep the pandas rules of the statement report: groups with
a NULL key are dropped, a sum over only NULLs is 0, the dividend total runs
over all rows, tax tables match event types case-insensitively."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerframe.operators import report as R

EVENTS = [None, "Dividendo", "DIVIDENDO", "JCP", "Juros Sobre Capital Próprio", "Rendimento"]
rows = st.lists(st.tuples(st.sampled_from(["AAA3", "BBB4", "CCC11"]), st.sampled_from(EVENTS),
                          st.one_of(st.none(), st.integers(-100, 1000).map(lambda i: i / 8)),
                          st.integers(1, 5)), max_size=10)


def _close(a, b):
    return abs(a - b) <= 1e-9 * max(1.0, abs(b))


def _pandas_sum(series):
    v = series.sum()
    return 0.0 if (v is None or (isinstance(v, float) and math.isnan(v))) else float(v)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_income_sections_follow_pandas_rules(spark, data):
    df = spark.createDataFrame(
        [(t, "2024-01", e, v, 1.0, n) for t, e, v, n in data],
        "ticker string, _reference_period string, event_type string, total_income double, "
        "total_shares double, num_payments bigint")
    pdf = pd.DataFrame(data, columns=["ticker", "event_type", "total_income", "num_payments"])

    by_type = {(r.event_type, r.is_total): r for r in R.dividends_by_type(df).collect()}
    if data:
        g = pdf.groupby("event_type")["total_income"].sum()     # NULL event types dropped
        for evt, val in g.items():
            assert _close(by_type[(evt, False)].total, float(val))
        assert {k for k in by_type if not k[1]} == {(e, False) for e in g.index}
        assert _close(by_type[(None, True)].total, _pandas_sum(pdf["total_income"]))
        assert by_type[(None, True)].payments == int(pdf["num_payments"].sum())
    else:
        assert by_type == {}

    for fn, pattern in ((R.tax_exempt_income, "Dividendo"), (R.tax_taxable_income, "JCP|Juros")):
        got = {(r.ticker, r.is_total): r.total_income for r in fn(df).collect()}
        mask = pdf["event_type"].str.contains(pattern, case=False, na=False, regex=True)
        sub = pdf[mask]
        if sub.empty:
            assert got == {}
            continue
        per = sub.groupby("ticker")["total_income"].sum()
        for t, val in per.items():
            assert _close(got[(t, False)], float(val))
        assert _close(got[(None, True)], float(per.sum()))
