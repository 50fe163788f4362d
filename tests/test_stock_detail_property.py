"""fct_stock_detail (T2, T3, T10) against a pandas statement of the models on
random positions and trades, NULLs and zero quantities included."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import raw_set
from ledgerframe.plans import build_marts

TICKERS = ["AAA3", "BBB4"]
MONTHS = ["2024-01", "2024-02"]
num = st.one_of(st.none(), st.integers(-4, 40).map(lambda i: i / 2))
positions = st.lists(st.tuples(st.sampled_from(TICKERS), num, num, num, st.sampled_from(MONTHS)),
                     max_size=6)
trades = st.lists(st.tuples(st.sampled_from(TICKERS + ["CCC3F"]), num, num), max_size=6)


def _s(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) if xs else None


def expected(pos, trd):
    lots = [(t[:-1] if t.endswith("F") else t, q, p) for t, q, p in trd
            if q is not None and p is not None and q > 0 and p > 0]
    wap = {}
    for t in {t for t, _, _ in lots}:
        q = sum(q for tt, q, _ in lots if tt == t)
        wap[t] = sum(q * p for tt, q, p in lots if tt == t) / q
    out = {}
    for key in {(t, m) for t, _, _, _, m in pos}:
        rows = [(None if q is None else int(round(q)), c, v) for t, q, c, v, m in pos if (t, m) == key]
        qty = _s(q for q, _, _ in rows)
        cq = _s(None if (q is None or c is None) else c * q for q, c, _ in rows)
        close = None if qty in (None, 0) or cq is None else cq / qty
        value = _s(v for _, _, v in rows)
        w = wap.get(key[0])
        invested = None if qty is None else qty * (w or 0.0)
        pct = 0.0 if not (w or 0.0) > 0 else (None if close is None else (close - w) / w * 100)
        out[key] = (qty, w, close, value, invested, pct)
    return out


def _eq(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(positions, trades)
def test_stock_detail_equals_models(spark, pos, trd):
    raw = raw_set(
        spark,
        raw_stock_positions=[{"Codigo_de_Negociacao": t, "Quantidade": q, "Preco_de_Fechamento": c,
                              "Valor_Atualizado": v, "_reference_period": m} for t, q, c, v, m in pos],
        raw_trades=[{"Codigo_de_Negociacao": t, "Quantidade_Compra": q, "Preco_Medio_Compra": p,
                     "Quantidade_Venda": 0.0, "_reference_period": "2024-01"} for t, q, p in trd])
    got = {(r.ticker, r._reference_period): (r.total_quantity, r.mean_purchase_price,
                                            r.current_closing_price, r.total_current_value,
                                            r.total_invested, r.pct_price_change)
           for r in build_marts(raw).stock_detail.collect()}
    want = expected(pos, trd)
    assert set(got) == set(want)
    for k in want:
        assert all(_eq(a, b) for a, b in zip(got[k], want[k])), (k, got[k], want[k])
