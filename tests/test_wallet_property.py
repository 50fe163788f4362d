"""The wallet mart (one conditional aggregate over class-tagged rows) equals
the join-based definition - per-month sums of each class, equity invested at
the whole-history weighted purchase price, invested summed with missing parts
as 0 - computed here with pandas on random small portfolios."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import raw_set
from ledgerframe.plans import build_marts

MONTHS = ["2024-01", "2024-02", "2024-03"]
TICKERS = ["AAA3", "BBB4", "CCC11"]
money = st.one_of(st.none(), st.integers(-50, 500).map(lambda i: i / 4))
qty = st.one_of(st.none(), st.integers(-2, 30).map(float))

positions = st.lists(st.tuples(st.sampled_from(TICKERS), qty, money, money,
                               st.sampled_from(MONTHS)), max_size=6)
trades = st.lists(st.tuples(st.sampled_from(TICKERS), qty, money, st.sampled_from(MONTHS)),
                  max_size=6)
treasury = st.lists(st.tuples(money, money, st.sampled_from(MONTHS)), max_size=3)
fixed = st.lists(st.tuples(money, st.sampled_from(MONTHS)), max_size=3)


def _sum(values):
    vals = [v for v in values if v is not None and not (isinstance(v, float) and math.isnan(v))]
    return sum(vals) if vals else None


def expected_wallet(pos, trd, trs, fix):
    # weighted price per ticker: lots with buy > 0 and price > 0
    lots = [(t, q, p) for t, q, p, _ in trd if q is not None and p is not None and q > 0 and p > 0]
    wap = {}
    for t in {t for t, _, _ in lots}:
        qs = [q for tt, q, _ in lots if tt == t]
        cost = [q * p for tt, q, p in lots if tt == t]
        wap[t] = sum(cost) / sum(qs) if sum(qs) != 0 else None
    # positions: ticker x month (all positions are stocks here)
    eq = {}
    for t, q, close, value, m in pos:
        qi = None if q is None else int(round(q))           # half-even like the staging cast
        eq.setdefault((t, m), []).append((qi, value))
    eq_rows = {k: (_sum(q for q, _ in v), _sum(val for _, val in v)) for k, v in eq.items()}
    classes = {}
    for (t, m), (q, val) in eq_rows.items():
        classes.setdefault(m, {}).setdefault("equity", []).append(val)
    for inv, cur, m in trs:
        classes.setdefault(m, {}).setdefault("treasury", []).append(cur)
    for curva, m in fix:
        classes.setdefault(m, {}).setdefault("fixed_income", []).append(curva)
    out = {}
    for m, cls in classes.items():
        class_values = {c: _sum(v) for c, v in cls.items()}
        total = _sum(class_values.values())
        eq_inv = _sum(q * (wap.get(t) or 0.0) if q is not None else None
                      for (t, mm), (q, _) in eq_rows.items() if mm == m)
        tr_inv = _sum(inv for inv, _, mm in trs if mm == m)
        fi_inv = _sum(c for c, mm in fix if mm == m)
        invested = (eq_inv or 0.0) + (tr_inv or 0.0) + (fi_inv or 0.0)
        out[m] = (total, invested)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(positions, trades, treasury, fixed)
def test_wallet_equals_join_definition(spark, pos, trd, trs, fix):
    raw = raw_set(
        spark,
        raw_stock_positions=[{"Codigo_de_Negociacao": t, "Quantidade": q, "Preco_de_Fechamento": c,
                              "Valor_Atualizado": v, "_reference_period": m}
                             for t, q, c, v, m in pos],
        raw_trades=[{"Codigo_de_Negociacao": t, "Quantidade_Compra": q, "Preco_Medio_Compra": p,
                     "Quantidade_Venda": 0.0, "_reference_period": m} for t, q, p, m in trd],
        raw_treasury_bonds=[{"Produto": "T", "Valor_Aplicado": i, "Valor_Atualizado": c,
                             "_reference_period": m} for i, c, m in trs],
        raw_fixed_income=[{"Produto": "F", "Valor_Atualizado_CURVA": c, "_reference_period": m}
                          for c, m in fix])
    got = {r._reference_period: (r.total_portfolio_value, r.total_invested)
           for r in build_marts(raw).monthly_wallet.collect()}
    want = expected_wallet(pos, trd, trs, fix)
    assert set(got) == set(want)
    for m in want:
        for a, b in zip(got[m], want[m]):
            assert (a is None and b is None) or (a is not None and b is not None
                                                 and abs(a - b) <= 1e-6 * max(1.0, abs(b))), (m, got[m], want[m])
