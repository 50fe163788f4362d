"""raw -> staging -> intermediate -> marts, as one lazy DataFrame graph.

Dependency graph (each arrow a DataFrame function)::

    raw_trades - S6 - T1 - T2 --------------+
    raw_stock - S1 -+                        +- T10 fct_stock_detail
    raw_etf --- S2 -+- T3 -------------------+
                       +- T4 (long form)     +- T9 fct_monthly_wallet
    raw_treasury - S4 -+- T12                |
    raw_fixed ---- S3 -+- T13 ---------------+
    raw_dividends - S5 - T11            raw_lending - S7

Nothing here triggers a job.  When several marts are written in one run the
caller may ``persist`` the shared intermediates (T2, T3); see
:mod:`ledgerframe.plans.statement_run`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import staging as S
from ..operators import transforms as T
from ..operators.report import P, latest_rows
from .lazy import LazyTables
from .maintained import PARTS


class Marts:
    """Every staging, intermediate and mart DataFrame of one set of raw
    tables.  Each model is built on first access; accessing one model builds
    only the models it depends on."""

    def __init__(self, raw, keys: Sequence[str] = (), sums: dict[str, DataFrame] | None = None,
                 **overrides: DataFrame):
        """``sums``: sums that stand in for the rows that the models add up
        (:mod:`.maintained`)."""
        self.keys = tuple(keys)
        self.sums = dict(sums or {})
        self.staging = S.stage_all(raw, self.keys)
        self._overrides = overrides

    def _get(self, name: str, build):
        if name in self._overrides:
            return self._overrides[name]
        cache = self.__dict__.setdefault("_cache", {})
        if name not in cache:
            cache[name] = build()
        return cache[name]

    def part(self, name: str) -> DataFrame:
        """The rows that a model adds up, or maintained sums of them."""
        return self.sums[name] if name in self.sums else PARTS[name].rows(self.staging, self.keys)

    @property
    def trades_clean(self) -> DataFrame:
        return self._get("trades_clean",
                         lambda: T.int_trades_clean(self.staging["stg_trades"], self.keys))

    @property
    def weighted_avg_price(self) -> DataFrame:
        return self._get("weighted_avg_price",
                         lambda: T.weighted_price(self.part("purchases"), self.keys))

    @property
    def equity_positions(self) -> DataFrame:
        return self._get("equity_positions", lambda: T.positions(self.part("holdings"), self.keys))

    @property
    def monthly_value(self) -> DataFrame:
        return self._get("monthly_value", lambda: T.int_monthly_portfolio_value(
            self.equity_positions, self.part("treasury"), self.part("fixed_income"), self.keys))

    @property
    def monthly_wallet(self) -> DataFrame:
        return self._get("monthly_wallet", lambda: T.fct_monthly_wallet(
            self.equity_positions, self.weighted_avg_price, self.part("treasury"),
            self.part("fixed_income"), self.keys))

    @property
    def stock_detail(self) -> DataFrame:
        return self._get("stock_detail", lambda: T.fct_stock_detail(
            self.equity_positions, self.weighted_avg_price, self.keys))

    def latest(self, name: str) -> DataFrame:
        """One of the position marts, only the rows of its last month.  A stored mart
        is read there; else the staged rows are cut to their last month first, so
        that no other month is aggregated."""
        if self._MODELS[name] in self._overrides:
            return latest_rows(self._overrides[self._MODELS[name]], self.keys)
        stg, keys = self.staging, list(self.keys)
        if name == "fct_treasury_summary":
            return T.fct_treasury_summary(latest_rows(stg["stg_treasury_bonds"], keys), keys)
        if name == "fct_fixed_income_summary":
            return T.fct_fixed_income_summary(latest_rows(stg["stg_fixed_income"], keys), keys)
        both = [stg["stg_stock_positions"], stg["stg_etf_positions"]]
        months = both[0].select(*keys, P).union(both[1].select(*keys, P))
        return T.fct_stock_detail(T.int_all_equity_positions(
            *[latest_rows(df, keys, months=months) for df in both], keys), self.weighted_avg_price, keys)

    @property
    def dividend_summary(self) -> DataFrame:
        return self._get("dividend_summary", lambda: T.dividend_summary(
            self.part("payments"), self.keys))

    @property
    def treasury_summary(self) -> DataFrame:
        return self._get("treasury_summary", lambda: T.fct_treasury_summary(
            self.part("treasury"), self.keys))

    @property
    def fixed_income_summary(self) -> DataFrame:
        return self._get("fixed_income_summary", lambda: T.fct_fixed_income_summary(
            self.part("fixed_income"), self.keys))

    _MODELS = {
        "int_trades_clean": "trades_clean",
        "int_weighted_avg_price": "weighted_avg_price",
        "int_all_equity_positions": "equity_positions",
        "int_monthly_portfolio_value": "monthly_value",
        "fct_monthly_wallet": "monthly_wallet",
        "fct_stock_detail": "stock_detail",
        "fct_dividend_summary": "dividend_summary",
        "fct_treasury_summary": "treasury_summary",
        "fct_fixed_income_summary": "fixed_income_summary",
    }

    def tables(self) -> LazyTables:
        """Every model by its relation name (staging, intermediate, marts),
        built on access."""
        builders = {name: (lambda name=name: self.staging[name]) for name in self.staging}
        builders.update({rel: (lambda attr=attr: getattr(self, attr))
                         for rel, attr in self._MODELS.items()})
        return LazyTables(builders)

    def mart_tables(self) -> LazyTables:
        return LazyTables({rel: (lambda attr=attr: getattr(self, attr))
                           for rel, attr in self._MODELS.items() if rel.startswith("fct_")})

    def register_views(self, names: Sequence[str] | None = None) -> list[str]:
        """Expose the models as temporary views under their relation names
        (``stg_trades``, ``int_weighted_avg_price``, ``fct_monthly_wallet``,
        ...) so they can be queried with ``spark.sql``.  Views stay lazy:
        only the models a statement reads are computed."""
        tables = self.tables()
        chosen = list(names) if names is not None else list(tables)
        for name in chosen:
            tables[name].createOrReplaceTempView(name)
        return chosen

    def with_stored(self, stored: dict[str, DataFrame]) -> "Marts":
        """The same models with some marts replaced by stored tables (read
        back after writing), keyed by relation name."""
        m = Marts.__new__(Marts)
        m.keys, m.staging, m.sums = self.keys, self.staging, self.sums
        m._overrides = {**self._overrides,
                        **{self._MODELS[k]: v for k, v in stored.items()}}
        m.__dict__["_cache"] = {}   # models derived from replaced ones are rebuilt on access
        return m


def build_marts(raw, keys: Sequence[str] = (), sums: dict[str, DataFrame] | None = None) -> Marts:
    """All models over a mapping of raw tables (lazy; see :class:`Marts`)."""
    return Marts(raw, keys, sums)
