"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement starts from the driver views (``lineitem``, ``part``,
``orders``, ``customer``, ``events``) and re-derives the statement tables,
staging relations and marts in plain SQL, independently of the Spark code.
Double outputs are rounded to 4 decimals, as on the Spark side.
"""

from __future__ import annotations

# The letters that header cleaning replaces, then those it drops.
LETTERS, REPLACED_BY = " /ãçéíóúÃÇÉÍÓÚâêôá()", "__aceiouACEIOUaeoa"

# The declared checks.  Table, then its columns; "+" joins the
# columns of a combination, ">" and ">=" give the lower bound of a range.
DECLARED = {
    "not_null": """
        stg_stock_positions ticker quantity closing_price current_value _reference_period
        stg_etf_positions ticker quantity closing_price _reference_period
        stg_fixed_income product_name _reference_period
        stg_treasury_bonds product_name invested_value current_value _reference_period
        stg_dividends product_name event_type net_value _reference_period
        stg_trades ticker _reference_period
        stg_stock_lending _reference_period
        int_trades_clean ticker buy_quantity avg_buy_price total_buy_cost _reference_period
        int_weighted_avg_price ticker total_shares_bought weighted_avg_price
        int_all_equity_positions ticker asset_type total_quantity total_current_value _reference_period
        int_monthly_portfolio_value asset_class total_value _reference_period
        fct_monthly_wallet _reference_period total_portfolio_value total_invested
        fct_stock_detail ticker _reference_period total_quantity current_closing_price total_current_value
        fct_dividend_summary ticker event_type total_income _reference_period
        fct_treasury_summary product_name _reference_period total_invested total_current_value
        fct_fixed_income_summary product_name _reference_period total_curva_value""",
    "unique": """
        int_weighted_avg_price ticker
        fct_monthly_wallet _reference_period""",
    "unique_combination": """
        int_all_equity_positions ticker+_reference_period
        fct_monthly_wallet _reference_period
        fct_stock_detail ticker+_reference_period
        fct_dividend_summary ticker+_reference_period+event_type""",
    "accepted_values": """
        int_all_equity_positions asset_type=stock|etf
        int_monthly_portfolio_value asset_class=equity|treasury|fixed_income""",
    "accepted_range": """
        int_weighted_avg_price total_shares_bought>0 weighted_avg_price>0
        int_all_equity_positions total_quantity>0
        fct_monthly_wallet total_portfolio_value>=0
        fct_stock_detail total_quantity>0 current_closing_price>0
        fct_dividend_summary total_income>0""",
}

# ----------------------------------------------------------------- adapter --
ADAPTER = """
lots AS (
  SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey
),
raw_trades AS (
  SELECT p_brand || '-' || p_type || (CASE WHEN l_linestatus = 'F' THEN 'F' ELSE '' END)
           AS Codigo_de_Negociacao,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS Periodo_Inicial,
         last_day(CAST(l_shipdate AS DATE)) AS Periodo_Final,
         CAST(l_suppkey AS VARCHAR) AS Instituicao,
         CASE WHEN sold THEN 0.0::DOUBLE ELSE l_quantity END AS Quantidade_Compra,
         CASE WHEN sold THEN l_quantity ELSE 0.0::DOUBLE END AS Quantidade_Venda,
         CASE WHEN sold THEN -l_quantity ELSE l_quantity END AS Quantidade_Liquida,
         CASE WHEN sold THEN 0.0::DOUBLE ELSE p_retailprice END AS Preco_Medio_Compra,
         CASE WHEN sold THEN p_retailprice ELSE 0.0::DOUBLE END AS Preco_Medio_Venda,
         'statement-' || strftime(l_shipdate, '%Y-%m') || '.xlsx' AS _source_file,
         strftime(l_shipdate, '%Y-%m') AS _reference_period
  FROM (SELECT *, l_returnflag = 'R' OR p_brand = 'Brand#3' AS sold FROM lots) AS l
),
raw_positions AS (
  SELECT p_brand || '-' || p_type AS Codigo_de_Negociacao,
         p_name AS Produto,
         CAST(l_suppkey AS VARCHAR) AS Instituicao,
         CAST(l_orderkey AS VARCHAR) AS Conta,
         p_type AS Tipo,
         l_quantity AS Quantidade,
         l_quantity * (1.0::DOUBLE - l_discount) AS Quantidade_Disponivel,
         p_retailprice AS Preco_de_Fechamento,
         l_extendedprice AS Valor_Atualizado,
         'statement-' || strftime(l_shipdate, '%Y-%m') || '.xlsx' AS _source_file,
         strftime(l_shipdate, '%Y-%m') AS _reference_period,
         p_type IN ('ECONOMY', 'STANDARD', 'SMALL') AS is_stock
  FROM lots
),
raw_stock_positions AS (SELECT * EXCLUDE (is_stock) FROM raw_positions WHERE is_stock),
raw_etf_positions AS (SELECT * EXCLUDE (is_stock) FROM raw_positions WHERE NOT is_stock),
raw_treasury_bonds AS (
  SELECT o_orderpriority AS Produto,
         'TESOURO NACIONAL' AS Instituicao,
         'BRSTN' || CAST(o_custkey AS VARCHAR) AS Codigo_ISIN,
         o_orderstatus AS Indexador,
         make_date(year(o_orderdate), 12, 31) AS Vencimento,
         1.0::DOUBLE AS Quantidade,
         o_totalprice AS Valor_Aplicado,
         o_totalprice * 1.10::DOUBLE AS Valor_bruto,
         o_totalprice * 1.08::DOUBLE AS Valor_liquido,
         o_totalprice * 1.05::DOUBLE AS Valor_Atualizado,
         'statement-' || strftime(o_orderdate, '%Y-%m') || '.xlsx' AS _source_file,
         strftime(o_orderdate, '%Y-%m') AS _reference_period
  FROM orders WHERE o_orderstatus = 'P'
),
raw_fixed_income AS (
  SELECT c_mktsegment AS Produto,
         CAST(c_nationkey AS VARCHAR) AS Instituicao,
         o_orderpriority AS Emissor,
         CAST(c_nationkey AS VARCHAR) AS Codigo,
         o_orderstatus AS Indexador,
         'CURVA' AS Tipo_de_regime,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS Data_de_Emissao,
         make_date(year(o_orderdate) + 2, 12, 31) AS Vencimento,
         1.0::DOUBLE AS Quantidade,
         o_totalprice AS Preco_Atualizado_CURVA,
         o_totalprice AS Valor_Atualizado_CURVA,
         'statement-' || strftime(o_orderdate, '%Y-%m') || '.xlsx' AS _source_file,
         strftime(o_orderdate, '%Y-%m') AS _reference_period
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderstatus IN ('F', 'O')
),
raw_dividends AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) || ' - ' || event_type AS Produto,
         CAST(ts AS DATE) AS Pagamento,
         CASE event_type WHEN 'purchase' THEN 'Dividendo'
                         WHEN 'view' THEN 'Juros Sobre Capital Proprio'
                         WHEN 'click' THEN 'JCP'
                         WHEN 'signup' THEN 'Rendimento' END AS Tipo_de_Evento,
         'CORRETORA' AS Instituicao,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS Quantidade,
         value AS Preco_unitario,
         value AS Valor_liquido,
         'statement-' || strftime(ts, '%Y-%m') || '.xlsx' AS _source_file,
         strftime(ts, '%Y-%m') AS _reference_period
  FROM events
),
raw_stock_lending AS (
  SELECT p_brand || '-' || p_type || ' - ' || p_name AS Produto,
         CAST(l_suppkey AS VARCHAR) AS Instituicao,
         l_returnflag AS Natureza,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS Numero_de_Contrato,
         l_discount AS Taxa,
         l_quantity AS Quantidade,
         p_retailprice AS Preco_de_Fechamento,
         l_extendedprice AS Valor_Atualizado,
         CAST(l_shipdate AS DATE) AS Data_de_registro,
         CAST(l_shipdate AS DATE) + 90 AS Data_de_vencimento,
         'statement-' || strftime(l_shipdate, '%Y-%m') || '.xlsx' AS _source_file,
         strftime(l_shipdate, '%Y-%m') AS _reference_period
  FROM lots
)"""

# ----------------------------------------------------------------- staging --
STAGING = """
stg_stock_positions AS (
  SELECT trim(Codigo_de_Negociacao) AS ticker, trim(Produto) AS product_name,
         trim(Instituicao) AS institution, CAST(Conta AS VARCHAR) AS account,
         trim(Tipo) AS stock_type, CAST(Quantidade AS INTEGER) AS quantity,
         CAST(Quantidade_Disponivel AS INTEGER) AS quantity_available,
         CAST(Preco_de_Fechamento AS DOUBLE) AS closing_price,
         CAST(Valor_Atualizado AS DOUBLE) AS current_value, _source_file, _reference_period
  FROM raw_stock_positions
  WHERE Codigo_de_Negociacao IS NOT NULL AND trim(CAST(Codigo_de_Negociacao AS VARCHAR)) <> ''
),
stg_etf_positions AS (
  SELECT trim(Codigo_de_Negociacao) AS ticker, trim(Produto) AS product_name,
         trim(Instituicao) AS institution, CAST(Conta AS VARCHAR) AS account,
         trim(Tipo) AS etf_type, CAST(Quantidade AS INTEGER) AS quantity,
         CAST(Quantidade_Disponivel AS INTEGER) AS quantity_available,
         CAST(Preco_de_Fechamento AS DOUBLE) AS closing_price,
         CAST(Valor_Atualizado AS DOUBLE) AS current_value, _source_file, _reference_period
  FROM raw_etf_positions
  WHERE Codigo_de_Negociacao IS NOT NULL AND trim(CAST(Codigo_de_Negociacao AS VARCHAR)) <> ''
),
stg_fixed_income AS (
  SELECT trim(Produto) AS product_name, trim(Instituicao) AS institution,
         trim(Emissor) AS issuer, trim(CAST(Codigo AS VARCHAR)) AS code,
         trim(CAST(Indexador AS VARCHAR)) AS index_type,
         trim(CAST(Tipo_de_regime AS VARCHAR)) AS regime_type,
         Data_de_Emissao AS issue_date, Vencimento AS maturity_date,
         CAST(Quantidade AS DOUBLE) AS quantity,
         CAST(Preco_Atualizado_CURVA AS DOUBLE) AS curva_price,
         CAST(Valor_Atualizado_CURVA AS DOUBLE) AS curva_value, _source_file, _reference_period
  FROM raw_fixed_income
  WHERE Produto IS NOT NULL AND trim(CAST(Produto AS VARCHAR)) <> ''
),
stg_treasury_bonds AS (
  SELECT trim(Produto) AS product_name, trim(Instituicao) AS institution,
         trim(Codigo_ISIN) AS isin_code, trim(CAST(Indexador AS VARCHAR)) AS index_type,
         Vencimento AS maturity_date, CAST(Quantidade AS DOUBLE) AS quantity,
         CAST(Valor_Aplicado AS DOUBLE) AS invested_value,
         CAST(Valor_bruto AS DOUBLE) AS gross_value,
         CAST(Valor_liquido AS DOUBLE) AS net_value,
         CAST(Valor_Atualizado AS DOUBLE) AS current_value, _source_file, _reference_period
  FROM raw_treasury_bonds
  WHERE Produto IS NOT NULL AND trim(CAST(Produto AS VARCHAR)) <> ''
),
stg_dividends AS (
  SELECT trim(Produto) AS product_name, Pagamento AS payment_date,
         trim(Tipo_de_Evento) AS event_type, trim(Instituicao) AS institution,
         CAST(Quantidade AS DOUBLE) AS quantity, CAST(Preco_unitario AS DOUBLE) AS unit_price,
         CAST(Valor_liquido AS DOUBLE) AS net_value, _source_file, _reference_period
  FROM raw_dividends
  WHERE Produto IS NOT NULL AND trim(CAST(Produto AS VARCHAR)) <> ''
),
stg_trades AS (
  SELECT regexp_replace(trim(CAST(Codigo_de_Negociacao AS VARCHAR)), 'F$', '') AS ticker,
         Periodo_Inicial AS period_start, Periodo_Final AS period_end,
         trim(Instituicao) AS institution,
         CAST(Quantidade_Compra AS DOUBLE) AS buy_quantity,
         CAST(Quantidade_Venda AS DOUBLE) AS sell_quantity,
         CAST(Quantidade_Liquida AS DOUBLE) AS net_quantity,
         CAST(Preco_Medio_Compra AS DOUBLE) AS avg_buy_price,
         CAST(Preco_Medio_Venda AS DOUBLE) AS avg_sell_price, _source_file, _reference_period
  FROM raw_trades
  WHERE Codigo_de_Negociacao IS NOT NULL AND trim(CAST(Codigo_de_Negociacao AS VARCHAR)) <> ''
),
stg_stock_lending AS (
  SELECT trim(split_part(CAST(Produto AS VARCHAR), ' - ', 1)) AS ticker,
         trim(Produto) AS product_name, trim(Instituicao) AS institution,
         trim(CAST(Natureza AS VARCHAR)) AS nature,
         trim(CAST(Numero_de_Contrato AS VARCHAR)) AS contract_number,
         CAST(Taxa AS DOUBLE) AS rate, CAST(Quantidade AS INTEGER) AS quantity,
         CAST(Preco_de_Fechamento AS DOUBLE) AS closing_price,
         CAST(Valor_Atualizado AS DOUBLE) AS current_value,
         Data_de_registro AS registration_date, Data_de_vencimento AS maturity_date,
         _source_file, _reference_period
  FROM raw_stock_lending
  WHERE Produto IS NOT NULL AND trim(CAST(Produto AS VARCHAR)) <> ''
)"""

# ------------------------------------------------------------ intermediate --
MODELS = """
int_trades_clean AS (
  SELECT ticker, _reference_period, institution, buy_quantity, avg_buy_price,
         sell_quantity, avg_sell_price,
         buy_quantity * avg_buy_price AS total_buy_cost,
         sell_quantity * avg_sell_price AS total_sell_value
  FROM stg_trades WHERE buy_quantity > 0 OR sell_quantity > 0
),
int_weighted_avg_price AS (
  SELECT ticker, sum(buy_quantity) AS total_shares_bought,
         sum(total_buy_cost) AS total_invested,
         sum(total_buy_cost) / nullif(sum(buy_quantity), 0) AS weighted_avg_price
  FROM int_trades_clean WHERE buy_quantity > 0 AND avg_buy_price > 0
  GROUP BY ticker
),
held AS (
  SELECT 'stock' AS asset_type, * FROM stg_stock_positions
  UNION ALL BY NAME SELECT 'etf' AS asset_type, * FROM stg_etf_positions
),
int_all_equity_positions AS (
  SELECT ticker, asset_type, _reference_period, sum(quantity)::BIGINT AS total_quantity,
         CASE WHEN total_quantity <> 0 THEN sum(quantity * closing_price) / total_quantity END
           AS avg_closing_price,
         sum(current_value) AS total_current_value
  FROM held GROUP BY ALL
),
basis AS (
  -- what a share of a ticker has cost; tickers never bought have no row
  SELECT map_from_entries(list((ticker, weighted_avg_price))) AS price FROM int_weighted_avg_price
),
-- one row for each amount: the month, what it measures, the amount
amounts AS (
  SELECT _reference_period, 'equity' AS measure, total_current_value AS amount
  FROM int_all_equity_positions
  UNION ALL
  SELECT _reference_period, 'equity_cost', total_quantity * coalesce(price[ticker], 0)
  FROM int_all_equity_positions, basis
  UNION ALL
  SELECT _reference_period, unnest(['treasury', 'treasury_cost']),
         unnest([current_value, invested_value])
  FROM stg_treasury_bonds
  UNION ALL
  SELECT _reference_period, unnest(['fixed_income', 'fixed_income_cost']),
         unnest([curva_value, curva_value])
  FROM stg_fixed_income
),
monthly AS (
  SELECT _reference_period, measure, sum(amount) AS amount FROM amounts GROUP BY ALL
),
int_monthly_portfolio_value AS (
  SELECT _reference_period, measure AS asset_class, amount AS total_value
  FROM monthly WHERE measure NOT LIKE '%cost'
),
sheet AS (
  SELECT _reference_period, map_from_entries(list((measure, amount))) AS of,
         sum(amount) FILTER (measure NOT LIKE '%cost') AS total_portfolio_value,
         coalesce(sum(amount) FILTER (measure LIKE '%cost'), 0) AS total_invested
  FROM monthly GROUP BY ALL
),
by_class AS (
  SELECT _reference_period, total_portfolio_value, coalesce(of['equity'], 0) AS equity_value,
         coalesce(of['treasury'], 0) AS treasury_value,
         coalesce(of['fixed_income'], 0) AS fixed_income_value
  FROM sheet
),
fct_monthly_wallet AS (
  SELECT c.*, total_invested, total_portfolio_value - total_invested AS absolute_gain_loss,
         if(total_invested > 0, 100 * absolute_gain_loss / total_invested, 0) AS pct_return
  FROM by_class AS c JOIN (SELECT _reference_period, total_invested FROM sheet) AS i
    USING (_reference_period)
),
fct_stock_detail AS (
  SELECT ticker, asset_type, _reference_period, total_quantity,
         price[ticker] AS mean_purchase_price, avg_closing_price AS current_closing_price,
         total_current_value, total_quantity * coalesce(mean_purchase_price, 0) AS total_invested,
         total_current_value - total_invested AS unrealized_gain_loss,
         if(mean_purchase_price > 0,
            100 * (avg_closing_price - mean_purchase_price) / mean_purchase_price, 0)
           AS pct_price_change
  FROM int_all_equity_positions, basis
),
fct_dividend_summary AS (
  SELECT trim(split_part(CAST(product_name AS VARCHAR), ' - ', 1)) AS ticker,
         _reference_period, event_type,
         sum(net_value) AS total_income, sum(quantity) AS total_shares,
         count(*) AS num_payments
  FROM stg_dividends GROUP BY 1, 2, 3
),
fct_treasury_summary AS (
  SELECT product_name, index_type, maturity_date, _reference_period,
         sum(quantity) AS total_quantity, sum(invested_value) AS total_invested,
         sum(gross_value) AS total_gross, sum(net_value) AS total_net,
         sum(current_value) AS total_current_value,
         sum(current_value) - sum(invested_value) AS gain_loss
  FROM stg_treasury_bonds GROUP BY product_name, index_type, maturity_date, _reference_period
),
fct_fixed_income_summary AS (
  SELECT product_name, issuer, code, index_type, regime_type, issue_date, maturity_date,
         _reference_period, sum(quantity) AS total_quantity,
         sum(curva_value) AS total_curva_value
  FROM stg_fixed_income
  GROUP BY product_name, issuer, code, index_type, regime_type, issue_date, maturity_date,
           _reference_period
)"""

BASE = "WITH " + ADAPTER.strip() + ",\n" + STAGING.strip() + ",\n" + MODELS.strip()


def with_base(select: str, extra_ctes: str = "") -> str:
    ctes = BASE + (",\n" + extra_ctes.strip() if extra_ctes.strip() else "")
    return ctes + "\n" + select.strip()


def rounded(select_from: str, cols: list[str], extra_ctes: str = "", digits: int = 4) -> str:
    """``SELECT * REPLACE (<c rounded half-up via decimal> AS c, ...) FROM (<query>)``."""
    if cols:
        repl = ", ".join(f"CAST(round(CAST({c} AS DECIMAL(38,10)), {digits}) AS DOUBLE) AS {c}"
                         for c in cols)
        outer = f"SELECT * REPLACE ({repl}) FROM ({select_from.strip()}) AS q"
    else:
        outer = select_from
    return with_base(outer, extra_ctes)


def table(name: str, double_cols: list[str]) -> str:
    return rounded(f"SELECT * FROM {name}", double_cols)


ORACLE: dict[str, str] = {
    "s1_stock_positions": table("stg_stock_positions", ["closing_price", "current_value"]),
    "s2_etf_positions": table("stg_etf_positions", ["closing_price", "current_value"]),
    "s3_fixed_income": table("stg_fixed_income", ["quantity", "curva_price", "curva_value"]),
    "s4_treasury_bonds": table("stg_treasury_bonds", ["quantity", "invested_value", "gross_value",
                                                      "net_value", "current_value"]),
    "s5_dividends": table("stg_dividends", ["quantity", "unit_price", "net_value"]),
    "s6_trades": table("stg_trades", ["buy_quantity", "sell_quantity", "net_quantity",
                                      "avg_buy_price", "avg_sell_price"]),
    "s7_stock_lending": table("stg_stock_lending", ["rate", "closing_price", "current_value"]),
    "t1_trades_clean": table("int_trades_clean", ["buy_quantity", "avg_buy_price", "sell_quantity",
                                                  "avg_sell_price", "total_buy_cost",
                                                  "total_sell_value"]),
    "t2_weighted_avg_price": table("int_weighted_avg_price", ["total_shares_bought",
                                                              "total_invested",
                                                              "weighted_avg_price"]),
    "t3_equity_positions": table("int_all_equity_positions", ["avg_closing_price",
                                                              "total_current_value"]),
    "t4_monthly_value": table("int_monthly_portfolio_value", ["total_value"]),
    "t6_value_by_class": table("by_class", ["total_portfolio_value", "equity_value",
                                            "treasury_value", "fixed_income_value"]),
    "t7_equity_invested": rounded(
        "SELECT _reference_period, amount AS total_equity_invested FROM monthly "
        "WHERE measure = 'equity_cost'", ["total_equity_invested"]),
    "t8_other_invested": rounded(
        "SELECT _reference_period, replace(measure, '_cost', '') AS asset_class, "
        "amount AS total_invested FROM monthly "
        "WHERE measure IN ('treasury_cost', 'fixed_income_cost')", ["total_invested"]),
    "t9_monthly_wallet": table("fct_monthly_wallet", [
        "total_portfolio_value", "equity_value", "treasury_value", "fixed_income_value",
        "total_invested", "absolute_gain_loss", "pct_return"]),
    "t10_stock_detail": table("fct_stock_detail", [
        "mean_purchase_price", "current_closing_price", "total_current_value", "total_invested",
        "unrealized_gain_loss", "pct_price_change"]),
    "t11_dividend_summary": table("fct_dividend_summary", ["total_income", "total_shares"]),
    "t12_treasury_summary": table("fct_treasury_summary", [
        "total_quantity", "total_invested", "total_gross", "total_net", "total_current_value",
        "gain_loss"]),
    "t13_fixed_income_summary": table("fct_fixed_income_summary", ["total_quantity",
                                                                   "total_curva_value"]),
}


# ----------------------------------------------------------------- quality --


def _check_sql(kind: str, t: str, column: str) -> str:
    def row(name: str, col: str, expr: str, source: str) -> str:
        return (f"SELECT '{name}' AS check_name, '{t}' AS table_name, '{col}' AS column_name, "
                f"CAST({expr} AS BIGINT) AS failures FROM {source}")

    if kind == "not_null":
        return row(kind, column, f"count(*) FILTER ({column} IS NULL)", t)
    if kind.startswith("unique"):
        cols = column.replace("+", ", ")
        given = f"WHERE {cols} IS NOT NULL " if kind == "unique" else ""
        return row(kind if kind == "unique" else "unique_combination_of_columns",
                   column.replace("+", ","), "count(*)",
                   f"(SELECT {cols} FROM {t} {given}GROUP BY ALL HAVING count(*) > 1) AS d")
    if kind == "accepted_values":
        column, _, allowed = column.partition("=")
        values = ", ".join(f"'{v}'" for v in allowed.split("|"))
        return row(kind, column, f"count(DISTINCT {column}) FILTER ({column} NOT IN ({values}))", t)
    bare = column.split(">")[0]
    return row("accepted_range", bare, f"count(*) FILTER (NOT ({column}))", t)


def _generic_sql(kind: str | None) -> str:
    parts = []
    for name, listed in DECLARED.items():
        for t, *columns in (line.split() for line in listed.split("\n") if line.strip()):
            parts += [_check_sql(name, t, c) for c in columns if kind in (None, name)]
    return "\nUNION ALL\n".join(parts)


def _count_sql(name: str, table: str, col: str, source_where: str) -> str:
    return (f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{col}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM {source_where}")


SINGULAR_SQL = {
    "q6_no_f_suffix": _count_sql("no_f_suffix_in_trades", "stg_trades", "ticker",
                                 "stg_trades WHERE ticker LIKE '%F' AND length(ticker) > 1"),
    "q7_no_negative_quantity": _count_sql("no_negative_quantities", "int_all_equity_positions",
                                          "total_quantity",
                                          "int_all_equity_positions WHERE total_quantity < 0"),
    "q8_portfolio_value_positive": _count_sql("portfolio_value_positive", "fct_monthly_wallet",
                                              "total_portfolio_value",
                                              "fct_monthly_wallet WHERE total_portfolio_value < 0"),
    "q9_period_format": "\nUNION ALL\n".join(
        _count_sql("reference_period_format", t, "_reference_period",
                   f"{t} WHERE NOT regexp_full_match(_reference_period, '\\d{{4}}-\\d{{2}}')")
        for t in ("fct_monthly_wallet", "fct_stock_detail", "fct_dividend_summary")),
    "q10_price_consistent": _count_sql(
        "weighted_avg_price_consistent", "int_weighted_avg_price", "weighted_avg_price",
        "int_weighted_avg_price WHERE total_shares_bought > 0 AND "
        "abs(weighted_avg_price - total_invested / total_shares_bought) > 0.01"),
}

ORACLE.update({
    "q1_not_null": with_base(_generic_sql("not_null")),
    "q2_unique": with_base(_generic_sql("unique")),
    "q3_unique_combination": with_base(_generic_sql("unique_combination")),
    "q4_accepted_values": with_base(_generic_sql("accepted_values")),
    "q5_accepted_range": with_base(_generic_sql("accepted_range")),
    **{k: with_base(v) for k, v in SINGULAR_SQL.items()},
    "q11_quality_gate": with_base(_generic_sql(None) + "\nUNION ALL\n"
                                  + "\nUNION ALL\n".join(SINGULAR_SQL.values())),
})


# -------------------------------------------------------------- benchmarks --
BENCH = """
periods AS (SELECT DISTINCT _reference_period FROM int_monthly_portfolio_value),
bounds AS (
  SELECT make_date(CAST(substr(min(_reference_period), 1, 4) AS INTEGER),
                   CAST(substr(min(_reference_period), 6, 2) AS INTEGER), 1) AS lo,
         make_date(CAST(substr(max(_reference_period), 1, 4) AS INTEGER),
                   CAST(substr(max(_reference_period), 6, 2) AS INTEGER), 28) AS hi
  FROM periods
),
landed_rates AS (
  SELECT strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS data,
         CAST(count(*) % 10 AS DOUBLE) / 100 AS valor
  FROM orders GROUP BY CAST(o_orderdate AS DATE)
),
rates AS (
  SELECT CAST(strptime(data, '%d/%m/%Y') AS DATE) AS date, valor AS rate_pct FROM landed_rates
),
rates_in_window AS (
  SELECT r.* FROM rates r, bounds b WHERE r.date >= b.lo AND r.date <= b.hi
),
cdi_monthly AS (
  SELECT strftime(date, '%Y-%m') AS _reference_period,
         (product(1 + rate_pct / 100) - 1) * 100 AS cdi_monthly_return
  FROM rates_in_window GROUP BY 1
),
cdi AS (
  SELECT p._reference_period, coalesce(m.cdi_monthly_return, 0) AS cdi_monthly_return,
         (product(1 + coalesce(m.cdi_monthly_return, 0) / 100)
            OVER (ORDER BY p._reference_period
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1) * 100 AS cdi_cumulative
  FROM periods p LEFT JOIN cdi_monthly m ON p._reference_period = m._reference_period
),
daily_prices AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN '^BVSP'
              WHEN o_orderpriority <> '2-HIGH' THEN o_orderpriority
              WHEN o_orderdate < DATE '1996-01-01' THEN 'DIVO11.PRE' ELSE 'DIVO11.SA' END AS symbol,
         CAST(o_orderdate AS DATE) AS date,
         max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS close
  FROM orders GROUP BY 1, 2
),
prices AS (SELECT * FROM daily_prices),
prices_in_window AS (
  SELECT p.* FROM prices p, bounds b WHERE p.date >= b.lo AND p.date < b.hi + 5
),
month_close AS (
  SELECT symbol, strftime(date, '%Y-%m') AS _reference_period,
         arg_max(close, date) FILTER (WHERE close IS NOT NULL) AS close
  FROM prices_in_window GROUP BY 1, 2
),
index_returns AS (
  SELECT symbol, _reference_period, close,
         (close / first_value(close) OVER (PARTITION BY symbol ORDER BY _reference_period
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) - 1) * 100 AS return_pct
  FROM month_close
),
index_wide AS (
  SELECT _reference_period,
         max(CASE WHEN symbol = '^BVSP' THEN return_pct END) AS ibov,
         max(CASE WHEN symbol = 'DIVO11.SA' THEN return_pct END) AS divo11
  FROM index_returns GROUP BY 1
),
indices AS (
  SELECT p._reference_period,
         coalesce(last_value(w.ibov IGNORE NULLS) OVER run, 0) AS ibov_return,
         coalesce(last_value(w.divo11 IGNORE NULLS) OVER run, 0) AS divo11_return
  FROM periods p LEFT JOIN index_wide w ON p._reference_period = w._reference_period
  WINDOW run AS (ORDER BY p._reference_period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
performance AS (
  SELECT w._reference_period, w.pct_return,
         coalesce(c.cdi_cumulative, 0) AS cdi_cumulative,
         coalesce(i.ibov_return, 0) AS ibov_return,
         coalesce(i.divo11_return, 0) AS divo11_return
  FROM fct_monthly_wallet w
  LEFT JOIN cdi c ON w._reference_period = c._reference_period
  LEFT JOIN indices i ON w._reference_period = i._reference_period
)"""

ORACLE.update({
    "b1_monthly_rate": rounded("SELECT * FROM cdi_monthly", ["cdi_monthly_return"], BENCH),
    "b2_cumulative_rate": rounded("SELECT * FROM cdi", ["cdi_monthly_return", "cdi_cumulative"],
                                  BENCH),
    "b3_month_end_close": rounded("SELECT * FROM month_close", ["close"], BENCH),
    "b4_index_returns": rounded("SELECT * FROM index_returns", ["close", "return_pct"], BENCH),
    "b5_index_returns": rounded("SELECT * FROM indices", ["ibov_return", "divo11_return"], BENCH),
    "b5_index_returns_long": rounded("""
        SELECT p._reference_period, s.symbol,
               coalesce(last_value(r.return_pct IGNORE NULLS) OVER (
                 PARTITION BY s.symbol ORDER BY p._reference_period
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS return_pct
        FROM periods p
        CROSS JOIN (VALUES ('^BVSP'), ('DIVO11.SA'), ('DIVO11.PRE'), ('3-MEDIUM'), ('4-NOT SPECIFIED'),
                           ('5-LOW'), ('NONE')) AS s(symbol)
        LEFT JOIN index_returns r ON r.symbol = s.symbol AND r._reference_period = p._reference_period""",
                                     ["return_pct"], BENCH),
    "b7_performance": rounded("SELECT * FROM performance", [
        "pct_return", "cdi_cumulative", "ibov_return", "divo11_return"], BENCH),
})


# ------------------------------------------------------------------ report --
_LABELS = (("01", "Jan"), ("02", "Fev"), ("03", "Mar"), ("04", "Abr"), ("05", "Mai"),
           ("06", "Jun"), ("07", "Jul"), ("08", "Ago"), ("09", "Set"), ("10", "Out"),
           ("11", "Nov"), ("12", "Dez"))


def label_sql(p: str) -> str:
    parts = f"string_split({p}, '-')"
    cases = " ".join(f"WHEN '{m}' THEN '{lab}'" for m, lab in _LABELS)
    return (f"(CASE WHEN len({parts}) = 2 THEN coalesce(CASE {parts}[2] {cases} END, {parts}[2])"
            f" || '/' || substr({parts}[1], 3) ELSE {p} END)")


def latest(table: str) -> str:
    return (f"(SELECT * FROM {table} WHERE _reference_period = "
            f"(SELECT max(_reference_period) FROM {table}))")


def totalled(detail_sql: str, body_cols: list[str], sum_cols: list[str]) -> str:
    """detail rows + a total row summing ``sum_cols`` (other columns NULL)."""
    total_cols = ", ".join(f"sum({c}) AS {c}" if c in sum_cols else f"NULL AS {c}"
                           for c in body_cols)
    cols = ", ".join(body_cols)
    return (f"SELECT {cols}, false AS is_total FROM ({detail_sql}) AS d "
            f"UNION ALL SELECT {total_cols}, true AS is_total FROM ({detail_sql}) AS d "
            f"HAVING count(*) > 0")


_ASSET_LABEL = "CASE WHEN asset_type = 'etf' THEN 'ETF' ELSE 'Ação' END"

REPORT = {
    "r1_latest_kpis": rounded(
        f"SELECT _reference_period, total_portfolio_value, total_invested, absolute_gain_loss, "
        f"pct_return / 100 AS pct_return FROM {latest('fct_monthly_wallet')} AS l",
        ["total_portfolio_value", "total_invested", "absolute_gain_loss", "pct_return"]),
    "r2_allocation": rounded(
        "SELECT _reference_period, asset_class, value, "
        "CASE WHEN t > 0 THEN value / t ELSE 0 END AS share FROM ("
        "SELECT _reference_period, 'Ações & ETFs' AS asset_class, equity_value AS value, "
        "equity_value + treasury_value + fixed_income_value AS t FROM l "
        "UNION ALL SELECT _reference_period, 'Tesouro Direto', treasury_value, "
        "equity_value + treasury_value + fixed_income_value FROM l "
        "UNION ALL SELECT _reference_period, 'Renda Fixa', fixed_income_value, "
        "equity_value + treasury_value + fixed_income_value FROM l) AS s",
        ["value", "share"], f"l AS {latest('fct_monthly_wallet')}"),
    "r4_wallet_evolution": rounded(
        f"SELECT _reference_period, {label_sql('_reference_period')} AS period_label, "
        "total_portfolio_value, equity_value, treasury_value, fixed_income_value, total_invested, "
        "absolute_gain_loss, pct_return / 100 AS pct_return FROM fct_monthly_wallet",
        ["total_portfolio_value", "equity_value", "treasury_value", "fixed_income_value",
         "total_invested", "absolute_gain_loss", "pct_return"]),
    "r5_equity_detail": rounded(
        totalled(f"SELECT ticker, {_ASSET_LABEL} AS asset_type, total_quantity, "
                 "mean_purchase_price, current_closing_price, total_invested, total_current_value, "
                 "unrealized_gain_loss, pct_price_change / 100 AS pct_price_change "
                 f"FROM {latest('fct_stock_detail')} AS l",
                 ["ticker", "asset_type", "total_quantity", "mean_purchase_price",
                  "current_closing_price", "total_invested", "total_current_value",
                  "unrealized_gain_loss", "pct_price_change"],
                 ["total_quantity", "total_invested", "total_current_value",
                  "unrealized_gain_loss"]),
        ["mean_purchase_price", "current_closing_price", "total_invested", "total_current_value",
         "unrealized_gain_loss", "pct_price_change"]).replace(
             "sum(total_quantity) AS total_quantity",
             "CAST(sum(total_quantity) AS BIGINT) AS total_quantity"),
    "r6_dividends_by_type": rounded(
        "SELECT event_type, coalesce(sum(total_income), 0) AS total, "
        "CAST(sum(num_payments) AS BIGINT) AS payments, false AS is_total "
        "FROM fct_dividend_summary WHERE event_type IS NOT NULL GROUP BY event_type "
        "UNION ALL SELECT NULL, coalesce(sum(total_income), 0), "
        "CAST(sum(num_payments) AS BIGINT), true FROM fct_dividend_summary HAVING count(*) > 0",
        ["total"]),
    "r7_dividends_by_ticker": rounded(
        "SELECT ticker, coalesce(sum(total_income), 0) AS total, "
        "CAST(sum(num_payments) AS BIGINT) AS payments "
        "FROM fct_dividend_summary WHERE ticker IS NOT NULL GROUP BY ticker", ["total"]),
    "r8_dividend_detail": rounded(
        f"SELECT ticker, _reference_period, {label_sql('_reference_period')} AS period_label, "
        "event_type, total_income, total_shares, num_payments FROM fct_dividend_summary",
        ["total_income", "total_shares"]),
    "r9_trades_listing": rounded(
        totalled("SELECT ticker, _reference_period, "
                 f"{label_sql('_reference_period')} AS period_label, institution, "
                 "CASE WHEN buy_quantity > 0 THEN buy_quantity END AS buy_quantity, "
                 "CASE WHEN avg_buy_price > 0 THEN avg_buy_price END AS avg_buy_price, "
                 "CASE WHEN buy_quantity * avg_buy_price > 0 THEN buy_quantity * avg_buy_price END "
                 "AS total_buy_cost, "
                 "CASE WHEN sell_quantity > 0 THEN sell_quantity END AS sell_quantity, "
                 "CASE WHEN avg_sell_price > 0 THEN avg_sell_price END AS avg_sell_price, "
                 "CASE WHEN sell_quantity * avg_sell_price > 0 THEN sell_quantity * avg_sell_price "
                 "END AS total_sell_value FROM stg_trades",
                 ["ticker", "_reference_period", "period_label", "institution", "buy_quantity",
                  "avg_buy_price", "total_buy_cost", "sell_quantity", "avg_sell_price",
                  "total_sell_value"],
                 ["buy_quantity", "total_buy_cost", "sell_quantity", "total_sell_value"]),
        ["buy_quantity", "avg_buy_price", "total_buy_cost", "sell_quantity", "avg_sell_price",
         "total_sell_value"]),
    "r10_trade_volume": rounded(
        "SELECT _reference_period, coalesce(sum(buy_quantity * avg_buy_price), 0) AS total_compras, "
        "coalesce(sum(sell_quantity * avg_sell_price), 0) AS total_vendas FROM stg_trades "
        "WHERE _reference_period IS NOT NULL GROUP BY _reference_period",
        ["total_compras", "total_vendas"]),
    "r11_treasury_latest": rounded(
        totalled(f"SELECT * FROM {latest('fct_treasury_summary')} AS l",
                 ["product_name", "index_type", "maturity_date", "_reference_period",
                  "total_quantity", "total_invested", "total_gross", "total_net",
                  "total_current_value", "gain_loss"],
                 ["total_invested", "total_gross", "total_net", "total_current_value",
                  "gain_loss"]),
        ["total_quantity", "total_invested", "total_gross", "total_net", "total_current_value",
         "gain_loss"]),
    "r12_treasury_evolution": rounded(
        "SELECT _reference_period, coalesce(sum(total_invested), 0) AS investido, "
        "coalesce(sum(total_current_value), 0) AS atual FROM fct_treasury_summary "
        "WHERE _reference_period IS NOT NULL GROUP BY _reference_period", ["investido", "atual"]),
    "r13_fixed_income_latest": rounded(
        totalled(f"SELECT * FROM {latest('fct_fixed_income_summary')} AS l",
                 ["product_name", "issuer", "code", "index_type", "regime_type", "issue_date",
                  "maturity_date", "_reference_period", "total_quantity", "total_curva_value"],
                 ["total_curva_value"]),
        ["total_quantity", "total_curva_value"]),
    "r14_tax_assets": rounded(
        totalled(f"SELECT ticker, {_ASSET_LABEL} AS asset_type, total_quantity, "
                 f"mean_purchase_price, total_invested FROM {latest('fct_stock_detail')} AS l",
                 ["ticker", "asset_type", "total_quantity", "mean_purchase_price",
                  "total_invested"], ["total_invested"]),
        ["mean_purchase_price", "total_invested"]),
    "r15_tax_exempt": rounded(
        totalled("SELECT ticker, coalesce(sum(total_income), 0) AS total_income "
                 "FROM fct_dividend_summary WHERE regexp_matches(event_type, 'Dividendo', 'i') "
                 "AND ticker IS NOT NULL GROUP BY ticker",
                 ["ticker", "total_income"], ["total_income"]), ["total_income"]),
    "r16_tax_taxable": rounded(
        totalled("SELECT ticker, coalesce(sum(total_income), 0) AS total_income "
                 "FROM fct_dividend_summary WHERE regexp_matches(event_type, 'JCP|Juros', 'i') "
                 "AND ticker IS NOT NULL GROUP BY ticker",
                 ["ticker", "total_income"], ["total_income"]), ["total_income"]),
    "r17_monthly_sales_flag": rounded(
        "SELECT _reference_period, s AS total_sell_value, "
        "CASE WHEN s > 5000000.0 THEN 'SIM' ELSE 'NÃO' END AS above_threshold FROM ("
        "SELECT _reference_period, coalesce(sum(sell_quantity * avg_sell_price), 0) AS s "
        "FROM stg_trades WHERE sell_quantity > 0 AND _reference_period IS NOT NULL "
        "GROUP BY _reference_period) AS m", ["total_sell_value"]),
    "r18_periods": rounded("SELECT DISTINCT _reference_period FROM fct_monthly_wallet "
                           "WHERE _reference_period IS NOT NULL", []),
}
ORACLE.update(REPORT)


# --------------------------------------------------------------- ingestion --
_MONTH_WORDS = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto",
                "setembro", "outubro", "novembro", "dezembro")
_MONTH_KEYS = (("janeiro", "01"), ("fevereiro", "02"), ("marco", "03"), ("abril", "04"),
               ("maio", "05"), ("junho", "06"), ("julho", "07"), ("agosto", "08"),
               ("setembro", "09"), ("outubro", "10"), ("novembro", "11"), ("dezembro", "12"))
_NAME_RE = r"(\p{Nd}{4})-([\p{L}\p{N}_]+)\.xlsx$"


def _period_from_name_sql(n: str) -> str:
    word = f"regexp_extract({n}, '{_NAME_RE}', 2)"
    cases = " ".join(f"WHEN '{w}' THEN '{m}'" for w, m in _MONTH_KEYS)
    return (f"CASE WHEN regexp_matches({n}, '{_NAME_RE}') THEN "
            f"regexp_extract({n}, '{_NAME_RE}', 1) || '-' || (CASE {word} {cases} ELSE '00' END) "
            f"ELSE {n} END")


_WORD_LIST = "[" + ", ".join(f"'{w}'" for w in _MONTH_WORDS) + "]"

# a number as the statement loader's parser accepts it (decimal comma first)
_T = "replace(value, ',', '.')"
_NUMBER_SQL = (f"CASE WHEN regexp_matches({_T}, "
               r"'^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$') "
               f"AND (isfinite(TRY_CAST({_T} AS DOUBLE)) OR regexp_matches({_T}, '(?i)inf')) "
               f"THEN TRY_CAST({_T} AS DOUBLE) END")

INGEST = {
    "i2_period_from_name": (
        "SELECT file_name, " + _period_from_name_sql("file_name") + " AS _reference_period FROM ("
        "SELECT DISTINCT CASE WHEN o_orderstatus = 'P' "
        "THEN 'extrato-' || CAST(year(o_orderdate) AS VARCHAR) || '.xlsx' "
        "ELSE 'relatorio-consolidado-mensal-' || CAST(year(o_orderdate) AS VARCHAR) || '-' || "
        "(CASE WHEN o_orderstatus = 'O' THEN upper(left(w, 1)) || substr(w, 2) ELSE w END) "
        "|| '.xlsx' END AS file_name "
        f"FROM (SELECT *, {_WORD_LIST}[month(o_orderdate)] AS w FROM orders) AS o) AS n"),
    "i8_column_coercion": (
        "SELECT source_file, sheet_name, column_name, count(value) AS n_values, "
        f"count({_NUMBER_SQL}) AS n_numeric, "
        f"CASE WHEN count(value) > 0 AND count({_NUMBER_SQL}) "
        "= count(value) THEN 'numeric' ELSE 'text' END AS decision FROM ("
        "SELECT 'orders-' || strftime(o_orderdate, '%Y-%m') AS source_file, "
        "o_orderpriority AS sheet_name, c.column_name, c.value FROM orders, "
        "LATERAL (VALUES ('Valor', replace(CAST(o_totalprice AS VARCHAR), '.', ',')), "
        "('Cliente', CASE WHEN o_orderstatus = 'P' THEN '-' ELSE CAST(o_custkey AS VARCHAR) END), "
        "('Status', o_orderstatus)) AS c(column_name, value)) AS cells "
        "GROUP BY source_file, sheet_name, column_name"),
    "i9_sparse_rows": (
        "SELECT l_orderkey, l_linenumber, filled_cells FROM ("
        "SELECT l_orderkey, l_linenumber, "
        "CAST((CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END) + "
        "(CASE WHEN l_linestatus <> 'O' THEN 1 ELSE 0 END) + "
        "(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) + "
        "(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END) AS INTEGER) AS filled_cells "
        "FROM lineitem) AS r WHERE filled_cells >= 2"),
    "i10_header_sanitise": (
        f"SELECT doc_id, lang, translate(text, '{LETTERS}', '{REPLACED_BY}') "
        "AS header FROM documents"),
}
ORACLE.update(INGEST)
ORACLE["i14_load_summary"] = with_base(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in ("raw_stock_positions", "raw_etf_positions", "raw_fixed_income",
              "raw_treasury_bonds", "raw_dividends", "raw_trades", "raw_stock_lending")))

# what the checks find in rows that break them
ORACLE["q12_failing_generic"] = """
    WITH lots AS (SELECT l_orderkey AS ticker, l_linestatus AS period, l_returnflag AS kind,
                         CASE WHEN l_tax > 0.01 THEN l_quantity END AS quantity, l_discount AS discount
                  FROM lineitem)
    SELECT 'not_null' AS check_name, 'lots' AS table_name, 'quantity' AS column_name,
           count(*) - count(quantity) AS failures FROM lots
    UNION ALL SELECT 'unique', 'lots', 'ticker', count(*) FROM
      (SELECT ticker FROM lots GROUP BY ticker HAVING count(*) >= 2)
    UNION ALL SELECT 'unique_combination_of_columns', 'lots', 'ticker,_reference_period', count(*) FROM
      (SELECT ticker FROM lots GROUP BY ticker, period HAVING count(*) >= 2)
    UNION ALL SELECT 'accepted_values', 'lots', 'asset_type', count(DISTINCT kind) FROM lots
      WHERE kind <> 'R' AND kind <> 'A'
    UNION ALL SELECT 'accepted_range', 'lots', 'quantity', count(*) FROM lots WHERE quantity <= 25
    UNION ALL SELECT 'accepted_range', 'lots', 'discount', count(*) FROM lots WHERE discount < 0.05"""
ORACLE["q13_failing_singular"] = """
    WITH months AS (SELECT count(*) AS n FROM orders
                    WHERE o_orderstatus = 'P' AND o_orderpriority NOT SIMILAR TO '[0-9]{4}-[0-9]{2}')
    SELECT 'no_f_suffix_in_trades' AS check_name, 'stg_trades' AS table_name, 'ticker' AS column_name,
           count(*) AS failures FROM lineitem WHERE l_linestatus = 'F'
    UNION ALL SELECT 'no_negative_quantities', 'int_all_equity_positions', 'total_quantity', count(*)
      FROM lineitem WHERE l_quantity < 10
    UNION ALL SELECT 'portfolio_value_positive', 'fct_monthly_wallet', 'total_portfolio_value', count(*)
      FROM orders WHERE o_totalprice < 100000
    UNION ALL SELECT 'reference_period_format', t, '_reference_period', n
      FROM months, (VALUES ('fct_monthly_wallet'), ('fct_stock_detail'), ('fct_dividend_summary')) AS m(t)
    UNION ALL SELECT 'weighted_avg_price_consistent', 'int_weighted_avg_price', 'weighted_avg_price',
      count(*) FROM lineitem WHERE l_quantity > 0 AND l_returnflag = 'R'"""

# sheet rows built from line items (decimal comma, dash, sparse rows)
LANDED_LOTS = f"""
lots AS (
  SELECT 'T' || l_partkey AS code, l_linenumber = 7 AS sparse, l_linestatus = 'F' AS dashed,
         CASE WHEN l_returnflag <> 'N' THEN lpad(CAST(l_suppkey AS VARCHAR), 8, '0') END AS account,
         l_quantity, round(l_extendedprice, 2) AS price, l_returnflag,
         'posicao-' || year(l_shipdate) || '-' || {_WORD_LIST}[month(l_shipdate)] || '.xlsx' AS file,
         year(l_shipdate) || '-' || CASE WHEN month(l_shipdate) = 3 THEN '00'
                                         ELSE lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') END AS period
  FROM lineitem
)"""
ORACLE["i5_conform_raw"] = f"""
    WITH {LANDED_LOTS.strip()}
    SELECT code AS Codigo_de_Negociacao, account AS Conta, CAST(NULL AS VARCHAR) AS Produto,
           CAST(l_quantity AS DOUBLE) AS Quantidade, CASE WHEN NOT dashed THEN price END AS Preco_de_Fechamento,
           file AS _source_file, period AS _reference_period, l_returnflag AS extra_setor,
           CASE WHEN dashed THEN '-' END AS rejected_price
    FROM lots WHERE NOT sparse"""
ORACLE["i8_landing_checks"] = f"""
    WITH {LANDED_LOTS.strip()}
    SELECT 'text_does_not_parse' AS check_name, 'raw_stock_positions' AS table_name,
           'Preco_de_Fechamento' AS column_name, count(*) AS failures
    FROM lots WHERE NOT sparse AND dashed HAVING count(*) > 0"""
ORACLE["i13_absent_kinds"] = """
    SELECT t AS table_name, CASE WHEN t = 'raw_stock_positions' THEN
             (SELECT count(*) FROM lineitem WHERE l_linenumber <> 7) ELSE 0 END AS row_count, c AS columns
    FROM (VALUES ('raw_stock_positions', 13), ('raw_etf_positions', 13), ('raw_fixed_income', 15),
                 ('raw_treasury_bonds', 14), ('raw_dividends', 11), ('raw_trades', 13),
                 ('raw_stock_lending', 14)) AS kinds(t, c)"""
ORACLE["t14_ordered_mart"] = with_base("""
    SELECT _reference_period, product_name, index_type, maturity_date, CAST(row_number() OVER (
             PARTITION BY _reference_period ORDER BY product_name, index_type, maturity_date) AS INTEGER)
             AS place FROM fct_treasury_summary""")
ORACLE["b6_absent_series"] = rounded(
    "SELECT _reference_period, pct_return, 0::DOUBLE AS cdi_cumulative, 0::DOUBLE AS ibov_return, "
    "0::DOUBLE AS divo11_return FROM fct_monthly_wallet", ["pct_return"])
ORACLE["r19_empty_section"] = with_base("""
    SELECT section, CASE WHEN section = 'tax_taxable_income' THEN
             (SELECT count(DISTINCT ticker) + least(count(*), 1) FROM fct_dividend_summary
              WHERE event_type ILIKE '%JCP%' OR event_type ILIKE '%Juros%') ELSE 0 END AS row_count
    FROM (VALUES ('tax_exempt_income'), ('latest_treasury'), ('latest_kpis'), ('trades_listing'),
                 ('tax_taxable_income')) AS s(section)""")
ORACLE["i4_landed_by_header"] = """
    SELECT 'T' || l_partkey AS Codigo_de_Negociacao, CAST(l_quantity AS DOUBLE) AS Quantidade,
           CAST(round(l_extendedprice, 2) AS DOUBLE) AS Preco_de_Fechamento,
           CASE WHEN l_linenumber % 2 = 0 THEN 'a-2024-junho.csv' ELSE 'b-2024-agosto.csv' END AS _source_file,
           CASE WHEN l_linenumber % 2 = 0 THEN '2024-06' ELSE '2024-08' END AS _reference_period,
           CASE WHEN l_linenumber % 2 = 1 THEN l_returnflag END AS extra_setor,
           CAST(l_linenumber % 2 AS INTEGER) AS n_extra, 0 AS n_rejected
    FROM lineitem"""
ORACLE["i11_missing_key"] = f"""
    WITH {LANDED_LOTS.strip()}
    SELECT file AS source_file, 'raw_stock_positions' AS table_name, 'Codigo_de_Negociacao' AS column_name,
           count(*) AS rows
    FROM lots WHERE NOT sparse AND file LIKE 'posicao-1995-%' GROUP BY file"""
ORACLE["i11_column_manifest"] = f"""
    WITH {LANDED_LOTS.strip()},
    cells AS (
      SELECT file, 'Codigo_de_Negociacao' AS c, count(*) AS n FROM lots GROUP BY file
      UNION ALL SELECT file, 'Conta', count(account) FROM lots WHERE NOT sparse GROUP BY file
      UNION ALL SELECT file, 'Quantidade', count(*) FROM lots WHERE NOT sparse GROUP BY file
      UNION ALL SELECT file, 'Preco_de_Fechamento', count(*) FROM lots WHERE NOT sparse GROUP BY file
      UNION ALL SELECT file, 'Setor', count(*) FROM lots WHERE NOT sparse GROUP BY file)
    SELECT file AS source_file, c AS column_name, n AS n_values FROM cells WHERE n > 0"""

# maintained by landing, the models are those of all right rows
ORACLE["t15_maintained_wallet"] = ORACLE["t9_monthly_wallet"]
ORACLE["t15_maintained_detail"] = ORACLE["t10_stock_detail"]
