"""Models maintained by landing equal a recomputation from all rows."""

import os
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fixtures import raw_set
from ledgerframe.operators import staging as S
from ledgerframe.plans import maintained as MT
from ledgerframe.plans import statement_run
from ledgerframe.plans.marts import build_marts
from ledgerframe.sinks import read_table
from ledgerframe.sources import workbook as WB
from ledgerframe.sources.incremental import land_changes
from xlsx_writer import write_xlsx

MODELS = ("weighted_avg_price", "equity_positions", "monthly_value", "monthly_wallet", "stock_detail",
          "dividend_summary", "treasury_summary", "fixed_income_summary")
POSITIONS = ["Código de Negociação", "Quantidade", "Preço de Fechamento", "Valor Atualizado"]
TRADES = ["Código de Negociação", "Quantidade (Compra)", "Quantidade (Venda)", "Preço Médio (Compra)",
          "Preço Médio (Venda)"]
TREASURY = ["Produto", "Indexador", "Vencimento", "Quantidade", "Valor Aplicado", "Valor bruto", "Valor líquido",
            "Valor Atualizado"]
FIXED = ["Produto", "Emissor", "Código", "Vencimento", "Quantidade", "Valor Atualizado CURVA"]
INCOME = ["Produto", "Tipo de Evento", "Quantidade", "Valor líquido"]


def statement(folder, name, positions=(), etfs=(), trades=(), treasury=(), fixed=(), income=()):
    sheets = {"Posição - Ações": [POSITIONS, *positions], "Posição - ETF": [POSITIONS, *etfs],
              "Negociações": [TRADES, *trades], "Posição - Tesouro Direto": [TREASURY, *treasury],
              "Posição - Renda Fixa": [FIXED, *fixed], "Proventos Recebidos": [INCOME, *income]}
    os.makedirs(folder, exist_ok=True)
    return write_xlsx(os.path.join(folder, name), {n: rows for n, rows in sheets.items() if len(rows) > 1})


def june(folder, shares=10):
    return statement(
        folder, "a-2024-junho.xlsx", positions=[["PETR4", shares, 30.0, 30.0 * shares], ["VALE3", 5, 60.0, 300.0]],
        etfs=[["BOVA11", 2, 100.0, 200.0]],
        trades=[["PETR4F", shares, 0, 20.0, 0], ["PETR4", 0, 1, 0, 31.0], ["VALE3", 5, 0, 50.0, 0]],
        treasury=[["Selic", "SELIC", "01/03/2029", 1.5, 100.0, 110.0, 108.0, 110.0]],
        fixed=[["CDB", "E", "C", "Liquidez diária", 1, 100.0], ["CDB", "E", "C", "A definir", 1, 200.0]],
        income=[["PETR4 - PETROBRAS", "Dividendo", 10, 7.5], ["PETR4 - PETROBRAS", "Dividendo", 10, 2.5]])


def july(folder, name="b-2024-julho.xlsx"):
    return statement(
        folder, name, positions=[["PETR4", 30, 33.0, 990.0]], trades=[["PETR4", 20, 0, 35.0, 0]],
        treasury=[["Selic", "SELIC", "01/03/2029", 1.5, 100.0, 112.0, 109.0, 112.0]],
        income=[["PETR4 - PETROBRAS", "JCP", 30, 3.0], ["VALE3 - VALE", None, 5, None]])


def rows(*tables):
    """All rows of the tables, in one job."""
    def text(df, number):
        columns = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
        return df.select(F.lit(number).alias("table"), F.to_json(F.struct(*columns)).alias("row"))
    return sorted(map(tuple, reduce(DataFrame.union, [text(df, i) for i, df in enumerate(tables)]).collect()))


def compare(spark, src, root, keys=()):
    """Land what changed, and compare every model with those of a full landing."""
    files = WB.list_workbooks(spark, src, nested=bool(keys))
    land_changes(spark, files, root)
    got = build_marts(raw_set(spark), keys, MT.maintain(spark, root, keys))     # no raw row is read
    landed = spark.createDataFrame(WB.land_workbooks(files).collect(), WB.LANDED_SCHEMA)
    want = build_marts(WB.land_raw_tables(landed, keys), keys)
    one, two = ([getattr(m, model) for model in MODELS] for m in (got, want))
    assert [df.dtypes for df in one] == [df.dtypes for df in two]
    assert rows(*one) == rows(*two)
    return got


def sums_written(root, keys="all"):
    return {(p, b): os.stat(f"{root}/sums/{keys}/{p}/{b}").st_mtime_ns
            for p in os.listdir(f"{root}/sums/{keys}") for b in os.listdir(f"{root}/sums/{keys}/{p}")}


def test_landings_equal_a_recomputation(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "state")
    june(src)
    marts = compare(spark, src, root)
    assert {r.ticker: r.weighted_avg_price for r in marts.weighted_avg_price.collect()} == {"PETR4": 20.0, "VALE3": 50.0}
    before = sums_written(root)
    later = july(src)
    marts = compare(spark, src, root)
    assert {r.ticker: r.weighted_avg_price for r in marts.weighted_avg_price.collect()} == {"PETR4": 30.0, "VALE3": 50.0}
    after = sums_written(root)
    assert before.items() <= after.items()                       # the sums of the first landing are left alone
    assert set(after) - set(before) == {(p, "1") for p in MT.PARTS}
    new = spark.read.parquet(f"{root}/sums/all/holdings/1")      # and the second adds its own rows up only
    assert {(r._source_file, r.ticker, r.batch) for r in new.collect()} == {("b-2024-julho.xlsx", "PETR4", 1)}
    june(src, shares=99)                                         # a month is sent again, one is gone
    os.remove(later)
    assert {r._reference_period for r in compare(spark, src, root).monthly_wallet.collect()} == {"2024-06"}


def test_missing_sums_are_made_again(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "state")
    june(src)
    land_changes(spark, WB.list_workbooks(spark, src), root)     # a run that ended before its sums
    july(src)
    compare(spark, src, root)
    os.rename(f"{root}/sums/all/payments/0", f"{root}/sums/all/payments/0.new-0")      # or between them
    compare(spark, src, root)


def test_kinds_that_no_file_holds(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "state")
    statement(src, "a-2024-junho.xlsx", trades=[["PETR4", 1, 0, 2.0, 0]])
    marts = compare(spark, src, root)
    assert marts.monthly_wallet.count() == 0 and marts.weighted_avg_price.count() == 1


def test_sums_by_owner(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "state")
    june(f"{src}/owner=ana"), june(f"{src}/owner=bob", shares=3)
    land_changes(spark, WB.list_workbooks(spark, src, nested=True), root)
    july(f"{src}/owner=bob")
    marts = compare(spark, src, root, ["owner"])
    assert {(r.owner, r._reference_period) for r in marts.monthly_wallet.collect()} == {
        ("ana", "2024-06"), ("bob", "2024-06"), ("bob", "2024-07")}


def test_null_groups_and_null_measures(spark):
    raw = raw_set(spark, raw_dividends=[
        {"Produto": "A - x", "Valor_liquido": None, "_reference_period": None, "_source_file": f}
        for f in ("one", "one", "two")])
    staged = S.stage_all(raw)
    whole = build_marts(raw).dividend_summary
    assert rows(build_marts(raw, sums=MT.sums_by_file(staged)).dividend_summary) == rows(whole)
    assert [(r.total_income, r.num_payments) for r in whole.collect()] == [(None, 3)]


def test_an_incremental_run_equals_a_recomputation(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    june(src)
    land_changes(spark, WB.list_workbooks(spark, src), f"{out}/landing")
    july(src)
    statement_run.run_workbooks(spark, src, out, incremental=True, gate=False)
    want = build_marts(WB.land_raw_tables(WB.land_workbooks(WB.list_workbooks(spark, src)))).mart_tables()
    for mart in ("fct_monthly_wallet", "fct_stock_detail", "fct_fixed_income_summary"):
        assert rows(read_table(spark, f"{out}/marts", mart)) == rows(want[mart]) != [], mart
