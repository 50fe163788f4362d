"""End-to-end run on generated workbooks, and incremental landing."""

import os

import pytest

from pyspark.sql import functions as F

from ledgerframe.operators.quality import QualityGateError
from ledgerframe.plans import statement_run
from ledgerframe.sinks import read_table
from ledgerframe.sources import workbook as WB
from ledgerframe.sources.incremental import land_changes
from test_workbook_landing import _june, _march, _plain
from xlsx_writer import write_xlsx


def test_full_run_writes_marts_and_report(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _june(src), _march(src), _plain(src)
    out = os.path.join(tmp_dir, "out")
    res = statement_run.run_workbooks(spark, src, out, gate=False, csv_report=True)
    wallet = read_table(spark, f"{out}/marts", "fct_monthly_wallet")
    assert {r._reference_period for r in wallet.collect()} == {"2024-06", "2024-00", "extrato.xlsx"}
    kpis = spark.read.parquet(res.report["latest_kpis"]).collect()
    assert len(kpis) == 1
    perf = spark.read.parquet(res.report["performance_vs_benchmarks"]).collect()
    assert len(perf) == 3 and {r.cdi_cumulative for r in perf} == {0.0}   # no series: zeros
    # partition pruning: the mart is stored by period
    assert os.path.isdir(f"{out}/marts/fct_stock_detail/_reference_period=2024-06")
    assert os.path.isdir(f"{out}/report/latest_kpis_csv")
    rejects = spark.read.parquet(f"{out}/rejects").collect()
    assert sorted((r.table_name, r.column_name, r.text) for r in rejects) == [
        ("raw_stock_positions", "Valor_Atualizado", "-"), ("raw_stock_positions", "Valor_Atualizado", "1.234,56")]
    with pytest.raises(QualityGateError, match="text_does_not_parse raw_stock_positions.Valor_Atualizado: 2"):
        statement_run.run_workbooks(spark, src, os.path.join(tmp_dir, "gated"))
    assert not os.path.exists(os.path.join(tmp_dir, "gated", "marts"))
    failing = {r.check_name for r in res.checks.filter(F.col("failures") > 0).collect()}
    assert "reference_period_format" in failing          # "extrato.xlsx" is not YYYY-MM


FIXED = ["Produto", "Instituição", "Emissor", "Código", "Vencimento", "Valor Atualizado CURVA"]


def test_lost_values_stop_the_run_and_stay_visible_without_the_gate(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    write_xlsx(os.path.join(src, "rel-2024-junho.xlsx"), {"Posição - Renda Fixa": [
        FIXED, ["CDB", "XP", "E", "C", "Liquidez diária", "100,00"], ["CDB", "XP", "E", "C", "A definir", 200.0],
        ["LCI", "XP", "E", "C", "01/06/2030", "1.234,56"]]})
    with pytest.raises(QualityGateError, match="Valor_Atualizado_CURVA: 1"):
        statement_run.run_workbooks(spark, src, out)
    statement_run.run_workbooks(spark, src, out, gate=False)
    rows = read_table(spark, f"{out}/marts", "fct_fixed_income_summary").collect()
    assert sorted((r.product_name, r.total_curva_value) for r in rows if r.maturity_date is None) \
        == [("CDB", 100.0), ("CDB", 200.0)]
    raw = read_table(spark, f"{out}/raw", "raw_fixed_income").collect()
    assert {k: v for r in raw for k, v in r._rejected.items() if k != "Vencimento"} \
        == {"Valor_Atualizado_CURVA": "1.234,56"}
    checks = {r.check_name for r in spark.read.parquet(f"{out}/checks").collect() if r.failures}
    assert "text_does_not_parse" in checks


def test_a_bad_intermediate_leaves_the_marts_alone(spark, tmp_dir):
    from fixtures import pos, raw_set, trade

    good = raw_set(spark, raw_stock_positions=[pos("A", 1, 1.0, 1.0, "2024-01")],
                   raw_trades=[trade("A", 1.0, 1.0, 0.0, 0.0, "2024-01")])
    bad = {**good, "raw_stock_positions": raw_set(
        spark, raw_stock_positions=[pos("A", -5, 1.0, 1.0, "2024-02")])["raw_stock_positions"]}
    out = os.path.join(tmp_dir, "out")
    statement_run.run(spark, good, out)
    with pytest.raises(QualityGateError, match="no_negative_quantities"):
        statement_run.run(spark, bad, out)
    assert {r._reference_period for r in read_table(spark, f"{out}/marts", "fct_stock_detail").collect()} \
        == {"2024-01"}


def _positions(folder, name, *rows):
    os.makedirs(folder, exist_ok=True)
    return write_xlsx(os.path.join(folder, name), {"Posição - Ações": [
        ["Código de Negociação", "Quantidade", "Preço de Fechamento", "Valor Atualizado"], *rows]})


def test_incremental_landing_equals_a_full_reload(spark, tmp_dir):
    src, state = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "state")

    def same():
        files = WB.list_workbooks(spark, src)
        got = land_changes(spark, files, state)
        key = lambda df: sorted(map(str, df.select("source_file", "table_name", "row_index",
                                                   "cells").collect()))
        assert key(got) == key(WB.land_workbooks(files))
        return got

    june = _positions(src, "a-2024-junho.xlsx", ["PETR4", 1, 1, 1], ["VALE3", 2, 1, 2])
    same()
    old = _positions(src, "b-2024-julho.xlsx", ["WEGE3", 3, 1, 3])
    os.utime(old, (1_000_000_000, 1_000_000_000))                 # far older than the newest file
    assert same().count() == 3
    _positions(src, "a-2024-junho.xlsx", ["PETR4", 99, 1, 99])      # sent again, a row less
    assert same().count() == 2
    write_xlsx(june, {"Proventos Recebidos": [["Produto"], ["X"]]})  # a sheet is gone
    same()
    os.remove(old)
    same()
    same()                                                       # nothing new: nothing decoded
    assert not [d for d in os.listdir(f"{state}/rows/batch=5") if d.startswith("table_name=")]


def test_two_owners_from_folders_equal_two_single_runs(spark, tmp_dir, capsys):
    from ledgerframe.__main__ import main

    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    for owner, q in (("ana", 10), ("bob", 3)):
        _positions(f"{src}/owner={owner}", "rel-2024-junho.xlsx", ["PETR4", q, 2, 2 * q])
    assert main(["run", "--workbooks", src, "--out", out, "--keys", "owner"]) == 0
    both = read_table(spark, f"{out}/marts", "fct_stock_detail")
    assert {r._source_file for r in read_table(spark, f"{out}/raw", "raw_stock_positions").collect()} \
        == {"owner=ana/rel-2024-junho.xlsx", "owner=bob/rel-2024-junho.xlsx"}
    for owner in ("ana", "bob"):
        one = os.path.join(tmp_dir, f"one-{owner}")
        statement_run.run_workbooks(spark, f"{src}/owner={owner}", one)
        want = read_table(spark, f"{one}/marts", "fct_stock_detail")
        got = both.filter(F.col("owner") == owner).select(*want.columns)
        assert list(map(str, got.collect())) == list(map(str, want.collect()))


def test_full_run_with_owner_keys(spark, tmp_dir):
    import datetime as dt

    from fixtures import pos, raw_set, trade
    a = raw_set(spark, raw_stock_positions=[pos("ITUB4", 10, 25.0, 250.0, "2024-01")],
                raw_trades=[trade("ITUB4", 10.0, 20.0, 0.0, 0.0, "2024-01")])
    b = raw_set(spark, raw_stock_positions=[pos("ITUB4", 1, 30.0, 30.0, "2024-02")],
                raw_trades=[trade("ITUB4", 1.0, 10.0, 0.0, 0.0, "2024-02")])
    raw = {t: a[t].withColumn("owner", F.lit("A")).unionByName(b[t].withColumn("owner", F.lit("B")))
           for t in a}
    prices = spark.createDataFrame([("^BVSP", dt.date(2024, 1, 5), 100.0),
                                    ("^BVSP", dt.date(2024, 2, 5), 110.0)],
                                   "symbol string, date date, close double")
    out = os.path.join(tmp_dir, "keyed")
    res = statement_run.run(spark, raw, out, keys=["owner"], gate=False, prices=prices)
    wallet = {r.owner: r for r in read_table(spark, f"{out}/marts", "fct_monthly_wallet").collect()}
    assert wallet["A"].total_invested == 200.0 and wallet["B"].total_invested == 10.0
    perf = {(r.owner, r._reference_period): r.ibov_return
            for r in spark.read.parquet(res.report["performance_vs_benchmarks"]).collect()}
    assert perf == {("A", "2024-01"): 0.0, ("B", "2024-02"): 0.0}   # each owner's own base
    kpis = spark.read.parquet(res.report["latest_kpis"]).collect()
    assert {(r.owner, r._reference_period) for r in kpis} == {("A", "2024-01"), ("B", "2024-02")}


def test_command_line_run(spark, tmp_dir, capsys):
    import json

    from ledgerframe.__main__ import main
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _june(src)
    with open(os.path.join(tmp_dir, "cdi.json"), "w") as f:
        json.dump([{"data": "03/06/2024", "valor": "0.04"}], f)
    assert main(["run", "--workbooks", src, "--out", os.path.join(tmp_dir, "out"), "--no-gate",
                 "--rates", os.path.join(tmp_dir, "cdi.json")]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["raw_rows"]["raw_stock_positions"] == 2
    assert "performance_vs_benchmarks" in out["report"]


def test_partition_values_stay_text(spark, tmp_dir):
    from ledgerframe.sinks import write_table
    df = spark.createDataFrame([("a", "202406"), ("b", "2024-06")], "v string, _reference_period string")
    path = os.path.join(tmp_dir, "t")
    write_table(df, path)
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["_reference_period"] == "string"
    assert {r._reference_period for r in back.collect()} == {"202406", "2024-06"}


def test_nested_folders_keep_owner_and_incremental_equals_full(spark, tmp_dir):
    src, state = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "state")

    def land():
        files = WB.list_workbooks(spark, src, nested=True)
        got = land_changes(spark, files, state)
        key = lambda df: sorted(map(str, df.select("source_file", "row_index", "keys", "cells").collect()))
        assert key(got) == key(WB.land_workbooks(files))
        return WB.conform_raw(got, "raw_stock_positions", ["owner"]).collect()

    for owner in "ab":
        _positions(f"{src}/owner={owner}/2023", "x-2023-junho.xlsx", [f"T{owner}", 1, 1, 1])
    assert {(r.owner, r.Codigo_de_Negociacao, r._source_file) for r in land()} == {
        (o, f"T{o}", f"owner={o}/2023/x-2023-junho.xlsx") for o in "ab"}
    _positions(f"{src}/owner=a/2023", "x-2023-junho.xlsx", ["NEW", 5, 1, 5])     # one of them is sent again
    assert {(r.owner, r.Codigo_de_Negociacao) for r in land()} == {("a", "NEW"), ("b", "Tb")}


def test_a_workbook_without_its_key_column_stops_the_run(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _positions(src, "a-2024-junho.xlsx", ["PETR4", 1, 1, 1])
    write_xlsx(os.path.join(src, "b-2024-julho.xlsx"), {"Posição - Ações": [
        ["Ativo", "Quantidade", "Valor Atualizado"], ["VALE3", 1, 2], ["WEGE3", 2, 2]]})
    with pytest.raises(QualityGateError, match="missing_key_column raw_stock_positions.Codigo_de_Negociacao: 2"):
        statement_run.run_workbooks(spark, src, out)
    assert [(r.source_file, r.column_name, r.rows) for r in spark.read.parquet(f"{out}/missing_keys").collect()] \
        == [("b-2024-julho.xlsx", "Codigo_de_Negociacao", 2)]
    assert ("b-2024-julho.xlsx", "Ativo", 2) in {
        (r.source_file, r.column_name, r.n_values) for r in spark.read.parquet(f"{out}/columns").collect()}


def _csv(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_a_run_over_csv_tables_equals_one_over_workbooks(spark, tmp_dir):
    src, tables = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "tables")
    _positions(src, "a-2024-junho.xlsx", ["PETR4", 3, 2, 6], ["VALE3", 1, 5, 5])
    write_xlsx(os.path.join(src, "b-2024-julho.xlsx"), {"Posição - Ações": [
        ["Valor Atualizado", "Código de Negociação", "Preço de Fechamento", "Quantidade"], [8, "PETR4", 2, 4]]})
    _csv(f"{tables}/raw_stock_positions", "a-2024-junho.csv",
         "Código de Negociação,Quantidade,Preço de Fechamento,Valor Atualizado\nPETR4,3,2,6\nVALE3,1,5,5\n")
    _csv(f"{tables}/raw_stock_positions", "b-2024-julho.csv",
         "Valor Atualizado,Código de Negociação,Preço de Fechamento,Quantidade\n8,PETR4,2,4\n")
    outs = [os.path.join(tmp_dir, n) for n in ("x", "y")]
    statement_run.run_workbooks(spark, src, outs[0])
    statement_run.run_tables(spark, tables, outs[1])
    for mart in ("fct_stock_detail", "fct_monthly_wallet"):
        one, two = (sorted(map(str, read_table(spark, f"{o}/marts", mart).collect())) for o in outs)
        assert one == two and one
    _csv(f"{tables}/raw_trades", "t-2024-julho.csv", "Ativo,Quantidade (Compra)\nPETR4,3\n")
    with pytest.raises(QualityGateError, match="missing_key_column raw_trades"):
        statement_run.run_tables(spark, tables, outs[1])
    with pytest.raises(FileNotFoundError):
        statement_run.run_tables(spark, src, outs[1])


def test_a_run_killed_in_a_write_leaves_the_old_table(spark, tmp_dir):
    from ledgerframe.sinks import replace, write_table

    path = os.path.join(tmp_dir, "marts", "t")
    old = spark.createDataFrame([("a", "2024-01")], "v string, _reference_period string")
    new = spark.createDataFrame([("b", "2024-02")], old.schema)

    def values():
        return {r.v for r in read_table(spark, f"{tmp_dir}/marts", "t", old.schema).collect()}

    write_table(old, path)

    def stops(to):                                   # part of the new table is written, then the run ends
        new.write.parquet(to)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        replace(spark, path, stops)
    assert values() == {"a"} and len(os.listdir(f"{tmp_dir}/marts")) == 2
    os.rename(path, path + ".old")                   # it ends between the two renames
    assert values() == {"a"}
    os.rename(path, path + ".old")
    write_table(new, path)
    assert values() == {"b"} and os.listdir(f"{tmp_dir}/marts") == ["t"]
    write_table(spark.read.parquet(path).select("v", "_reference_period"), path)    # reads what it replaces
    assert values() == {"b"}


def test_a_bad_mart_is_never_published(spark, tmp_dir):
    from fixtures import pos, raw_set, trade

    good = raw_set(spark, raw_stock_positions=[pos("A", 1, 1.0, 1.0, "2024-01")],
                   raw_trades=[trade("A", 1.0, 1.0, 0.0, 0.0, "2024-01")])
    bad = raw_set(spark, raw_stock_positions=[pos("A", 2, 1.0, 2.0, "2024-13"), pos("A", 2, 1.0, 2.0, "later")],
                  raw_trades=[trade("A", 1.0, 1.0, 0.0, 0.0, "2024-01")])
    out = os.path.join(tmp_dir, "out")

    def months(mart):
        return {r._reference_period for r in read_table(spark, f"{out}/marts", mart).collect()}

    statement_run.run(spark, good, out)
    with pytest.raises(QualityGateError, match="reference_period_format fct_"):
        statement_run.run(spark, bad, out)
    assert months("fct_stock_detail") == months("fct_monthly_wallet") == {"2024-01"}
    checks = {(r.check_name, r.table_name): r.failures for r in spark.read.parquet(f"{out}/checks").collect()}
    assert checks["reference_period_format", "fct_stock_detail"] == 1
    statement_run.run(spark, good, out)                     # copies that were not published are gone
    assert not [d for d in os.listdir(f"{out}/marts") if ".new-" in d]


def test_observed_counts_equal_a_scan(spark, tmp_dir):
    """Row counts and row checks seen by a write are those of the stored table, on rows
    that fail, on NULLs and on an empty table."""
    from ledgerframe.operators import quality as Q
    from ledgerframe.sinks import write_table
    from ledgerframe.sources import workbook as WB

    rows = spark.range(1000).selectExpr(
        "if(id % 7 = 0, null, concat('T', id % 50)) as ticker",
        "if(id % 3 = 0, '2024-01', if(id % 11 = 0, null, 'x')) as _reference_period",
        "cast(if(id % 5 = 0, null, id - 20) as double) as total_quantity",
        "cast(id % 4 as double) as current_closing_price", "cast(id as double) as total_current_value")
    for name, df in (("some", rows), ("none", rows.where("total_current_value < 0"))):
        path, watch = os.path.join(tmp_dir, name), Q.Watch("fct_stock_detail")
        write_table(df, path, sort_within=["ticker"], watch=watch)
        back = spark.read.schema(df.schema).parquet(path)
        seen = [tuple(r[c] for c in Q.RESULT_COLUMNS) for r in watch.results()]
        left = Q.run_checks({"fct_stock_detail": back}, watched=["fct_stock_detail"]).collect()
        scan = Q.run_checks({"fct_stock_detail": back}).collect()
        assert sorted([*seen, *map(tuple, left)]) == sorted(map(tuple, scan)) and len(seen) == 8
        assert [watch.rows] == [r.row_count for r in WB.load_summary({"t": back}).collect()]
    assert {f for *_, f in seen} == {0}
