"""I4 (CSV/Parquet landings), I15 (JSON rate landing), I16 (price files)."""

import json
import os

from ledgerframe.operators import staging as S
from ledgerframe.sources import landing, series
from ledgerframe.sources import workbook as WB


def test_csv_landing_conforms_to_declared_schema(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pos")
    os.makedirs(d)
    with open(os.path.join(d, "relatorio-consolidado-mensal-2024-junho.csv"), "w") as f:
        f.write("Codigo_de_Negociacao,Conta,Quantidade,Preco_de_Fechamento,Setor\n")
        f.write('PETR4,00123,10,"20,5",Energia\n')
    df = landing.read_raw_table(spark, d, "raw_stock_positions", "csv")
    r = df.collect()[0]
    assert r.Conta == "00123" and r.Quantidade == 10.0 and r.Preco_de_Fechamento == 20.5
    assert r.Produto is None and r._reference_period == "2024-06"
    assert r._extra_columns == {"Setor": "Energia"}


def test_rate_json_landing(spark, tmp_dir):
    p = os.path.join(tmp_dir, "cdi.json")
    with open(p, "w") as f:
        json.dump([{"data": "02/01/2024", "valor": "0.04"}, {"data": "bad", "valor": "x"}], f)
    rows = series.read_landed_rates(spark, p).collect()
    assert str(rows[0].date) == "2024-01-02" and rows[0].rate_pct == 0.04
    assert rows[1].date is None and rows[1].rate_pct is None


def test_price_csv_landing(spark, tmp_dir):
    p = os.path.join(tmp_dir, "px.csv")
    with open(p, "w") as f:
        f.write("symbol,date,adj_close\n^BVSP,2024-01-31,127000.5\n")
    r = series.read_prices(spark, p, "csv").collect()[0]
    assert r.symbol == "^BVSP" and str(r.date) == "2024-01-31" and r.close == 127000.5


def test_rate_json_lines_landing(spark, tmp_dir):
    p = os.path.join(tmp_dir, "cdi.jsonl")
    with open(p, "w") as f:
        f.write('{"data": "02/01/2024", "valor": "0.04"}\n{"data": "03/01/2024", "valor": "0.05"}\n')
    rows = series.read_landed_rates(spark, p, json_array=False).collect()
    assert [r.rate_pct for r in rows] == [0.04, 0.05]


def test_csv_rejects_and_owner_column(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pos")
    os.makedirs(d)
    with open(os.path.join(d, "rel-2024-junho.csv"), "w") as f:
        f.write('owner,Codigo_de_Negociacao,Valor_Atualizado\nana,PETR4,"1.234,56"\nbob,VALE3,"5,5"\n')
    rows = landing.read_raw_table(spark, d, "raw_stock_positions", "csv", keys=["owner"]).collect()
    assert {r.owner: (r.Valor_Atualizado, r._rejected) for r in rows} \
        == {"ana": (None, {"Valor_Atualizado": "1.234,56"}), "bob": (5.5, {})}
    assert all(r._extra_columns == {} for r in rows)


def test_monthly_prices_then_daily_ones(spark):
    monthly = spark.sql("select * from values ('A', date'2024-01-31', 1.0D), ('B', date'2024-01-31', null)"
                        " as t(symbol, date, close)")
    daily = spark.sql("select * from values ('A', date'2024-01-02', 9.0D), ('B', date'2024-01-02', 2.0D),"
                      " ('C', date'2024-01-03', 3.0D) as t(symbol, date, close)")
    got = sorted(tuple(r) for r in series.monthly_then_daily(monthly, daily).collect())
    assert [(s, c) for s, _, c in got] == [("A", 1.0), ("B", 2.0), ("C", 3.0)]
    assert series.monthly_then_daily(None, daily) is daily


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def _checks(spark, d, table, fmt, **options):
    landed = landing.land_table(spark, d, table, fmt, **options)
    raw = {table: landing.read_raw_table(spark, d, table, fmt, **options)}
    return {(r.check_name, r.column_name): r.failures for r in WB.landing_checks(raw, landed).collect()}


def test_csv_files_are_read_by_their_own_headers(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pos")
    _write(d, "a-2024-junho.csv", "Código de Negociação,Quantidade,Valor Atualizado\nPETR4,100,1\n")
    _write(d, "b-2024-julho.csv", "﻿Valor Atualizado,Setor,Código de Negociação,Quantidade\n\n2,Energia,VALE3,200\n")
    _write(d, "c-2024-maio.csv", 'Quantidade,"Codigo_de_Negociacao"\n"3,5",WEGE3\n')
    rows = landing.read_raw_table(spark, d, "raw_stock_positions", "csv").collect()
    assert {r.Codigo_de_Negociacao: (r.Quantidade, r.Valor_Atualizado, r._extra_columns, r._reference_period)
            for r in rows} == {"PETR4": (100.0, 1.0, {}, "2024-06"), "VALE3": (200.0, 2.0, {"Setor": "Energia"}, "2024-07"),
                               "WEGE3": (3.5, None, {}, "2024-05")}
    assert S.stg_stock_positions(landing.read_raw_table(spark, d, "raw_stock_positions", "csv")).count() == 3
    assert _checks(spark, d, "raw_stock_positions", "csv") == {}


def test_csv_losses_are_check_results(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pos")
    _write(d, "clash-2024-junho.csv", "Codigo_de_Negociacao,Preço,Preco,Preço\nPETR4,1,2,3\n")
    _write(d, "nokey-2024-junho.csv", "Ativo,Quantidade\nVALE3,1\nWEGE3,2\n")
    _write(d, "long-2024-junho.csv", "Codigo_de_Negociacao,Quantidade\nITSA4,1,5\nITUB4,1\n")
    rows = {r.Codigo_de_Negociacao: r for r in landing.read_raw_table(spark, d, "raw_stock_positions", "csv").collect()}
    assert rows["PETR4"]._extra_columns == {"Preco": "1", "Preco__2": "2", "Preco.1": "3"}
    assert rows["ITSA4"]._extra_columns == {"_cell_2": "5"} and rows["ITUB4"]._extra_columns == {}
    assert _checks(spark, d, "raw_stock_positions", "csv") == {
        ("headers_clean_to_one_name", "Preco"): 1, ("missing_key_column", "Codigo_de_Negociacao"): 2,
        ("row_longer_than_header", ""): 1}


def test_csv_sparse_rows_missing_texts_and_separator(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pos")
    _write(d, "a-2024-junho.csv", "Codigo_de_Negociacao;Conta;Quantidade;Unnamed: 3;\nPETR4;NaN;1,5;x;y\n;;;;\nTotal;;;;\n"
                                  '"A;""B""";01;2;;\n')
    rows = landing.read_raw_table(spark, d, "raw_stock_positions", "csv", sep=";").collect()
    assert {r.Codigo_de_Negociacao: (r.Conta, r.Quantidade, r._extra_columns) for r in rows} \
        == {"PETR4": (None, 1.5, {}), "Total": (None, None, {}), 'A;"B"': ("01", 2.0, {})}


def test_parquet_files_are_read_by_column_name(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pos")
    for name, sql in (("x", "select 'PETR4' as `Código de Negociação`, 1.5D as Quantidade"),
                      ("y", "select 9.0D as Valor_Atualizado, 2.0D as Quantidade, 'VALE3' as Codigo_de_Negociacao")):
        spark.sql(sql).write.parquet(f"{d}/{name}")
    rows = landing.read_raw_table(spark, d, "raw_stock_positions", nested=True).collect()
    got = {r.Quantidade: (r.Codigo_de_Negociacao, r.Valor_Atualizado, r._extra_columns) for r in rows}
    # two columns of different files clean to one name: both kept, and a check says so
    assert got[1.5][1] is None and got[2.0][1] == 9.0
    assert _checks(spark, d, "raw_stock_positions", "parquet", nested=True)[
        "headers_clean_to_one_name", "Codigo_de_Negociacao"] == 1
    spark.sql("select 'WEGE3' as Codigo_de_Negociacao, '7' as Quantidade").write.parquet(f"{d}/z")
    rows = landing.read_raw_table(spark, d, "raw_stock_positions", nested=True).collect()
    assert {r.Codigo_de_Negociacao: (r.Quantidade, r.Valor_Atualizado) for r in rows} \
        == {"PETR4": (1.5, None), "VALE3": (2.0, 9.0), "WEGE3": (7.0, None)}


def test_parquet_with_its_own_lineage(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pos")
    spark.sql("select 'PETR4' as Codigo_de_Negociacao, '2024-03' as _reference_period, 'f.xlsx' as _source_file") \
        .write.parquet(d)
    r = landing.read_raw_table(spark, d, "raw_stock_positions").first()
    assert (r._source_file, r._reference_period, r._extra_columns) == ("f.xlsx", "2024-03", {})


def test_files_in_nested_folders_keep_owner_and_rows(spark, tmp_dir):
    for owner in "ab":
        for year in ("2023", "2024"):
            _write(f"{tmp_dir}/in/owner={owner}/{year}", "x-2024-junho.csv",
                   f"Codigo_de_Negociacao,Quantidade\n{owner}{year},{year}\n")
    rows = landing.read_raw_table(spark, f"{tmp_dir}/in", "raw_stock_positions", "csv", keys=["owner"]).collect()
    assert {(r.owner, r._source_file, r.Codigo_de_Negociacao) for r in rows} == {
        (o, f"owner={o}/{y}/x-2024-junho.csv", o + y) for o in "ab" for y in ("2023", "2024")}


def test_file_names():
    root = "file:/data/in"
    assert WB.file_name_of("file:/data/in/owner=a/2023/x%20y.xlsx", root) == "owner=a/2023/x y.xlsx"
    assert WB.file_name_of("file:/data/in/x.xlsx", root) == "x.xlsx"
    assert WB.file_name_of("file:/data/in/owner=a/x.xlsx", root + "/owner=a") == "owner=a/x.xlsx"
    assert WB.file_name_of("file:/other/owner=a/x.xlsx", root) == "owner=a/x.xlsx"
    assert WB.path_keys("owner=a/2023/x.xlsx") == {"owner": "a"}
