"""Workbook landing from generated .xlsx files (FIXTURES.md section 3)."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerframe.functions.text import sanitize_header, sanitize_header_py
from ledgerframe.operators import staging as S
from ledgerframe.schemas import RAW_SCHEMAS
from ledgerframe.sources import workbook as WB
from xlsx_writer import write_xlsx

POS_HEADER = ["Código de Negociação", "Produto", "Instituição", "Conta", "Tipo", "Quantidade",
              "Quantidade Disponível", "Preço de Fechamento", "Valor Atualizado", None,
              "Observação õ"]
TRADE_HEADER = ["Código de Negociação", "Período (Inicial)", "Período (Final)", "Instituição",
                "Quantidade (Compra)", "Quantidade (Venda)", "Quantidade (Líquida)",
                "Preço Médio (Compra)", "Preço Médio (Venda)"]
DIV_HEADER = ["Produto", "Pagamento", "Tipo de Evento", "Instituição", "Quantidade",
              "Preço unitário", "Valor líquido"]


def _june(folder):
    return write_xlsx(os.path.join(folder, "relatorio-consolidado-mensal-2024-junho.xlsx"), {
        "Posição - Ações (1)": [
            POS_HEADER,
            ["PETR4", "PETROBRAS PN", "XP", "00123", "PN", 10, 10, "20,50", 205.0, "x", "obs"],
            ["VALE3", "VALE ON", "XP", "00456", "ON", 2.5, 2.5, 60.0, 150.0, None, None],
            [],
            ["Total", None, None, None, None, None, None, None, 355.0],
        ],
        "Posição - ETF": [POS_HEADER[:9], ["BOVA11", "ISHARES", "XP", "1", "CI", 3, 3, 100.0, 300.0]],
        "negociações": [
            TRADE_HEADER,
            ["BBAS3F ", "01/06/2024", "30/06/2024", "XP", 100, 0, 100, "10,00", 0],
            ["BBAS3", "01/06/2024", "30/06/2024", "XP", 50, 0, 50, 13.0, 0],
        ],
        "Proventos Recebidos": [
            DIV_HEADER,
            ["ITSA4 - ITAUSA S.A. - PN", "15/06/2024", "Dividendo", "XP", 100, 0.1, 10.0],
        ],
        "Posição - Renda Fixa": [["Produto", "Instituição", "Emissor", "Código", "Indexador"],
                                 []],
    })


def _march(folder):
    hdr = POS_HEADER[:9] + ["Setor"]
    return write_xlsx(os.path.join(folder, "relatorio-consolidado-mensal-2024-março.xlsx"), {
        "Posição - Ações": [hdr,
                            ["PETR4", "PETROBRAS PN", "XP", "00123", "PN", 1.5, 1, 20.0, "1.234,56",
                             "Energia"],
                            ["ITSA4", "ITAUSA", "XP", "00123", "PN", 3.5, 3, 10.0, "-", "Bancos"]],
    })


def _plain(folder):
    return write_xlsx(os.path.join(folder, "extrato.xlsx"), {
        "Posição - Ações": [POS_HEADER[:9], ["WEGE3", "WEG", "XP", "7", "ON", 1, 1, 40.0, 40.0]],
    })


@pytest.fixture()
def landed(spark, tmp_dir):
    _june(tmp_dir), _march(tmp_dir), _plain(tmp_dir)
    with open(os.path.join(tmp_dir, "notes.txt"), "w") as f:
        f.write("not a workbook")
    files = WB.list_workbooks(spark, tmp_dir)
    return WB.land_workbooks(files).cache()


def test_no_workbooks_raises(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        WB.list_workbooks(spark, tmp_dir)


def test_match_sheets_containment_both_ways():
    m = WB.match_sheets(["Resumo", "Posição - Ações (1)", "NEGOCIAÇÕES", "Posição"])
    assert m["raw_stock_positions"] == "Posição - Ações (1)"
    assert m["raw_trades"] == "NEGOCIAÇÕES"
    # "Posição" is contained in several kind names; the first sheet wins per kind
    assert m["raw_etf_positions"] == "Posição"
    assert "raw_dividends" not in m


def test_header_sanitising_py_and_spark_agree(spark):
    headers = POS_HEADER[:9] + TRADE_HEADER + DIV_HEADER + ["Observação õ", "A/B (c)", "Ê à Á"]
    df = spark.createDataFrame([(h,) for h in headers], "h string")
    got = [r[0] for r in df.select(sanitize_header("h")).collect()]
    assert got == [sanitize_header_py(h) for h in headers]
    assert sanitize_header_py("Quantidade (Líquida)") == "Quantidade_Liquida"
    assert sanitize_header_py("Observação õ") == "Observacao_õ"


def test_landing_rows_periods_and_sparse_filter(spark, landed):
    raw = WB.land_raw_tables(landed)
    stock = raw["raw_stock_positions"]
    rows = {(r.Codigo_de_Negociacao, r._reference_period) for r in stock.collect()}
    assert rows == {("PETR4", "2024-06"), ("VALE3", "2024-06"), ("PETR4", "2024-00"),
                    ("ITSA4", "2024-00"), ("WEGE3", "extrato.xlsx")}
    june = {r.Codigo_de_Negociacao: r for r in stock.filter("_reference_period = '2024-06'").collect()}
    assert june["PETR4"].Conta == "00123"                      # text keeps its zeros
    assert june["PETR4"].Preco_de_Fechamento == 20.5           # decimal comma
    assert june["PETR4"]._extra_columns == {"Observacao_õ": "obs"}
    march = {r.Codigo_de_Negociacao: r for r in stock.filter("_reference_period = '2024-00'").collect()}
    assert march["PETR4"].Valor_Atualizado is None             # 1.234,56 does not parse
    assert march["ITSA4"].Valor_Atualizado is None             # "-" does not parse
    assert march["PETR4"]._extra_columns == {"Setor": "Energia"}


def test_absent_and_empty_kinds_are_typed_and_empty(spark, landed):
    raw = WB.land_raw_tables(landed)
    assert raw["raw_stock_lending"].count() == 0
    assert raw["raw_stock_lending"].schema["Taxa"].dataType == RAW_SCHEMAS["raw_stock_lending"]["Taxa"].dataType
    assert raw["raw_fixed_income"].count() == 0                # header-only sheet skipped
    assert raw["raw_etf_positions"].count() == 1               # only the June file has ETFs


def test_trades_and_dividends_typed(spark, landed):
    raw = WB.land_raw_tables(landed)
    stg = S.stg_trades(raw["raw_trades"]).collect()
    assert sorted(r.ticker for r in stg) == ["BBAS3", "BBAS3"]
    assert {str(r.period_start) for r in stg} == {"2024-06-01"}
    assert sorted(r.avg_buy_price for r in stg) == [10.0, 13.0]
    div = raw["raw_dividends"].collect()[0]
    assert str(div.Pagamento) == "2024-06-15" and div.Preco_unitario == 0.1


def test_staging_rounds_half_even(spark, landed):
    stg = S.stg_stock_positions(WB.land_raw_tables(landed)["raw_stock_positions"])
    q = {(r.ticker, r._reference_period): r.quantity for r in stg.collect()}
    assert q[("VALE3", "2024-06")] == 2       # 2.5 -> 2
    assert q[("PETR4", "2024-00")] == 2       # 1.5 -> 2
    assert q[("ITSA4", "2024-00")] == 4       # 3.5 -> 4


def test_coercion_rejects_and_load_summary(spark, landed):
    rej = WB.coercion_rejects(landed)
    bad = {(r.source_file, r.column_name) for r in rej.filter(~F.col("all_parse")).collect()}
    assert bad == {("relatorio-consolidado-mensal-2024-março.xlsx", "Valor_Atualizado")}
    summary = {r.table_name: r.row_count for r in WB.load_summary(WB.land_raw_tables(landed)).collect()}
    assert summary["raw_stock_positions"] == 5 and summary["raw_stock_lending"] == 0
    assert summary["raw_trades"] == 2 and summary["raw_dividends"] == 1


def test_column_coercion_all_or_nothing(spark):
    cells = spark.createDataFrame(
        [("f", "a", "1,5"), ("f", "a", "2"), ("f", "b", "1"), ("f", "b", "-"), ("f", "c", None)],
        "source_file string, column_name string, value string")
    got = {r.column_name: (r.n_values, r.n_numeric, r.decision)
           for r in WB.column_coercion(cells, ["source_file", "column_name"]).collect()}
    assert got == {"a": (2, 2, "numeric"), "b": (2, 1, "text"), "c": (0, 0, "text")}


def test_corrupt_workbook_is_reported_not_fatal(spark, tmp_dir):
    _june(tmp_dir)
    with open(os.path.join(tmp_dir, "broken-2024-julho.xlsx"), "wb") as f:
        f.write(b"not a zip archive")
    landed = WB.land_workbooks(WB.list_workbooks(spark, tmp_dir))
    bad = WB.unreadable_workbooks(landed).collect()
    assert [r.source_file for r in bad] == ["broken-2024-julho.xlsx"]
    assert "BadZipFile" in bad[0].error
    assert WB.land_raw_tables(landed)["raw_stock_positions"].count() == 2


def test_date_cells(spark):
    df = spark.createDataFrame([("45474",), ("15/06/2024",), ("2024-06-15",), ("1e12",), ("x",)],
                               "v string")
    got = [str(r[0]) for r in df.select(WB._date_cell(F.col("v"))).collect()]
    assert got == ["2024-07-01", "2024-06-15", "2024-06-15", "None", "None"]


def test_column_coercion_wide_equals_long(spark):
    wide = spark.createDataFrame([("f", "1,5", "-"), ("f", "2", "3"), ("g", None, "x")],
                                 "source_file string, a string, b string")
    long = wide.selectExpr("source_file", "stack(2, 'a', a, 'b', b) as (column_name, value)")
    w = WB.column_coercion_wide(wide, ["source_file"], ["a", "b"])
    lng = WB.column_coercion(long, ["source_file", "column_name"])
    key = lambda r: (r.source_file, r.column_name)
    assert sorted(map(tuple, w.select(*lng.columns).collect())) == \
        sorted(map(tuple, lng.collect()))
    assert {key(r): r.decision for r in w.collect()} == {
        ("f", "a"): "numeric", ("f", "b"): "text", ("g", "a"): "text", ("g", "b"): "text"}


def test_missing_value_markers(spark, tmp_dir):
    write_xlsx(os.path.join(tmp_dir, "rel-2024-maio.xlsx"), {
        "Posição - Ações": [POS_HEADER[:9],
                            ["PETR4", "N/A", "XP", "1", "PN", 1, 1, "NA", 10.0],
                            ["NA", "NA", "NA", "NA", "NA", "NA", None, None, None],
                            ["VALE3", "VALE", "XP", "2", "ON", 2, 2, 5.0, 10.0]]})
    landed = WB.land_workbooks(WB.list_workbooks(spark, tmp_dir))
    rows = {r.Codigo_de_Negociacao: r for r in WB.land_raw_tables(landed)["raw_stock_positions"].collect()}
    assert set(rows) == {"PETR4", "VALE3"}              # the all-"NA" row is sparse: dropped
    assert rows["PETR4"].Produto is None and rows["PETR4"].Preco_de_Fechamento is None
    assert WB.coercion_rejects(landed).filter(~F.col("all_parse")).count() == 0


def test_date_styled_cells_and_1904_workbooks(spark, tmp_dir):
    from xlsx_writer import ExcelDate
    hdr = ["Produto", "Pagamento", "Tipo de Evento", "Valor líquido"]
    write_xlsx(os.path.join(tmp_dir, "a-2024-julho.xlsx"), {
        "Proventos Recebidos": [hdr, ["ITSA4", ExcelDate(45474), "Dividendo", 1.0]]})
    write_xlsx(os.path.join(tmp_dir, "b-2024-julho.xlsx"), {
        "Proventos Recebidos": [hdr, ["BBAS3", ExcelDate(44012), "Dividendo", 2.0]]},
        date1904=True)
    raw = WB.land_raw_tables(WB.land_workbooks(WB.list_workbooks(spark, tmp_dir)))
    got = {r.Produto: str(r.Pagamento) for r in raw["raw_dividends"].collect()}
    assert got == {"ITSA4": "2024-07-01", "BBAS3": "2024-07-01"}


def test_headers_that_clean_to_one_name_keep_both_columns(spark, tmp_dir):
    write_xlsx(os.path.join(tmp_dir, "a-2024-julho.xlsx"), {"Posição - Ações": [
        ["Código de Negociação", "Quantidade", "(Quantidade)"], ["PETR4", 10, 50], ["VALE3", None, 70]]})
    landed = WB.land_workbooks(WB.list_workbooks(spark, tmp_dir)).cache()
    raw = WB.land_raw_tables(landed)
    rows = {r.Codigo_de_Negociacao: r for r in raw["raw_stock_positions"].collect()}
    assert rows["PETR4"].Quantidade == 10.0 and rows["VALE3"].Quantidade is None
    assert {t: r._extra_columns for t, r in rows.items()} \
        == {"PETR4": {"Quantidade__2": "50"}, "VALE3": {"Quantidade__2": "70"}}
    checks = [tuple(r) for r in WB.landing_checks(raw, landed).collect()]
    assert checks == [("headers_clean_to_one_name", "raw_stock_positions", "Quantidade", 1)]


def _damaged(path, part="xl/worksheets/sheet1.xml"):
    """Overwrite bytes inside the compressed stream of one part."""
    import zipfile

    with zipfile.ZipFile(path) as z:
        info = z.getinfo(part)
    with open(path, "r+b") as f:
        f.seek(info.header_offset + 30 + len(part) + info.compress_size // 2)
        f.write(b"\xff" * 40)


def test_any_fault_of_a_file_is_reported_and_none_of_its_rows_stay(spark, tmp_dir, monkeypatch):
    import zipfile

    monkeypatch.setattr(WB, "CHUNK_ROWS", 5)
    rows = [[f"T{i}", i, i, 10 * i] for i in range(1, 4000)]
    head = ["Código de Negociação", "Quantidade", "Preço de Fechamento", "Valor Atualizado"]
    for name in ("good", "stream"):
        write_xlsx(os.path.join(tmp_dir, f"{name}-2024-julho.xlsx"), {"Posição - Ações": [head, *rows]})
    _damaged(os.path.join(tmp_dir, "stream-2024-julho.xlsx"))
    with zipfile.ZipFile(os.path.join(tmp_dir, "empty-2024-julho.xlsx"), "w") as z:
        z.writestr("x", "no workbook")
    secret = write_xlsx(os.path.join(tmp_dir, "secret-2024-julho.xlsx"), {"Posição - Ações": [head, *rows]})
    raw = bytearray(open(secret, "rb").read())
    for sign, at in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):     # the encryption bit of every entry
        start = raw.find(sign)
        while start >= 0:
            raw[start + at] |= 1
            start = raw.find(sign, start + 1)
    open(secret, "wb").write(raw)
    landed = WB.land_workbooks(WB.list_workbooks(spark, tmp_dir)).cache()
    bad = {r.source_file.split("-")[0] for r in WB.unreadable_workbooks(landed).collect()}
    assert bad == {"stream", "empty", "secret"}
    got = WB.land_raw_tables(landed)["raw_stock_positions"]
    assert {r._source_file for r in got.select("_source_file").distinct().collect()} == {"good-2024-julho.xlsx"}
    assert got.count() == len(rows)


def test_a_date_beyond_the_calendar_is_rejected_text_not_a_fault(spark, tmp_dir):
    from xlsx_writer import ExcelDate

    write_xlsx(os.path.join(tmp_dir, "a-2024-julho.xlsx"), {"Proventos Recebidos": [
        ["Produto", "Pagamento", "Tipo de Evento"], ["ITSA4", ExcelDate(1e12), "Dividendo"]]})
    row = WB.land_raw_tables(WB.land_workbooks(WB.list_workbooks(spark, tmp_dir)))["raw_dividends"].collect()[0]
    assert row.Pagamento is None and row._rejected == {"Pagamento": "1000000000000.0"}


def test_unstyled_serials_follow_the_workbooks_epoch(spark, tmp_dir):
    hdr = ["Produto", "Pagamento", "Tipo de Evento"]
    write_xlsx(os.path.join(tmp_dir, "a-2024-julho.xlsx"),
               {"Proventos Recebidos": [hdr, ["ITSA4", 44012, "Dividendo"]]}, date1904=True)
    row = WB.land_raw_tables(WB.land_workbooks(WB.list_workbooks(spark, tmp_dir)))["raw_dividends"].collect()[0]
    assert str(row.Pagamento) == "2024-07-01"


def test_a_large_sheet_is_parsed_row_by_row(tmp_dir):
    import tracemalloc

    path = write_xlsx(os.path.join(tmp_dir, "big-2024-julho.xlsx"), {"negociações": [
        TRADE_HEADER, *([f"T{i}", "01/06/2024", "30/06/2024", "XP", i, 0, i, 1.5, 0] for i in range(30_000))]})
    content = open(path, "rb").read()
    tracemalloc.start()
    n = sum(1 for _ in WB.parse_workbook("big-2024-julho.xlsx", content))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 30_000 and peak < 8_000_000


def _losing_rows(spark, folder):
    """Landed rows of every kind of loss: what each check counts is known."""
    stock, trades = "raw_stock_positions", "raw_trades"
    rows = [
        ("a", stock, "s", 1, 3, None, {}, {"Codigo_de_Negociacao": "A", "Quantidade": "1,5", "Setor": "x"}),
        ("a", stock, "s", 2, 3, None, {}, {"Codigo_de_Negociacao": "B", "Quantidade": "-"}),
        ("a", stock, "s", 3, 4, None, {}, {"Quantidade": "-"}),                             # sparse
        ("a", trades, "t", 1, 3, None, {}, {"Codigo_de_Negociacao": "A", "Periodo_Inicial": "soon", "_cell_9": "x"}),
        ("b", stock, "s", 1, 3, None, {}, {"Codigo_de_Negociacao": " ", "Quantidade": "-"}),  # no key in the sheet
        ("b", stock, "s", 2, 3, None, {}, {"Quantidade": "2"}),
        ("c", stock, "s", 1, 3, None, {}, {"Quantidade": "-", "_cell_7": "x"}),             # of an unreadable file
        ("c", WB.UNREADABLE, None, 0, 0, None, {}, {"error": "E"}),
        (None, trades, None, 1, 2, None, {}, {"Codigo_de_Negociacao": "A", "Quantidade_Compra": "many"}),
        ("b", WB.CLASH, "s", 0, 0, None, {}, {"table": stock, "column": "Preco", "headers": "x"}),
        ("b", WB.CLASH, "s", 0, 0, None, {}, {"table": stock, "column": "Preco", "headers": "y"})]
    spark.createDataFrame(rows, WB.LANDED_SCHEMA).write.parquet(folder)
    return spark.read.schema(WB.LANDED_SCHEMA).parquet(folder)


def test_losses_of_all_kinds_are_counted_in_one_pass(spark, tmp_dir):
    landed = _losing_rows(spark, os.path.join(tmp_dir, "landed"))
    raw = WB.land_raw_tables(landed)
    found = WB.landing_checks(raw, landed)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("headers_clean_to_one_name", "raw_stock_positions", "Preco", 2),
        ("missing_key_column", "raw_stock_positions", "Codigo_de_Negociacao", 2),
        ("row_longer_than_header", "raw_stock_positions", "", 1),
        ("row_longer_than_header", "raw_trades", "", 1),
        ("text_does_not_parse", "raw_stock_positions", "Quantidade", 2),
        ("text_does_not_parse", "raw_trades", "Periodo_Inicial", 1),
        ("text_does_not_parse", "raw_trades", "Quantidade_Compra", 1),
        ("unreadable_workbook", "landing", "c", 1)]
    # tables that do not say where they come from give the same
    assert sorted(map(tuple, WB.landing_checks(dict(raw), landed).collect())) \
        == sorted(map(tuple, found.collect()))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
