"""Round trip of cell values through a written workbook and the parser
(pure Python, no Spark): text (any characters, incl. XML specials and
accents), numbers and booleans come back as the cell text; empty cells and
missing-value markers are absent."""

import io
import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerframe.functions.text import sanitize_header_py
from ledgerframe.sources.workbook import MISSING_TEXT, parse_workbook
from xlsx_writer import write_xlsx

HEADER = ["Código de Negociação", "Produto", "Quantidade"]
text = st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc", "Cn", "Co")), max_size=10)
cell = st.one_of(st.none(), text, st.integers(-10**6, 10**6), st.booleans(),
                 st.floats(allow_nan=False, allow_infinity=False, width=32))


def _expected(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return None if v in MISSING_TEXT else v


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(cell, cell, cell), min_size=1, max_size=8))
def test_cells_round_trip(rows):
    with tempfile.TemporaryDirectory() as d:
        path = write_xlsx(os.path.join(d, "x-2024-junho.xlsx"),
                          {"Posição - Ações": [HEADER, *[list(r) for r in rows]]})
        content = open(path, "rb").read()
    got = list(parse_workbook("x-2024-junho.xlsx", io.BytesIO(content).getvalue()))
    names = [sanitize_header_py(h) for h in HEADER]
    assert len(got) == len(rows)
    for (_, table, sheet, _, width, _, _, cells), row in zip(got, rows):
        assert table == "raw_stock_positions" and sheet == "Posição - Ações" and width == 3
        want = {n: _expected(v) for n, v in zip(names, row) if _expected(v) is not None}
        assert cells == want
