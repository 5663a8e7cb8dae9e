"""Write tiny XLSX workbooks, as input for the workbook reader."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


_STYLES = (
    f'<styleSheet xmlns="{_MAIN}"><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
    '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>'
)


def _cell(reference: str, value) -> str:
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int):  # a day
        return f'<c r="{reference}" s="1"><v>{value}</v></c>'
    return f'<c r="{reference}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'


def _row(number: int, cells: list) -> str:
    inner = "".join(_cell(f"{chr(65 + i)}{number}", v) for i, v in enumerate(cells))
    return f'<row r="{number}">{inner}</row>'


def workbook_bytes(group: pd.DataFrame) -> pd.DataFrame:
    """One workbook with the customers of a group: text, days and flags."""
    columns = ["c_name", "c_custkey", "opened", "big"]
    rows = [_row(1, columns)]
    rows += [
        _row(i, [name, key, int(day), bool(big)]) for i, (name, key, day, big) in enumerate(zip(*(group[c] for c in columns)), 2)
    ]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="s" sheetId="1" r:id="r1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="r1" Type="sheet" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr("xl/styles.xml", _STYLES)
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(rows)}</sheetData></worksheet>')
    return pd.DataFrame({"__path": [group["__path"].iloc[0]], "content": [out.getvalue()]})
