"""Spans of HTML cells, dates and flags of workbooks."""

import datetime as dt
import io
import zipfile

import pytest

from tallyhouse.sources.documents import html_tables, sheet_rows

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


@pytest.mark.parametrize(
    "rows, want",
    [
        ("<tr><td rowspan=2>a<td>b</tr><tr><td>c</tr>", [["a", "b"], ["a", "c"]]),
        ("<tr><td colspan=2>a<td>b</tr><tr><td>c<td>d<td>e</tr>", [["a", "a", "b"], ["c", "d", "e"]]),
        ("<tr><td>a<td rowspan=3>b</tr><tr><td>c</tr><tr></tr><tr><td>d</tr>", [["a", "b"], ["c", "b"], ["", "b"], ["d"]]),
        ("<tr><td rowspan=2 colspan=2>a<td>b</tr><tr><td>c</tr>", [["a", "a", "b"], ["a", "a", "c"]]),
        ("<tr><td rowspan=0>a<td>b</tr><tr><td>c</tr><tr><td>d</tr>", [["a", "b"], ["a", "c"], ["a", "d"]]),
        ("<tr><td colspan=x rowspan=''>a<td colspan=0>b</tr>", [["a", "b"]]),
        ("<tr><td>a<td><table><tr><td rowspan=2>in<td>1<tr><td>2</table><td>b</tr>", [["a", "", "b"]]),
    ],
)
def test_spans(rows, want):
    assert html_tables(f"<table>{rows}</table>")[0] == want


def book(cells: str, formats: str = "", styles: str = '<xf numFmtId="0"/><xf numFmtId="14"/>', setting: str = "") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}">{setting}<sheets><sheet name="s" sheetId="1" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}"><numFmts>{formats}</numFmts><cellXfs>{styles}</cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{MAIN}"><sheetData><row>{cells}</row></sheetData></worksheet>')
    return out.getvalue()


def test_dates_flags_and_errors():
    cells = (
        '<c s="1"><v>45306</v></c><c s="1"><v>45306.75</v></c><c s="1"><v>0.5</v></c><c><v>45306</v></c><c t="b"><v>1</v></c><c t="b"><v>0</v></c>'
        '<c t="e"><v>#N/A</v></c><c t="str" s="1"><v>45306</v></c><c t="d"><v>2024-01-15T00:00:00</v></c><c s="1"><v>nothing</v></c><c s="1"><v>1</v></c><c s="1"><v>61</v></c>'
    )
    got = list(sheet_rows(book(cells)))
    assert got == [
        ["2024-01-15", "2024-01-15 18:00:00", "12:00:00", "45306", "True", "False", None, "45306", "2024-01-15", "nothing", "1900-01-01", "1900-03-01"]
    ]
    assert (dt.datetime(2024, 1, 15) - dt.datetime(1904, 1, 1)).days == 43844
    assert list(sheet_rows(book('<c s="1"><v>43844</v></c>', setting='<workbookPr date1904="1"/>'))) == [["2024-01-15"]]


@pytest.mark.parametrize(
    "code, is_date",
    [("yyyy\\-mm\\-dd", True), ("[$-409]d-mmm-yy;@", True), ("[h]:mm", True), ("0.00", False), ('0" days"', False), ("[Red]0.0", False), ("General", False), ("#,##0_);(#,##0)", False)],
)
def test_which_formats_are_dates(code, is_date):
    made = book('<c s="1"><v>45306</v></c>', f'<numFmt numFmtId="170" formatCode="{code.replace(chr(34), "&quot;")}"/>', '<xf numFmtId="0"/><xf numFmtId="170"/>')
    ((text,),) = sheet_rows(made)
    assert (text != "45306") == is_date
