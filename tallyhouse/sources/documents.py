"""Cells out of XLSX workbooks and HTML pages, with the standard library.

Small per-file helpers for ``mapInPandas``; Spark reads and spreads the files.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd

_CHUNK = 10_000


def _frames(path: str, table_no: int, rows: Iterator[list]) -> Iterator[pd.DataFrame]:
    """Rows in batches, so that a long table is never held as one frame."""
    batch: list[tuple] = []
    for row_no, cells in enumerate(rows):
        batch.append((path, table_no, row_no, cells))
        if len(batch) == _CHUNK:
            yield pd.DataFrame(batch, columns=["__path", "table_no", "row_no", "cells"])
            batch = []
    if batch:
        yield pd.DataFrame(batch, columns=["__path", "table_no", "row_no", "cells"])


Cell = tuple[str, int, int]  # text, columns, rows


def _count(text: str | None, most: int) -> int:
    found = re.match(r"\s*\d+", text or "")
    return min(int(found.group()), most) if found else 1


def spread(rows: list[list[Cell]]) -> list[list[str]]:
    """Every cell in all columns and rows that it spans."""
    out, below = [], {}  # column -> text and number of rows it still reaches down
    for row in rows:
        line: list[str] = []

        def from_above() -> bool:
            held = below.get(len(line))
            if held is None:
                return False
            below[len(line)] = (held[0], held[1] - 1)
            if held[1] == 1:
                del below[len(line)]
            line.append(held[0])
            return True

        for text, columns, deep in row:
            while from_above():
                pass
            for _ in range(columns):
                if deep > 1:
                    below[len(line)] = (text, deep - 1)
                line.append(text)
        # cells from above that stand right of the row's own
        while below and len(line) <= max(below):
            if not from_above():
                line.append("")
        out.append(line)
    return out


class _Tables(HTMLParser):
    """Rows of every table of a page, in order of the opening tags.

    A table inside a cell is a table of its own; its text is not part of the
    cell around it.  A cell is kept with the columns and rows it spans.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[Cell]]] = []
        self._open: list[dict] = []  # innermost table last: its rows and its open cell
        self._muted = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self._muted += 1
        elif tag == "table":
            rows: list[list[Cell]] = []
            self.tables.append(rows)
            self._open.append({"rows": rows, "cell": None, "span": (1, 1)})
        elif not self._open:
            return
        elif tag == "tr":
            self._close_cell()
            self._open[-1]["rows"].append([])
        elif tag in ("td", "th") and self._open[-1]["rows"]:
            self._close_cell()
            self._open[-1]["cell"] = []
            said = dict(attrs)
            # 0 rows mean: to the end of the table; the limits are those of the HTML standard (fixed values)
            rows = _count(said.get("rowspan"), 65534)
            self._open[-1]["span"] = (max(1, _count(said.get("colspan"), 1000)), rows or 65534)
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self._muted = max(0, self._muted - 1)
        elif self._open and tag in ("td", "th", "tr", "table"):
            self._close_cell()
            if tag == "table":
                self._open.pop()

    def handle_data(self, data):
        if self._open and self._open[-1]["cell"] is not None and not self._muted:
            self._open[-1]["cell"].append(data)

    def _close_cell(self):
        here = self._open[-1]
        if here["cell"] is not None:
            here["rows"][-1].append((re.sub(r"\s+", " ", "".join(here["cell"])).strip(), *here["span"]))
        here["cell"] = None


def html_tables(page: str) -> list[list[list[str]]]:
    parser = _Tables()
    parser.feed(page)
    parser.close()
    return [[row for row in spread(table) if row] for table in parser.tables]


def table_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["__path"], batch["content"]):
            for table_no, rows in enumerate(html_tables(bytes(content).decode("utf-8", errors="replace"))):
                yield from _frames(path, table_no, iter(rows))


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_NS}sheets/{_NS}sheet")
    wanted = sheet.get(_REL)
    for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if rel.get("Id") == wanted:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    return "xl/worksheets/sheet1.xml"


# Number formats of dates and times that need no declaration in a workbook.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(_DATE_FORMATS)
    for made in root.iter(f"{_NS}numFmt"):
        # what is quoted, escaped or in brackets (colours, conditions) is no part of the date
        code = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]', "", made.get("formatCode", "").lower())
        if re.search(r"[dyhs]|m", code) and "general" not in code:
            dates.add(int(made.get("numFmtId")))
    styles = root.find(f"{_NS}cellXfs")
    return {k for k, x in enumerate(styles if styles is not None else []) if int(x.get("numFmtId", "0")) in dates}


def _first_day(book: zipfile.ZipFile) -> dt.datetime:
    setting = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_NS}workbookPr")
    later = setting is not None and setting.get("date1904") in ("1", "true")
    return dt.datetime(1904, 1, 1) if later else dt.datetime(1899, 12, 30)


def _as_date(serial: str, first: dt.datetime) -> str:
    """A day, a moment, or below one day a time of day; the text as it is where it is no such number."""
    try:
        days = float(serial)
        if first.year == 1899 and 0 < days < 60:
            days += 1  # the calendar of 1900 has a 29th of February, so days before it are one off
        seconds = round(days * 86400)
        moment = first + dt.timedelta(seconds=seconds)
    except (ValueError, OverflowError):
        return serial
    if 0 <= float(serial) < 1:
        return moment.strftime("%H:%M:%S")
    return moment.strftime("%Y-%m-%d" if seconds % 86400 == 0 else "%Y-%m-%d %H:%M:%S")


def _cell_text(cell, shared: list[str], dates: set[int], first: dt.datetime) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_NS}t"))
    value = cell.find(f"{_NS}v")
    if value is None or value.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "True" if value.text.strip() == "1" else "False"
    if kind in (None, "n") and int(cell.get("s", "0")) in dates:
        return _as_date(value.text, first)
    if kind == "d":
        return value.text.replace("T", " ").removesuffix(" 00:00:00")
    return value.text


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet, streamed from its XML.

    Dates and times come out as such by the style of their cell, flags as
    True and False, errors as nothing.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter(f"{_NS}t")))
        dates, first = _date_styles(book), _first_day(book)
        with book.open(_first_sheet(book)) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_NS}row":
                    continue
                cells: list[str | None] = []
                for i, cell in enumerate(row.findall(f"{_NS}c")):
                    at = _column_number(cell.get("r")) if cell.get("r") else i
                    cells.extend([None] * (at - len(cells)))
                    cells.append(_cell_text(cell, shared, dates, first))
                yield cells
                row.clear()


def sheet_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["__path"], batch["content"]):
            yield from _frames(path, 0, sheet_rows(bytes(content)))
