"""Small department files, invented for the tests."""

from __future__ import annotations

import os
import zipfile


def write(root, name: str, text: str) -> str:
    path = os.path.join(str(root), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def csv(header: str, rows: list[str]) -> str:
    """With the unnamed index column and the blank tail the real files have."""
    return "," + header + "\n" + "".join(f"{i},{r}\n" for i, r in enumerate(rows)) + "\n"


CAMPAIGNS = (
    "\tcampaign_id\tcampaign_name\tcampaign_description\tdiscount\n"
    '0\tCMP1\tspring  push\t"""All  you need"" - Ann"\t1%\n'
    "1\tCMP2\tSummer\tHot days\t10%%\n"
    "2\tCMP3\tAutumn\tLeaves\t5pct\n"
)


def orders(root, rows, tag=""):
    write(root, f"Operations/order_data{tag}.csv", csv("order_id,user_id,estimated arrival,transaction_date", rows))


def merchants_of_orders(root, rows, tag=""):
    write(root, f"Enterprise/order_with_merchant_data{tag}.csv", csv("order_id,merchant_id,staff_id", rows))


def prices(root, rows, tag=""):
    write(root, f"Operations/line_item_data_prices{tag}.csv", csv("order_id,price,quantity", rows))


def products_of_orders(root, rows, tag=""):
    write(root, f"Operations/line_item_data_products{tag}.csv", csv("order_id,product_name,product_id", rows))


def campaign_rows(root, rows, tag=""):
    write(
        root,
        f"Marketing/transactional_campaign_data{tag}.csv",
        csv("transaction_date,campaign_id,order_id,estimated arrival,availed", rows),
    )


def html_table(header, rows) -> str:
    def tr(cells, tag):
        return "<tr>" + "".join(f"<{tag}> {c} </{tag}>" for c in cells) + "</tr>"

    return (
        "<html><body><script>var t='<table>';</script><table border=1>"
        + tr(header, "th")
        + "".join(tr(r, "td") for r in rows)
        + "</table></body></html>"
    )


def merchant_dims(root, ids):
    rows = [(i, m, "acme  inc", "1 Road", "st", "town", "land", "(02) 55", "2020-01-02") for i, m in enumerate(ids)]
    header = ("", "merchant_id", "name", "street", "state", "city", "country", "contact number", "creation_date")
    write(root, "Enterprise/merchant_data.html", html_table(header, rows))


def staff_dims(root, ids):
    rows = [(i, s, "mcdonald", "2 Road", "st", "town", "land", "Senior", "+1 5", "2020-01-02") for i, s in enumerate(ids)]
    header = ("", "staff_id", "name", "street", "state", "city", "country", "job_level", "contact_number", "creation_date")
    write(root, "Enterprise/staff_data.html", html_table(header, rows))


def workbook(path: str, rows: list[list]) -> None:
    """A minimal XLSX file: text as shared strings, numbers as they are."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    shared: list[str] = []
    body = []
    for r, cells in enumerate(rows, 1):
        out = []
        for c, value in enumerate(cells):
            ref = f"{chr(65 + c)}{r}"
            if value is None:
                continue
            if isinstance(value, str):
                if value not in shared:
                    shared.append(value)
                out.append(f'<c r="{ref}" t="s"><v>{shared.index(value)}</v></c>')
            else:
                out.append(f'<c r="{ref}"><v>{value}</v></c>')
        body.append(f'<row r="{r}">{"".join(out)}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="rId7"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId7" Type="x" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(body)}</sheetData></worksheet>')
        z.writestr(
            "xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><t>{t}</t></si>" for t in shared) + "</sst>"
        )
