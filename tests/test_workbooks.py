"""Spreadsheets made by hand, cell by cell."""

import zipfile

from sitegrain.sources import workbooks

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def book(path, rows, shared=()):
    """rows: row number, [(cell, type, value)]; type s shared, i inline, n number, b boolean, f formula text."""
    def cell(at, kind, value):
        if kind == "i":
            return f'<c r="{at}" t="inlineStr"><is><r><t>{value[:1]}</t></r><r><t>{value[1:]}</t></r></is></c>'
        mark = {"s": ' t="s"', "b": ' t="b"', "f": ' t="str"', "n": ""}[kind]
        return f'<c r="{at}"{mark}><v>{value}</v></c>'

    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>" + "".join(f'<row r="{n}">' + "".join(cell(*c) for c in cells) + "</row>" for n, cells in rows) + "</sheetData></worksheet>")


def test_practice_lists(spark, tmp_path):
    book(tmp_path / "a.xlsx", [(1, [("A1", "s", 0), ("B1", "s", 1), ("D1", "i", "Website")]), (2, [("A2", "n", "7.0"), ("B2", "s", 2), ("D2", "i", "x.com")]), (3, [("B3", "i", "no index")]), (5, [("A5", "i", " 9 "), ("B5", "f", "Dim &amp; Co")])], ["ID", "Office Name", "Bright"])
    book(tmp_path / "b.xlsx", [(1, [("A1", "i", "Group")]), (2, [("A2", "i", "Index"), ("B2", "i", "Practice Name"), ("C2", "i", "Zip Code")]), (3, [("A3", "n", "1"), ("B3", "i", "Far"), ("C3", "n", "76701")])])
    (tmp_path / "broken.xlsx").write_bytes(b"no workbook")
    got = {(r.idx, r.practice_name, r.website, r.zip, r.row) for r in workbooks.read_practice_book(spark, f"file://{tmp_path}").collect()}
    assert got == {(7, "Bright", "x.com", None, 2), (9, "Dim & Co", None, None, 5), (1, "Far", None, "76701", 3)}


def test_batch_tables(spark, tmp_path):
    book(tmp_path / "t.xlsx", [(1, [("A1", "i", "Practice Information")]), (2, [("A2", "i", "Index"), ("B2", "i", "Doctor Name"), ("C2", "i", "CEREC (Same Day Crowns)"), ("AA2", "i", "Google Reviews Ranking"), ("AB2", "i", "Implants")]), (3, [("A3", "n", "4"), ("B3", "i", "Dr. A B"), ("C3", "i", "x"), ("AA3", "n", "4.5"), ("AB3", "n", "12")]), (4, [("A4", "n", "4"), ("C4", "b", "0")])])
    got = sorted((r.pos, r.idx, r.doctor_name, r.cerec, r.google_rating, r.implants) for r in workbooks.read_batch_book(spark, f"file://{tmp_path}").collect())
    assert got == [(3, 4, "Dr. A B", True, 4.5, 12), (4, 4, None, False, None, None)]
