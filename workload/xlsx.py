"""Writes minimal spreadsheets, as input for the spreadsheet scan."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def column_letters(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def workbook(rows: list[list], shared: bool = True, sheet_part: str = "worksheets/sheet1.xml") -> bytes:
    """A workbook with one sheet; text goes to the shared strings or into the cells."""
    strings: dict[str, int] = {}
    lines = []
    for r, row in enumerate(rows, start=1):
        cells = []
        for c, value in enumerate(row):
            if value is None:
                continue
            place = f"{column_letters(c)}{r}"
            if not isinstance(value, str):
                cells.append(f'<c r="{place}"><v>{value!r}</v></c>')
            elif shared:
                number = strings.setdefault(value, len(strings))
                cells.append(f'<c r="{place}" t="s"><v>{number}</v></c>')
            else:
                cells.append(f'<c r="{place}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
        lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>'
        '<sheet name="Export" sheetId="7" r:id="rId3"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}"><Relationship Id="rId3" '
        f'Type="{RELATIONS}/worksheet" Target="{sheet_part}"/></Relationships>',
        f"xl/{sheet_part}": f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    if shared:
        items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">{items}</sst>'
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)
    return target.getvalue()
