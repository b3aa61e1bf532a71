"""Minimal .xlsx encoding (standard library): one sheet, inline strings.

Characters XML 1.0 cannot carry (most C0 controls, CR) are written with the
OOXML ``_xHHHH_`` escape, and a literal ``_xHHHH_`` in the text escapes its
underscore as ``_x005F_``; readers undo both.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.sax.saxutils import escape

# The most rows one worksheet and the most characters (UTF-16
# units) one cell can hold in the format; a part of this many code points fits a cell.
MAX_SHEET_ROWS = 1_048_576
MAX_CELL_UNITS = 32_767
PART_CHARS = MAX_CELL_UNITS // 2

_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _xml_ok(ch: str) -> bool:
    c = ord(ch)
    return (c in (0x9, 0xA) or 0x20 <= c <= 0xD7FF or 0xE000 <= c <= 0xFFFD or c >= 0x10000)


def escape_ooxml(s: str) -> str:
    s = _ESCAPED.sub(lambda m: "_x005F_" + m.group(0)[1:], s)
    return "".join(ch if _xml_ok(ch) else f"_x{ord(ch):04X}_" for ch in s)


def unescape_ooxml(s: str) -> str:
    return _ESCAPED.sub(lambda m: chr(int(m.group(1), 16)), s)


_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.'
       'spreadsheetml.sheet.main+xml"/>'
       '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-'
       'officedocument.spreadsheetml.worksheet+xml"/></Types>')
_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
         '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
         'officeDocument" Target="xl/workbook.xml"/></Relationships>')
_WB = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
       'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
       '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
_WB_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
            'relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(escape_ooxml(v))}</t></is></c>'


def column_name(i: int) -> str:
    """0 -> A, 25 -> Z, 26 -> AA."""
    name = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        name = chr(65 + r) + name
    return name


def _pieces(v) -> list:
    """A text too long for a cell as consecutive pieces that fit; anything else as it is."""
    if isinstance(v, str) and 2 * len(v) > MAX_CELL_UNITS and len(v.encode("utf-16-le")) // 2 > MAX_CELL_UNITS:
        return [v[i:i + PART_CHARS] for i in range(0, len(v), PART_CHARS)]
    return [v]


def sheet_bytes(header: str, cells) -> bytes:
    """A workbook whose first column is ``header`` then ``cells`` (None = empty).

    A text longer than a cell may be is never cut: it goes on in the columns
    ``<header>+1``, ``<header>+2``, ... of its row, which the reader joins again.
    """
    parts, widest = [], 1
    for i, v in enumerate(cells, start=2):
        if i > MAX_SHEET_ROWS:
            raise ValueError(f"a worksheet holds at most {MAX_SHEET_ROWS} rows")
        pieces = _pieces(v)
        widest = max(widest, len(pieces))
        row = "".join(_cell(f"{column_name(k)}{i}", x) for k, x in enumerate(pieces))
        parts.append(f'<row r="{i}">{row}</row>')
    names = [header, *[f"{header}+{k}" for k in range(1, widest)]]
    parts.insert(0, '<row r="1">' + "".join(_cell(f"{column_name(k)}1", x) for k, x in enumerate(names)) + "</row>")
    sheet = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
             f'<sheetData>{"".join(parts)}</sheetData></worksheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CT)
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/workbook.xml", _WB)
        z.writestr("xl/_rels/workbook.xml.rels", _WB_RELS)
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()
