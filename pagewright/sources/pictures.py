"""Overlays and workbooks in plain numpy and standard library: boxes drawn on images, bitmaps, table sheets."""

from __future__ import annotations

import io
import re
import struct
import zipfile
from collections.abc import Sequence
from html import unescape
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_boxes(image: np.ndarray, boxes: Sequence[Sequence[float]], colours: Sequence[Sequence[int]], width: int = 2) -> np.ndarray:
    """A copy with boxes filled by their colour (r, g, b, opacity of 255) and outlined by it; image in BGR."""
    out = image.astype(float)
    h, w = image.shape[:2]
    for (x1, y1, x2, y2), (r, g, b, opacity) in zip(boxes, colours, strict=True):
        x1, y1, x2, y2 = (int(np.clip(v, 0, m)) for v, m in ((x1, w), (y1, h), (x2, w), (y2, h)))
        if x1 >= x2 or y1 >= y2:
            continue
        share, colour = opacity / 255, np.array([b, g, r], float)
        out[y1:y2, x1:x2] = out[y1:y2, x1:x2] * (1 - share) + colour * share
        for part in (out[y1 : y1 + width, x1:x2], out[max(y1, y2 - width) : y2, x1:x2], out[y1:y2, x1 : x1 + width], out[y1:y2, max(x1, x2 - width) : x2]):
            part[:] = colour
    return np.rint(out).astype(np.uint8)


def draw_order(image: np.ndarray, boxes: Sequence[Sequence[float]], colour: Sequence[int] = (255, 0, 0)) -> np.ndarray:
    """A copy with a line from the centre of each box to that of the next."""
    out = image.copy()
    centres = [((b[0] + b[2]) / 2, (b[1] + b[3]) / 2) for b in boxes]
    for (x1, y1), (x2, y2) in zip(centres, centres[1:], strict=False):
        n = int(max(abs(x2 - x1), abs(y2 - y1))) + 1
        x, y = np.rint(np.linspace(x1, x2, n)).astype(int), np.rint(np.linspace(y1, y2, n)).astype(int)
        inside = (x >= 0) & (x < out.shape[1]) & (y >= 0) & (y < out.shape[0])
        out[y[inside], x[inside]] = colour[::-1]
    return out


def colour_map(n: int) -> list[tuple[int, int, int]]:
    """n colours (r, g, b) that differ: the bits of a number spread over the high bits of the channels."""
    out = []
    for k in range(n):
        channels, bits = [0, 0, 0], k
        for shift in range(8):
            for c in range(3):
                channels[c] |= (bits >> c & 1) << (7 - shift)
            bits >>= 3
        out.append(tuple(channels))
    return out


def bitmap(image: np.ndarray) -> bytes:
    """A BMP file of a BGR image."""
    h, w = image.shape[:2]
    rows = np.zeros((h, -(-w * 3 // 4) * 4), np.uint8)
    rows[:, : w * 3] = image[::-1, :, :3].reshape(h, -1)
    return b"BM" + struct.pack("<IHHI", 54 + rows.size, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, rows.size, 2835, 2835, 0, 0) + rows.tobytes()


# --- workbooks -------------------------------------------------------------------------------


def table_cells(html: str) -> list[tuple[int, int, int, int, str]]:
    """(row, column, rows, columns, text) of a table's cells, placed so that spans above and to the left keep their room."""
    taken: set[tuple[int, int]] = set()
    found = []
    for r, tr in enumerate(re.findall(r"(?is)<tr\b[^>]*>(.*?)</tr>", html)):
        c = 0
        for attributes, inner in re.findall(r"(?is)<t[dh]\b([^>]*)>(.*?)</t[dh]>", tr):
            while (r, c) in taken:
                c += 1
            span = {k.lower(): max(1, int(v)) for k, v in re.findall(r"(?i)\b(rowspan|colspan)\s*=\s*[\"']?(\d+)", attributes)}
            rows, columns = span.get("rowspan", 1), span.get("colspan", 1)
            taken.update((r + i, c + j) for i in range(rows) for j in range(columns))
            text = unescape(re.sub(r"<[^>]+>", "", re.sub(r"(?i)<br\s*/?>", "\n", inner))).strip()
            found.append((r, c, rows, columns, text))
            c += columns
    return found


def _reference(row: int, column: int) -> str:
    name, column = "", column + 1
    while column:
        column, rest = divmod(column - 1, 26)
        name = chr(65 + rest) + name
    return f"{name}{row + 1}"


_NUMBER = re.compile(r"-?(?:0|[1-9]\d{0,14})(?:\.\d+)?")
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def _sheet(html: str) -> str:
    cells = table_cells(html)
    rows: dict[int, list[str]] = {}
    for r, c, _, _, text in sorted(cells):
        clean = escape(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text))
        at = _reference(r, c)
        rows.setdefault(r, []).append(f'<c r="{at}"><v>{text}</v></c>' if _NUMBER.fullmatch(text) else f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{clean}</t></is></c>')
    data = "".join(f'<row r="{r + 1}">{"".join(v)}</row>' for r, v in sorted(rows.items()))
    merged = [f'<mergeCell ref="{_reference(r, c)}:{_reference(r + h - 1, c + w - 1)}"/>' for r, c, h, w, _ in cells if h > 1 or w > 1]
    merges = f'<mergeCells count="{len(merged)}">{"".join(merged)}</mergeCells>' if merged else ""
    return f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{_MAIN}"><sheetData>{data}</sheetData>{merges}</worksheet>'


def workbook(tables: Sequence[str]) -> bytes:
    """An XLSX file with a sheet for each table's HTML, spans merged, numbers as numbers; without tables one empty sheet."""
    sheets = list(tables) or [""]
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    n = range(1, len(sheets) + 1)
    parts = {
        "[Content_Types].xml": f'{head}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        + "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in n)
        + "</Types>",
        "_rels/.rels": f'{head}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>' + "".join(f'<sheet name="Table {k}" sheetId="{k}" r:id="rId{k}"/>' for k in n) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in n) + "</Relationships>",
    } | {f"xl/worksheets/sheet{k}.xml": _sheet(html) for k, html in zip(n, sheets, strict=True)}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in parts.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), content)  # the same bytes for the same tables
    return out.getvalue()


def workbooks(tables: Column) -> Column:
    """XLSX bytes of an array of table HTML."""

    @F.arrow_udf("binary")
    def made(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else workbook([t or "" for t in x]) for x in lists.to_pylist()], pa.binary())

    return made(tables)
