"""Cells of workbooks and tables of text documents, read from their zipped XML.

Both formats bound their own size (a sheet has 1,048,576 rows at most), so they are read
on the driver, one sheet at a time.
"""

from __future__ import annotations

import datetime
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from pathlib import Path

#: Name spaces of the two formats (fixed values).
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: Numbers of the built-in date formats of a workbook (fixed values).
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
DAY_ZERO = datetime.datetime(1899, 12, 30)


def _root(book: zipfile.ZipFile, name: str) -> ET.Element | None:
    return ET.fromstring(book.read(name)) if name in book.namelist() else None


def sheet_parts(path: str | Path) -> dict[str, str]:
    """Of each visible sheet of a workbook, in its order: the name and the file inside."""
    with zipfile.ZipFile(path) as book:
        links = {r.get("Id"): r.get("Target", "") for r in _root(book, "xl/_rels/workbook.xml.rels").iter(f"{PACKAGE}Relationship")}
        sheets = _root(book, "xl/workbook.xml").iter(f"{SHEET}sheet")
        own = {s.get("name"): links[s.get(RELATION)] for s in sheets if s.get("state", "visible") == "visible"}
    return {name: part.lstrip("/") if part.startswith("/") else f"xl/{part}" for name, part in own.items()}


def _column(reference: str) -> int:
    """Column number, from 0, of a cell's reference such as ``AB12``."""
    at = 0
    for c in reference:
        if not c.isalpha():
            break
        at = at * 26 + ord(c.upper()) - 64
    return at - 1


def _dated_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date."""
    styles = _root(book, "xl/styles.xml")
    if styles is None:
        return set()
    made = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{SHEET}numFmt")}
    shows_day = lambda code: bool(re.search(r"[dmyhs]", re.sub(r"\[[^\]]*\]|\"[^\"]*\"|\\.", "", code), re.I))
    cells = styles.find(f"{SHEET}cellXfs")
    kinds = [int(x.get("numFmtId", 0)) for x in cells] if cells is not None else []
    return {i for i, k in enumerate(kinds) if k in DATE_FORMATS or shows_day(made.get(k, ""))}


def _as_day(number: str) -> str:
    moment = DAY_ZERO + datetime.timedelta(seconds=round(float(number) * 86400))
    return moment.date().isoformat() if moment.time() == datetime.time() else moment.isoformat(" ")


def sheet_rows(path: str | Path, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The rows of a sheet (the first one by default) as texts, empty cells null."""
    parts = sheet_parts(path)
    if sheet is not None and sheet not in parts:
        raise KeyError(f"no sheet {sheet!r} in {path}")
    with zipfile.ZipFile(path) as book:
        texts = _root(book, "xl/sharedStrings.xml")
        shared = ["".join(t.text or "" for t in s.iter(f"{SHEET}t")) for s in (texts if texts is not None else ())]
        dated = _dated_styles(book)
        with book.open(parts[sheet] if sheet is not None else next(iter(parts.values()))) as stream:
            for _, row in ET.iterparse(stream):
                if row.tag != f"{SHEET}row":
                    continue
                cells: dict[int, str] = {}
                for i, cell in enumerate(row.iter(f"{SHEET}c")):
                    kind, value = cell.get("t"), cell.findtext(f"{SHEET}v")
                    if kind == "inlineStr":
                        value = "".join(t.text or "" for t in cell.iter(f"{SHEET}t"))
                    elif kind == "s" and value is not None:
                        value = shared[int(value)]
                    elif kind == "b" and value is not None:
                        value = "true" if value == "1" else "false"
                    elif kind in (None, "n") and value is not None and int(cell.get("s", 0)) in dated:
                        value = _as_day(value)
                    if value not in (None, ""):
                        cells[_column(cell.get("r")) if cell.get("r") else i] = value
                yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]
                row.clear()


def document_tables(path: str | Path) -> list[list[list[str]]]:
    """The tables of a text document (``.docx``): rows of cell texts."""
    with zipfile.ZipFile(path) as book:
        body = _root(book, "word/document.xml")
    text = lambda cell: "\n".join("".join(t.text or "" for t in p.iter(f"{WORD}t")) for p in cell.iter(f"{WORD}p")).strip()
    return [[[text(c) for c in row.findall(f"{WORD}tc")] for row in table.findall(f"{WORD}tr")] for table in body.iter(f"{WORD}tbl")]


def document_text(path: str | Path) -> str:
    """The paragraphs of a text document, one a line."""
    with zipfile.ZipFile(path) as book:
        body = _root(book, "word/document.xml")
    return "\n".join("".join(t.text or "" for t in p.iter(f"{WORD}t")) for p in body.iter(f"{WORD}p"))


def records(rows: list[list[str | None]]) -> list[dict[str, str]]:
    """Rows under the names of the first row that has any cell; unnamed columns are left out."""
    filled = [r for r in rows if any(c not in (None, "") for c in r)]
    if not filled:
        return []
    names = [str(c).strip() if c not in (None, "") else None for c in filled[0]]
    return [{n: c or "" for n, c in zip(names, [*r, *[None] * (len(names) - len(r))]) if n} for r in filled[1:]]
