"""Roster workbooks, every cell as text.

The only row-level Python in the library.  An XLSX file is a zip of XML parts; the sheet is
parsed as a stream, so a task holds one Arrow batch of rows, not the sheet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SHEET = "Roster"
HEADER_START = "Facility ID"
BATCH_ROWS = 5000


def read_workbooks(spark: SparkSession, pattern: str | list[str], columns: Sequence[str], sheet: str = SHEET,
                   header_start: str = HEADER_START) -> DataFrame:
    """Rows below the header of ``sheet``; workbooks without that sheet are skipped.

    The header is the first row whose first cell is ``header_start``; title rows above and blank
    rows below are dropped.  Cells are matched to ``columns`` by normalised header name.  Files are parsed by the tasks
    that read them (no shuffle of their bytes); a task holds what ``spark.sql.files.maxPartitionBytes`` gives it, or one file.
    """
    wanted = list(columns)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from wardflow.sources.workbook import sheet_rows
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                name, rows = path.rsplit("/", 1)[-1], []
                for row in sheet_rows(content, sheet, header_start):
                    rows.append([row.get(c) for c in wanted] + [name])
                    if len(rows) == BATCH_ROWS:
                        yield pd.DataFrame(rows, columns=[*wanted, "_file"], dtype=object)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=[*wanted, "_file"], dtype=object)

    files = spark.read.format("binaryFile").load(pattern).select("path", "content")
    schema = ", ".join(f"`{c}` string" for c in [*wanted, "_file"])
    return files.mapInPandas(parse, schema)


def sheet_rows(content: bytes, sheet: str, header_start: str) -> Iterator[dict[str, str | None]]:
    """Data rows of one workbook as ``{normalised header: text}``."""
    import io
    import zipfile

    from wardflow.functions.parsing import normal_name

    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part = _sheet_part(book, sheet)
        if part is None:
            return
        shared, date_styles = _shared_strings(book), _date_styles(book)
        header = None
        for cells in _cells(book, part, shared, date_styles):
            if header is None:
                if cells.get(0) == header_start:
                    header = {i: normal_name(v) for i, v in cells.items() if v}
            elif any(v is not None for v in cells.values()):
                yield {name: cells.get(i) for i, name in header.items()}


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _tree(book, part):
    from xml.etree import ElementTree
    return ElementTree.fromstring(book.read(part))


def _sheet_part(book, sheet: str) -> str | None:
    link = None
    for node in _tree(book, "xl/workbook.xml").iter():
        if _local(node.tag) == "sheet" and node.get("name") == sheet:
            link = next(v for k, v in node.attrib.items() if k.endswith("}id"))
    if link is None:
        return None
    for node in _tree(book, "xl/_rels/workbook.xml.rels"):
        if node.get("Id") == link:
            target = node.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return None


def _shared_strings(book) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return ["".join(t.text or "" for t in item.iter() if _local(t.tag) == "t")
            for item in _tree(book, "xl/sharedStrings.xml")]


def _date_styles(book) -> set[str]:
    """Style numbers that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    tree, custom = _tree(book, "xl/styles.xml"), {}
    for node in tree.iter():
        if _local(node.tag) == "numFmt":
            custom[node.get("numFmtId")] = node.get("formatCode", "").lower()
    dates = {str(n) for n in [*range(14, 23), *range(45, 48)]}
    dates |= {k for k, code in custom.items() if "y" in code or "d" in code}
    for node in tree:
        if _local(node.tag) == "cellXfs":
            return {str(i) for i, xf in enumerate(node) if xf.get("numFmtId") in dates}
    return set()


def _cells(book, part, shared, date_styles) -> Iterator[dict[int, str | None]]:
    from datetime import datetime, timedelta
    from xml.etree import ElementTree

    def text_of(cell) -> str | None:
        kind = cell.get("t")
        if kind == "inlineStr":
            value = "".join(t.text or "" for t in cell.iter() if _local(t.tag) == "t")
        else:
            value = next((v.text for v in cell if _local(v.tag) == "v"), None)
            if value is not None and kind == "s":
                value = shared[int(value)]
            elif value is not None and kind is None and cell.get("s") in date_styles:
                moment = datetime(1899, 12, 30) + timedelta(days=float(value))
                value = moment.strftime("%Y-%m-%d" if moment.time() == datetime.min.time()
                                        else "%Y-%m-%d %H:%M:%S")
        return value if value not in (None, "") else None

    def column_of(reference: str) -> int:
        number = 0
        for letter in reference:
            if not letter.isalpha():
                break
            number = number * 26 + ord(letter.upper()) - 64
        return number - 1

    with book.open(part) as stream:
        for _, node in ElementTree.iterparse(stream):
            if _local(node.tag) == "row":
                row = {}
                for i, cell in enumerate(node):
                    row[column_of(cell.get("r")) if cell.get("r") else i] = text_of(cell)
                yield row
                node.clear()
