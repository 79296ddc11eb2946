"""Workbooks (XLSX) as a Spark data source, read and written with the standard library.

``spark.read.format("workbook").load(path)`` gives ``path, ord, cells`` of the
first sheet of every file; ``df.write.format("workbook")`` writes one file per
task from the frame's columns, into a folder that all machines share. Register both once per session with
``register(spark)``.
"""

from __future__ import annotations

import glob
import os
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
#: The most rows and the longest sheet name that the format allows.
MOST_ROWS, NAME_LENGTH = 1_048_576, 31
#: What XML 1.0 can't carry.
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def column_name(number: int) -> str:
    """1 -> A, 28 -> AB."""
    out = ""
    while number > 0:
        number, digit = divmod(number - 1, 26)
        out = chr(ord("A") + digit) + out
    return out


def column_number(reference: str) -> int:
    """AB12 -> 28; 1 if there are no letters."""
    number = 0
    for c in reference:
        if not c.isalpha():
            break
        number = number * 26 + ord(c.upper()) - ord("A") + 1
    return number or 1


def sheet_names(names: Iterable[str]) -> list[str]:
    """Allowed, distinct names: illegal signs replaced, cut to length, ``_2``, ``_3`` on a clash."""
    out: list[str] = []
    taken: set[str] = set()
    for raw in names:
        base = re.sub(r"[\[\]:*?/\\]", "_", raw or "").strip("'")[:NAME_LENGTH] or "Sheet"
        name, n = base, 1
        while name.lower() in taken:
            n += 1
            tail = f"_{n}"
            name = base[: NAME_LENGTH - len(tail)] + tail
        taken.add(name.lower())
        out.append(name)
    return out


def _sheet(headers: Sequence[str], rows: Iterable[Sequence[object]]) -> Iterator[str]:
    yield f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{MAIN}"><sheetData>'
    for r, row in enumerate((headers, *rows), 1):
        cells = (
            f'<c r="{column_name(c)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(_CONTROL.sub("", str(v)))}</t></is></c>'
            for c, v in enumerate(row, 1)
            if v is not None and str(v) != ""
        )
        yield f'<row r="{r}">{"".join(cells)}</row>'
    yield "</sheetData></worksheet>"


def write_workbook(path: str, sheets: Sequence[tuple[str, Sequence[str], Sequence[Sequence[object]]]]) -> None:
    """A workbook of ``(name, headers, rows)`` sheets; one empty sheet if there are none."""
    sheets = list(sheets) or [("Sheet1", [], [])]
    for name, _, rows in sheets:
        if len(rows) >= MOST_ROWS:
            raise ValueError(f"sheet {name!r} has more rows than the format allows; write several files")
    names = sheet_names(s[0] for s in sheets)
    numbers = range(1, len(sheets) + 1)
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{SHEET_TYPE}.worksheet+xml"/>' for i in numbers)
    listed = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in zip(numbers, names))
    linked = "".join(f'<Relationship Id="rId{i}" Type="{RELS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
    files = {
        "[Content_Types].xml": f'{head}<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{SHEET_TYPE}.sheet.main+xml"/>{parts}</Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="{PACKAGE}/relationships">{linked}</Relationships>',
    }
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in files.items():
            z.writestr(name, body)
        for i, (_, headers, rows) in zip(numbers, sheets):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                for piece in _sheet(headers, rows):
                    f.write(piece.encode("utf-8", "replace"))


def read_first_sheet(path: str) -> Iterator[list[str]]:
    """Rows of the first sheet, gaps filled by cell references; shared and inline strings alike."""
    tag = lambda name: f"{{{MAIN}}}{name}"
    with zipfile.ZipFile(path) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter(tag("t"))))
        with z.open("xl/worksheets/sheet1.xml") as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != tag("row"):
                    continue
                cells: list[str] = []
                for c in row.iter(tag("c")):
                    at = column_number(c.get("r", "")) if c.get("r") else len(cells) + 1
                    cells += [""] * (at - 1 - len(cells))
                    value = c.find(tag("v"))
                    if c.get("t") == "s" and value is not None and (value.text or "").isdigit():
                        n = int(value.text)
                        cells.append(shared[n] if n < len(shared) else "")
                    elif c.get("t") == "inlineStr":
                        cells.append("".join(t.text or "" for t in c.iter(tag("t"))))
                    else:
                        cells.append(value.text or "" if value is not None else "")
                yield cells
                row.clear()


def _files(path: str) -> list[str]:
    path = path.removeprefix("file://")
    return sorted(glob.glob(os.path.join(path, "**", "*.xlsx"), recursive=True) if os.path.isdir(path) else glob.glob(path))


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in _files(self.path)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition is None or partition.value is None:
            return
        for i, cells in enumerate(read_first_sheet(partition.value)):
            yield partition.value, i - 1, cells


@dataclass
class _Written(WriterCommitMessage):
    path: str


class _Writer(DataSourceWriter):
    def __init__(self, path: str, columns: list[str], sheet: str) -> None:
        self.path, self.columns, self.sheet = path.removeprefix("file://"), columns, sheet

    def write(self, rows: Iterator) -> _Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        target = os.path.join(self.path, f"part-{context.partitionId():05d}-{context.taskAttemptId()}.xlsx")
        write_workbook(target, [(self.sheet, self.columns, [tuple(r) for r in rows])])
        return _Written(target)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        kept = {m.path for m in messages if m}
        if lost := sorted(p for p in kept if not os.path.exists(p)):
            raise ValueError(f"{lost[0]} was written on another machine; workbooks need a folder that all machines share")
        for f in glob.glob(os.path.join(self.path, "part-*.xlsx")):
            if f not in kept and os.path.basename(f).count("-") == 2:
                os.remove(f)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            if m and os.path.exists(m.path):
                os.remove(m.path)


class WorkbookSource(DataSource):
    """``workbook``: first sheets as ``path, ord, cells``; ``ord`` is -1 for the header row."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return "path string, ord long, cells array<string>"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:  # noqa: ANN001
        return _Writer(self.options["path"], schema.fieldNames(), self.options.get("sheet", "Sheet1"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)
