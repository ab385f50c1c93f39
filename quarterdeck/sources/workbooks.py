"""Workbook files as a data source: one table of cells.

The source lists a folder in full, files of no bytes, of other kinds and lock files included, and plans partitions of
whole files of a bounded size. Every file ends in cells or in a row that says why not. What a query does not need is left
out as early as it is known: files by folder and name before they are opened, sheets before they are parsed, and below the
header the columns that are not asked for before their cells are read. The decoder is the only Python on a data path; it
reads the few parts of the xlsx container that hold text and numbers and streams the cells of a sheet.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from fnmatch import fnmatchcase
from functools import lru_cache
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith

from quarterdeck.config import HEADER_ROW
from quarterdeck.functions.text import cleaned

CELLS_SCHEMA = (
    "path string, file string, freq string, sheet string, row_pos bigint, col_pos int, text string, error string"
)
_ARROW = pa.schema(
    [("path", pa.string()), ("file", pa.string()), ("freq", pa.string()), ("sheet", pa.string()), ("row_pos", pa.int64()),
     ("col_pos", pa.int32()), ("text", pa.string()), ("error", pa.string())]
)
_BATCH_ROWS = 20000
#: Bytes of a workbook's sheets that are parsed once and held; what is beyond is streamed, twice.
HELD_BYTES = 1 << 20
#: Bytes and files of a partition; a larger file is a partition by itself. Beyond so many partitions they hold more files.
PARTITION_BYTES, PARTITION_FILES, MANY_PARTITIONS = 32 << 20, 64, 512
#: Suffixes of the container that the decoder reads; a file of any other kind is rejected unread. Fixed values.
DECODED = (".xlsx", ".xlsm")
#: Start of the names of files that an open workbook leaves beside it. Fixed value.
LOCK = "~$"
FREQUENCIES = ("quarterly", "yearly", "cumulative")
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


# --- the container --------------------------------------------------------------------------------------------------------


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _joined_text(element) -> str:
    return "".join(t.text or "" for t in element.iter() if _tag(t) == "t")


def _sheet_parts(book: zipfile.ZipFile) -> dict[str, str]:
    """Sheet name -> archive member."""
    targets = {}
    for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        target = rel.attrib["Target"]
        targets[rel.attrib["Id"]] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    parts = {}
    for element in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _tag(element) == "sheet":
            rel_id = next(v for k, v in element.attrib.items() if k.endswith("}id"))
            if element.attrib["name"] in parts:
                raise ValueError(f"two sheets named {element.attrib['name']}")
            parts[element.attrib["name"]] = targets[rel_id]
    return parts


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return [_joined_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]


def _raw(cell) -> str | None:
    for v in cell:
        if v.tag.endswith("v"):
            return v.text
    return None


def _is_filled(cell, shared: Sequence[str]) -> bool:
    """Whether `_cell_text` would find a text, without making one."""
    kind = cell.attrib.get("t", "n")
    if kind == "inlineStr":
        for t in cell.iter():
            if t.text and _tag(t) == "t":
                return True
        return False
    raw = _raw(cell)
    return raw is not None and kind != "e" and (kind != "s" or bool(shared[int(raw)]))


def _cell_text(cell, shared: Sequence[str]) -> str:
    """Text of a filled cell."""
    kind = cell.attrib.get("t", "n")
    if kind == "inlineStr":
        return _joined_text(cell)
    raw = _raw(cell)
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "true" if raw == "1" else "false"
    return raw


@lru_cache(1 << 16)
def _place(reference: str) -> tuple[int, int]:
    """1-based row and column."""
    letters, number = _CELL_REF.fullmatch(reference).groups()
    column = 0
    for letter in letters:
        column = column * 26 + ord(letter) - 64
    return int(number), column


def _rows(book: zipfile.ZipFile, part: str, whole: bool) -> Iterator[ElementTree.Element]:
    """Row elements of a sheet. One that is not parsed as a whole drops them from memory as they are read."""
    if whole:
        yield from (e for e in ElementTree.fromstring(book.read(part)).iter() if e.tag.endswith("row"))
        return
    with book.open(part) as stream:
        for _, element in ElementTree.iterparse(stream):
            if element.tag.endswith("row"):
                yield element
                element.clear()


def _filled_cells(
    book: zipfile.ZipFile, part: str, shared: Sequence[str], whole: bool = False
) -> Iterator[tuple[int, int, ElementTree.Element]]:
    """Filled cells with their 1-based row and column."""
    before = 0
    for element in _rows(book, part, whole):
        for cell in element:
            if _is_filled(cell, shared):
                row, column = _place(cell.attrib["r"])
                if row < before:
                    raise ValueError(f"row {row} stands below row {before}")
                before = row
                yield row, column, cell


def _used_from(cells: Iterable[tuple[int, int, object]]) -> tuple[int, int]:
    """First used row and column."""
    first_row = first_column = 0
    for row, column, _ in cells:
        first_row = min(first_row or row, row)
        first_column = min(first_column or column, column)
    return first_row, first_column


@dataclass(frozen=True)
class Wanted:
    """What is read of a workbook.

    titles: sheets are named `<title> - <entity>`, and an entity needs all of them; no other sheet is read. columns: cleaned
    names in the header row; below it, cells of other columns are passed over. sheets: plain sheets that must be there; no
    other is read. sheet: a test of the sheet's name.
    """

    titles: tuple[str, ...] = ()
    sheets: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    header_row: int = HEADER_ROW
    sheet: Callable[[str], bool] = field(default=lambda name: True)


def _chosen(names: Sequence[str], file: str, wanted: Wanted) -> tuple[list[str], list[str]]:
    """Sheets to read, and what is wrong with the others that should have been there.

    An entity's sheets count in a file that names it; others are another entity's.
    """
    if wanted.sheets:
        absent = [s for s in wanted.sheets if s not in names]
        return [n for n in names if n in wanted.sheets], [f"MissingSheets: {', '.join(absent)}"] * bool(absent)
    if not wanted.titles:
        return list(names), []
    by_entity: dict[str, dict[str, str]] = {}
    for name in names:
        for title in wanted.titles:
            if name.startswith(f"{title} - "):
                by_entity.setdefault(name[len(title) + 3 :], {})[title] = name
    if not by_entity:
        return [], [f"MissingSheets: {', '.join(wanted.titles)}"]
    sheets, errors = [], []
    for entity, found in by_entity.items():
        absent = [t for t in wanted.titles if t not in found]
        if entity not in file:
            errors.append(f"OtherEntity: {entity} is not in the file's name")
        elif absent:
            errors.append(f"MissingSheets: {entity}: {', '.join(absent)}")
        else:
            sheets += found.values()
    return sheets, errors


def workbook_cells(content: bytes, file: str = "", wanted: Wanted = Wanted()) -> Iterator[tuple]:
    """(sheet, row, column, text, error) of the filled cells, 0-based within the sheet's used range.

    The first pass finds the used ranges and so meets any damage before a cell is handed out; the second hands out the cells.
    Small sheets are parsed for both at once, others streamed, so a sheet of any size is never held. Of a cell given twice the
    first text counts; the others are errors.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        parts = _sheet_parts(book)
        sheets, errors = _chosen(list(parts), file, wanted)
        sheets = [name for name in sheets if wanted.sheet(name)]
        shared = _shared_strings(book) if sheets else []
        held: dict[str, list] = {}
        room, origins = HELD_BYTES, {}
        for name in sheets:
            size = book.getinfo(parts[name]).file_size
            if size <= room:
                room -= size
                held[name] = list(_filled_cells(book, parts[name], shared, whole=True))
            origins[name] = _used_from(held[name] if name in held else _filled_cells(book, parts[name], shared))
        if wanted.titles:  # elsewhere sheets without use are common
            errors += [f"EmptySheet: {name}" for name, used in origins.items() if used == (0, 0)]
        if not errors and not any(map(any, origins.values())):
            errors = ["NoCells: nothing to read"]
        for error in errors:
            yield None, None, None, None, error
        for name, (first_row, first_column) in origins.items():
            keep, row, seen = None, -1, set()
            if wanted.columns:
                keep = set()
            for at, column, cell in held[name] if name in held else _filled_cells(book, parts[name], shared):
                if at != row:
                    row, seen = at, set()
                if keep is not None and at - first_row > wanted.header_row and column not in keep:
                    continue
                if column in seen:
                    yield name, None, None, None, f"RepeatedCell: {name}: {cell.attrib['r']}"
                    continue
                seen.add(column)
                text = _cell_text(cell, shared)
                if keep is not None and at - first_row == wanted.header_row and cleaned(text) in wanted.columns:
                    keep.add(column)
                yield name, at - first_row, column - first_column, text, None


# --- the source -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class WorkbookFile:
    path: str
    where: str
    size: int
    freq: str | None = None
    error: str | None = None


@dataclass
class WorkbookPartition(InputPartition):
    files: list[WorkbookFile]


def frequency_folders(relative: str) -> list[str]:
    """Frequencies named by the folders of a path below the ingest root, as words; the file's own name does not count."""
    words = (w for folder in relative.split("/")[:-1] for w in re.findall(r"[a-z]+", folder.lower()))
    return [w for w in words if w in FREQUENCIES]


def list_workbooks(folder: str, name_part: str = "", by_frequency: bool = False) -> list[WorkbookFile]:
    """All files below a folder (or the one file) whose name contains `name_part`, in order, with what is wrong with them."""
    if re.match(r"file:/(?!//)", folder):
        folder = folder.removeprefix("file:")
    store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    root = root.rstrip("/")
    top = store.get_file_info(root)
    if top.type == fs.FileType.NotFound:
        raise FileNotFoundError(folder)
    infos = [top] if top.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
    found = []
    for info in sorted((i for i in infos if i.type == fs.FileType.File), key=lambda i: i.path):
        if not fnmatchcase(info.base_name, f"*{name_part}*"):
            continue
        relative = info.path[len(root) :].lstrip("/")
        path = f"{folder.rstrip('/')}/{relative}" if relative else folder
        freqs = frequency_folders(relative) if by_frequency else []
        suffix = "." + info.extension.lower() if info.extension else ""
        error = (
            "LockFile: left beside an open workbook" if info.base_name.startswith(LOCK)
            else "no frequency folder" if by_frequency and not freqs
            else f"several frequency folders: {', '.join(freqs)}" if len(freqs) > 1
            else f"UnsupportedFile: {suffix}" if suffix not in DECODED
            else "EmptyFile: 0 bytes" if not info.size
            else None
        )
        found.append(WorkbookFile(path, info.path, info.size or 0, freqs[0] if len(freqs) == 1 else None, error))
    return found


def in_partitions(files: Sequence[WorkbookFile], most_bytes: int, most_files: int) -> list[WorkbookPartition]:
    """Neighbouring files in partitions of bounded bytes and numbers; a rejected file costs no bytes."""
    partitions: list[WorkbookPartition] = []
    held = 0
    for file in files:
        size = 0 if file.error else file.size
        if not partitions or held + size > most_bytes or len(partitions[-1].files) == most_files:
            partitions.append(WorkbookPartition([]))
            held = 0
        partitions[-1].files.append(file)
        held += size
    return partitions


class WorkbookReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.name_part = options.get("name_part", "")
        self.titles = tuple(json.loads(options.get("titles", "[]")))
        self.sheets = tuple(json.loads(options.get("sheets", "[]")))
        self.columns = tuple(json.loads(options.get("columns", "[]")))
        self.header_row = int(options.get("header_row", HEADER_ROW))
        self.by_frequency = options.get("by_frequency", "false") == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Conditions on file, path and freq leave out files, those on sheet leave out sheets; Spark still applies them all."""
        for condition in filters:
            column = ".".join(getattr(condition, "attribute", ()))
            if column in ("path", "file", "freq", "sheet"):
                if isinstance(condition, EqualTo):
                    self.tests.append((column, "in", (condition.value,)))
                elif isinstance(condition, In):
                    self.tests.append((column, "in", tuple(condition.value)))
                elif isinstance(condition, StringStartsWith):
                    self.tests.append((column, "starts", condition.value))
            yield condition

    def _passes(self, column: str, value: str | None) -> bool:
        for tested, kind, wanted in self.tests:
            if tested == column and not (value is not None and (value in wanted if kind == "in" else value.startswith(wanted))):
                return False
        return True

    def partitions(self):
        files = [
            f for f in list_workbooks(self.folder, self.name_part, self.by_frequency)
            if self._passes("path", f.path) and self._passes("freq", f.freq) and self._passes("file", f.path.rsplit("/", 1)[-1])
        ]
        most_files = max(PARTITION_FILES, -(-len(files) // MANY_PARTITIONS))
        return in_partitions(files, PARTITION_BYTES, most_files) or [WorkbookPartition([])]

    def read(self, partition):
        wanted = Wanted(self.titles, self.sheets, self.columns, self.header_row, lambda name: self._passes("sheet", name))
        store = fs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder else fs.LocalFileSystem()
        held: list[tuple] = []  # of many small files
        for file in partition.files:
            name = file.path.rsplit("/", 1)[-1]
            for rows in self._rows(store, file, name, wanted):
                held += [(file.path, name, file.freq, *row) for row in rows]
                if len(held) >= _BATCH_ROWS:
                    yield self._batch(held)
                    held = []
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    def _rows(self, store: fs.FileSystem, file: WorkbookFile, name: str, wanted: Wanted) -> Iterator[list[tuple]]:
        if file.error:
            yield [(None, None, None, None, file.error)]
            return
        rows: list[tuple] = []
        try:
            with store.open_input_stream(file.where) as stream:
                content = stream.readall()
            for row in workbook_cells(content, name, wanted):
                rows.append(row)
                if len(rows) == _BATCH_ROWS:
                    yield rows
                    rows = []
        except Exception as error:  # any damage is this file's verdict
            rows = [(None, None, None, None, f"{type(error).__name__}: {error}")]
        if rows:
            yield rows


class WorkbookSource(DataSource):
    """`path` (a folder or a file) and, as options, name_part, titles, sheets and columns (JSON lists), header_row, by_frequency."""

    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def schema(self) -> str:
        return CELLS_SCHEMA

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options)


def read_workbooks(
    spark: SparkSession,
    folder: str,
    name_part: str = "",
    titles: Sequence[str] = (),
    columns: Sequence[str] = (),
    header_row: int = HEADER_ROW,
    by_frequency: bool = False,
    sheets: Sequence[str] = (),
) -> DataFrame:
    """Cells of all workbooks below `folder` whose file name contains `name_part`; every file gets cells or an error.

    `titles`, `sheets`, `columns` and `header_row` as in `Wanted`. With `by_frequency` the folders below `folder` give the column
    `freq`, and a file in none or in several of them is rejected unread. Filters on path, file, freq and sheet are pushed
    into the source, for which this session's switch for that is turned on.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WorkbookSource)
    return (
        spark.read.format("workbooks")
        .option("name_part", name_part)
        .option("titles", json.dumps(list(titles)))
        .option("sheets", json.dumps(list(sheets)))
        .option("columns", json.dumps(list(columns)))
        .option("header_row", str(header_row))
        .option("by_frequency", str(by_frequency).lower())
        .load(folder)
    )


def good_cells(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("error").isNull()).drop("error")


def quarantine(cells: DataFrame) -> DataFrame:
    """Files, entities and cells that were not read, and the reason."""
    return cells.filter(F.col("error").isNotNull()).select("path", "file", "error")
