"""Sources: workbooks, statement sheets, exports."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from functools import cache, lru_cache
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from quarterdeck.config import SHEET_TITLES
from quarterdeck.operators.exports import dedup_latest_export, prefer_reports
from quarterdeck.plans.ingest import ingest, land_cells
from quarterdeck.session import scratch_path
from quarterdeck.sources import statements as S
from quarterdeck.sources.workbooks import good_cells, read_workbooks
from quarterdeck.workloads.panels import PART_ITEMS_SQL, cents, part_cells, r4, table

_EPOCH = (1980, 1, 1, 0, 0, 0)


@lru_cache(1 << 14)
def _letters(column: int) -> str:
    name = ""
    while column:
        column, rest = divmod(column - 1, 26)
        name = chr(65 + rest) + name
    return name


def workbook_bytes(sheets: dict[str, list[list]], repeat: str | None = None) -> bytes:
    """A minimal xlsx file for fixtures: text and number cells, None leaves a cell out.

    Sheet `repeat` gives the last number of its last but one row twice, the second time as another.
    """
    books = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
    rels = "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
    relations = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:

        def add(name: str, text: str) -> None:
            book.writestr(zipfile.ZipInfo(name, _EPOCH), text.encode())

        add("xl/workbook.xml", f'<workbook xmlns:r="{relations}"><sheets>{books}</sheets></workbook>')
        add("xl/_rels/workbook.xml.rels", f"<Relationships>{rels}</Relationships>")
        for i, (name, rows) in enumerate(sheets.items(), 1):
            lines = []
            for r, row in enumerate(rows, 1):
                cells = []
                for c, value in enumerate(row, 1):
                    if isinstance(value, str):
                        cells.append(f'<c r="{_letters(c)}{r}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
                    elif value is not None:
                        cells.append(f'<c r="{_letters(c)}{r}"><v>{value}</v></c>')
                if name == repeat and r == len(rows) - 1:
                    cells.append(f'<c r="{_letters(len(row))}{r}"><v>-1</v></c>')
                if cells:
                    lines.append(f'<row r="{r}">{"".join(cells)}</row>')
            add(f"xl/worksheets/sheet{i}.xml", f"<worksheet><sheetData>{''.join(lines)}</sheetData></worksheet>")
    return buffer.getvalue()


#: What is wrong with the workbooks of some suppliers, by supplier number modulo 20: (remainder, frequency, reason).
FAULTS = (
    (1, "quarterly", "OtherEntity"), (2, "quarterly", "RepeatedCell"), (3, "quarterly", "BadZipFile"),
    (4, "quarterly", "LockFile"), (5, "yearly", "MissingSheets"), (6, "cumulative", "EmptyFile"),
    (7, "quarterly", "UnsupportedFile"), (8, "yearly", "no frequency folder"), (9, "cumulative", "several frequency folders"),
    (11, "quarterly", "no export date"), (12, "yearly", "IS: no header row"), (13, "cumulative", "CF: no label column"),
    (14, "quarterly", "NOTES: no unit column"), (15, "yearly", "BS: no line item"), (16, "cumulative", "EmptySheet"),
    (17, "quarterly", "BS: unreadable period total"),
)


def _sheet_rows(key: str, supplier: int, frame: list[tuple[str, int, int]], fault: str) -> list[list]:
    """Rows of a statement sheet from (header, money, lines); a fault that names the sheet, or the sheet of its kind, is put in."""
    top = [["Report"], ["-" if fault == "no export date" else f"Exported: 0{supplier % 9 + 1}/03/2024"], *[["-"]] * 6]
    header = ["Chỉ tiêu", "Đơn vị", *(h for h, _, _ in frame)]
    money, lines = [int(m) for _, m, _ in frame], [n if n % 5 else "n/a" for _, _, n in frame]
    body = [[f"{key} section"], [f"{key} money", "VND", *money], [f"{key} lines", "count", *lines]]
    where, _, what = fault.partition(": ")
    if fault == "EmptySheet" and key == "IS":
        return []
    if where == key:
        if what == "no header row":
            return top
        if what == "no line item":
            return [*top, header]
        if what == "no label column":
            header = ["Tên", *header[1:]]
        if what == "no unit column":
            header = [header[0], "Khác", *header[2:]]
        if what.startswith("unreadable"):
            header = [*header, "Total"]
    return [*top, header, *body]


def _by_year(quarters: list[dict]) -> dict[int, tuple[int, int]]:
    """Money and lines of every year."""
    years: dict[int, tuple[int, int]] = {}
    for q in quarters:
        money, lines = years.get(q["year"], (0, 0))
        years[q["year"]] = money + q["money"], lines + q["lines"]
    return years


def _supplier_books(supplier: int, quarters: list[dict]) -> Iterator[tuple[str, bytes]]:
    """The workbooks of one supplier, given one row per quarter: path below the root and content."""
    quarters = sorted(quarters, key=lambda q: (q["year"], q["quarter"]))
    entity = f"S{supplier}"
    headed = {
        "quarterly": [(f"Q{q['quarter']} {q['year']}", q["money"], q["lines"]) for q in quarters],
        "yearly": [(str(year), *sums) for year, sums in _by_year(quarters).items()],
        "cumulative": [(f"6M {year}", *sums) for year, sums in _by_year([q for q in quarters if q["quarter"] <= 2]).items()],
    }
    for freq, frame in headed.items():
        fault = next((f for k, where, f in FAULTS if k == supplier % 20 and where == freq), "")
        sheets = {f"{t} - {entity}": _sheet_rows(k, supplier, frame, fault) for k, t in SHEET_TITLES.items()}
        folder, name = f"data-{freq}", f"{entity}.xlsx"
        if fault == "MissingSheets":
            del sheets[f"{SHEET_TITLES['NOTES']} - {entity}"]
        elif fault == "OtherEntity":
            sheets |= {f"{t} - X{supplier}": _sheet_rows(k, supplier, frame, "") for k, t in SHEET_TITLES.items()}
        elif fault == "UnsupportedFile":
            name = f"{entity}.xls"
        elif fault == "no frequency folder":
            folder = "misc"
        elif fault == "several frequency folders":
            folder += "/old-yearly"
        elif fault == "LockFile":
            yield f"{folder}/~${name}", b"lock"
        content = workbook_bytes(sheets, repeat=f"{SHEET_TITLES['BS']} - {entity}" if fault == "RepeatedCell" else None)
        if fault in ("BadZipFile", "EmptyFile"):
            content = b"not a workbook" if fault == "BadZipFile" else b""
        yield f"{folder}/{name}", content


def _supplier_quarters(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .select(
            F.col("l_suppkey").alias("supplier"),
            F.year("l_shipdate").alias("year"),
            F.quarter("l_shipdate").alias("quarter"),
            cents("l_extendedprice").alias("cents"),
        )
        .groupBy("supplier", "year", "quarter")
        .agg(F.sum("cents").alias("money"), F.count("*").alias("lines"), F.max("cents").alias("top"))
    )


@cache
def _store_of(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


@lru_cache(1 << 10)
def _made(folder: str, below: str) -> str:
    """A folder, made once by a worker."""
    store, root = _store_of(folder)
    store.create_dir(f"{root}/{below}", recursive=True)
    return f"{root}/{below}"


def put_file(folder: str, relative: str, content: bytes) -> str:
    """Write a file below a shared folder; a task that runs again writes the same."""
    below, _, name = relative.rpartition("/")
    with _store_of(folder)[0].open_output_stream(f"{_made(folder, below)}/{name}") as stream:
        stream.write(content)
    return relative


_ON_DISK: dict[tuple[str, str, str], str] = {}


def written_once(kind: str, spark, sf: str, build) -> str:
    """The folder of files that are built from the tables once in a session."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _ON_DISK:
        folder = scratch_path(spark, kind)
        build(folder)
        _ON_DISK[key] = folder
    return _ON_DISK[key]


def workbook_folder(spark, sf) -> str:
    """Three workbooks per supplier on disk, below a root whose own name holds a frequency. A supplier is one row.

    The rows are few but each costs Python time, so the number of tasks is fixed rather than left to AQE.
    """

    def build(folder: str) -> None:
        def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(batch["supplier"].to_pylist(), batch["quarters"].to_pylist(), strict=True)
                paths = [put_file(folder, path, content) for k, q in rows for path, content in _supplier_books(int(k), q)]
                yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string())})

        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        quarters = _supplier_quarters(spark, sf).repartition(tasks, "supplier")
        suppliers = quarters.groupBy("supplier").agg(F.collect_list(F.struct("year", "quarter", "money", "lines")).alias("quarters"))
        suppliers.mapInArrow(put, "path string").write.format("noop").mode("overwrite").save()

    return written_once("quarterly-run", spark, sf, build)


def _read(spark, sf):
    titles = list(SHEET_TITLES.values())
    return read_workbooks(spark, workbook_folder(spark, sf), titles=titles, by_frequency=True)


def _below(spark, sf):
    """Path below the root."""
    return F.replace(F.col("path"), F.lit(workbook_folder(spark, sf)), F.lit(""))


def workbook_cells(spark, sf):
    """Filled cells per file and sheet, with a sum of the numeric ones."""
    cells = good_cells(_read(spark, sf)).withColumn("path", _below(spark, sf))
    number = F.when(F.col("text").rlike(r"^\d+$") & (F.col("row_pos") > 8), F.col("text").try_cast("bigint"))
    return cells.groupBy("file", "path", "freq", "sheet").agg(
        F.count("*").alias("n_cells"),
        F.max("row_pos").alias("last_row"),
        F.max("col_pos").alias("last_col"),
        F.sum(number).alias("total"),
    )


def _ingested(spark, sf):
    return ingest(land_cells(spark, workbook_folder(spark, sf), scratch_path(spark, "cells")))


def rejected_files(spark, sf):
    """Path and reason of everything that ingest rejects, whatever its kind."""
    reason = F.when(F.col("error").startswith("several"), F.split_part("error", F.lit(":"), F.lit(1))).otherwise(
        F.when(F.col("error").rlike("^[A-Z][a-z]"), F.split_part("error", F.lit(":"), F.lit(1))).otherwise(F.col("error"))
    )
    return _ingested(spark, sf).rejected.select(_below(spark, sf).alias("path"), reason.alias("reason"))


def freq_union(spark, sf):
    """Facts of all suppliers and frequencies from one landed cell table, no loop."""
    return _ingested(spark, sf).facts.select("freq", "entity", "item", "label", "period", "value")


def yearly_files(spark, sf):
    """One frequency's cells: the files of the others are not opened."""
    cells = good_cells(_read(spark, sf)).filter(F.col("freq") == "yearly")
    return cells.groupBy("file").agg(F.count_distinct("sheet").alias("sheets"))


_FAULT_ROWS = ", ".join(f"({k}, '{freq}', '{fault}')" for k, freq, fault in FAULTS)
WORKBOOKS_SQL = f"""
sq AS (
  SELECT l_suppkey AS supplier, year(l_shipdate) AS year, quarter(l_shipdate) AS quarter,
    sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS money, count(*) AS lines FROM lineitem GROUP BY 1, 2, 3),
books AS (
  SELECT supplier, 'quarterly' AS freq, year, year || '_q' || quarter AS period, money, lines FROM sq
  UNION ALL SELECT supplier, 'yearly', year, year || '_q4', sum(money), sum(lines) FROM sq GROUP BY supplier, year
  UNION ALL SELECT supplier, 'cumulative', year, year || '_q2', sum(money), sum(lines) FROM sq
    WHERE quarter <= 2 GROUP BY supplier, year),
faults(k, freq, fault) AS (VALUES {_FAULT_ROWS}),
files AS (
  SELECT s.supplier, f.freq, coalesce(x.fault, '') AS fault
  FROM (SELECT DISTINCT supplier FROM sq) s CROSS JOIN (VALUES ('quarterly'), ('yearly'), ('cumulative')) f(freq)
  LEFT JOIN faults x ON x.k = s.supplier % 20 AND x.freq = f.freq),
readable AS (
  SELECT *, '/data-' || freq || '/S' || supplier || '.xlsx' AS tail FROM files
  WHERE fault NOT IN ('BadZipFile', 'MissingSheets', 'EmptyFile', 'UnsupportedFile', 'no frequency folder', 'several frequency folders')),
sheets(key, title) AS (VALUES ('BS', 'Cân đối kế toán'), ('IS', 'Báo cáo thu nhập'),
  ('CF', 'Lưu chuyển tiền tệ'), ('NOTES', 'Thuyết minh')),
read_sheets AS (
  SELECT * FROM readable CROSS JOIN sheets WHERE NOT (fault = 'EmptySheet' AND key = 'IS')),
fact_sheets AS (
  SELECT * FROM read_sheets WHERE fault <> 'no export date' AND NOT (starts_with(fault, key || ': ') AND fault NOT LIKE '%unreadable%'))"""


def sheet_to_long(spark, sf):
    facts = S.statement_facts(S.statement_items(part_cells(spark, sf)))
    return facts.select("file", "sheet", "item", "label", "period", "value")


def rowid_assign(spark, sf):
    return S.statement_items(part_cells(spark, sf)).select("file", "sheet", "row_pos", "item")


def structure_scan(spark, sf):
    return S.structure_of(S.statement_items(part_cells(spark, sf)))


def export_date(spark, sf):
    """Export date of every (brand, type) sheet, each taken as a file of its own."""
    cells = part_cells(spark, sf).withColumn("file", F.concat_ws("/", "file", "sheet")).withColumn("sheet", F.lit("BS"))
    return S.export_dates(cells.withColumn("entity", F.col("file"))).drop("entity")


def _event_exports(spark, sf):
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return table(spark, sf, "events").select(
        "user_id", "event_type", "ts", "event_id", value.alias("value"), (F.col("event_id") % 2).alias("report_rank")
    )


def latest_export(spark, sf):
    newest = dedup_latest_export(
        _event_exports(spark, sf), ["user_id", "event_type"], "ts", "event_id", ["event_id", "value"]
    )
    return newest.withColumn("value", r4("value"))


def report_preference(spark, sf):
    chosen = prefer_reports(
        _event_exports(spark, sf), ["user_id", "event_type"], "report_rank", "ts", "event_id",
        ["report_rank", "event_id", "value"],
    )
    return chosen.withColumn("value", r4("value"))


QUERIES = {
    "src_workbook_cells": (
        workbook_cells,
        f"""WITH {WORKBOOKS_SQL},
        counted AS (
          SELECT r.*, coalesce(b.n, 0) AS n, b.total, starts_with(r.fault, r.key || ': ') AS here
          FROM read_sheets r
          LEFT JOIN (SELECT supplier, freq, count(*) AS n,
                            CAST(sum(money) + coalesce(sum(CASE WHEN lines % 5 <> 0 THEN lines END), 0) AS BIGINT) AS total
                     FROM books GROUP BY supplier, freq) b ON b.supplier = r.supplier AND b.freq = r.freq)
        SELECT 'S' || supplier || '.xlsx' AS file, tail AS path, freq, title || ' - S' || supplier AS sheet,
          CASE WHEN here AND fault LIKE '%no header row' THEN 8 WHEN here AND fault LIKE '%no line item' THEN 8 + 2 + n
            ELSE 8 + 2 + 1 + 2 * 2 + 3 * n + CAST(here AND fault LIKE '%unreadable%' AS INT) END AS n_cells,
          CAST(CASE WHEN here AND fault LIKE '%no header row' THEN 7 WHEN here AND fault LIKE '%no line item' THEN 8 ELSE 11 END AS BIGINT) AS last_row,
          CAST(CASE WHEN here AND fault LIKE '%no header row' THEN 0
            ELSE 1 + n + CAST(here AND fault LIKE '%unreadable%' AS INT) END AS INT) AS last_col,
          CASE WHEN NOT (here AND (fault LIKE '%no header row' OR fault LIKE '%no line item')) THEN total END AS total
        FROM counted""",
    ),
    "src_quarantine": (
        rejected_files,
        f"""WITH {WORKBOOKS_SQL}
        SELECT CASE fault WHEN 'UnsupportedFile' THEN '/data-quarterly/S' || supplier || '.xls'
            WHEN 'LockFile' THEN '/data-quarterly/~$S' || supplier || '.xlsx'
            WHEN 'no frequency folder' THEN '/misc/S' || supplier || '.xlsx'
            WHEN 'several frequency folders' THEN '/data-cumulative/old-yearly/S' || supplier || '.xlsx'
            ELSE '/data-' || freq || '/S' || supplier || '.xlsx' END AS path, fault AS reason
        FROM files WHERE fault <> ''""",
    ),
    "src_yearly_files": (
        yearly_files,
        f"""WITH {WORKBOOKS_SQL}
        SELECT 'S' || supplier || '.xlsx' AS file, count(DISTINCT key) AS sheets FROM read_sheets WHERE freq = 'yearly' GROUP BY 1""",
    ),
    "src_freq_union": (
        freq_union,
        f"""WITH {WORKBOOKS_SQL}
        SELECT b.freq, 'S' || b.supplier AS entity, r.key || '_1' AS item,
          r.key || ' money' AS label, b.period,
          CAST(b.money AS DOUBLE) AS value
        FROM books b JOIN fact_sheets r ON b.supplier = r.supplier AND b.freq = r.freq
        UNION ALL
        SELECT b.freq, 'S' || b.supplier, r.key || '_2', r.key || ' lines', b.period,
          CASE WHEN b.lines % 5 <> 0 THEN CAST(b.lines AS DOUBLE) END
        FROM books b JOIN fact_sheets r ON b.supplier = r.supplier AND b.freq = r.freq""",
    ),
    "src_sheet_to_long": (
        sheet_to_long,
        f"""WITH {PART_ITEMS_SQL}
        SELECT file, sheet, item, label, '2024_q1' AS period, CAST(p_size AS DOUBLE) AS value FROM kept
        UNION ALL SELECT file, sheet, item, label, '2024_q2', price FROM kept""",
    ),
    "src_rowid_assign": (rowid_assign, f"WITH {PART_ITEMS_SQL} SELECT file, sheet, row_pos, item FROM kept"),
    "src_structure_scan": (structure_scan, f"WITH {PART_ITEMS_SQL} SELECT file, sheet, item, label FROM kept"),
    "src_export_date": (
        export_date,
        """SELECT p_brand || '/' || p_type AS file, CASE WHEN length(p_brand) + length(p_type) <= 12
             THEN make_date(2024, CAST(length(p_brand) + length(p_type) AS INT), 15) END AS export_date
           FROM (SELECT DISTINCT p_brand, p_type FROM part) p""",
    ),
    "src_report_preference": (
        report_preference,
        """SELECT user_id, event_type, event_id % 2 AS report_rank, event_id,
             round(CASE WHEN event_id % 7 <> 0 THEN value END, 4) AS value
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                 ORDER BY event_id % 2, ts DESC, event_id) AS rn FROM events) e WHERE rn = 1""",
    ),
    "dedup_latest_export": (
        latest_export,
        """SELECT user_id, event_type, event_id, round(CASE WHEN event_id % 7 <> 0 THEN value END, 4) AS value
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                 ORDER BY ts DESC, event_id) AS rn FROM events) e WHERE rn = 1""",
    ),
}
