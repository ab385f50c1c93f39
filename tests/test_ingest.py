import pathlib
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, StringStartsWith

from quarterdeck.config import LABEL_COLUMN, SHEET_TITLES, UNIT_COLUMN, ItemRules
from quarterdeck.functions.text import clean_name, cleaned
from quarterdeck.operators.panel import merge_panel
from quarterdeck.plans.ingest import ingest, land_cells
from quarterdeck.sources.tables import formula_list, read_dictionary, read_formulas
from quarterdeck.sources import workbooks
from quarterdeck.sources.statements import statement_facts, statement_items
from quarterdeck.sources.workbooks import Wanted, good_cells, quarantine, read_workbooks, workbook_cells
from quarterdeck.workloads.scans import workbook_bytes
from tests.helpers import rows


def sheet(headers, lines, date="01/02/2024"):
    top = [["Company"], [f"Ngày xuất dữ liệu: {date}"], ["-"], ["-"], ["-"], ["-"], ["-"], ["-"]]
    return top + [["Chỉ tiêu", "Đơn vị", *headers]] + lines


def book(entity, headers, numbers, date="01/02/2024", skip=()):
    sheets = {}
    for key, title in SHEET_TITLES.items():
        if key not in skip:
            body = [["Section"], [f"{key} a", "VND", *numbers], ["Other section", None], [f"{key} b", "VND", *["x" for _ in numbers]]]
            sheets[f"{title} - {entity}"] = sheet(headers, body, date)
    return workbook_bytes(sheets)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("books")

    def put(name, content):
        path = pathlib.Path(root, name)
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(content)

    put("data-quarterly/Report AAA old.xlsx", book("AAA", ["Q1 2023", "Q2 2023"], [1, 2], "01/02/2023"))
    put("data-quarterly/Report AAA new.xlsx", book("AAA", ["Q1 2023", "Q3 2023"], [10, 30]))
    put("data-yearly/Report AAA.xlsx", book("AAA", ["2023"], [100]))
    put("data-cumulative/Report BBB.xlsx", book("BBB", ["6M 2023"], [7]))
    put("data-quarterly/~$Report AAA new.xlsx", b"lock")
    put("data-quarterly/Broken CCC.xlsx", b"PK not a zip")
    put("data-quarterly/Partial DDD.xlsx", book("DDD", ["Q1 2023"], [1], skip=("NOTES",)))
    put("data-quarterly/Undated EEE.xlsx", book("EEE", ["Q1 2023"], [1], date="soon"))
    return str(root)


def test_bulk_read_keeps_going(spark, folder):
    cells = read_workbooks(spark, folder, titles=list(SHEET_TITLES.values()))
    assert {r["file"] for r in good_cells(cells).select("file").distinct().collect()} == {
        "Report AAA old.xlsx", "Report AAA new.xlsx", "Report AAA.xlsx", "Report BBB.xlsx", "Undated EEE.xlsx",
    }
    bad = {r["file"]: r["error"] for r in quarantine(cells).collect()}
    assert set(bad) == {"Broken CCC.xlsx", "Partial DDD.xlsx", "~$Report AAA new.xlsx"}
    assert "BadZipFile" in bad["Broken CCC.xlsx"] and "Thuyết minh" in bad["Partial DDD.xlsx"]
    only = read_workbooks(spark, folder, name_part="BBB")
    assert only.select("file").distinct().count() == 1


def test_ingest_to_panel(spark, folder, tmp_path):
    done = ingest(land_cells(spark, folder, str(tmp_path / "cells")))
    values = {(r["freq"], r["entity"], r["item"], r["period"]): r["value"] for r in done.facts.collect()}
    assert values["quarterly", "AAA", "BS_1", "2023_q1"] == 10.0  # newest export
    assert values["quarterly", "AAA", "BS_1", "2023_q2"] == 2.0  # only in the older one
    assert values["quarterly", "AAA", "NOTES_2", "2023_q3"] is None  # text in a number cell
    assert values["yearly", "AAA", "IS_1", "2023_q4"] == 100.0
    assert values["cumulative", "BBB", "CF_1", "2023_q2"] == 7.0
    assert not any(k[1] == "EEE" for k in values)
    assert {r["file"] for r in done.rejected.collect()} == {
        "Broken CCC.xlsx", "Partial DDD.xlsx", "Undated EEE.xlsx", "~$Report AAA new.xlsx",
    }
    labels = {(r["item"], r["label"]) for r in done.structure.collect()}
    assert labels == {(f"{k}_{n}", f"{k} {x}") for k in SHEET_TITLES for n, x in ((1, "a"), (2, "b"))}
    facts = done.facts.select("freq", "entity", "item", "year", "quarter", "value")
    merged = {(r["entity"], r["item"], r["quarter"]): r["value"] for r in merge_panel(facts, ItemRules()).collect()}
    assert merged["AAA", "IS_1", 3] == 42.0 and merged["AAA", "BS_1", 3] == 30.0 and merged["AAA", "IS_1", 4] == 100.0


def test_used_range_shared_strings_and_kinds():
    """A sheet that starts at C3, with shared text, a boolean, an error and a far column."""
    import io

    buffer = io.BytesIO()
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="S" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId7" Target="/xl/worksheets/a.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><r><t>two </t></r><r><t>runs</t></r></si></sst>")
        z.writestr(
            "xl/worksheets/a.xml",
            f'<worksheet {main}><sheetData><row r="3"><c r="D3" t="s"><v>0</v></c><c r="E3"/></row>'
            '<row r="5"><c r="C5" t="b"><v>1</v></c><c r="D5" t="e"><v>#DIV/0!</v></c><c r="AB5"><v>1.5</v></c></row>'
            "</sheetData></worksheet>",
        )
    assert list(workbook_cells(buffer.getvalue())) == [
        ("S", 0, 1, "two runs", None), ("S", 2, 0, "true", None), ("S", 2, 25, "1.5", None),
    ]


def lines(*entities, change=lambda key, rows: rows):
    """A quarterly workbook with the four sheets of each entity."""
    body = lambda k, e: [[f"{k} a", "VND", float(len(e))]]
    named = {f"{t} - {e}": change(k, sheet(["Q1 2023"], body(k, e))) for e in entities for k, t in SHEET_TITLES.items()}
    return workbook_bytes(named)


def changed(key, how):
    return lambda k, rows: how(rows) if k == key else rows


def put_all(root, files):
    for name, content in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    return str(root)


def reasons(rejected):
    """File and kind of error: all of a reject that names a sheet key or has no kind, else what stands before the colon."""
    kind = lambda e: e.split(":")[0] if e[1:2].islower() else e
    return {(r["file"].split(".")[0], kind(r["error"])) for r in rejected.collect()}


def test_every_file_ends_in_facts_or_rejects(spark, tmp_path):
    files = {
        "data-quarterly/AAA.xlsx": lines("AAA"),
        "data-quarterly/BBB.XLSX": lines("BBB"),
        "data-quarterly/CCC.xls": b"old format",
        "data-quarterly/notes.txt": b"text",
        "data-quarterly/DDD.xlsx": lines("DDD", change=changed("BS", lambda r: [r[0], ["-"], *r[1:]])),  # header one row lower, no date
        "data-quarterly/EEE.xlsx": lines("EEE", change=changed("IS", lambda r: [*r[:8], ["Chỉ tiêu", "Khác", "Q1 2023"], *r[9:]])),
        "data-quarterly/FFF.xlsx": lines("FFF", change=changed("CF", lambda r: r[:9])),
        "data-quarterly/GGG.xlsx": lines("GGG", change=changed("NOTES", lambda r: [])),
        "data-quarterly/HHH.xlsx": lines("HHH", change=changed("BS", lambda r: [*r[:8], [*r[8], "Oops"], *r[9:]])),
        "data-quarterly/III.xlsx": lines("III", change=changed("IS", lambda r: [*r[:8], ["Tên", *r[8][1:]], *r[9:]])),
        "data-quarterly/JJJ.xlsx": lines("JJJ", change=changed("IS", lambda r: r[:8])),
        "elsewhere/KKK.xlsx": lines("KKK"),
        "data-yearly/LLL.xlsm": b"PK broken",
        "data-yearly/MMM.xlsx": b"",
        "data-yearly/_NNN.xlsx": lines("NNN"),
        "data-yearly/.hidden/OOO.xlsx": b"",
        "data-yearly/~$PPP.xlsx": b"lock",
        "data-yearly/QQQ.xlsx": lines("QQQ", change=lambda k, r: []),
        "top.xlsx": lines("top"),
    }
    done = ingest(land_cells(spark, put_all(tmp_path / "in", files), str(tmp_path / "cells")))
    assert reasons(done.rejected) == {
        ("CCC", "UnsupportedFile"), ("notes", "UnsupportedFile"), ("DDD", "no export date"), ("EEE", "IS: no unit column"),
        ("FFF", "CF: no line item"), ("GGG", "EmptySheet"), ("HHH", "BS: unreadable period oops"),
        ("III", "IS: no label column"), ("JJJ", "IS: no header row"), ("KKK", "no frequency folder"), ("LLL", "BadZipFile"),
        ("MMM", "EmptyFile"), ("~$PPP", "LockFile"), ("QQQ", "EmptySheet"), ("OOO", "EmptyFile"),
        ("top", "no frequency folder"),
    }
    facts = done.facts.filter("year is not null").select("entity").distinct().collect()
    assert {r["entity"] for r in facts} == {"AAA", "BBB", "EEE", "FFF", "GGG", "HHH", "III", "JJJ", "NNN"}


def test_frequency_is_the_folder_below_the_root(spark, tmp_path):
    root = tmp_path / "quarterly-run"
    files = {
        "data-yearly/AAA quarterly.xlsx": lines("AAA"),
        "2023/Cumulative/x/BBB.xlsx": lines("BBB"),
        "quarterly/old-yearly/CCC.xlsx": lines("CCC"),
        "yearlyish/DDD.xlsx": lines("DDD"),
    }
    done = ingest(land_cells(spark, put_all(root, files), str(tmp_path / "cells")))
    assert {(r["freq"], r["entity"]) for r in done.facts.collect()} == {("yearly", "AAA"), ("cumulative", "BBB")}
    assert reasons(done.rejected) == {("CCC", "several frequency folders"), ("DDD", "no frequency folder")}


def test_two_entities_and_repeated_cells_in_one_workbook(spark, tmp_path):
    twice = workbook_bytes(
        {f"{t} - RRR": sheet(["Q1 2023"], [[f"{k} a", "VND", 1.0], [f"{k} b", "VND", 2.0]]) for k, t in SHEET_TITLES.items()},
        repeat=f"{SHEET_TITLES['IS']} - RRR",
    )
    lacking = {f"{t} - BBB": sheet(["Q1 2023"], [["a", "VND", 1.0]]) for k, t in SHEET_TITLES.items() if k != "CF"}
    with_both = {f"{t} - AAA": sheet(["Q1 2023"], [[f"{k} a", "VND", 5.0]]) for k, t in SHEET_TITLES.items()} | lacking
    files = {
        "quarterly/AAA and BBBB.xlsx": lines("AAA", "BBBB"),
        "quarterly/CCC.xlsx": lines("CCC", "DDD"),
        "quarterly/AAA BBB.xlsx": workbook_bytes(with_both | {"Remarks": [["free text"]]}),
        "quarterly/RRR.xlsx": twice,
    }
    done = ingest(land_cells(spark, put_all(tmp_path / "in", files), str(tmp_path / "cells")))
    values = {(r["entity"], r["item"]): r["value"] for r in done.facts.collect()}
    assert values["BBBB", "NOTES_1"] == 4.0 and values["CCC", "BS_1"] == 3.0 and values["RRR", "IS_1"] == 1.0
    assert {e for e, _ in values} == {"AAA", "BBBB", "CCC", "RRR"}
    assert reasons(done.rejected) == {("CCC", "OtherEntity"), ("AAA BBB", "MissingSheets"), ("RRR", "RepeatedCell")}


def test_repeated_cells_of_any_cell_table(spark):
    cells = [("f", "S", r, c, t) for r, row in enumerate([["Chỉ tiêu", "Đơn vị", "Q1 2023"], ["a", "VND", "2"], ["b", "VND", "7"]]) for c, t in enumerate(row)]
    cells += [("f", "S", 1, 2, "10"), ("f", "S", 0, 2, "Q1 2023")]
    frame = spark.createDataFrame(cells, "file string, sheet string, row_pos long, col_pos int, text string")
    facts = statement_facts(statement_items(frame, header_row=0))
    assert rows(facts.select("item", "period", "value")) == [("S_1", "2023_q1", 10.0), ("S_2", "2023_q1", 7.0)]


def test_structure_leaves_value_cells_unread(spark, tmp_path, monkeypatch):
    content = book("AAA", ["Q1 2023", "Q2 2023"], [1, 2])
    read = []
    monkeypatch.setattr(workbooks, "_cell_text", lambda cell, shared, real=workbooks._cell_text: read.append(real(cell, shared)) or read[-1])
    every = list(workbook_cells(content, "AAA.xlsx", Wanted(tuple(SHEET_TITLES.values()))))
    n_all = len(read)
    read.clear()
    wanted = Wanted(tuple(SHEET_TITLES.values()), columns=(LABEL_COLUMN, UNIT_COLUMN))
    narrow = list(workbook_cells(content, "AAA.xlsx", wanted))
    assert n_all == len(every) and len(read) == len(narrow) == n_all - 4 * 4
    assert not {"1", "2", "x"} & set(read)
    assert set(narrow) < set(every)
    root = put_all(tmp_path / "in", {"quarterly/AAA.xlsx": content, "yearly/AAA.xlsx": book("AAA", ["2023", "total"], [1, 2])})
    whole = ingest(land_cells(spark, root, str(tmp_path / "whole")))
    pruned = ingest(land_cells(spark, root, str(tmp_path / "pruned"), structure_only=True))
    assert rows(whole.structure) == rows(pruned.structure) and len(rows(pruned.structure)) == 16
    assert rows(whole.rejected) == rows(pruned.rejected) and len(rows(pruned.rejected)) == 4


def test_filters_reach_the_source(spark, tmp_path):
    root = put_all(
        tmp_path / "in",
        {"quarterly/AAA.xlsx": lines("AAA"), "yearly/AAA.xlsx": lines("AAA"), "yearly/BAD.xlsx": b"PK broken", "cumulative/BAD.xlsx": b"PK broken"},
    )
    cells = read_workbooks(spark, root, titles=list(SHEET_TITLES.values()), by_frequency=True)
    assert {r["path"].removeprefix(root) for r in cells.filter("freq = 'quarterly'").select("path").distinct().collect()} == {"/quarterly/AAA.xlsx"}
    assert cells.filter("freq IN ('yearly', 'cumulative') AND error IS NOT NULL").count() == 2
    assert cells.filter("sheet = 'Thuyết minh - AAA'").select("sheet", "freq").distinct().count() == 2
    reader = workbooks.WorkbookReader({"path": root, "by_frequency": "true"})
    list(reader.pushFilters([EqualTo(("freq",), "yearly"), StringStartsWith(("file",), "A"), EqualTo(("sheet",), "x")]))
    assert [f.path for p in reader.partitions() for f in p.files] == [f"{root}/yearly/AAA.xlsx"]
    wanted = Wanted(sheet=lambda name: name.startswith("Thuy"))
    assert {c[0] for c in workbook_cells(lines("AAA"), "AAA.xlsx", wanted)} == {"Thuyết minh - AAA"}


def test_partitions_hold_whole_files_of_bounded_size():
    files = [workbooks.WorkbookFile(f"{k}", f"{k}", size, None, error) for k, (size, error) in enumerate([(5, None), (6, None), (100, "x"), (4, None), (20, None), (1, None)])]
    parts = workbooks.in_partitions(files, 10, 3)
    assert [[f.path for f in p.files] for p in parts] == [["0"], ["1", "2", "3"], ["4"], ["5"]]


@pytest.mark.parametrize("damage", ["<row r='5'><c r='A5'><v>1</v></c></row><row r='3'><c r='A3'><v>1</v></c></row>", "<row r='1'><c r='1A'><v>1</v></c></row>"])
def test_damaged_sheets_are_the_files_verdict(damage):
    import io

    with zipfile.ZipFile(io.BytesIO(workbook_bytes({"S": [["a"]]}))) as good:
        parts = {n: good.read(n) for n in good.namelist()}
    parts["xl/worksheets/sheet1.xml"] = f"<worksheet><sheetData>{damage}</sheetData></worksheet>".encode()
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for n, c in parts.items():
            z.writestr(n, c)
    with pytest.raises((ValueError, AttributeError)):
        list(workbook_cells(buffer.getvalue()))


def test_names_are_cleaned_alike_before_and_after_they_are_rows(spark):
    names = ["Chỉ tiêu", "Đơn vị", "Q1 2023", " (A/B): c-d,e.f?  g\u00a0h ", "l'été’s", "Ñandú_ü", "số dư", "ABC"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(clean_name(F.col("n"))).collect()]
    assert got == [cleaned(n) for n in names]


def test_formula_and_dictionary_tables(spark, tmp_path):
    (tmp_path / "f.csv").write_text('Chỉ tiêu,Công thức tính,Tên sheet\nA,"round(IS_1, 2)",S\n"B, b",BS_1,T\n', encoding="utf-8")
    (tmp_path / "d.csv").write_text('﻿"rowid","chi_tieu"\n"BS_1","\'=x"\n', encoding="utf-8")
    formulas = formula_list(read_formulas(spark, str(tmp_path / "f.csv")))
    assert [(f.metric, f.text, f.sheet) for f in formulas] == [("A", "round(IS_1, 2)", "S"), ("B, b", "BS_1", "T")]
    assert rows(read_dictionary(spark, str(tmp_path / "d.csv"))) == [("BS_1", "'=x")]


def test_small_sheets_are_parsed_once_and_large_ones_streamed(monkeypatch):
    content = book("AAA", ["Q1 2023", "Q2 2023"], [1, 2])
    opened = []
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, name, *a, real=zipfile.ZipFile.open, **b: opened.append(str(name)) or real(self, name, *a, **b))
    wanted = Wanted(tuple(SHEET_TITLES.values()))
    once = list(workbook_cells(content, "AAA.xlsx", wanted))
    assert sum("worksheets" in name for name in opened) == len(SHEET_TITLES)
    opened.clear()
    monkeypatch.setattr(workbooks, "HELD_BYTES", 0)
    assert list(workbook_cells(content, "AAA.xlsx", wanted)) == once
    assert sum("worksheets" in name for name in opened) == 2 * len(SHEET_TITLES)


def test_small_files_share_a_batch(folder):
    reader = workbooks.WorkbookReader({"path": folder, "titles": '["' + '", "'.join(SHEET_TITLES.values()) + '"]'})
    (partition,) = reader.partitions()
    (batch,) = reader.read(partition)
    assert len(set(batch["path"].to_pylist())) == len(partition.files) == 8


def test_many_files_go_into_a_bounded_number_of_partitions(tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "PARTITION_FILES", 1)
    monkeypatch.setattr(workbooks, "MANY_PARTITIONS", 2)
    for n in range(7):
        pathlib.Path(tmp_path, f"{n}.xlsx").write_bytes(b"x")
    assert [len(p.files) for p in workbooks.WorkbookReader({"path": str(tmp_path)}).partitions()] == [4, 3]


def test_line_items_are_found_once(spark, folder, tmp_path):
    done = ingest(land_cells(spark, folder, str(tmp_path / "cells")))
    for frame in (done.facts, done.structure, done.rejected):
        assert "collect_list" not in frame._jdf.queryExecution().executedPlan().toString()
