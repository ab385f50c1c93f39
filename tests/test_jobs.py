"""Files in, files out."""

import datetime
import pathlib

import pytest
from pyspark.sql import functions as F

from quarterdeck.config import PeerGroup
from quarterdeck.operators.panel import QUARTERLY, merge_panel
from quarterdeck.plans import jobs as J
from quarterdeck.plans.reports import single_entity_ytd
from quarterdeck.config import ItemRules
from quarterdeck.workloads.scans import workbook_bytes
from tests.helpers import facts, rows
from tests.test_ingest import book

FORMULAS = 'Chỉ tiêu,Công thức tính,Tên sheet\nTổng tài sản,BS_1,Assets\nYield,IS_1 / BS_1,Ratios\nWrong,IS_77 * 2,Ratios\n'
PEERS = J.Peers((PeerGroup("all", "Mean %d", "Sum %d"),), {"all": ["AAA", "BBB"]}, ["AAA"], ["AAA", "BBB"])


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    root = pathlib.Path(tmp_path_factory.mktemp("jobs"))
    for name, content in {
        "in/data-quarterly/AAA.xlsx": book("AAA", ["Q1 2023", "Q2 2023"], [1, 2]),
        "in/data-quarterly/BBB.xlsx": book("BBB", ["Q1 2023"], [3]),
        "in/data-quarterly/ZZZ.xlsx": book("ZZZ", ["Q1 2023"], [99]),
        "in/data-yearly/AAA.xlsx": book("AAA", ["2023"], [8]),
        "in/data-cumulative/AAA.xlsx": b"broken",
        "manual/data_manual.xlsx": workbook_bytes({"M2": [["Item", "Year", "Month", "Số dư"], ["Tiền gửi A", 2024, 1, 5],
                                                         ["Tiền gửi B", 2024, 1, 2.5], ["Khác", 2024, 1, 9], ["Tiền gửi A", 2024, 2, 4]]}),
    }.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    (root / "f.csv").write_text(FORMULAS, encoding="utf-8")
    return root


def test_metrics_job(spark, place, tmp_path):
    out = J.metrics_job(spark, str(place / "in"), str(place / "f.csv"), str(tmp_path / "w"), str(tmp_path / "o"), PEERS)
    values = {(r["table_name"], r["yq"], r["name"]): r["value"] for r in out["metrics"].collect()}
    assert values["tong_tai_san", "2023-04-01", "AAA"] == 2.0
    assert values["tong_tai_san", "2023-10-01", "AAA"] == 8.0
    assert values["yield", "2023-04-01", "AAA"] == 1.5
    assert values["tong_tai_san", "2023-01-01", "Mean 2"] == 2.0 and values["tong_tai_san", "2023-01-01", "Sum 2"] == 4.0
    assert {k[2] for k in values} == {"AAA", "Mean 2", "Sum 2"}
    assert [r["metric"] for r in out["formula_errors"].collect()] == ["Wrong"]
    assert [r["file"] for r in out["rejected"].collect()] == ["AAA.xlsx"]
    assert (tmp_path / "o" / "metrics" / "sheet=Ratios" / "table_name=yield").is_dir()
    script = spark.read.text(str(tmp_path / "o" / "sql" / "create" / "table=yield")).collect()
    inserted = spark.read.text(str(tmp_path / "o" / "sql" / "rows" / "table=yield")).collect()
    assert inserted and all(r[0].startswith('INSERT INTO "yield" ("yq", "name", "value") VALUES (') for r in inserted)
    assert script[1][0] == 'CREATE TABLE "yield" ("yq" TEXT, "name" TEXT, "value" REAL);'


def test_metrics_job_replaces_tables_and_leaves_no_scratch(spark, place, tmp_path):
    from quarterdeck.session import shared_dir

    scratch = pathlib.Path(shared_dir(spark).removeprefix("file:")) / "quarterdeck"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    try:
        out = J.metrics_job(
            spark, str(place / "in"), str(place / "f.csv"), str(tmp_path / "w"), str(tmp_path / "o"), PEERS, tables=str(tmp_path / "t")
        )
        assert out["table_errors"].count() == 0
        want = out["metrics"].filter("table_name = 'yield'").select("yq", "name", "value")
        assert rows(spark.table("yield")) == rows(want) and spark.table("tong_tai_san").columns == ["yq", "name", "value"]
        assert not {p for p in scratch.iterdir() if p not in before} and out["clashes"].count() == 0 and out["rejected"].count() == 1
    finally:
        for t in ("yield", "tong_tai_san"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_structure_and_lineage_jobs(spark, place, tmp_path):
    out = J.structure_job(spark, str(place / "in"), str(place / "f.csv"), str(tmp_path / "w"), str(tmp_path / "o"))
    assert out["gate"].first()["publish"] and out["critical"].count() == 0
    assert out["gate"].first()["n_rejected"] == 1 and [r["file"] for r in out["rejected"].collect()] == ["AAA.xlsx"]
    missing = J.lineage_job(spark, str(place / "f.csv"), str(tmp_path / "o" / "dictionary"), str(tmp_path / "o"))
    assert rows(missing.select("metric", "item")) == [("Wrong", "IS_77")]
    written = spark.read.option("header", True).csv(str(tmp_path / "o" / "formula_definitions"))
    assert ("Yield", "IS_1:IS a | BS_1:BS a") in rows(written.select("metric", "definition"))


def test_raw_panel_job(spark, place, tmp_path):
    done = J.raw_panel_job(spark, str(place / "in"), str(tmp_path / "w"), str(tmp_path / "raw"))
    wide = done["panel"]
    assert [r["file"] for r in done["rejected"].collect()] == ["AAA.xlsx"]
    assert wide.columns == ["item", "label", "entity", "2023_q1", "2023_q2"]
    assert rows(wide.filter("item = 'BS_1'").select("entity", "2023_q1", "2023_q2")) == [("AAA", 1.0, 2.0), ("BBB", 3.0, None), ("ZZZ", 99.0, None)]


def test_monthly_job(spark, place):
    out = J.monthly_job(spark, str(place / "manual"), "M2", F.col("item").contains("Tiền gửi"), "so_du", "deposits")
    assert [tuple(r) for r in out.collect()] == [(datetime.date(2024, 1, 1), 7.5), (datetime.date(2024, 2, 1), 4.0)]


def test_monthly_job_publishes_or_fails(spark, place, tmp_path):
    keep = F.col("item").contains("Tiền gửi")
    try:
        J.monthly_job(spark, str(place / "manual"), "M2", keep, "so_du", "deposits_out", published=str(tmp_path / "p"))
        assert rows(spark.table("deposits_out")) == [("2024-01-01", 7.5), ("2024-02-01", 4.0)]
        assert (tmp_path / "p" / "sql" / "create").is_dir()
    finally:
        spark.sql("DROP TABLE IF EXISTS deposits_out")
    with pytest.raises(ValueError, match="BadZipFile"):
        J.monthly_job(spark, str(place / "in" / "data-cumulative"), "M2", keep, "so_du", "none")


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    facts(spark, [("A", "IS_1", "2023_q1", 1)]).withColumn("freq", F.lit(QUARTERLY)).write.parquet(path)
    stored = spark.read.parquet(path)

    def scans(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in text.split("\n") if "FileScan" in line]

    plan = scans(merge_panel(stored, ItemRules(), ["IS_1", "BS_1"]))
    assert any("In(item, [BS_1,IS_1])" in line for line in plan)
    calendar = [line for line in plan if "In(item" not in line]
    assert calendar and all("ReadSchema: struct<entity:string,year:int,quarter:int,freq:string>" in line for line in calendar)
    single = scans(single_entity_ytd(stored.drop("freq"), "A", 2023, 3, ItemRules()))
    assert single and all("EqualTo(entity,A)" in line for line in single)


def test_facts_are_never_shuffled_by_entity_alone(spark, tmp_path):
    """Without broadcasts: one scan of the values, exchanges by (entity, item), and only keys and calendars by entity."""
    import re

    from quarterdeck.operators.series import derive_series

    path = str(tmp_path / "facts")
    facts(spark, [("A", "IS_1", "2023_q1", 1), ("B", "BS_1", "2023_q2", 2)]).withColumn("freq", F.lit(QUARTERLY)).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        panel = merge_panel(spark.read.parquet(path), ItemRules(), ["IS_1", "BS_1"])
        plan = derive_series(panel, ItemRules())._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((.*?), \d+\)", plan)
    keys = [(re.sub(r"#\d+L?", "", columns).split(", "), re.sub(r"#\d+L?", "", by)) for columns, by in exchanges]
    assert any(by == "entity, item" and "value" in columns for columns, by in keys)
    assert not any(by == "entity" and {"value", "v1", "low"} & set(columns) for columns, by in keys)
    scans = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    # one for the quarterly reports and one for the others, which are disjoint
    assert sum("value" in s for s in scans) == 2
