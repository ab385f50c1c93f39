import datetime
import sqlite3

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators.numbering import number_by_order, number_by_position
from quarterdeck.plans.reports import audit_job, monthly_sum, raw_panel
from quarterdeck.sinks import sql_script as Q
from quarterdeck.sinks import writers as W
from tests.helpers import rows


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(
        [(1, True, 1.5, "it's", datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 3, 4, 5)),
         (2, None, float("nan"), None, None, None), (3, False, float("-inf"), "a;b", datetime.date(1999, 12, 31), None)],
        "i int, b boolean, x double, t string, d date, m timestamp",
    )


def test_literals(mixed):
    assert [r[0] for r in Q.row_tuples(mixed.orderBy("i")).collect()] == [
        "(1, 1, 1.5, 'it''s', '2024-01-02', '2024-01-02 03:04:05')",
        "(2, NULL, NULL, NULL, NULL, NULL)",
        "(3, 0, NULL, 'a;b', '1999-12-31', NULL)",
    ]


def test_statements_hold_at_most_200_rows_and_load(spark):
    df = spark.range(10030).select("id", F.concat(F.lit("n'"), F.col("id").cast("string")).alias("name")).repartition(3)
    statements = [r["statement"] for r in Q.insert_statements(df, "t").collect()]
    assert max(s.count("), (") + 1 for s in statements) == 200
    con = sqlite3.connect(":memory:")
    for s in Q.create_statements(df, "t") + statements:
        con.execute(s)
    assert con.execute("SELECT count(*), count(DISTINCT id), max(name) FROM t").fetchone() == (10030, 10030, "n'9999")


def test_scripts_of_many_tables_load(spark, tmp_path):
    df = spark.range(900).select("id", F.concat(F.lit("a;\n(b), 'c"), F.col("id").cast("string")).alias("name"), F.concat(F.lit('t"'), F.col("id") % 7).alias("to"))
    Q.write_scripts(df.repartition(4), "to", str(tmp_path / "s"), batch_rows=50)
    con = sqlite3.connect(":memory:")
    for kind in ("create", "rows"):
        for file in sorted((tmp_path / "s" / kind).glob("table=*/*.txt")):
            con.executescript(file.read_text(encoding="utf-8"))
    for k in range(7):
        got = con.execute(f'SELECT count(*), min(id), max(name) FROM "t""{k}"').fetchone()
        ids = [i for i in range(900) if i % 7 == k]
        assert got == (len(ids), k, max(f"a;\n(b), 'c{i}" for i in ids))


def test_every_column_is_inserted_but_the_one_that_names_the_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "a`b", 2.5, "t1"), (1, "x", "a`b", 2.5, "t1"), (3, None, "", None, "t2")], "a int, _b string, `c``d` string, _table double, _to string")
    Q.write_scripts(df, "_to", str(tmp_path / "s"))
    Q.write_script(df, "whole", str(tmp_path / "w"))
    con = sqlite3.connect(":memory:")
    for kind in ("create", "rows"):
        for file in [*sorted((tmp_path / "s" / kind).glob("table=*/*.txt")), *sorted((tmp_path / "w" / kind).glob("*.txt"))]:
            con.executescript(file.read_text(encoding="utf-8"))
    assert con.execute('SELECT "a", "_b", "c`d", "_table" FROM t1').fetchall() == [(1, "x", "a`b", 2.5)] * 2
    assert con.execute('SELECT "a", "_b", "c`d", "_table" FROM t2').fetchall() == [(3, None, "", None)]
    assert con.execute('SELECT count(*), count(DISTINCT "_to") FROM whole').fetchone() == (3, 2)


def test_scripts_of_a_rerun_are_identical(spark, tmp_path, monkeypatch):
    """Whatever the order of the input, and with one row that comes very often."""
    monkeypatch.setattr(Q, "RUN_ROWS", 70)
    rows_ = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), F.lit("x;y").alias("t"))
    texts = []
    for k, df in enumerate((rows_.repartition(5), rows_.orderBy(F.col("id").desc()), rows_.repartition(3, "id"))):
        Q.write_script(df, "t", str(tmp_path / f"s{k}"))
        parts = sorted((tmp_path / f"s{k}" / "rows").glob("*.txt"))
        texts.append("".join(p.read_text(encoding="utf-8") for p in parts))
    assert texts[0] == texts[1] == texts[2]
    statements = [s for s in texts[0].split(";\n") if s]
    assert max(s.count("), (") + 1 for s in statements) <= 200
    assert sum(s.count("(0, 'x;y')") for s in statements) == 1000 and texts[0].count("'x;y')") == 3000
    parts = Q.insert_statements(rows_, "t").select("batch").collect()
    assert len({r["batch"].split("-")[0] for r in parts}) > 4


def test_script_is_not_written_for_an_empty_result(spark, tmp_path, mixed):
    assert not Q.write_script(mixed.filter("false"), "t", str(tmp_path / "s"))
    assert Q.write_script(mixed, "t", str(tmp_path / "s"))
    assert spark.read.text(str(tmp_path / "s" / "create")).count() == 2


def test_guarded_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("=1+1", ["a", "b"], 1), ("-x", [], 2), ('q"uote, x', None, 3), ("a=b", ["c"], 4)], "t string, l array<string>, n int")
    W.write_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert rows(back.select("t", "n")) == [("'-x", "2"), ("'=1+1", "1"), ("a=b", "4"), ('q"uote, x', "3")]
    assert {r["l"] for r in back.collect()} >= {"a | b", "c"}


def test_tables_are_replaced_with_published_types(spark, tmp_path, mixed):
    try:
        assert W.replace_table(mixed.select("i"), "qd_test", str(tmp_path / "t"))
        assert W.replace_table(mixed, "qd_test", str(tmp_path / "t"))
        assert dict(spark.table("qd_test").dtypes) == {"i": "bigint", "b": "bigint", "x": "double", "t": "string", "d": "string", "m": "string"}
        assert not W.replace_table(mixed.filter("false"), "qd_test", str(tmp_path / "t"))
        assert spark.table("qd_test").count() == 3
        errors = W.replace_tables({"bad name!": mixed, "qd_test": mixed}, str(tmp_path / "u"))
        assert list(errors) == ["bad name!"]
    finally:
        spark.sql("DROP TABLE IF EXISTS qd_test")


def _versions(folder):
    return sorted(p.name for p in folder.iterdir() if p.is_dir()) if folder.exists() else []


@pytest.mark.parametrize("managed", [True, False])
def test_a_failing_replacement_leaves_the_old_table(spark, tmp_path, managed):
    folder = None if managed else str(tmp_path / "t")
    name = f"qd_swap_{'m' if managed else 'e'}"
    good = spark.range(5)
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("task killed"))).alias("id"))
    try:
        assert W.replace_table(good, name, folder)
        with pytest.raises(Exception, match="task killed"):
            W.replace_table(broken, name, folder)
        assert rows(spark.table(name)) == [(k,) for k in range(5)]
        assert W.replace_table(spark.range(7).withColumn("more", F.lit("x")), name, folder)
        assert spark.table(name).count() == 7 and spark.table(name).columns == ["id", "more"]
        assert not W.replace_table(good.filter("id < 0"), name, folder)
        assert spark.table(name).count() == 7
        if folder:
            assert len(_versions(tmp_path / "t")) == 1  # those of failed, replaced and empty versions are gone
        assert not spark.catalog.tableExists(f"{name}__next") and not spark.catalog.tableExists(f"{name}__old")
    finally:
        for t in (name, f"{name}__next", f"{name}__old"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


@pytest.mark.parametrize("step", [1, 2])
def test_a_run_that_ends_between_stage_and_swap(spark, tmp_path, monkeypatch, step):
    """The driver is lost after the stage (step 1) or between the two renames (step 2); the next run goes on from there."""
    name = f"qd_lost_{step}"

    class Lost(Exception):
        pass

    real, renames = type(spark).sql, []

    def dying(self, text, *args, **kwargs):
        if "RENAME" in text:
            renames.append(text)
            if len(renames) == step:
                raise Lost
        return real(self, text, *args, **kwargs)

    try:
        W.replace_table(spark.range(5), name, str(tmp_path / "t"))
        monkeypatch.setattr(type(spark), "sql", dying)
        with pytest.raises(Lost):
            W.replace_table(spark.range(9), name, str(tmp_path / "t"))
        monkeypatch.undo()
        assert spark.table(name if step == 1 else f"{name}__old").count() == 5
        W.recover_table(spark, name)
        assert spark.table(name).count() == 5
        assert W.replace_table(spark.range(9), name, str(tmp_path / "t")) and spark.table(name).count() == 9
        assert len(_versions(tmp_path / "t")) == 1
    finally:
        for t in (name, f"{name}__next", f"{name}__old"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_scratch_scopes_are_emptied(spark):
    import pathlib

    from quarterdeck.session import land, scratch_path, scratch_scope

    kept = scratch_path(spark, "kept")
    land(spark.range(3), kept)
    with pytest.raises(ValueError, match="stop"), scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        land(spark.range(3), inner)
        raise ValueError("stop")
    local = lambda p: pathlib.Path(p.removeprefix("file:"))
    assert local(kept).exists() and not local(inner).exists()


def test_partitioned_write(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("sheet"))
    W.write_partitioned(df, str(tmp_path / "p"))
    assert sorted(p.name for p in (tmp_path / "p").iterdir() if p.is_dir()) == ["sheet=0", "sheet=1", "sheet=2"]
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100


def test_raw_panel_reads_its_periods(spark):
    df = spark.createDataFrame(
        [("BS_1", "l", "A", "2023_q2", "2024-01-01", "f", 2.0), ("BS_1", "l", "A", "2023_q1", "2024-01-01", "f", 1.0),
         ("BS_1", "l", "A", "2023_q1", "2024-02-01", "g", 9.0), ("BS_1", "l", "A", "note", "2024-02-01", "g", 0.0)],
        "item string, label string, entity string, period string, export_date string, file string, value double",
    ).withColumn("export_date", F.to_date("export_date"))
    wide = raw_panel(df)
    assert wide.columns == ["item", "label", "entity", "2023_q1", "2023_q2"]
    assert rows(wide) == [("BS_1", "l", "A", 9.0, 2.0)]


def test_monthly_sum(spark):
    df = spark.createDataFrame([("Tiền gửi KKH", 2024, 1, 5), ("Tiền gửi CKH", 2024, 1, 6), ("Khác", 2024, 2, 9)], "item string, year int, month int, amount int")
    out = monthly_sum(df, F.col("item").contains("Tiền gửi"), "amount", "deposits")
    assert [tuple(r) for r in out.collect()] == [(datetime.date(2024, 1, 1), 11)]


def test_audit_job_writes_the_dictionary_only_if_clean(spark, tmp_path):
    schema = "entity string, sheet string, file string, item string, label string"
    clean = spark.createDataFrame([("A", "BS", "f", "BS_1", "=Cash")], schema)
    assert audit_job(clean, str(tmp_path / "r1"), str(tmp_path / "d1")).first()["publish"]
    assert spark.read.option("header", True).csv(str(tmp_path / "d1")).first()["chi_tieu"] == "'=Cash"
    drift = clean.unionByName(spark.createDataFrame([("A", "BS", "g", "BS_1", "Money")], schema))
    assert not audit_job(drift, str(tmp_path / "r2"), str(tmp_path / "d2")).first()["publish"]
    assert not (tmp_path / "d2").exists()


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_numbering_by_position(spark, chunk):
    df = spark.range(500).select((F.col("id") % 3 == 0).cast("int").alias("k"), (F.col("id") * 3).alias("pos"))
    out = number_by_position(df, ["k"], "pos", "n", chunk).collect()
    for k in (0, 1):
        ordered = sorted((r["pos"], r["n"]) for r in out if r["k"] == k)
        assert [n for _, n in ordered] == list(range(1, len(ordered) + 1))


def test_numbering_by_any_order_with_a_hot_key_and_ties(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") % 4).alias("v"), "id"
    )
    out = number_by_order(df, ["k"], [F.col("v").desc(), F.col("id").asc()], "n").collect()
    groups = {}
    for r in out:
        groups.setdefault(r["k"], []).append((-r["v"], r["id"], r["n"]))
    assert sum(map(len, groups.values())) == 3000
    assert all([n for *_, n in sorted(g)] == list(range(1, len(g) + 1)) for g in groups.values())
