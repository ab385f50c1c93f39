"""Null and edge rules of the panel, each on hand-computed rows."""

import re

import pytest
from pyspark.sql import functions as F

from quarterdeck import session
from quarterdeck.config import ItemRules, PeerGroup
from quarterdeck.operators.exports import dedup_latest_export, prefer_reports
from quarterdeck.operators.groups import group_rows, membership_of, summarize_by_group
from quarterdeck.operators.panel import (
    CUMULATIVE,
    QUARTERLY,
    YEARLY,
    calendar_rows,
    entity_calendar,
    clashing_cells,
    merge_panel,
    ytd_cumulate,
)
from quarterdeck.operators.reshape import duplicate_keys, pivot_unique, union_strict, unpivot
from quarterdeck.workloads.registry import QUERIES
from tests.helpers import by_key, exchanges, facts, no_broadcasts, panel, rows

RULES = ItemRules()


def test_flow_sum_skips_nulls_and_starts_at_zero(spark):
    out = by_key(ytd_cumulate(facts(spark, [
        ("A", "IS_1", "2023_q1", None), ("A", "IS_1", "2023_q2", 5), ("A", "IS_1", "2023_q3", 7),
    ]), RULES))
    assert [out["A", "IS_1", f"2023_q{q}"] for q in (1, 2, 3)] == [0.0, 5.0, 12.0]


def test_missing_row_is_a_null_cell(spark):
    """IS_2 has no row in 2023 at all, but the entity reports that year."""
    out = by_key(ytd_cumulate(facts(spark, [
        ("A", "IS_1", "2023_q1", 1), ("A", "IS_1", "2024_q1", 2), ("A", "IS_2", "2024_q1", 9), ("A", "BS_1", "2024_q1", 3),
    ]), RULES))
    assert out["A", "IS_2", "2023_q1"] == 0.0
    assert out["A", "BS_1", "2023_q1"] is None


def test_item_known_from_a_fourth_quarter_only(spark):
    out = by_key(ytd_cumulate(facts(spark, [("A", "IS_1", "2023_q1", 1), ("A", "IS_2", "2023_q4", 9)]), RULES))
    assert out == {("A", "IS_1", "2023_q1"): 1.0, ("A", "IS_2", "2023_q1"): 0.0}


def test_stock_takes_the_latest_quarter_even_if_null(spark):
    out = by_key(ytd_cumulate(facts(spark, [
        ("A", i, "2023_q1", 4) for i in ("BS_1", "CF_48", "NOTES_119", "NOTES_120")
    ] + [("A", i, "2023_q2", None) for i in ("BS_1", "CF_48", "NOTES_119", "NOTES_120")]), RULES))
    assert [out["A", i, "2023_q2"] for i in ("BS_1", "CF_48", "NOTES_119")] == [None] * 3
    assert out["A", "NOTES_120", "2023_q2"] == 4.0  # not a listed note: a flow


def test_opening_cash_takes_the_earliest_reported_quarter(spark):
    out = by_key(ytd_cumulate(facts(spark, [
        ("A", "CF_47", "2023_q2", 3), ("A", "CF_47", "2023_q3", 8), ("A", "IS_1", "2023_q2", 1),
        ("B", "IS_1", "2023_q1", 1), ("B", "CF_47", "2023_q2", 6),
    ]), RULES))
    assert out["A", "CF_47", "2023_q3"] == 3.0
    assert out["B", "CF_47", "2023_q2"] is None  # the first quarter is reported, without this item


def test_year_need_not_be_complete_and_q4_drops_out(spark):
    out = by_key(ytd_cumulate(facts(spark, [
        ("A", "IS_1", "2023_q1", 1), ("A", "IS_1", "2023_q3", 4), ("A", "IS_1", "2023_q4", 100),
    ]), RULES))
    assert out == {("A", "IS_1", "2023_q1"): 1.0, ("A", "IS_1", "2023_q3"): 5.0}


def _mixed(spark):
    quarterly = facts(spark, [
        ("A", "IS_1", "2023_q1", 1), ("A", "IS_1", "2023_q2", 2), ("A", "IS_2", "2023_q2", 3), ("A", "IS_1", "2023_q3", 5),
        ("B", "IS_1", "2023_q1", 1), ("B", "IS_1", "2023_q2", 1),
    ]).withColumn("freq", F.lit(QUARTERLY))
    half = facts(spark, [("A", "IS_1", "2023_q2", 30), ("A", "IS_1", "2023_q4", 60)]).withColumn("freq", F.lit(CUMULATIVE))
    year = facts(spark, [("A", "IS_1", "2023_q4", 70), ("B", "IS_1", "2023_q4", None)]).withColumn("freq", F.lit(YEARLY))
    return quarterly.unionByName(half).unionByName(year)


def test_precedence_is_per_entity_and_period(spark):
    out = by_key(merge_panel(_mixed(spark), RULES))
    assert out == {
        ("A", "IS_1", "2023_q1"): 1.0,
        ("A", "IS_2", "2023_q1"): 0.0,
        ("A", "IS_1", "2023_q2"): 30.0,  # cumulative; the quarterly IS_2 of that period goes too
        ("A", "IS_1", "2023_q3"): 8.0,  # the running sum still uses the covered quarter
        ("A", "IS_2", "2023_q3"): 3.0,
        ("A", "IS_1", "2023_q4"): 70.0,  # yearly before cumulative
        ("B", "IS_1", "2023_q1"): 1.0,
        ("B", "IS_1", "2023_q2"): 2.0,
        ("B", "IS_1", "2023_q4"): None,
    }


def test_pruning_items_keeps_the_values_and_the_calendar(spark):
    whole = by_key(merge_panel(_mixed(spark), RULES))
    pruned = by_key(merge_panel(_mixed(spark), RULES, ["IS_2"]))
    assert pruned == {k: v for k, v in whole.items() if k[1] == "IS_2"}
    periods = {(r["entity"], r["year"], r["quarter"]) for r in calendar_rows(entity_calendar(_mixed(spark))).collect()}
    assert periods == {(e, int(p[:4]), int(p[-1])) for e, _, p in whole}


def test_unreadable_periods_are_left_out(spark):
    broken = facts(spark, [("A", "IS_1", "2023_q1", 1)]).unionByName(
        spark.createDataFrame([("A", "IS_1", None, None, 5.0)], "entity string, item string, year int, quarter int, value double")
    )
    assert by_key(ytd_cumulate(broken, RULES)) == {("A", "IS_1", "2023_q1"): 1.0}


def test_a_cell_with_two_values_is_missing_and_listed(spark):
    data = facts(spark, [("A", "BS_1", "2023_q1", 1), ("A", "BS_1", "2023_q1", 2), ("A", "BS_1", "2023_q2", 3), ("A", "BS_1", "2023_q2", 3)])
    assert by_key(ytd_cumulate(data, RULES)) == {("A", "BS_1", "2023_q1"): None, ("A", "BS_1", "2023_q2"): 3.0}
    listed = clashing_cells(data.withColumn("freq", F.lit(QUARTERLY))).collect()
    assert [tuple(r) for r in listed] == [(QUARTERLY, "A", "BS_1", 2023, 1, 1.0, 2.0)]


def test_equal_rows_count_once(spark):
    out = ytd_cumulate(facts(spark, [("A", "IS_1", "2023_q1", 1)] * 2), RULES)
    assert by_key(out) == {("A", "IS_1", "2023_q1"): 1.0}


def test_pivot_rejects_duplicates_and_inverts_unpivot(spark):
    data = panel(spark, [("A", "x", "2023_q1", 1), ("A", "y", "2023_q1", None), ("B", "x", "2023_q1", 3)])
    wide = pivot_unique(data, ["entity"], "item", "value", ["x", "y"])
    assert rows(wide) == [("A", 1.0, None), ("B", 3.0, None)]
    assert rows(unpivot(wide, ["entity"], "item", "value")) == [("A", "x", 1.0), ("A", "y", None), ("B", "x", 3.0), ("B", "y", None)]
    twice = data.unionByName(data)
    with pytest.raises(Exception, match="more than one row"):
        pivot_unique(twice, ["entity"], "item", "value", ["x", "y"]).collect()
    assert duplicate_keys(twice, ["entity", "item"]).count() == 3


def test_strict_union_checks_the_schema(spark):
    a, b = spark.range(1), spark.range(1).selectExpr("cast(id as int) id")
    with pytest.raises(ValueError, match="schemas differ"):
        union_strict([a, b])


def test_newest_export_wins_even_if_null(spark):
    df = spark.createDataFrame(
        [("k", "2024-01-01", "a", 1.0), ("k", "2024-02-01", "c", 5.0), ("k", "2024-02-01", "b", None), ("m", None, "a", 2.0),
         ("m", "2020-01-01", "z", 3.0)],
        "key string, d string, file string, value double",
    ).withColumn("d", F.to_date("d"))
    assert rows(dedup_latest_export(df, ["key"], "d", "file")) == [("k", None), ("m", 3.0)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_newest_export_by_time(spark, kind):
    df = spark.createDataFrame(
        [("k", "2024-01-01 00:00:00.5", "a", 1.0), ("k", "2024-01-01 00:00:00.6", "z", 2.0), ("k", None, "a", 3.0),
         ("k", "2024-01-01 00:00:00.6", "b", 4.0)],
        "key string, d string, file string, value double",
    ).withColumn("d", F.col("d").cast(kind))
    assert rows(dedup_latest_export(df, ["key"], "d", "file")) == [("k", 4.0)]


def test_preferred_report_is_filled_from_the_other(spark):
    df = spark.createDataFrame(
        [("k", 1, "2024-03-01", "a", 1.0), ("k", 0, "2023-01-01", "b", 2.0), ("k", 0, "2023-06-01", "c", 3.0),
         ("m", 1, "2024-01-01", "a", 4.0)],
        "key string, report int, d string, file string, value double",
    ).withColumn("d", F.to_date("d"))
    assert rows(prefer_reports(df, ["key"], "report", "d", "file")) == [("k", 3.0), ("m", 4.0)]


GROUPS = (PeerGroup("g", "BQ %d g"), PeerGroup("all", "BQ %d all", "Sum %d all"))


def _grouped(spark, means=True):
    data = panel(spark, [
        ("A", "x", "2023_q1", 1), ("B", "x", "2023_q1", None), ("B", "x", "2023_q2", 6), ("C", "x", "2023_q1", 8),
        ("C", "y", "2023_q1", 2), ("D", "z", "2023_q1", 5),
    ])
    members = membership_of(data, {"g": ["A", "B", "E"], "all": ["A", "B", "C"]})
    return by_key(summarize_by_group(data, members, GROUPS, means))


def test_group_means_totals_and_labels(spark):
    out = _grouped(spark)
    assert out["BQ 2 g", "x", "2023_q1"] == 1.0  # the NULL is skipped, B counts as a member through q2
    assert out["BQ 3 all", "x", "2023_q1"] == 4.5
    assert out["Sum 3 all", "x", "2023_q1"] == 9.0
    assert out["Sum 3 all", "y", "2023_q2"] == 0.0  # nobody reports it there
    assert out["Sum 3 all", "z", "2023_q1"] == 0.0  # only an outsider has it
    assert out["BQ 2 g", "z", "2023_q1"] is None
    assert out["D", "z", "2023_q1"] == 5.0


def test_total_only(spark):
    labels = {k[0] for k in _grouped(spark, means=False)}
    assert labels == {"A", "B", "C", "D", "Sum 3 all"}


def test_total_is_mean_times_members_without_nulls(spark):
    data = panel(spark, [(f"E{i}", "x", p, i * 7) for i in range(1, 9) for p in ("2023_q1", "2023_q2")])
    members = membership_of(data, {"all": [f"E{i}" for i in range(1, 9)]})
    out = by_key(group_rows(data, members, GROUPS[1:]))
    for p in ("2023_q1", "2023_q2"):
        assert out["Sum 8 all", "x", p] == out["BQ 8 all", "x", p] * 8


def test_group_rows_read_the_panel_once(spark, tmp_path):
    path = str(tmp_path / "panel")
    panel(spark, [(f"E{i}", f"BS_{k}", "2023_q1", i) for i in range(6) for k in range(4)]).write.parquet(path)
    stored = spark.read.parquet(path)
    members = membership_of(stored, {"all": [f"E{i}" for i in range(4)]})
    with no_broadcasts(spark):
        found, scans = exchanges(group_rows(stored, members, GROUPS[1:]))
    # The panel itself was read when its cells were landed; what is left reads them.
    assert len(found) <= 6 and not any("entity" in keys for _, keys in found)
    assert all("group" in s or "item" in s for s in scans)
    assert "Subquery" not in group_rows(stored, members, GROUPS[1:])._jdf.queryExecution().toString()


def test_grid_with_a_given_chart_and_hot_groups(spark):
    data = panel(spark, [(f"E{i}", f"BS_{i % 3}", f"202{i % 2}_q1", i) for i in range(300)] + [("X", "IS_7", "2020_q1", 1)])
    members = membership_of(data, {"g": [f"E{i}" for i in range(300)], "all": ["E0", "E1"]})
    chart = spark.createDataFrame([("BS_0",), ("BS_9",)], "item string")
    got = by_key(group_rows(data, members, GROUPS, items=chart))
    assert {i for _, i, _ in got} == {"BS_0", "BS_9"}
    assert got["BQ 300 g", "BS_0", "2020_q1"] == sum(range(0, 300, 6)) / 50
    assert got["Sum 2 all", "BS_9", "2021_q1"] == 0.0 and got["BQ 2 all", "BS_9", "2021_q1"] is None
    whole = by_key(group_rows(data, members, GROUPS))
    assert {i for _, i, _ in whole} == {"BS_0", "BS_1", "BS_2", "IS_7"}


def test_partitioning_does_not_change_the_panel(spark):
    mixed = _mixed(spark)
    expected = rows(merge_panel(mixed, RULES))
    for n in (1, 3, 13):
        assert rows(merge_panel(mixed.repartition(n, F.rand(7)), RULES)) == expected


def _orders(spark, folder):
    spark.sql(
        "SELECT id AS o_orderkey, id % 5 AS o_custkey, DATE'1995-01-15' + CAST(id * 11 AS INT) AS o_orderdate,"
        " IF(id % 3 = 0, 'O', 'F') AS o_orderstatus, CAST(id AS DOUBLE) AS o_totalprice FROM range(120)"
    ).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_large_panels_are_dealt_out_once_to_tasks_of_bounded_input(spark, tmp_path, monkeypatch):
    sf = _orders(spark, tmp_path)
    usual = {name: rows(QUERIES[name][0](spark, sf)) for name in ("formula_batch", "transpose_panel")}
    monkeypatch.setattr(session, "TASK_BYTES", 64)
    for name, expected in usual.items():
        out = QUERIES[name][0](spark, sf)
        plan = out._jdf.queryExecution().executedPlan().toString()
        numbers = [int(n) for n in re.findall(r"Exchange hashpartitioning\([^\n]*?, (\d+)\), REPARTITION_BY_NUM", plan)]
        assert numbers and min(numbers) > 8
        assert plan.count("Exchange hashpartitioning") == 2 * len(numbers)  # the orders', then the customers'
        assert rows(out) == expected


def test_merged_panels_are_dealt_out_to_tasks_of_bounded_input(spark, tmp_path, monkeypatch):
    data = facts(spark, [(e, "IS_1", f"2023_q{q}", q) for e in "ABC" for q in (1, 2, 3)]).withColumn("freq", F.lit(QUARTERLY))
    data.write.parquet(f"{tmp_path}/facts")
    data = spark.read.parquet(f"{tmp_path}/facts")
    usual = rows(merge_panel(data, RULES))
    monkeypatch.setattr(session, "TASK_BYTES", 64)
    out = merge_panel(data, RULES)
    assert re.search(r"REPARTITION_BY_NUM", out._jdf.queryExecution().executedPlan().toString())
    assert rows(out) == usual


def test_unpivot_keeps_the_partitioning(spark):
    wide = spark.createDataFrame([("A", 1.0, None), ("B", 3.0, 4.0)], "entity string, `x.1` double, y double").repartition(3, "entity")
    long = unpivot(wide, ["entity"], "item", "value")
    assert rows(long) == [("A", "x.1", 1.0), ("A", "y", None), ("B", "x.1", 3.0), ("B", "y", 4.0)]
    again = long.groupBy("entity").agg(F.sum("value"))
    assert again._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
