import pytest

from quarterdeck.config import ItemRules
from quarterdeck.operators import series as S
from quarterdeck.operators.panel import ytd_cumulate
from tests.helpers import by_key, exchanges, facts, no_broadcasts, panel

RULES = ItemRules()
SEMI = ItemRules(semi_annual=("S",))


def quarters(first_year, values, entity="A", item="BS_1"):
    return [(entity, item, f"{first_year + i // 4}_q{i % 4 + 1}", v) for i, v in enumerate(values)]


def test_average_needs_prior_year_end_and_every_quarter(spark):
    data = quarters(2022, [1, 2, 3, 4, 8, 12, 16, 20, 1, None, 3, 4, 5])
    out = by_key(S.add_average_balance(panel(spark, data), RULES), "avg")
    assert out["A", "BS_1", "2022_q3"] is None  # no prior Q4
    assert out["A", "BS_1", "2023_q1"] == 6.0
    assert out["A", "BS_1", "2023_q4"] == (4 + 8 + 12 + 16 + 20) / 5
    assert out["A", "BS_1", "2024_q2"] is None and out["A", "BS_1", "2024_q3"] is None  # gap in Q2
    assert out["A", "BS_1", "2025_q1"] == 4.5


def test_five_point_mean_is_by_calendar(spark):
    data = quarters(2022, [1, 2, 3, 4, 5, 6])
    gap = [d for d in quarters(2022, [1, 2, 3, 4, 5, 6], entity="B") if d[2] != "2022_q3"]
    out = by_key(S.add_five_point_mean(panel(spark, data + gap), RULES), "roll5")
    assert out["A", "BS_1", "2022_q4"] is None
    assert out["A", "BS_1", "2023_q1"] == 3.0 and out["A", "BS_1", "2023_q2"] == 4.0
    assert out["B", "BS_1", "2023_q2"] is None  # five rows, but not five quarters


def test_trailing_year(spark):
    data = quarters(2022, [1, 3, 6, 10, 2, 5, 9, 14], item="IS_1")
    out = by_key(S.add_trailing_year(panel(spark, data), RULES), "roll4")
    assert out["A", "IS_1", "2022_q3"] is None
    assert out["A", "IS_1", "2022_q4"] == 10.0
    assert out["A", "IS_1", "2023_q1"] == 2 + 10 - 1
    assert out["A", "IS_1", "2023_q3"] == 9 + 10 - 6


def test_semi_annual_entity(spark):
    data = [("S", "BS_1", p, v) for p, v in
            (("2022_q2", 1), ("2022_q4", 2), ("2023_q1", 99), ("2023_q2", 4), ("2023_q4", 6), ("2024_q2", 8))]
    rows = panel(spark, data)
    avg = by_key(S.add_average_balance(rows, SEMI), "avg")
    assert avg["S", "BS_1", "2023_q1"] is None
    assert avg["S", "BS_1", "2023_q2"] == 3.0  # a stray odd quarter does not count
    assert avg["S", "BS_1", "2023_q4"] == 4.0
    assert avg["S", "BS_1", "2024_q2"] == 7.0
    roll5 = by_key(S.add_five_point_mean(rows, SEMI), "roll5")
    assert roll5["S", "BS_1", "2024_q2"] == 6.0  # Q2, Q4, Q2 in the frame
    assert roll5["S", "BS_1", "2023_q1"] is None
    flows = panel(spark, [("S", "IS_1", p, v) for p, v in (("2022_q2", 4), ("2022_q4", 9), ("2023_q2", 5), ("2023_q3", 7))])
    roll4 = by_key(S.add_trailing_year(flows, SEMI), "roll4")
    assert roll4["S", "IS_1", "2023_q2"] == 5 + 9 - 4
    assert roll4["S", "IS_1", "2023_q3"] is None


def test_two_point_average_follows_the_entitys_rows(spark):
    data = [("A", "x", "2022_q1", 2), ("A", "x", "2023_q3", 4), ("A", "y", "2022_q1", 1), ("A", "y", "2023_q4", 7),
            ("A", "x", "2023_q4", 10)]
    out = by_key(S.add_two_point_average(panel(spark, data)), "avg")
    assert out["A", "x", "2023_q3"] == 3.0  # far apart, yet neighbouring rows
    assert out["A", "x", "2023_q4"] == 7.0
    assert out["A", "y", "2023_q4"] is None  # y is missing in the row before
    assert out["A", "x", "2022_q1"] is None


def test_two_point_average_never_shuffles_values_by_entity_alone(spark, tmp_path):
    path = str(tmp_path / "panel")
    panel(spark, [("A", "x", "2022_q1", 2), ("B", "y", "2022_q1", 3)]).write.parquet(path)
    with no_broadcasts(spark):
        found, _ = exchanges(S.add_two_point_average(spark.read.parquet(path)))
    assert any(keys == "entity, item" and "value" in columns for columns, keys in found)
    assert not any(keys == "entity" and "value" in columns for columns, keys in found)


def test_series_apply_to_their_items_only(spark):
    data = quarters(2022, range(1, 10)) + quarters(2022, range(1, 10), item="IS_1") + quarters(2022, range(1, 10), item="NOTES_120")
    last = {r["item"]: r for r in S.derive_series(panel(spark, data), RULES).filter("year = 2024").collect()}
    assert last["BS_1"]["avg"] and last["BS_1"]["roll5"] and last["BS_1"]["roll4"] is None
    assert last["IS_1"]["roll4"] and last["IS_1"]["avg"] is None and last["IS_1"]["roll5"] is None
    assert last["NOTES_120"]["avg"] is None


@pytest.mark.parametrize("seed", [1, 2])
def test_year_to_date_differences_give_back_the_quarters(spark, seed):
    values = [(seed * 37 * (i + 1)) % 101 for i in range(12)]
    data = quarters(2021, values, item="IS_1")
    ytd = by_key(ytd_cumulate(facts(spark, data), RULES))
    for year in (2021, 2022, 2023):
        q1, q2, q3 = (ytd["A", "IS_1", f"{year}_q{q}"] for q in (1, 2, 3))
        offset = (year - 2021) * 4
        assert [q1, q2 - q1, q3 - q2] == values[offset : offset + 3]


def test_one_exchange_serves_all_series(spark):
    data = panel(spark, quarters(2022, range(1, 10)))
    plan = S.derive_series(data, RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
