"""Random reports of many entities against a plain Python reading of the rules on wide tables."""

import random

from pyspark.sql import functions as F

from quarterdeck.config import ItemRules
from quarterdeck.operators.panel import CUMULATIVE, QUARTERLY, YEARLY, merge_panel
from quarterdeck.operators.series import derive_series

ITEMS = ("BS_1", "IS_1", "IS_2", "CF_47", "CF_48", "NOTES_3", "NOTES_200")
YEARS = (2021, 2022, 2023)
RULES = ItemRules(semi_annual=("E3", "E7", "E11"))


def random_reports(entity, rng):
    cells = {}
    density = rng.choice((0.2, 0.6, 1.0))
    for freq, quarters in ((QUARTERLY, (1, 2, 3, 4)), (CUMULATIVE, (2, 4)), (YEARLY, (4,))):
        if rng.random() < 0.25:
            continue
        for year in YEARS:
            for quarter in quarters:
                if rng.random() < 0.8:
                    for item in ITEMS:
                        if rng.random() < density:
                            value = None if rng.random() < 0.15 else float(rng.randint(-50, 50))
                            cells[freq, entity, item, year, quarter] = value
    return cells


def brute_panel(cells):
    """Wide tables per entity and frequency, then one source per entity and period."""
    out = {}
    for entity in {k[1] for k in cells}:
        tables = {f: {k[2:]: v for k, v in cells.items() if k[:2] == (f, entity)} for f in (QUARTERLY, CUMULATIVE, YEARLY)}
        taken = set()
        for freq in (YEARLY, CUMULATIVE):
            own = {k[1:] for k in tables[freq]}
            for (item, *period), value in tables[freq].items():
                if tuple(period) not in taken:
                    out[entity, item, *period] = value
            taken |= own
        table = tables[QUARTERLY]
        columns = {k[1:] for k in table if k[2] <= 3}
        for item in {k[0] for k in table}:
            for year, quarter in columns - taken:
                upto = sorted(q for y, q in columns if y == year and q <= quarter)
                values = [table.get((item, year, q)) for q in upto]
                if "BS" in item or item in RULES.stock_notes or item in RULES.closing_items:
                    value = values[-1]
                elif item in RULES.opening_items:
                    value = values[0]
                else:
                    value = float(sum(v for v in values if v is not None))
                out[entity, item, year, quarter] = value
    return out


def brute_series(panel):
    out = {}
    for (entity, item, year, quarter), value in panel.items():
        get = lambda y, q: panel.get((entity, item, y, q))
        semi = entity in RULES.semi_annual
        valid = not semi or quarter % 2 == 0
        start = get(year - 1, 4)
        so_far = [get(year, q) for q in range(1, quarter + 1) if not semi or q % 2 == 0]
        average = (sum(so_far) + start) / (len(so_far) + 1) if valid and start is not None and None not in so_far else None
        index = year * 4 + quarter - 1
        frame = [get((index - back) // 4, (index - back) % 4 + 1) for back in range(5)]
        frame = [v for v in frame if v is not None]
        five = sum(frame) / len(frame) if valid and len(frame) >= (3 if semi else 5) else None
        if not valid:
            trailing = None
        elif quarter == 4:
            trailing = value
        else:
            parts = (value, start, get(year - 1, quarter))
            trailing = None if None in parts else parts[0] + parts[1] - parts[2]
        stock = "BS" in item or item in RULES.stock_notes
        flow = item.startswith("IS_")
        out[entity, item, year, quarter] = (
            value, average if stock else None, five if stock else None, trailing if flow else None
        )
    return out


def test_panel_and_series(spark):
    rng = random.Random(42)
    cells = {}
    for i in range(150):
        cells |= random_reports(f"E{i}", rng)
    flat = [(*k, v) for k, v in cells.items()]
    facts = spark.createDataFrame(flat, "freq string, entity string, item string, year int, quarter int, value double")
    got = {
        (r["entity"], r["item"], r["year"], r["quarter"]): tuple(None if x is None else round(x, 9) for x in r[5:9])
        for r in derive_series(merge_panel(facts, RULES), RULES)
        .select("entity", "item", "year", "quarter", "qidx", "value", "avg", "roll5", "roll4")
        .collect()
    }
    want = {k: tuple(None if x is None else round(x, 9) for x in v) for k, v in brute_series(brute_panel(cells)).items()}
    assert len(want) > 3000 and any(v[1] is not None for v in want.values())
    assert got == want


def test_items_filter_changes_nothing_else(spark):
    rng = random.Random(7)
    cells = {}
    for i in range(30):
        cells |= random_reports(f"E{i}", rng)
    facts = spark.createDataFrame(
        [(*k, v) for k, v in cells.items()], "freq string, entity string, item string, year int, quarter int, value double"
    )
    kept = merge_panel(facts, RULES, ["IS_1", "CF_47"])
    whole = merge_panel(facts, RULES).filter(F.col("item").isin("IS_1", "CF_47"))
    assert sorted(map(str, kept.collect())) == sorted(map(str, whole.collect()))
