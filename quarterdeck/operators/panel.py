"""From discrete reports to one year-to-date panel.

Facts are long: `entity, item, year, quarter, value`, plus `freq` where several export frequencies are mixed, one value
per key. A statement table has a cell for every item of an entity in every period that entity reports, so a missing row
and a NULL cell mean the same thing; the entity's calendar supplies the periods.

Facts are partitioned by (entity, item), so a partition key holds at most a calendar's worth of rows and an entity with
very many items spreads over many tasks. Calendars are one row per entity; they are first handed to the entity's items, so
the facts meet them without leaving that partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.config import ItemRules
from quarterdeck.functions.period import index_quarter, index_year, period_index
from quarterdeck.session import dealt

QUARTERLY, CUMULATIVE, YEARLY = "quarterly", "cumulative", "yearly"
PANEL = ("entity", "item", "year", "quarter", "qidx", "value")


def is_stock(rules: ItemRules) -> Column:
    """Whether `item` is a balance at a point in time: a balance-sheet item or one of the listed notes."""
    # one expression text instead of a hundred literals sent one by one
    listed = ", ".join(f"'{note}'" for note in rules.stock_notes)
    return F.col("item").contains(rules.stock_marker) | F.expr(f"item IN ({listed})")


def with_index(df: DataFrame) -> DataFrame:
    return df.withColumn("qidx", period_index(F.col("year"), F.col("quarter")))


def reported(facts: DataFrame) -> DataFrame:
    """Facts with a readable period, less the discrete fourth quarters, which year-to-date values do not use."""
    on_panel = (F.col("freq") != QUARTERLY) | (F.col("quarter") <= 3)
    return with_index(facts).filter(F.col("qidx").isNotNull() & on_panel)


def entity_calendar(facts: DataFrame) -> DataFrame:
    """Periods each entity reports, per frequency. Reads no item or value; items are collapsed map-side."""
    periods = reported(facts).select("entity", "freq", "qidx").distinct()
    return periods.groupBy("entity").agg(
        *[
            F.collect_list(F.when(F.col("freq") == freq, F.col("qidx"))).alias(f"{freq}_periods")
            for freq in (QUARTERLY, CUMULATIVE, YEARLY)
        ]
    )


def own_periods() -> Column:
    """All periods of an `entity_calendar` row."""
    return F.array_union(F.array_union("quarterly_periods", "cumulative_periods"), "yearly_periods")


def calendar_rows(calendar: DataFrame) -> DataFrame:
    """The calendar in panel form: one row per entity and period, with a NULL item."""
    return calendar.select("entity", F.explode(own_periods()).alias("qidx")).select(
        "entity",
        F.lit(None).cast("string").alias("item"),
        index_year(F.col("qidx")).alias("year"),
        index_quarter(F.col("qidx")).alias("quarter"),
        "qidx",
        F.lit(None).cast("double").alias("value"),
    )


def _with_calendar(rows: DataFrame, facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows partitioned by (entity, item) with their entity's calendar columns.

    Only the distinct keys of the facts are ever shuffled by entity alone, and a join can split an entity with very many.
    """
    by_item = facts.select("entity", "item").distinct().join(calendar, "entity")
    return rows.join(by_item, ["entity", "item"])


def _one_value(column: str, low: str) -> Column:
    """The value of a cell; NULL if it was given two different ones, which `clashing_cells` lists."""
    return F.when(~(F.col(column) > F.col(low)), F.col(column))


def clashing_cells(facts: DataFrame) -> DataFrame:
    """Cells that were given two different values, with the smallest and the largest. They count as missing in the panel."""
    keys = ["freq", "entity", "item", "year", "quarter"]
    cells = facts.groupBy(*keys).agg(F.min("value").alias("smallest"), F.max("value").alias("largest"))
    return cells.filter(F.col("largest") > F.col("smallest"))


def _years_of_items(quarterly: DataFrame) -> DataFrame:
    """One row per entity, item and year with the discrete quarters v1-v3 and the periods it stands for.

    A row stands for its own year and for the following ones up to the item's next row; the first one also for all years
    before. So an item's rows cover the whole calendar of its entity. `after` < qidx <= `upto` gives the range.
    """
    quarters = [
        (agg(F.when(F.col("quarter") == q, F.col("value")))).alias(f"{name}{q}")
        for q in (1, 2, 3)
        for agg, name in ((F.max, "v"), (F.min, "low"))
    ]
    by_item = Window.partitionBy("entity", "item").orderBy("year")
    first = F.lag("year").over(by_item).isNull()
    return (
        dealt(quarterly, "entity", "item")
        .groupBy("entity", "item", "year")
        .agg(*quarters)
        .withColumn("after", F.when(first, F.lit(0)).otherwise(F.col("year") * 4))
        .withColumn("upto", F.coalesce(F.lead("year").over(by_item) * 4, F.lit(2**31 - 1)))
        .withColumns({f"v{q}": _one_value(f"v{q}", f"low{q}") for q in (1, 2, 3)})
    )


def _quarterly_value(rules: ItemRules) -> Column:
    """Year-to-date value at `quarter`, for a row of `_years_of_items` placed at period `qidx`."""
    quarter, zero = F.col("quarter"), F.lit(0.0)
    own = F.when(quarter == 1, F.col("v1")).when(quarter == 2, F.col("v2")).otherwise(F.col("v3"))
    year_start = F.col("qidx") - quarter
    earliest = (
        F.when(F.array_contains("quarterly_periods", year_start + 1), F.col("v1"))
        .when(F.array_contains("quarterly_periods", year_start + 2), F.col("v2"))
        .otherwise(F.col("v3"))
    )
    running = (
        F.coalesce("v1", zero)
        + F.when(quarter >= 2, F.coalesce("v2", zero)).otherwise(zero)
        + F.when(quarter >= 3, F.coalesce("v3", zero)).otherwise(zero)
    )
    item, in_year = F.col("item"), F.col("year") == F.col("item_year")
    return (
        F.when(is_stock(rules) | item.isin(*rules.closing_items), F.when(in_year, own))
        .when(item.isin(*rules.opening_items), F.when(in_year, earliest))
        .otherwise(F.when(in_year, running).otherwise(zero))
    )


def _year_to_date(quarterly: DataFrame, calendar: DataFrame, rules: ItemRules) -> DataFrame:
    """Every item in every quarterly period of its entity that no other frequency supplies."""
    free = F.array_except("quarterly_periods", F.array_union("cumulative_periods", "yearly_periods"))
    years = _years_of_items(quarterly).withColumnRenamed("year", "item_year")
    due = F.filter("free", lambda p: (p > F.col("after")) & (p <= F.col("upto")))
    placed = (
        _with_calendar(years, quarterly, calendar.select("entity", "quarterly_periods", free.alias("free")))
        .withColumn("qidx", F.explode(due))
        .withColumn("year", index_year(F.col("qidx")))
        .withColumn("quarter", index_quarter(F.col("qidx")))
    )
    return placed.select(*PANEL[:-1], _quarterly_value(rules).alias("value"))


def _as_reported(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Cumulative and yearly cells; yearly periods take precedence over cumulative ones.

    Partitioned like the year-to-date rows, so that the union of both stays partitioned by (entity, item).
    """
    covered = (F.col("freq") == CUMULATIVE) & F.array_contains("yearly_periods", F.col("qidx"))
    cells = (
        dealt(facts, "entity", "item")
        .groupBy("entity", "item", "freq", "year", "quarter", "qidx")
        .agg(F.max("value").alias("value"), F.min("value").alias("low"))
        .withColumn("value", _one_value("value", "low"))
    )
    return _with_calendar(cells, facts, calendar.select("entity", "yearly_periods")).filter(~covered).select(*PANEL)


def merge_panel(
    facts: DataFrame, rules: ItemRules, items: Sequence[str] | None = None, calendar: DataFrame | None = None
) -> DataFrame:
    """Quarterly, cumulative and yearly facts (column `freq`) to one year-to-date panel.

    Discrete quarters 1-3 become year-to-date: stock, closing-cash and listed note items keep the quarter's own value
    (also when it is NULL), opening cash takes the year's earliest reported quarter, every other item is a running sum
    that skips NULLs and starts at 0. A year need not be complete; fourth quarters only show that an entity has an
    item. The other frequencies pass through. Precedence holds at (entity, period) grain, whichever items a source
    has: yearly before cumulative before quarterly.

    Equal rows for one cell count once, a cell with two values is missing (`clashing_cells`). `items` limits the panel; the filter reaches the scan
    of the facts, while the calendar still sees all of them. `calendar` is `entity_calendar(facts)`, if at hand.
    """
    calendar = entity_calendar(facts) if calendar is None else calendar
    wanted = facts if items is None else facts.filter(F.col("item").isin(*items))
    reports = with_index(wanted).filter(F.col("qidx").isNotNull() & F.col("freq").isin(CUMULATIVE, YEARLY))
    return uncovered_year_to_date(wanted, rules, calendar).unionByName(_as_reported(reports, calendar))


def uncovered_year_to_date(facts: DataFrame, rules: ItemRules, calendar: DataFrame | None = None) -> DataFrame:
    """Year-to-date rows of the quarterly facts, in the periods that no other frequency of the entity covers."""
    calendar = entity_calendar(facts) if calendar is None else calendar
    placed = with_index(facts).filter(F.col("qidx").isNotNull() & (F.col("freq") == QUARTERLY))
    return _year_to_date(placed, calendar, rules)


def tag_quarterly(facts: DataFrame) -> DataFrame:
    return facts.withColumn("freq", F.lit(QUARTERLY))


def ytd_cumulate(quarterly: DataFrame, rules: ItemRules) -> DataFrame:
    """Year-to-date panel of purely quarterly facts."""
    facts = tag_quarterly(quarterly)
    return _year_to_date(with_index(facts).filter(F.col("qidx").isNotNull()), entity_calendar(facts), rules)
