"""Derived series over the panel, all as windows of one (entity, item) partitioning.

The panel is unique on (entity, item, qidx), so a window partition holds at most as many rows as there are quarters.
Frames are calendar ranges on `qidx`; within four quarters back there is exactly one fourth quarter, so the prior
year end needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.config import ItemRules
from quarterdeck.operators.panel import is_stock

ROLL5_POINTS, ROLL5_POINTS_SEMI = 5, 3


def _calendar_frame(start: int, end: int):
    return Window.partitionBy("entity", "item").orderBy("qidx").rangeBetween(start, end)


def _year_so_far():
    ordered = Window.partitionBy("entity", "item", "year").orderBy("quarter")
    return ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def is_semi_annual(rules: ItemRules) -> Column:
    return F.col("entity").isin(*rules.semi_annual) if rules.semi_annual else F.lit(False)


def expected_points(rules: ItemRules) -> Column:
    """Reports due in the year up to this quarter."""
    half = F.floor(F.col("quarter") / 2).cast("int")
    return F.when(is_semi_annual(rules), half).otherwise(F.col("quarter"))


def is_valid_quarter(rules: ItemRules) -> Column:
    return ~is_semi_annual(rules) | (F.col("quarter") % 2 == 0)


def prior_year_end() -> Column:
    """Value of the previous year's fourth quarter."""
    return F.max(F.when(F.col("quarter") == 4, F.col("value"))).over(_calendar_frame(-4, -1))


def same_quarter_last_year() -> Column:
    return F.max("value").over(_calendar_frame(-4, -4))


def running_sum(rules: ItemRules) -> tuple[Column, Column]:
    """Running sum and non-NULL count within the year; odd quarters of semi-annual entities do not count."""
    value = F.when(is_valid_quarter(rules), F.col("value"))
    return F.sum(value).over(_year_so_far()), F.count(value).over(_year_so_far())


def average_balance(rules: ItemRules) -> Column:
    """Mean of the prior year end and all quarters so far; NULL if one of them is missing."""
    total, points = running_sum(rules)
    due = expected_points(rules)
    start = prior_year_end()
    complete = is_valid_quarter(rules) & (points == due) & start.isNotNull()
    return F.when(complete, (total + start) / (due + 1))


def five_point_mean(rules: ItemRules) -> Column:
    """Mean over five calendar quarters; NULL unless all points due are there."""
    frame = _calendar_frame(-4, 0)
    mean, points = F.avg("value").over(frame), F.count("value").over(frame)
    due = F.when(is_semi_annual(rules), F.lit(ROLL5_POINTS_SEMI)).otherwise(F.lit(ROLL5_POINTS))
    return F.when(is_valid_quarter(rules) & (points >= due), mean)


def trailing_year(rules: ItemRules) -> Column:
    """Trailing twelve months from year-to-date values."""
    value = F.col("value")
    return F.when(
        is_valid_quarter(rules),
        F.when(F.col("quarter") == 4, value).otherwise(value + prior_year_end() - same_quarter_last_year()),
    )


def add_average_balance(panel: DataFrame, rules: ItemRules) -> DataFrame:
    return panel.withColumn("avg", average_balance(rules))


def add_five_point_mean(panel: DataFrame, rules: ItemRules) -> DataFrame:
    return panel.withColumn("roll5", five_point_mean(rules))


def add_trailing_year(panel: DataFrame, rules: ItemRules) -> DataFrame:
    return panel.withColumn("roll4", trailing_year(rules))


def add_two_point_average(panel: DataFrame) -> DataFrame:
    """Mean of this and the entity's previous reported period, whatever its distance.

    The previous period is the entity's, not the item's: an item missing there gives NULL. The entity's calendar is handed
    to its items first, so the values meet it in the partitioning of the window and are never shuffled by entity alone.
    """
    by_item = Window.partitionBy("entity", "item").orderBy("qidx")
    calendar = panel.groupBy("entity").agg(F.sort_array(F.collect_set("qidx")).alias("_periods"))
    of_items = panel.select("entity", "item").distinct().join(calendar, "entity")
    position = F.array_position("_periods", F.col("qidx")).cast("int")
    previous = F.get("_periods", position - 2)
    return (
        panel.withColumn("_before", F.lag("qidx").over(by_item))
        .withColumn("_both", (F.col("value") + F.lag("value").over(by_item)) / 2)
        .join(of_items, ["entity", "item"])
        .withColumn("avg", F.when(F.col("_before") == previous, F.col("_both")))
        .select(*panel.columns, "avg")
    )


def defined_series(item: str, rules: ItemRules) -> set[str]:
    """Names of the series that `derive_series` fills for an item."""
    stock = rules.stock_marker in item or item in rules.stock_notes
    return ({"avg", "roll5"} if stock else set()) | ({"roll4"} if item.startswith(rules.ttm_prefix) else set())


def derive_series(panel: DataFrame, rules: ItemRules, two_point: bool = False) -> DataFrame:
    """`avg` and `roll5` for stock items, `roll4` for income items, on one exchange.

    `two_point` takes the mean of this and the previous reported period as `avg`; that reads the panel three times, but its
    values once.
    """
    source = add_two_point_average(panel).withColumnRenamed("avg", "_avg") if two_point else panel
    average = F.col("_avg") if two_point else average_balance(rules)
    return source.select(
        *panel.columns,
        F.when(is_stock(rules), average).alias("avg"),
        F.when(is_stock(rules), five_point_mean(rules)).alias("roll5"),
        F.when(F.col("item").startswith(rules.ttm_prefix), trailing_year(rules)).alias("roll4"),
    )
