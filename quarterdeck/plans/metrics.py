"""Facts of all frequencies to published metric tables.

Exchanges on panel-sized data: one on (entity, item), which serves the year-to-date cells and all series windows; one for
the wide rows. The series and the calendars are landed, as entities and groups both read them. Calendars and groups are
combined map-side first. Items no formula uses are filtered at the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.config import Formula, ItemRules, PeerGroup
from quarterdeck.functions.period import index_quarter, index_year, period_start_text
from quarterdeck.functions.text import clean_name
from quarterdeck.operators.formulas import (
    SERIES,
    check_formulas,
    error_table,
    evaluate_blocks,
    in_blocks,
    known_columns,
    referenced_items,
    vectors,
)
from quarterdeck.operators.groups import group_rows, summarize_by_group
from quarterdeck.operators.panel import PANEL, calendar_rows, entity_calendar, merge_panel, own_periods
from quarterdeck.operators.ranking import published_entities
from quarterdeck.operators.series import derive_series
from quarterdeck.session import dealt, land, more_tasks, scratch_path


@dataclass(frozen=True)
class Metrics:
    """Evaluated metrics: the long values and the formulas that failed."""

    values: DataFrame
    errors: DataFrame


def known_items(facts: DataFrame, items: Sequence[str]) -> list[str]:
    """Which of the items the data holds. One small job; skip it by passing the dictionary's items."""
    rows = facts.filter(F.col("item").isin(*items)).select("item").distinct().collect()
    return sorted(r[0] for r in rows)


def whole_calendar(calendars: DataFrame) -> Column:
    """All periods of the panel as one array: a scalar subquery over the entities' calendars."""
    return calendars.agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set(own_periods()))))).scalar()


def filled_calendar(own: DataFrame, calendar: Column | None) -> DataFrame:
    """entity, year, quarter, qidx, present: an entity's own `periods`, and those of the whole calendar that it lacks."""
    periods = F.col("periods") if calendar is None else F.array_union(calendar, F.col("periods"))
    rows = own.select("entity", F.explode(periods).alias("qidx"), "periods").withColumn("present", F.array_contains("periods", F.col("qidx")))
    return rows.select(
        "entity", index_year(F.col("qidx")).alias("year"), index_quarter(F.col("qidx")).alias("quarter"), "qidx", "present"
    )


def enrich_panel(
    panel: DataFrame,
    membership: DataFrame,
    groups: Sequence[PeerGroup],
    rules: ItemRules,
    items: DataFrame | None = None,
    means: bool = True,
    two_point: bool = False,
) -> DataFrame:
    """Panel plus group rows, with all derived series. The panel is read several times, so land it first.

    Without `means` groups have totals only; `two_point` changes the average balance (see `derive_series`).
    """
    return derive_series(summarize_by_group(panel, membership, groups, means, items), rules, two_point)


def build_metrics(
    facts: DataFrame,
    membership: DataFrame,
    groups: Sequence[PeerGroup],
    formulas: Sequence[Formula],
    rules: ItemRules,
    items: Sequence[str] | None = None,
    annualise: bool = False,
    published: tuple[Sequence, Sequence] | None = None,
    means: bool = True,
    two_point: bool = False,
) -> Metrics:
    """Evaluate all formulas for entities and groups. The facts are read several times, so land them first.

    `items` is the chart of accounts, if known. `published` = (ranked peers, everyone) limits the result to the
    entities a metric table shows and fills their calendar, as publishing needs. `means` and `two_point` as in
    `enrich_panel`.
    """
    spark = facts.sparkSession
    used = referenced_items(formulas)
    present = known_items(facts, used) if items is None else [i for i in used if i in set(items)]
    named = facts.withColumn("entity", F.col("entity").cast("string"))
    # Both are read twice below, for entities and for groups.
    calendars = land(entity_calendar(named), scratch_path(spark, "calendars"))
    merged = merge_panel(named, rules, used, calendars)
    series = land(derive_series(merged, rules, two_point), scratch_path(spark, "series"))
    chart = spark.createDataFrame([(i,) for i in used], "item string")
    members = membership.withColumn("entity", F.col("entity").cast("string"))
    rows = series.select(*PANEL).unionByName(calendar_rows(calendars))
    group_panel = group_rows(rows, members, groups, means, chart)
    group_series = derive_series(group_panel, rules, two_point)

    columns = known_columns(formulas, present, SERIES, rules)
    good, failed = check_formulas(spark, list(columns), formulas)
    blocks = in_blocks(good, columns)
    periods = calendars.select("entity", own_periods().alias("periods"))
    group_periods = group_panel.groupBy("entity").agg(F.collect_set("qidx").alias("periods"))
    calendar = None
    if published is not None:
        peers, everyone = published
        calendar = whole_calendar(calendars)
        shown = published_entities(F.col("entity"), peers, everyone)
        series, group_series, periods, group_periods = (x.filter(shown) for x in (series, group_series, periods, group_periods))
    if more_tasks(series):  # in the partitioning of the vectors, whose rows are of many items
        series = dealt(series, "entity", "year", "quarter", "qidx")
    found = vectors(series, blocks, columns, filled_calendar(periods, calendar)).unionByName(
        vectors(group_series, blocks, columns, filled_calendar(group_periods, calendar))
    )
    return Metrics(evaluate_blocks(found, blocks, annualise), error_table(spark, failed))


def publish(values: DataFrame, formulas: Sequence[Formula]) -> DataFrame:
    """Metric tables in one frame: sheet, table name, first day of the period, entity name and value."""
    names = F.create_map(*[x for f in formulas for x in (F.lit(f.metric), clean_name(F.lit(f.metric)))])
    sheets = F.create_map(*[x for f in formulas for x in (F.lit(f.metric), F.lit(f.sheet))])
    return values.select(
        F.element_at(sheets, F.col("metric")).alias("sheet"),
        F.element_at(names, F.col("metric")).alias("table_name"),
        period_start_text(F.col("year"), F.col("quarter")).alias("yq"),
        F.col("entity").alias("name"),
        "value",
    )
