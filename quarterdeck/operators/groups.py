"""Peer groups as pseudo-entities: means and totals per period and item.

`membership(group, entity)` may hold overlapping groups. It is joined without a hint: Spark broadcasts it only below
`spark.sql.autoBroadcastJoinThreshold` and shuffles (with skew splitting) otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.config import PeerGroup
from quarterdeck.session import land, scratch_path

_PERIOD = ["year", "quarter", "qidx"]
#: Buckets of the chart of accounts in a grid of items and periods.
GRID_BUCKETS = 16


def membership_of(df: DataFrame, groups: dict[str, Sequence]) -> DataFrame:
    """A small configured membership as a DataFrame in the session of `df`."""
    entity_type = df.schema["entity"].dataType.simpleString()
    rows = [(group, entity) for group, members in groups.items() for entity in members]
    return df.sparkSession.createDataFrame(rows, f"`group` string, entity {entity_type}")


def present_entities(panel: DataFrame) -> DataFrame:
    return panel.select("entity").distinct()


def group_member_count(entities: DataFrame, membership: DataFrame) -> DataFrame:
    """Distinct members present anywhere in the panel, per group. Input: distinct entities."""
    return entities.join(membership.distinct(), "entity").groupBy("group").agg(F.count("*").alias("n_members"))


def group_cells(panel: DataFrame, membership: DataFrame) -> DataFrame:
    """Mean (skipping NULLs) and sum of every item per group and period, all overlapping groups in one pass.

    Members are combined map-side, so the shuffle carries groups x periods x items per task, whatever a group's size.
    """
    return (
        panel.join(membership, "entity")
        .groupBy("group", *_PERIOD, "item")
        .agg(F.avg("value").alias("mean"), F.sum("value").alias("total"))
    )


def group_summary(panel: DataFrame, membership: DataFrame, outsiders: bool = True) -> DataFrame:
    """All that group rows need, in one pass over the panel, landed: group, period, item, entity, mean, total.

    Rows with an entity tell who is present in a group; the others are its cells and, with a NULL item, periods. Both kinds
    are combined map-side by one aggregate. `outsiders` adds the cells of entities in no group, under a NULL group.
    """
    joined = panel.join(membership.distinct(), "entity", "left" if outsiders else "inner")
    entity_type = panel.schema["entity"].dataType
    kinds = {"year": "int", "quarter": "int", "qidx": "int", "item": "string", "value": "double"}
    cell = F.struct("group", F.lit(None).cast(entity_type).alias("entity"), *(F.col(c).cast(t).alias(c) for c, t in kinds.items()))
    member = F.struct("group", "entity", *(F.lit(None).cast(t).alias(c) for c, t in kinds.items()))
    rows = joined.select(F.inline(F.array(cell, member))).filter(F.col("group").isNotNull() | F.col("item").isNotNull())
    cells = rows.groupBy("group", "entity", *_PERIOD, "item").agg(F.avg("value").alias("mean"), F.sum("value").alias("total"))
    return land(cells, scratch_path(panel.sparkSession, "group-cells"))


def filled_group_cells(panel: DataFrame, membership: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """`group_cells` with every item of the panel in every period of a group, and the group's number of members present.

    A statement table has all columns in every row, so an item that no member reports has no mean and a total of 0. The
    grid of items and periods is an equi-join on a bucket of the items, which every period is dealt to. `items` (column
    `item`) is the chart of accounts, if known.
    """
    summary = group_summary(panel, membership, outsiders=items is None)
    grouped = summary.filter(F.col("group").isNotNull())
    by_group = grouped.groupBy("group").agg(
        F.collect_set(F.when(F.col("entity").isNull(), F.struct(*_PERIOD))).alias("periods"), F.count("entity").alias("n_members")
    )
    chart = (summary if items is None else items).filter(F.col("item").isNotNull()).select("item").distinct()
    bucketed = chart.withColumn("bucket", F.pmod(F.hash("item"), F.lit(GRID_BUCKETS)))
    periods = by_group.select("group", "n_members", F.inline("periods")).withColumn(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(GRID_BUCKETS - 1)))
    )
    none = F.lit(None).cast("double")
    grid = periods.join(bucketed, "bucket").select("group", *_PERIOD, "item", none.alias("mean"), none.alias("total"), "n_members")
    cells = grouped.filter(F.col("item").isNotNull()).select(
        "group", *_PERIOD, "item", "mean", "total", F.lit(None).cast("long").alias("n_members")
    )
    # Each cell meets its place in the grid; a place alone has the total 0. An item outside the chart has no place.
    met = grid.unionByName(cells).groupBy("group", *_PERIOD, "item").agg(*(F.max(c).alias(c) for c in ("mean", "total", "n_members")))
    return met.filter(F.col("n_members").isNotNull()).withColumn("total", F.coalesce("total", F.lit(0.0)))


def group_mean(panel: DataFrame, membership: DataFrame) -> DataFrame:
    return group_cells(panel, membership).select("group", *_PERIOD, "item", F.col("mean").alias("value"))


def group_sum(panel: DataFrame, membership: DataFrame, items: DataFrame | None = None) -> DataFrame:
    cells = filled_group_cells(panel, membership, items)
    return cells.select("group", *_PERIOD, "item", F.col("total").alias("value"))


def _label(labels: dict[str, str | None]) -> Column:
    label = F.lit(None).cast("string")
    for key, pattern in labels.items():
        if pattern:
            label = F.when(F.col("group") == key, F.format_string(pattern, "n_members")).otherwise(label)
    return label


def group_rows(
    panel: DataFrame,
    membership: DataFrame,
    groups: Sequence[PeerGroup],
    means: bool = True,
    items: DataFrame | None = None,
) -> DataFrame:
    """The pseudo-entities alone, in panel form: one pass over the panel gives means, totals and numbers of members.

    `items` (the chart of accounts) is read from the panel unless the caller has it.
    """
    total_rows = F.struct(_label({g.key: g.total_label for g in groups}).alias("entity"), F.col("total").alias("value"))
    mean_rows = F.struct(_label({g.key: g.mean_label for g in groups}).alias("entity"), F.col("mean").alias("value"))
    return (
        filled_group_cells(panel, membership, items)
        .select("item", *_PERIOD, F.inline(F.array(mean_rows, total_rows) if means else F.array(total_rows)))
        .filter(F.col("entity").isNotNull())
        .select("entity", "item", *_PERIOD, "value")
    )


def summarize_by_group(
    panel: DataFrame,
    membership: DataFrame,
    groups: Sequence[PeerGroup],
    means: bool = True,
    items: DataFrame | None = None,
) -> DataFrame:
    """The panel with its group rows appended; group rows are ordinary entities for every later step."""
    rows = group_rows(panel, membership, groups, means, items)
    return panel.withColumn("entity", F.col("entity").cast("string")).unionByName(rows)
