"""Choosing among several exports of the same cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_first(when: Column, kind: str) -> Column:
    """A value whose ascending order is newest first; an unknown date comes last.

    A time without zone is compared by its distance from a fixed one, so no session time zone enters.
    """
    if kind == "timestamp_ntz":
        return F.coalesce(F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") - when, F.expr("INTERVAL '106751990' DAY"))
    ticks = F.unix_date(when) if kind == "date" else F.unix_micros(when)
    return F.coalesce(-ticks.cast("long"), F.lit(2**63 - 1))


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Per key the values of the row that comes first by `order`.

    An aggregate, not a row_number: it combines map-side, so a key that holds a third of all rows costs one row per
    task in the shuffle. A NULL value of the first row wins.
    """
    first = F.min_by(F.struct(*values), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, *[F.col(f"_first.{v}") for v in values])


def dedup_latest_export(
    df: DataFrame, keys: Sequence[str], exported: str, tie: str, values: Sequence[str] = ("value",)
) -> DataFrame:
    """The newest export wins per key; equal dates are settled by the smallest `tie`."""
    kind = dict(df.dtypes)[exported]
    return pick_first(df, keys, [newest_first(F.col(exported), kind), F.col(tie)], values)


def prefer_reports(
    df: DataFrame, keys: Sequence[str], report_rank: str, exported: str, tie: str, values: Sequence[str] = ("value",)
) -> DataFrame:
    """The preferred report kind wins (smallest rank), others fill the keys it lacks; within a kind the newest."""
    kind = dict(df.dtypes)[exported]
    order = [F.col(report_rank), newest_first(F.col(exported), kind), F.col(tie)]
    return pick_first(df, keys, order, values)
