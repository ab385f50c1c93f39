"""Order of the named peers at the latest period, and the views that use it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.operators.numbering import number_by_order
from quarterdeck.operators.reshape import pivot_unique
from quarterdeck.session import checkpointed


def latest_values(values: DataFrame, shown: Column, latest: Column | None = None) -> DataFrame:
    """Value of every (metric, entity) that is `shown` at the latest period; NULL where the entity has none there.

    One pass: an aggregate keeps each key's last period with its value, all entities that are not shown being one key of
    their metric; the latest period is that of the keys. `latest` sets it instead.
    """
    last = F.max(F.struct("qidx", "value")).alias("last")
    keyed = values.groupBy("metric", F.when(shown, F.col("entity")).alias("entity"), shown.alias("_shown"))
    if latest is None:
        keys = checkpointed(keyed.agg(last))  # as many as metrics and entities; read twice
        latest = keys.agg(F.max("last.qidx")).scalar()
    else:
        keys = keyed.agg(F.max(F.when(F.col("qidx") == latest, F.struct("qidx", "value"))).alias("last"))
    return keys.filter("_shown").select("metric", "entity", F.when(F.col("last.qidx") == latest, F.col("last.value")).alias("value"))


def rank_latest_period(values: DataFrame, peers: Sequence | DataFrame, latest: Column | None = None) -> DataFrame:
    """Rank the peers per metric by their latest value, descending, NULLs first, ties by entity.

    A configured list of peers bounds the rows per metric, so a plain window ranks them. Peers given as a DataFrame
    (column `entity`) may be any number and are ranked with range partitioning.
    """
    order = [F.col("value").desc_nulls_first(), F.col("entity").asc()]
    if isinstance(peers, DataFrame):
        listed = peers.select("entity", F.lit(True).alias("_peer")).distinct()
        kept = latest_values(values.join(listed, "entity", "left"), F.coalesce("_peer", F.lit(False)), latest)
        return number_by_order(kept, ["metric"], order, "latest_rank")
    kept = latest_values(values, F.coalesce(F.col("entity").isin(*peers), F.lit(False)), latest)
    rank = F.row_number().over(Window.partitionBy("metric").orderBy(*order))
    return kept.withColumn("latest_rank", rank.cast("long"))


def published_entities(entity: Column, peers: Sequence, everyone: Sequence) -> Column:
    """Entities a metric table shows: the ranked peers and whatever is outside the full list (the group rows)."""
    return entity.isin(*peers) | ~entity.isin(*everyone)


def wide_metric(values: DataFrame, metric: str, peers: Sequence, everyone: Sequence) -> DataFrame:
    """Period rows x entity columns of one metric: peers in rank order, then the group rows.

    A column per peer and group row, so their names are read on the driver; for many of them use the long metric table.
    The metric's values are checkpointed, as the order, the names and the pivot all read them.
    """
    one = checkpointed(values.filter(F.col("metric") == metric))
    ranked = rank_latest_period(one, peers).orderBy("latest_rank").select("entity")
    others = one.filter(~F.col("entity").isin(*everyone)).select("entity").distinct().orderBy("entity")
    columns = [r[0] for frame in (ranked, others) for r in frame.collect()]
    # every period stays a row, also one that only unpublished entities report
    return pivot_unique(one, ["year", "quarter"], "entity", "value", columns).orderBy("year", "quarter")
