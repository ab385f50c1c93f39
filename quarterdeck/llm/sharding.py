"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded key and ranked within their source; rank over source size is a row's fractional rank.
Sorted by it, every stretch of rows holds the sources in the proportions of the whole, so equal cuts give shards that
match the mixture, with row counts at most one apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import id_text, numbered


def interleave(
    rows: DataFrame, shards: int, seed: int, source: str = "source", key: str = "doc_id", ties: tuple[str, ...] = ()
) -> DataFrame:
    """Add `shard` and `slot` (gapless from 0 in each shard) to all rows; other columns stay.

    A null source is a source of its own, a null key counts as empty text. Rows with equal key are told apart by the
    columns in `ties`; rows equal in those too get neighbouring places in any order. With fewer rows than shards, some
    shards are empty; an empty table stays empty. Columns named `_stratum`, `_shuffle`, `_rank` are reserved.
    """
    prepared = rows.withColumns(
        {
            "_stratum": F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")),
            "_shuffle": F.md5(F.concat(F.lit(f"{seed}:"), id_text(key))),
        }
    )
    finest = [F.col("_stratum"), F.col("_shuffle"), F.col(key), *map(F.col, ties)]
    ranked, total = numbered(prepared, finest, "_rank")
    # A source's rows are neighbours in that order: its first position and its size give the rank within it.
    sources = ranked.groupBy("_stratum").agg(F.min("_rank").alias("_first"), F.count("*").alias("_size"))
    rank = F.col("_rank") - F.col("_first")
    fractional = ranked.join(sources, "_stratum").withColumn("_share", (2 * rank + 1) / (2 * F.col("_size")))
    placed, _ = numbered(fractional, [F.col("_share"), *finest], "_place")
    shard = F.expr(f"_place * {shards} div {max(total, 1)}")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_place") - F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}"))
        .drop("_stratum", "_shuffle", "_rank", "_first", "_size", "_share", "_place")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    shards = sharded.select("shard").distinct().count()
    sharded.repartition(max(shards, 1), "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all rows. A null text has no bytes."""
    narrow = docs.select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    placed = interleave(narrow, shards, seed, ties=("size", "text_crc32"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
