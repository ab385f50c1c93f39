"""Row numbers that do not put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.session import checkpointed


def chunk_of(position: Column, chunk_rows: int) -> Column:
    return F.floor(position / chunk_rows)


def running_offsets(sizes: DataFrame, keys: list[str], order: str, size: str = "n", out: str = "before") -> DataFrame:
    """Rows that precede each chunk of its group. Holds one row per chunk, not per data row."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn(out, F.coalesce(F.sum(size).over(earlier), F.lit(0).cast("long")))


def number_in_chunks(df: DataFrame, keys: list[str], chunk: str, order: list, out: str) -> DataFrame:
    """1-based number within `keys`, given a column that cuts every group into ordered pieces.

    Each piece is numbered by itself; the sizes of the earlier pieces are summed up separately and added back.
    """
    sizes = df.groupBy(*keys, chunk).agg(F.count("*").alias("n"))
    offsets = running_offsets(sizes, keys, chunk, out="_before").drop("n")
    local = F.row_number().over(Window.partitionBy(*keys, chunk).orderBy(*order))
    return (
        df.withColumn("_local", local)
        .join(offsets, [*keys, chunk])
        .withColumn(out, F.col("_before") + F.col("_local"))
        .drop("_local", "_before")
    )


def number_by_position(
    df: DataFrame, keys: list[str], position: str, out: str, chunk_rows: int = 65536
) -> DataFrame:
    """1-based number within `keys` by an integer `position` that is unique there.

    A group is cut into position ranges, so no task sorts more than `chunk_rows` rows of it.
    """
    chunked = df.withColumn("_chunk", chunk_of(F.col(position), chunk_rows))
    return number_in_chunks(chunked, keys, "_chunk", [position], out).drop("_chunk")


def number_by_order(df: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """1-based number within `keys` by any unique order, however large a group is.

    Rows are range-partitioned by (keys, order), so equal keys spread over many tasks. The partition id is written
    down with a checkpoint because the sampled range bounds may differ if the exchange were computed again.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *[F.col(k) for k in keys], *order)
    ranged = checkpointed(ranged.withColumn("_part", F.spark_partition_id()))
    return number_in_chunks(ranged, keys, "_part", order, out).drop("_part")
