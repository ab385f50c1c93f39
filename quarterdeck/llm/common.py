"""What several operators share: tables, landing, global row numbers, word splitting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.session import checkpointed, land, scratch_path

#: White space between words, as a regular expression for Java, RE2 and Python alike.
SPACES = r"[\x20\x09-\x0D]+"
_LOCAL_BITS = 33  # monotonically_increasing_id() keeps the number within the partition in that many bits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, df: DataFrame) -> str:
    """The name with as many underscores before it as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back."""
    return land(df, scratch_path(df.sparkSession, name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once: a lambda's variable is not inlined, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(doc_id: str | Column) -> Column:
    """The id as text; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(column.cast("string"), F.lit(""))


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(id_text(doc_id)) % folds


def numbered(df: DataFrame, order: list[Column], out: str) -> tuple[DataFrame, int]:
    """0-based position of every row in a global order, and the number of rows.

    Rows are range-partitioned and sorted, so a key with a large share of the rows spreads over tasks if later order
    columns tell its rows apart. The checkpoint fixes the partitions; only their sizes go through the driver.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    fixed = checkpointed(ranged.withColumn("_local", F.monotonically_increasing_id()))
    part = F.shiftright("_local", _LOCAL_BITS).cast("int")
    sizes = sorted(fixed.groupBy(part.alias("part")).count().collect())
    starts, total = [], 0
    for row in sizes:
        starts.append((row["part"], total))
        total += row["count"]
    # One row per partition of the exchange: small whatever the data.
    offsets = F.broadcast(spark.createDataFrame(starts, "_part int, _start bigint"))
    within = F.col("_local").bitwiseAND((1 << _LOCAL_BITS) - 1)
    return (
        fixed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(out, F.col("_start") + within)
        .drop("_part", "_start", "_local"),
        total,
    )


def running(df: DataFrame, order: list[Column], amounts: dict[str, Column], name: str) -> DataFrame:
    """Add, for each of `amounts`, its sum over all rows before this one in a global order. Built-in functions only.

    Rows are range-partitioned by the order and landed, which fixes the partitions; each is summed by itself and starts at
    the sum of the earlier ones. One row per partition is all that is ordered as a whole. Rows equal in all order columns
    follow each other in any order.
    """
    keys = {f"_order_{k}": c for k, c in enumerate(order)}
    valued = df.withColumns(keys | {f"_amount_{out}": c for out, c in amounts.items()})
    ranged = valued.repartitionByRange(shuffle_partitions(df.sparkSession), *keys)
    rows = landed(ranged.withColumn("_part", F.spark_partition_id()), name)
    within = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_part").agg(*(F.sum(f"_amount_{out}").alias(f"_base_{out}") for out in amounts))
    bases = sums.select("_part", *(F.coalesce(F.sum(f"_base_{out}").over(earlier), F.lit(0)).alias(f"_base_{out}") for out in amounts))
    local = rows.withColumns({out: F.coalesce(F.sum(f"_amount_{out}").over(within), F.lit(0)) for out in amounts})
    total = local.join(bases, "_part").withColumns({out: F.col(out) + F.col(f"_base_{out}") for out in amounts})
    return total.select(*df.columns, *amounts)
