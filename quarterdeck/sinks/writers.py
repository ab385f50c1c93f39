"""Parquet, CSV and table outputs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from quarterdeck.operators.reshape import pivot_unique
from quarterdeck.session import remove


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """One directory per value of `by` (default `sheet`), nested if there are several columns.

    The rebalance hint gives each value few files and lets AQE split a value that is too big for one task.
    """
    columns = by or ("sheet",)
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def wide_raw_panel(facts: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Items x sorted period columns."""
    return pivot_unique(facts, ["item", "label", "entity"], "period", "value", sorted(periods))


def period_columns(facts: DataFrame) -> list[str]:
    """Period labels present, sorted; a driver-side list as long as the calendar."""
    rows = facts.select("period").distinct().filter(F.col("period").rlike(r"^\d{4}_q\d")).collect()
    return sorted(r[0] for r in rows)


def join_lists(df: DataFrame, separator: str = " | ") -> DataFrame:
    """Text lists to one text, as files cannot hold lists."""
    lists = [f.name for f in df.schema if isinstance(f.dataType, ArrayType)]
    return df.withColumns({c: F.concat_ws(separator, F.col(c)) for c in lists})


def guard_formulas(df: DataFrame) -> DataFrame:
    """Prefix text that a spreadsheet would take for a formula with an apostrophe."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    guarded = {
        c: F.when(F.col(c).rlike(r"^[=+\-@]"), F.concat(F.lit("'"), F.col(c))).otherwise(F.col(c)) for c in texts
    }
    return df.withColumns(guarded)


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV with guarded text; doubled quotes inside cells."""
    guarded = guard_formulas(join_lists(df))
    guarded.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def temporal_as_text(df: DataFrame) -> DataFrame:
    """Dates as yyyy-MM-dd and timestamps as yyyy-MM-dd HH:mm:ss."""
    texts = {}
    for field in df.schema:
        if isinstance(field.dataType, DateType):
            texts[field.name] = F.date_format(field.name, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType):
            texts[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, TimestampNTZType):
            # date_format would go through the session time zone
            texts[field.name] = F.substring(F.col(field.name).cast("string"), 1, 19)
    return df.withColumns(texts)


def storage_type(data_type) -> str:
    """Type class of a published column."""
    if isinstance(data_type, (BooleanType, IntegralType)):
        return "INTEGER"
    if isinstance(data_type, (FloatType, DoubleType)):
        return "REAL"
    return "TEXT"


_SPARK_TYPES = {"INTEGER": "bigint", "REAL": "double", "TEXT": "string"}


def as_published(df: DataFrame) -> DataFrame:
    """Reduce the columns to the three published types."""
    texts = temporal_as_text(df)
    return texts.select(*[F.col(f.name).cast(_SPARK_TYPES[storage_type(f.dataType)]).alias(f.name) for f in texts.schema])


def replace_table(df: DataFrame, table: str, folder: str | None = None) -> bool:
    """Replace a table and its columns; an empty result leaves the old one alone. Returns whether it was replaced.

    The result is staged as a table of its own, `<table>__next`, and read back before anything happens to the old one; then
    the names are swapped. A run that ends in between leaves the old table as it was, or, between the two renames, as
    `<table>__old`, from which the next run takes it back. `folder` holds the data of the versions; without one the
    catalog's warehouse does.
    """
    spark = df.sparkSession
    following, former = f"{table}__next", f"{table}__old"
    recover_table(spark, table)
    published = as_published(df)
    writer = published.write.mode("overwrite").format("parquet")
    version = f"{folder.rstrip('/')}/{uuid.uuid4().hex}" if folder else None
    try:
        (writer.option("path", version) if version else writer).saveAsTable(following)
    except Exception:
        if version:
            remove(spark, version)
        raise
    staged = spark.table(following)
    if staged.dtypes != published.dtypes:
        raise ValueError(f"{following} holds {staged.dtypes}, not {published.dtypes}")
    if staged.isEmpty():
        _drop(spark, following)
        return False
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    _drop(spark, former)
    return True


def recover_table(spark: SparkSession, table: str) -> None:
    """Take back what a run left that ended before it was done: the old table, if it has no name, and no staged one."""
    if spark.catalog.tableExists(f"{table}__old"):
        if spark.catalog.tableExists(table):
            _drop(spark, f"{table}__old")
        else:
            spark.sql(f"ALTER TABLE {table}__old RENAME TO {table}")
    _drop(spark, f"{table}__next")


def _drop(spark: SparkSession, table: str) -> None:
    """Drop a table with its data, which a catalog leaves where a folder was given."""
    if not spark.catalog.tableExists(table):
        return
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    spark.sql(f"DROP TABLE {table}")
    if detail.get("Type") == "EXTERNAL" and detail.get("Location"):
        remove(spark, detail["Location"])


def replace_tables(frames: Mapping[str, DataFrame], folder: str | None = None) -> dict[str, str]:
    """Replace several tables; a failing one is reported and does not stop the others."""
    errors = {}
    for table, df in frames.items():
        try:
            replace_table(df, table, f"{folder}/{table}" if folder else None)
        except Exception as error:
            errors[table] = str(error)
    return errors
