"""CSV tables the job is configured with, and plain sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.config import Formula

# Headers of the formula table and the dictionary table.
FORMULA_HEADERS = {"Chỉ tiêu": "metric", "Công thức tính": "formula", "Tên sheet": "sheet"}
DICTIONARY_HEADERS = {"rowid": "item", "chi_tieu": "label"}


def _csv(spark: SparkSession, path: str, headers: dict[str, str]) -> DataFrame:
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    df = df.toDF(*[c.lstrip("\ufeff") for c in df.columns])
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in headers.items()])


def read_formulas(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, FORMULA_HEADERS)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, DICTIONARY_HEADERS)


def formula_list(formulas: DataFrame) -> list[Formula]:
    """Formulas as plan settings: each becomes an expression of the plan, so their texts belong on the driver."""
    rows = formulas.select("metric", "formula", "sheet").collect()
    return [Formula(r["metric"], r["formula"], r["sheet"]) for r in rows]
