"""Which items each formula uses, and what they mean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.text import item_references, strip_prefix


def formula_references(formulas: DataFrame) -> DataFrame:
    """One row per (metric, formula, item) in order of first use; a formula without items keeps one row."""
    refs = F.posexplode_outer(item_references(F.col("formula"))).alias("pos", "item")
    return formulas.select("metric", "formula", refs)


def with_labels(references: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Left join to the dictionary; the guard apostrophe of the CSV export is removed from the labels."""
    labels = dictionary.select("item", strip_prefix(F.col("label"), "'").alias("label"))
    return references.join(labels, "item", "left")


def missing_definitions(references: DataFrame, dictionary: DataFrame) -> DataFrame:
    """References without a usable label."""
    labelled = dictionary.filter(F.col("label").isNotNull()).select("item")
    return references.filter(F.col("item").isNotNull()).join(labelled, "item", "left_anti")


def collapse_definitions(labelled: DataFrame) -> DataFrame:
    """One row per formula with its `item:label` pairs in order of first use; pairs without a label are left out.

    The list is as long as the formula has items.
    """
    pair = F.when(F.col("label").isNotNull(), F.struct("pos", F.concat("item", F.lit(":"), "label").alias("text")))
    ordered = F.sort_array(F.collect_list(pair))
    return labelled.groupBy("metric", "formula").agg(F.concat_ws(" | ", ordered["text"]).alias("definition"))
