"""Structure checks over all workbooks at once.

Input `structure`: entity, sheet, file, item, label, and `folder` where several folders are checked together. Findings
are located with map-side combined aggregates; only the findings are joined back to list their variants.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.config import SHEET_TITLES, ItemRules
from quarterdeck.functions.text import item_references
from quarterdeck.operators.reshape import item_number, item_order, union_relaxed

# Names of the checks in the report.
ROW_COUNT, LABEL_DRIFT, ITEM_DRIFT = "row_count_diff", "chi_tieu_drift", "rowid_drift"
BLOCKING = (ROW_COUNT, LABEL_DRIFT)


def _scope(structure: DataFrame) -> list[str]:
    return [c for c in ("folder", "entity", "sheet") if c in structure.columns]


def _variants(column: str) -> Column:
    """Number of different values, NULL being one of them."""
    return F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))


def row_count_diff(structure: DataFrame) -> DataFrame:
    """Files whose number of line items differs from other files of the same entity and sheet."""
    scope = _scope(structure)
    lengths = structure.groupBy(*scope, "file").agg(F.max(item_number(F.col("item"))).alias("row_count"))
    uneven = (
        lengths.groupBy(*scope)
        .agg(
            F.min("row_count").alias("_low"),
            F.max("row_count").alias("_high"),
            F.count("row_count").alias("_known"),
            F.count("*").alias("_files"),
        )
        .filter((F.col("_low") != F.col("_high")) | ((F.col("_known") > 0) & (F.col("_known") < F.col("_files"))))
    )
    return lengths.join(uneven.select(*scope), scope, "left_semi").withColumn("check_type", F.lit(ROW_COUNT))


def _drift(structure: DataFrame, key: str, varying: str, lists: str, check: str) -> DataFrame:
    keys = [*_scope(structure), key]
    rows = structure.select(*keys, varying, "file").distinct()
    drifting = rows.groupBy(*keys).agg(_variants(varying).alias("n_variants")).filter("n_variants > 1")
    hits = rows.join(drifting, keys)
    # collect_set drops NULL, which is a variant too
    missing = F.when(F.max(F.col(varying).isNull()), F.array(F.lit(None).cast("string"))).otherwise(
        F.array().cast("array<string>")
    )
    return (
        hits.groupBy(*keys, "n_variants")
        .agg(
            F.concat(missing, F.sort_array(F.collect_set(varying))).alias(lists),
            F.sort_array(F.collect_set("file")).alias("files"),
        )
        .withColumn("check_type", F.lit(check))
    )


def label_drift(structure: DataFrame) -> DataFrame:
    """Items that carry more than one label (a missing label counts as one)."""
    return _drift(structure, "item", "label", "label_variants", LABEL_DRIFT)


def item_drift(structure: DataFrame) -> DataFrame:
    """Non-blank labels that sit on more than one item."""
    named = structure.filter(F.col("label").isNotNull() & (F.trim("label") != ""))
    return _drift(named, "label", "item", "item_variants", ITEM_DRIFT)


def audit_report(structure: DataFrame) -> DataFrame:
    """All three checks, for every folder and entity, in one job."""
    return union_relaxed([row_count_diff(structure), label_drift(structure), item_drift(structure)])


def audit_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("check_type").agg(F.count("*").alias("n"))


def rule_items(rules: ItemRules) -> list[str]:
    return [*rules.opening_items, *rules.closing_items, *rules.stock_notes]


def critical_items(formulas: DataFrame, extra: Iterable[str], text: str = "formula") -> DataFrame:
    """Items any formula refers to, and the `extra` ones the item rules name."""
    used = formulas.select(F.explode(item_references(F.col(text))).alias("item"))
    named = formulas.sparkSession.createDataFrame([(i,) for i in extra], "item string")
    return used.union(named).distinct()


def critical_hits(report: DataFrame, critical: DataFrame) -> DataFrame:
    """Findings on items that formulas or rules depend on."""
    return report.join(critical.select("item").distinct(), "item", "left_semi")


def data_dictionary(structure: DataFrame, sheets: Sequence[str] = tuple(SHEET_TITLES)) -> DataFrame:
    """Distinct (item, label) with the statement order as columns; sort by them on output."""
    sheet_pos, number = item_order(F.col("item"), sheets)
    return structure.select("item", "label").distinct().select("item", "label", sheet_pos.alias("sheet_pos"), number.alias("num"))


def repeated_items(dictionary: DataFrame) -> DataFrame:
    """Dictionary rows whose item occurs more than once."""
    many = dictionary.groupBy("item").agg(F.count("*").alias("_n")).filter("_n > 1").select("item")
    return dictionary.join(many, "item", "left_semi")


def audit_gate(report: DataFrame, dictionary: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """One row: blocking findings, items defined twice, sources rejected, and whether the dictionary may be published.

    Rejected sources are only counted: the rest of the structure may still be sound.
    """
    findings = report.agg(F.count_if(F.col("check_type").isin(*BLOCKING)).alias("n_blocking"))
    repeats = repeated_items(dictionary).agg(F.count("*").alias("n_repeated"))
    lost = F.lit(0).cast("long") if rejected is None else rejected.agg(F.count("*").alias("n")).scalar()
    one = findings.withColumn("n_repeated", repeats.scalar()).withColumn("n_rejected", lost)
    return one.withColumn("publish", (F.col("n_blocking") == 0) & (F.col("n_repeated") == 0))
