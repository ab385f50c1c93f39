"""Workbook folders to a landed cell table, and from there to facts of all frequencies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.config import HEADER_ROW, LABEL_COLUMN, SHEET_TITLES, UNIT_COLUMN
from quarterdeck.functions.text import clean_name
from quarterdeck.operators.exports import dedup_latest_export
from quarterdeck.session import land, scratch_path
from quarterdeck.sources.statements import (
    export_dates,
    statement_facts,
    statement_items,
    statement_sheets,
    structure_of,
    with_period_parts,
)
from quarterdeck.sources.workbooks import good_cells, quarantine, read_workbooks


@dataclass(frozen=True)
class Ingested:
    facts: DataFrame
    structure: DataFrame
    rejected: DataFrame


def land_cells(spark: SparkSession, folder: str, target: str, structure_only: bool = False) -> DataFrame:
    """Decode every workbook once and write the cells; later steps read them with filters pushed to the scan.

    `structure_only` leaves the value cells unread: below the header only labels and units are decoded.
    """
    columns = [LABEL_COLUMN, UNIT_COLUMN] if structure_only else []
    titles = list(SHEET_TITLES.values())
    return land(read_workbooks(spark, folder, titles=titles, columns=columns, by_frequency=True), target)


def _rejects(where: DataFrame, error: Column) -> DataFrame:
    return where.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), error.alias("error"))


def sheet_rejects(cells: DataFrame, items: DataFrame, filled: DataFrame) -> DataFrame:
    """Statement sheets of readable files that give no line item: (path, file, error), one row per file, entity and sheet.

    `cells` are those of the statement sheets, `filled` their distinct path, entity and sheet. A sheet may lack the header row, its label or unit column, or any row with a
    unit. Files are told apart by `path`.
    """
    sheet = ["path", "entity", "sheet"]
    heads = cells.filter(F.col("row_pos") == HEADER_ROW).select(*sheet, clean_name(F.col("text")).alias("name"))
    found = heads.groupBy(*sheet).agg(
        F.bool_or(F.col("name") == LABEL_COLUMN).alias("label"), F.bool_or(F.col("name") == UNIT_COLUMN).alias("unit")
    )
    used = items.select(F.col("file").alias("path"), "entity", "sheet").distinct().withColumn("used", F.lit(True))
    joined = filled.join(found, sheet, "left")
    reason = (
        F.when(F.col("label").isNull(), "no header row")
        .when(~F.col("label"), "no label column")
        .when(~F.col("unit"), "no unit column")
        .otherwise("no line item")
    )
    lost = joined.join(used, sheet, "left").filter(F.col("used").isNull())
    return _rejects(lost, F.concat("sheet", F.lit(": "), reason))


def period_rejects(facts: DataFrame) -> DataFrame:
    """Column headers that are no period: (path, file, error), one row per file, sheet and header."""
    unread = facts.filter(F.col("year").isNull() | F.col("quarter").isNull())
    columns = unread.select(F.col("file").alias("path"), "sheet", "period").distinct()
    return _rejects(columns, F.concat("sheet", F.lit(": unreadable period "), F.coalesce("period", F.lit("(empty)"))))


def ingest(landed: DataFrame, work: str | None = None) -> Ingested:
    """Facts (newest export wins), structure and rejects of a landed cell table.

    Line items and the list of sheets are landed too, as several results read them: in `work`, or else as scratch data.

    Every file ends in facts or in `rejected`, with the reason: what the source did not read (files of no bytes, of other
    kinds, damaged, locked, in none or several frequency folders; entities with missing sheets or not in the file's name;
    repeated cells), an entity's sheets without a readable export date as a whole, a sheet without line items and a header
    that is no period by themselves.
    """
    place = lambda name: f"{work}/{name}" if work else scratch_path(landed.sparkSession, name)
    readable = good_cells(landed).withColumn("file", F.col("path"))
    cells = statement_sheets(readable)
    dates = export_dates(cells)
    # One pass over all cells; what else is read of them are header and date rows.
    sheets = land(cells.select("path", "file", "entity", "sheet").distinct(), place("sheets"))
    files = (
        sheets.select("path", "file", "entity").distinct()
        .join(dates, ["file", "entity"], "left")
        .withColumn("error", F.when(F.col("export_date").isNull(), "no export date"))
    )
    dated = files.filter(F.col("error").isNull()).select("file", "entity", "export_date")
    labelled = F.array_contains(F.map_values("header"), LABEL_COLUMN)
    items = land(statement_items(cells, keep=["entity", "freq"]).filter(labelled), place("items"))
    facts = with_period_parts(statement_facts(items, keep=["entity", "freq"]).join(dated, ["file", "entity"]))
    on_time = facts.filter(F.col("year").isNotNull() & F.col("quarter").isNotNull())
    newest = dedup_latest_export(on_time, ["freq", "entity", "item", "label", "period"], "export_date", "file")
    known, filled = (f.join(dated, ["file", "entity"], "left_semi") for f in (cells, sheets))
    rejected = (
        quarantine(landed)
        .unionByName(_rejects(files.filter(F.col("error").isNotNull()), F.col("error")))
        .unionByName(sheet_rejects(known, items, filled))
        .unionByName(period_rejects(facts))
    )
    structure = structure_of(items, keep=["entity", "freq"]).withColumnRenamed("freq", "folder")
    return Ingested(with_period_parts(newest), structure.join(dated, ["file", "entity"], "left_semi"), rejected)
