"""Cells of statement sheets to long facts.

Input `cells`: file, sheet, row_pos, col_pos, text (positions 0-based in the used range). A sheet may be far larger
than a task can hold, so rows are cut into position ranges (`chunk`) and everything is keyed by (file, sheet, chunk):
the cells shuffle once, and only per-chunk and per-header tables are joined to them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.config import EXPORT_DATE_ROW, HEADER_ROW, LABEL_COLUMN, SHEET_TITLES, UNIT_COLUMN
from quarterdeck.functions.period import extract_or_null, normalise_period, period_quarter, period_year
from quarterdeck.functions.text import clean_name, safe_double
from quarterdeck.operators.numbering import chunk_of, number_in_chunks
from quarterdeck.operators.reshape import pivot_unique

_SHEET = ["file", "sheet"]


def statement_sheets(cells: DataFrame, titles: Mapping[str, str] = SHEET_TITLES) -> DataFrame:
    """Keep the statement sheets, named `<title> - <entity>`; `sheet` becomes the short key."""
    key = entity = F.lit(None).cast("string")
    for short, full in titles.items():
        named = F.startswith(F.col("sheet"), F.lit(f"{full} - "))
        key = F.when(named, F.lit(short)).otherwise(key)
        entity = F.when(named, F.substr("sheet", F.lit(len(full) + 4))).otherwise(entity)
    return cells.withColumns({"entity": entity, "sheet": key}).filter(F.col("sheet").isNotNull())


def export_dates(cells: DataFrame, first_sheet: str = "BS") -> DataFrame:
    """Export date per file and entity: a dd/mm/yyyy text in the second row of the first sheet; NULL if unreadable."""
    text = extract_or_null(F.col("text"), r"(\d{2}/\d{2}/\d{4})", 1)
    date = F.to_date(F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))
    here = (F.col("row_pos") == EXPORT_DATE_ROW) & (F.col("col_pos") == 0) & (F.col("sheet") == first_sheet)
    return cells.filter(here).groupBy("file", "entity").agg(F.max(date).alias("export_date"))


def statement_items(
    cells: DataFrame,
    keep: Sequence[str] = (),
    header_row: int = HEADER_ROW,
    chunk_rows: int = 4096,
) -> DataFrame:
    """Line items: the rows below the header whose unit cell is filled.

    Output: file, sheet, *keep, row_pos, item, label, cells (map col_pos -> text), header (map col_pos -> cleaned
    name or period). `item` is the sheet key and the position among the kept rows of the sheet. `keep` names columns that are
    constant within a sheet; sheets of one key, as of two entities in one workbook, are told apart by them. Of a cell that is
    given twice the least text counts.
    """
    scope = [*_SHEET, *keep]
    table = cells.filter(F.col("row_pos") >= header_row).withColumn("chunk", chunk_of(F.col("row_pos"), chunk_rows))
    rows = (
        table.filter(F.col("row_pos") > header_row)
        .repartition(*scope, "chunk")
        .groupBy(*scope, "chunk", "row_pos")
        .agg(F.collect_list(F.struct("col_pos", F.col("text").alias("value"))).alias("entries"))
        .withColumn("cells", _map_of("entries"))
        .drop("entries")
    )
    # periods are read here, once per column, not once per fact
    named = F.struct("col_pos", normalise_period(clean_name(F.col("text"))).alias("value"))
    headers = (
        table.filter(F.col("row_pos") == header_row)
        .groupBy(*scope)
        .agg(F.collect_list(named).alias("entries"))
        .withColumn("header", _map_of("entries"))
        .drop("entries")
    )
    chunk_headers = table.select(*scope, "chunk").distinct().join(headers, scope)
    kept = (
        rows.join(chunk_headers, [*scope, "chunk"])
        .withColumn("unit", _cell_under("header", "cells", UNIT_COLUMN))
        .filter(F.col("unit").isNotNull())
    )
    numbered = number_in_chunks(kept, scope, "chunk", ["row_pos"], "_n")
    return numbered.select(
        *scope,
        "row_pos",
        F.concat("sheet", F.lit("_"), F.col("_n").cast("string")).alias("item"),
        _cell_under("header", "cells", LABEL_COLUMN).alias("label"),
        "cells",
        "header",
    )


def _map_of(entries: str) -> Column:
    """Map of (col_pos, value) entries; a column given twice has its least value. Entries are as many as the sheet is wide."""
    columns = F.array_distinct(F.transform(entries, lambda e: e["col_pos"]))
    of = lambda c: F.array_min(F.transform(F.filter(entries, lambda e: e["col_pos"] == c), lambda e: e["value"]))
    return F.when(F.size(columns) == F.size(entries), F.map_from_entries(entries)).otherwise(
        F.map_from_arrays(columns, F.transform(columns, of))
    )


def _cell_under(header: str, cells: str, name: str) -> Column:
    """Text of the row under the named column. The maps are as wide as the sheet."""
    columns = F.map_keys(F.map_filter(header, lambda _, n: n == name))
    return F.try_element_at(cells, F.get(columns, F.lit(0)))


def statement_facts(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Line items to long facts; one row per item and period column, a missing cell being NULL."""
    periods = F.map_filter("header", lambda _, n: ~n.isin(LABEL_COLUMN, UNIT_COLUMN))
    return (
        items.select(*_SHEET, *keep, "item", "label", "cells", F.explode(periods).alias("col_pos", "period"))
        .withColumn("value", safe_double(F.try_element_at("cells", F.col("col_pos"))))
        .select(*_SHEET, *keep, "item", "label", "period", "value")
    )


def plain_rows(cells: DataFrame, sheet: str, columns: Sequence[str]) -> DataFrame:
    """Rows of a plain sheet whose first row holds the headers; `columns` are cleaned header names, values are text."""
    table = cells.filter(F.col("sheet") == sheet)
    heads = table.filter(F.col("row_pos") == 0).select("file", "col_pos", clean_name(F.col("text")).alias("name"))
    body = table.filter(F.col("row_pos") > 0).join(heads, ["file", "col_pos"])
    return pivot_unique(body.filter(F.col("name").isin(*columns)), ["file", "row_pos"], "name", "text", columns)


def structure_of(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Structure only: item, label, sheet and file, no values."""
    return items.select(*_SHEET, *keep, "item", "label")


def with_period_parts(facts: DataFrame) -> DataFrame:
    return facts.withColumn("year", period_year(F.col("period"))).withColumn("quarter", period_quarter(F.col("period")))
