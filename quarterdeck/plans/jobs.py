"""Jobs from files to files: metrics, audit, formula lineage, raw panel, monthly sums.

Steps that several later ones read (cells, facts, published metrics) are landed as parquet below `work`, a folder all
executors share. Every job can be run again from the start; outputs are overwritten.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.config import ItemRules, PeerGroup
from quarterdeck.operators.audit import critical_hits, critical_items, rule_items
from quarterdeck.operators.groups import membership_of
from quarterdeck.operators.lineage import (
    collapse_definitions,
    formula_references,
    missing_definitions,
    with_labels,
)
from quarterdeck.operators.panel import QUARTERLY, clashing_cells
from quarterdeck.plans.ingest import ingest, land_cells
from quarterdeck.plans.metrics import build_metrics, publish
from quarterdeck.plans.reports import audit_job, monthly_sum
from quarterdeck.session import land, scratch_path, scratch_scope
from quarterdeck.sinks.sql_script import write_script, write_scripts
from quarterdeck.sinks.writers import period_columns, replace_table, replace_tables, wide_raw_panel, write_csv, write_partitioned
from quarterdeck.sources.statements import plain_rows
from quarterdeck.sources.tables import formula_list, read_dictionary, read_formulas
from quarterdeck.sources.workbooks import good_cells, quarantine, read_workbooks


@dataclass(frozen=True)
class Peers:
    """Groups with their members, the entities ranked by name, and the full list they belong to."""

    groups: Sequence[PeerGroup]
    members: Mapping[str, Sequence[str]]
    ranked: Sequence[str]
    everyone: Sequence[str]


def metrics_job(
    spark: SparkSession,
    folder: str,
    formulas_csv: str,
    work: str,
    out: str,
    peers: Peers,
    rules: ItemRules = ItemRules(),
    means: bool = True,
    two_point: bool = False,
    tables: str | None = None,
) -> dict[str, DataFrame]:
    """Workbooks and formulas to one partition and one SQL script per metric, below its sheet.

    With a folder `tables`, every metric also replaces a table of the catalog, whose data lie there. Returns `metrics`,
    `formula_errors`, `table_errors` (tables that could not be replaced), `rejected` (workbooks, sheets and headers) and
    `clashes` (cells with two values, which count as missing). Entities outside the full list are not read. `means` and
    `two_point` as in `enrich_panel`. Scratch data are deleted once the metrics are written.
    """
    done = ingest(land_cells(spark, folder, f"{work}/cells"), work)
    columns = ("freq", "entity", "item", "year", "quarter", "value")
    known = done.facts.filter(F.col("entity").isin(*peers.everyone)).select(*columns)
    facts = land(known, f"{work}/facts")
    formulas = formula_list(read_formulas(spark, formulas_csv))
    members = membership_of(facts, peers.members)
    shown = (peers.ranked, peers.everyone)
    with scratch_scope(spark):
        result = build_metrics(
            facts, members, peers.groups, formulas, rules, published=shown, means=means, two_point=two_point
        )
        write_partitioned(publish(result.values, formulas), f"{out}/metrics", "sheet", "table_name")
    metrics = spark.read.parquet(f"{out}/metrics")
    columns = ["yq", "name", "value"]
    write_scripts(metrics.select(*columns, "table_name"), "table_name", f"{out}/sql")
    failed = {}
    if tables is not None:
        names = [r[0] for r in metrics.select("table_name").distinct().orderBy("table_name").collect()]
        frames = {n: metrics.filter(F.col("table_name") == n).select(*columns) for n in names}  # as many as formulas
        failed = replace_tables(frames, tables)
    return {
        "metrics": metrics,
        "formula_errors": result.errors,
        "table_errors": spark.createDataFrame(list(failed.items()), "table_name string, error string"),
        "rejected": done.rejected,
        "clashes": clashing_cells(facts),
    }


def structure_job(
    spark: SparkSession, folder: str, formulas_csv: str, work: str, out: str, rules: ItemRules = ItemRules()
) -> dict[str, DataFrame]:
    """Audit the structure of the quarterly and yearly workbooks; publish the dictionary if nothing blocks it.

    Returns the `gate` row, the `critical` findings, those on items that formulas or rules use, and `rejected`. The gate
    counts the rejects; whether they stand in the way is the caller's decision.
    """
    done = ingest(land_cells(spark, folder, f"{work}/cells", structure_only=True), work)
    rejected = land(done.rejected, f"{work}/rejected")
    audited = done.structure.filter(F.col("folder").isin("quarterly", "yearly"))
    gate = audit_job(audited, f"{out}/structure_report", f"{out}/dictionary", rejected)
    report = spark.read.option("header", True).option("escape", '"').csv(f"{out}/structure_report")
    critical = critical_items(read_formulas(spark, formulas_csv), rule_items(rules))
    return {"gate": gate, "critical": critical_hits(report, critical), "rejected": rejected}


def lineage_job(spark: SparkSession, formulas_csv: str, dictionary_csv: str, out: str) -> DataFrame:
    """Write what each formula is made of; returns the references without a definition."""
    references = formula_references(read_formulas(spark, formulas_csv))
    dictionary = read_dictionary(spark, dictionary_csv)
    write_csv(collapse_definitions(with_labels(references, dictionary)), f"{out}/formula_definitions")
    return missing_definitions(references, dictionary)


def raw_panel_job(spark: SparkSession, folder: str, work: str, out: str) -> dict[str, DataFrame]:
    """Quarterly cells of all entities as items x sorted periods: `panel`, and what was `rejected`."""
    done = ingest(land_cells(spark, folder, f"{work}/cells"), work)
    landed = land(done.facts.filter(F.col("freq") == QUARTERLY), f"{work}/quarterly")
    wide_raw_panel(landed, period_columns(landed)).write.mode("overwrite").parquet(out)
    return {"panel": spark.read.parquet(out), "rejected": done.rejected}


def monthly_job(
    spark: SparkSession, workbook: str, sheet: str, keep: Column, amount: str, out: str, published: str | None = None
) -> DataFrame:
    """Filtered monthly sum of a plain sheet with columns item, year, month and `amount`.

    `workbook` is a file, or a folder of files that each have the sheet; of these only the sheet's four columns are decoded,
    once. With a folder `published`, the sum also replaces the table `out` and is written as a script. An unreadable
    workbook, or one without the sheet, fails the job.
    """
    columns = ["item", "year", "month", amount]
    read = read_workbooks(spark, workbook, sheets=[sheet], columns=columns, header_row=0)
    cells = land(read, scratch_path(spark, "sheet"))
    unread = quarantine(cells).limit(10).collect()  # enough to say what is wrong
    if unread:
        raise ValueError("; ".join(f"{r['file']}: {r['error']}" for r in unread))
    rows = plain_rows(good_cells(cells), sheet, columns)
    typed = rows.select(
        "item",
        F.col("year").try_cast("double").cast("int").alias("year"),
        F.col("month").try_cast("double").cast("int").alias("month"),
        F.col(amount).try_cast("double").alias(amount),
    )
    sums = monthly_sum(typed, keep, amount, out)
    if published is not None:
        replace_table(sums, out, f"{published}/{out}")
        write_script(sums, out, f"{published}/sql")
    return sums
