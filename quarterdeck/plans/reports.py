"""The smaller jobs: structure audit, raw panel, one entity's year to date, monthly sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.config import ItemRules
from quarterdeck.operators.audit import audit_gate, audit_report, data_dictionary
from quarterdeck.operators.exports import dedup_latest_export
from quarterdeck.operators.panel import ytd_cumulate
from quarterdeck.session import checkpointed
from quarterdeck.sinks.writers import period_columns, wide_raw_panel, write_csv
from quarterdeck.sources.tables import DICTIONARY_HEADERS


def raw_panel(exports: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Newest export per cell as items x sorted periods. The period list is read from the data unless given."""
    newest = dedup_latest_export(exports, ["item", "label", "entity", "period"], "export_date", "file")
    return wide_raw_panel(newest, period_columns(exports) if periods is None else periods)


def single_entity_ytd(facts: DataFrame, entity, year: int, quarter: int, rules: ItemRules) -> DataFrame:
    """Year-to-date values of one entity at the latest reported quarter up to `quarter`.

    The entity filter reaches the scan; the year filter stays above, as the entity's other years decide which items
    its statement has.
    """
    ytd = ytd_cumulate(facts.filter(F.col("entity") == entity), rules)
    upto = ytd.filter((F.col("year") == year) & (F.col("quarter") <= quarter))
    label = upto.agg(F.max("quarter")).scalar()
    return upto.filter(F.col("quarter") == label)


def filtered_sum(amount: str, keep: Column) -> Column:
    """Sum over the rows kept, 0 if all of them are NULL; NULL where no row is kept."""
    return F.when(F.count_if(keep) > 0, F.coalesce(F.sum(F.when(keep, F.col(amount))), F.lit(0)))


def monthly_sum(rows: DataFrame, keep: Column, amount: str, out: str) -> DataFrame:
    """Filtered sum per month, labelled with the first of the month. Input has `year` and `month`."""
    return (
        rows.filter(keep)
        .withColumn("ym", F.make_date("year", "month", F.lit(1)))
        .groupBy("ym")
        .agg(filtered_sum(amount, F.lit(True)).alias(out))
        .orderBy("ym")
    )


def audit_job(
    structure: DataFrame, report_path: str, dictionary_path: str, rejected: DataFrame | None = None
) -> DataFrame:
    """Write the audit report, and the dictionary if nothing blocks it. Returns the gate row, with the number of rejects.

    The distinct structure is checkpointed, as every check reads it.
    """
    rows = checkpointed(structure.distinct())
    report = audit_report(rows)
    dictionary = data_dictionary(rows)
    write_csv(report, report_path)
    gate = audit_gate(report, dictionary, rejected)
    if gate.first()["publish"]:
        ordered = dictionary.orderBy("sheet_pos", "num")
        write_csv(ordered.select(*[F.col(c).alias(h) for h, c in DICTIONARY_HEADERS.items()]), dictionary_path)
    return gate
