"""Periods: text `YYYY_qN`, year and quarter, and the consecutive index year*4+quarter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PERIOD = r"(\d{4})_q(\d)"


def extract_or_null(text: Column, pattern: str, group: int) -> Column:
    """Regex group, NULL (not '') where the pattern does not match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def period_year(period: Column) -> Column:
    return extract_or_null(period, _PERIOD, 1).cast("int")


def period_quarter(period: Column) -> Column:
    return extract_or_null(period, _PERIOD, 2).cast("int")


def period_index(year: Column, quarter: Column) -> Column:
    """Neighbouring quarters differ by exactly one, also across a year end."""
    return (year * 4 + quarter).cast("int")


def index_year(qidx: Column) -> Column:
    return F.shiftright((qidx - 1).cast("int"), 2)


def index_quarter(qidx: Column) -> Column:
    return (F.pmod(qidx - 1, F.lit(4)) + 1).cast("int")


def period_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("_q"), quarter.cast("string"))


def period_start_text(year: Column, quarter: Column) -> Column:
    """First day of the quarter as `YYYY-MM-01`, NULL for an unreadable period."""
    month = F.lpad((quarter * 3 - 2).cast("string"), 2, "0")
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), month, F.lit("-01"))


def period_start_date(year: Column, quarter: Column) -> Column:
    return F.make_date(year, quarter * 3 - 2, F.lit(1))


def normalise_period(header: Column) -> Column:
    """Headers of all three export frequencies to `YYYY_qN`: `q1_2024`, `2024` and `6m_2024`."""
    months = F.regexp_extract(header, r"^(\d{1,2})m_", 1)
    return (
        F.when(header.rlike(r"^(19|20)\d\d$"), F.concat(header, F.lit("_q4")))
        .when(
            header.rlike(r"^\d{1,2}m_\d{4}"),
            F.concat(
                F.split_part(header, F.lit("_"), F.lit(2)),
                F.lit("_q"),
                F.floor(months.try_cast("int") / 3).cast("string"),
            ),
        )
        .otherwise(F.regexp_replace(header, r"(?s)^(.*?)(q\d)_(\d{4})", "$1$3_$2"))
    )
