"""Text and number clean-up."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters a cleaned name turns into an underscore, and those it drops.
_TO_UNDERSCORE = " /:,?()\\.\\-\u00a0"
_DROPPED = "'\u2019"

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

ITEM_ID = r"[A-Z]+_\d+"


@cache
def _accent_table() -> tuple[str, str]:
    """Argument pair for `translate`: accented characters with their bases, then combining marks, which it drops.

    Generated over the Basic Multilingual Plane without Hangul, whose decomposition has no marks.
    """
    accented, bases, marks = [], [], []
    for code in range(0x80, 0x10000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        if unicodedata.combining(char):
            marks.append(char)
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", char) if not unicodedata.combining(c))
        if len(base) == 1 and base != char:
            accented.append(char)
            bases.append(base)
    return "".join(accented + marks), "".join(bases)


def strip_accents(text: Column, also: str = "", also_to: str = "") -> Column:
    """Base characters without marks, in one pass; plain ASCII text is passed through.

    `also`/`also_to` are further characters to map one to one.
    """
    accented, bases = _accent_table()
    mapped = F.translate(text, also + accented, also_to + bases)
    return F.when(text.rlike(r"[^\x00-\x7F]"), mapped).otherwise(text)


def clean_name(text: Column) -> Column:
    """Text to an ASCII snake_case name; the Vietnamese d with stroke has no decomposition, so it is mapped too."""
    plain = strip_accents(F.lower(text), "đ", "d")
    for dropped in _DROPPED:
        plain = F.replace(plain, F.lit(dropped), F.lit(""))
    return F.regexp_replace(plain, f"[{_TO_UNDERSCORE}_]+", "_")


@cache
def _plain_characters() -> dict[int, str | None]:
    accented, bases = _accent_table()
    return {ord(c): bases[k] if k < len(bases) else None for k, c in enumerate(accented)} | {ord("đ"): "d"}


def cleaned(text: str) -> str:
    """`clean_name` of one text, for names that are read before they become rows."""
    plain = "".join(c for c in text.lower().translate(_plain_characters()) if c not in _DROPPED)
    return re.sub(f"[{_TO_UNDERSCORE}_]+", "_", plain)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Apply `clean_name` to the column names (names only, so it is evaluated once on the driver)."""
    spark = df.sparkSession
    row = spark.range(1).select(*[clean_name(F.lit(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.toDF(*row)


def safe_double(text: Column) -> Column:
    """Numeric text to double; anything else, also 'NaN', '1.5d' or '1,234', to NULL."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def item_references(formula: Column) -> Column:
    """Distinct item ids of a formula in order of first use; a series prefix such as avg_ is ignored."""
    return F.array_distinct(F.regexp_extract_all(formula, F.lit(f"({ITEM_ID})"), F.lit(1)))


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace the first match only; `pattern` must not hold groups, `replacement` is literal text."""
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})", "$1" + literal)


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)


def map_strict(key: Column, mapping: Mapping[str, object]) -> Column:
    """Look a key up; an unknown key fails the job, a NULL key stays NULL."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    unknown = F.raise_error(F.concat(F.lit("no mapping for "), key))
    return F.when(key.isNotNull(), F.coalesce(F.try_element_at(table, key), unknown))
