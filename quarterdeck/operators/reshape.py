"""Wide/long reshaping, unions, ordering keys and key checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    IntegralType,
    LongType,
    MapType,
    NullType,
    NumericType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from quarterdeck.functions.period import extract_or_null
from quarterdeck.functions.text import map_strict


def unpivot(df: DataFrame, ids: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long over all other columns; NULL cells stay.

    Columns of one type go through a generator, which unlike Spark's own unpivot keeps the partitioning of the rows.
    """
    columns = [c for c in df.columns if c not in ids]
    if len({df.schema[c].dataType for c in columns}) != 1:
        return df.unpivot(list(ids), columns, name, value)
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    cells = [F.struct(F.lit(c).alias(name), quoted(c).alias(value)) for c in columns]
    return df.select(*map(quoted, ids), F.inline(F.array(*cells)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def pivot_unique(
    df: DataFrame, index: Sequence[str], on: str, value: str, columns: Iterable[str]
) -> DataFrame:
    """Long to wide for the given columns; two rows for one cell fail the job.

    One conditional aggregate per cell, so it is a single exchange on `index` with map-side combining.
    """
    cells = []
    for name in columns:
        here = F.col(on) == F.lit(name)
        clash = F.raise_error(F.concat(F.lit(f"more than one row for column {name}")))
        cells.append(
            F.when(F.count_if(here) > 1, clash).otherwise(F.max(F.when(here, F.col(value)))).alias(str(name))
        )
    return df.groupBy(*index).agg(*cells)


#: Types from narrow to wide; two of one list have the wider in common, all others have text.
_LADDERS = (
    (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType),
    (DateType, TimestampNTZType, TimestampType),
)


def common_type(types: Sequence[DataType]) -> DataType:
    """The type that holds values of all of them: a number's wider kind, a date's, or text.

    Whole numbers beside fractions are doubles, as a float holds few of their digits. Decimals meet whole numbers in a
    decimal that holds both, and doubles in a double. Lists and structures have none in common but their own type.
    """
    known = list(dict.fromkeys(t for t in types if not isinstance(t, NullType)))
    if len(known) <= 1:
        return known[0] if known else StringType()
    nested = [t for t in known if isinstance(t, (ArrayType, MapType, StructType))]
    if nested:
        raise ValueError(f"no type in common: {', '.join(t.simpleString() for t in known)}")
    if all(isinstance(t, (DecimalType, IntegralType)) for t in known):
        whole = max(t.precision - t.scale if isinstance(t, DecimalType) else 19 for t in known)
        scale = max(t.scale if isinstance(t, DecimalType) else 0 for t in known)
        if any(isinstance(t, DecimalType) for t in known):
            return DecimalType(min(whole + scale, 38), scale)
    if all(isinstance(t, NumericType) for t in known) and any(isinstance(t, DecimalType) for t in known):
        return DoubleType()
    for ladder in _LADDERS:
        if all(type(t) in ladder for t in known):
            widest = max(known, key=lambda t: ladder.index(type(t)))
            mixed = isinstance(widest, FloatType) and any(isinstance(t, IntegralType) for t in known)
            return DoubleType() if mixed else widest
    return StringType()


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; missing columns become NULL, and columns of several types get the one they have in common."""
    found: dict[str, list[DataType]] = {}
    for frame in frames:
        for column in frame.schema:
            found.setdefault(column.name, []).append(column.dataType)
    target = {name: common_type(types) for name, types in found.items()}
    cast = lambda f: f.select(*(F.col(f"`{c.name}`").cast(target[c.name]).alias(c.name) for c in f.schema))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(cast, frames))


def union_strict(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of frames that must agree on column names and types."""
    expected = sorted(frames[0].dtypes)
    for frame in frames[1:]:
        if sorted(frame.dtypes) != expected:
            raise ValueError(f"schemas differ: {expected} and {sorted(frame.dtypes)}")
    return reduce(lambda a, b: a.unionByName(b), frames)


def item_sheet(item: Column) -> Column:
    return extract_or_null(item, r"^([A-Z]+)_", 1)


def item_number(item: Column) -> Column:
    return extract_or_null(item, r"_(\d+)$", 1).cast("long")


def item_order(item: Column, sheets: Mapping[str, object]) -> tuple[Column, Column]:
    """Sort key of an item id: position of its sheet (unknown sheets fail), then its number."""
    positions = {key: i for i, key in enumerate(sheets)}
    return map_strict(item_sheet(item), positions), item_number(item)
