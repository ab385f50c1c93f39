import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from quarterdeck.operators.reshape import common_type, union_relaxed
from tests.helpers import rows


def test_unions_of_several_types(spark):
    day = datetime.date(2024, 1, 2)
    whole = spark.createDataFrame([(1, 2, 3, True, day, None)], "a int, b long, c int, d boolean, e date, `f.x` int")
    text = spark.createDataFrame([("x", 1.5, 2**40, 7, datetime.datetime(2024, 1, 2, 3), "z")], "a string, b double, c long, d int, e timestamp, `f.x` string")
    union = union_relaxed([whole, text, spark.createDataFrame([(9,)], "g int")])
    assert dict(union.dtypes) == {"a": "string", "b": "double", "c": "bigint", "d": "int", "e": "timestamp", "f.x": "string", "g": "int"}
    got = union.orderBy("a").collect()
    assert got[1]["a"] == "1" and got[1]["b"] == 2.0 and got[1]["d"] == 1 and got[1]["e"] == datetime.datetime(2024, 1, 2)
    assert got[2]["a"] == "x" and got[2]["c"] == 2**40 and got[0]["g"] == 9


def test_one_frame_and_equal_types(spark):
    one = spark.createDataFrame([(1, [2])], "a int, l array<int>")
    assert rows(union_relaxed([one])) == rows(one)
    assert rows(union_relaxed([one, one])) == rows(one) * 2


@pytest.mark.parametrize(
    "kinds, want",
    [("int long", "bigint"), ("boolean byte", "tinyint"), ("float int", "double"), ("float float", "float"), ("date string", "string"),
     ("date timestamp", "timestamp"), ("date int", "string"), ("boolean string", "string"), ("decimal(5,2) int", "decimal(21,2)"),
     ("decimal(5,2) decimal(9,1)", "decimal(10,2)"), ("decimal(5,2) double", "double"), ("void long", "bigint"), ("void void", "string")],
)
def test_common_types(kinds, want):
    types = [T.NullType() if k == "void" else T.DataType.fromDDL(k) for k in kinds.split(" ")]
    assert common_type(types).simpleString() == want
    assert common_type(types[::-1]).simpleString() == want


def test_nested_types_have_nothing_in_common():
    with pytest.raises(ValueError, match="no type in common"):
        common_type([T.ArrayType(T.LongType()), T.StringType()])


def test_decimals_keep_their_digits(spark):
    a = spark.createDataFrame([(Decimal("1.25"),)], "v decimal(5,2)")
    b = spark.createDataFrame([(2**62,)], "v long")
    assert {str(r["v"]) for r in union_relaxed([a, b]).collect()} == {"1.25", f"{2**62}.00"}
