import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarterdeck.functions import period as P
from quarterdeck.functions import text as T


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[1] for r in df.select("i", expression(F.col("c"))).orderBy("i").collect()]


def test_bad_numbers_become_null(spark):
    texts = ["1.5", "-2", "+3.", ".5", "1e3", "1,234", "abc", "", " 1.5 ", "1.5d", "inf", "NaN", None]
    expected = [1.5, -2.0, 3.0, 0.5, 1000.0] + [None] * 8
    assert apply(spark, texts, T.safe_double) == expected


def test_unreadable_period_is_null(spark):
    assert apply(spark, ["2023_q4", "FY2023", None], P.period_year) == [2023, None, None]
    assert apply(spark, ["2023_q4", "FY2023", None], P.period_quarter) == [4, None, None]


def test_index_is_consecutive_over_the_year_end(spark):
    label = lambda c: P.period_index(P.period_year(c), P.period_quarter(c))
    assert apply(spark, ["2023_q4", "2024_q1"], label) == [8096, 8097]
    both = spark.range(8089, 8101).select(
        "id", P.index_year(F.col("id")).alias("y"), P.index_quarter(F.col("id")).alias("q")
    )
    assert all(r["y"] * 4 + r["q"] == r["id"] and 1 <= r["q"] <= 4 for r in both.collect())


def test_period_headers_of_all_frequencies(spark):
    headers = ["q1_2024", "2023", "6m_2024", "12m_2020", "9m_2021_x", "x_q2_2020_q3_2021", "chi_tieu", "2024_q1"]
    expected = ["2024_q1", "2023_q4", "2024_q2", "2020_q4", "2021_q3", "x_2020_q2_q3_2021", "chi_tieu", "2024_q1"]
    assert apply(spark, headers, P.normalise_period) == expected


def test_period_start(spark):
    start = lambda c: P.period_start_text(P.period_year(c), P.period_quarter(c))
    assert apply(spark, ["2024_q1", "2024_q4", "bad"], start) == ["2024-01-01", "2024-10-01", None]


def test_clean_vietnamese_names(spark):
    texts = ["Tổng tài sản", "Đơn vị", "Chỉ tiêu", "LN/VCSH (%)", "a - b__c", "d'Or", "Q1 2024", "6M 2024"]
    expected = ["tong_tai_san", "don_vi", "chi_tieu", "ln_vcsh_%_", "a_b_c", "dor", "q1_2024", "6m_2024"]
    assert apply(spark, texts, T.clean_name) == expected


@settings(max_examples=40, deadline=None)
@given(texts=st.lists(st.text(st.characters(max_codepoint=0xABFF, blacklist_categories=("Cs", "Cc"))), min_size=1, max_size=30))
def test_strip_accents_equals_unicode_decomposition(spark, texts):
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
    assert apply(spark, texts, T.strip_accents) == [plain(t) for t in texts]


def test_item_references_in_order_of_first_use(spark):
    texts = ["roll4_IS_3 / avg_BS_1 + BS_1 * quarter - abs(IS_3)", "1 + 1", "NOTES_12+CF_4"]
    assert apply(spark, texts, T.item_references) == [["IS_3", "BS_1"], [], ["NOTES_12", "CF_4"]]


def test_first_match_only(spark):
    assert apply(spark, ["a-b-c", "abc"], lambda c: T.replace_first(c, "-", "$1")) == ["a$1b-c", "abc"]


def test_prefix(spark):
    assert apply(spark, ["'=a", "a'", "''x", None], lambda c: T.strip_prefix(c, "'")) == ["=a", "a'", "'x", None]


def test_unknown_key_fails(spark):
    mapping = {"a": 1, "b": 2}
    assert apply(spark, ["b", None, "a"], lambda c: T.map_strict(c, mapping)) == [2, None, 1]
    with pytest.raises(Exception, match="no mapping for z"):
        apply(spark, ["z"], lambda c: T.map_strict(c, mapping))


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Chỉ tiêu` int, `Đơn vị` int")
    assert T.clean_column_names(df).columns == ["chi_tieu", "don_vi"]
