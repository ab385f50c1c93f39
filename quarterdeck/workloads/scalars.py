"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.functions import period as P
from quarterdeck.functions import text as T
from quarterdeck.workloads.panels import cents, table


def clean_names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.clean_name(F.col("text")).alias("name"))


def _periods(spark, sf):
    label = P.period_label(F.year("o_orderdate"), F.quarter("o_orderdate"))
    broken = F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("FY"), F.year("o_orderdate").cast("string")))
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(broken, label).alias("yq"))


PERIODS_SQL = """
periods AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'FY' || year(o_orderdate)
    ELSE year(o_orderdate) || '_q' || quarter(o_orderdate) END AS yq FROM orders),
parts AS (
  SELECT o_orderkey, yq, TRY_CAST(nullif(regexp_extract(yq, '(\\d{4})_q(\\d)', 1), '') AS INT) AS year,
    TRY_CAST(nullif(regexp_extract(yq, '(\\d{4})_q(\\d)', 2), '') AS INT) AS quarter FROM periods)"""


def period_parts(spark, sf):
    yq = F.col("yq")
    return _periods(spark, sf).select(
        "o_orderkey", "yq", P.period_year(yq).alias("year"), P.period_quarter(yq).alias("quarter")
    )


def period_index(spark, sf):
    rows = period_parts(spark, sf)
    return rows.select("o_orderkey", P.period_index(F.col("year"), F.col("quarter")).alias("qidx"))


def period_to_date(spark, sf):
    rows = period_parts(spark, sf)
    return rows.select("o_orderkey", P.period_start_text(F.col("year"), F.col("quarter")).alias("start"))


def make_date(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    return rows.select("o_orderkey", F.make_date("y", "m", F.lit(1)).alias("ym"))


def safe_cast(spark, sf):
    key = F.col("o_orderkey")
    whole = cents("o_totalprice").cast("string")
    text = (
        F.when(key % 11 == 0, F.element_at(F.array(*[F.lit(x) for x in ("1,234", "abc", "", "NaN")]), (key % 4 + 1).cast("int")))
        .when(key % 11 == 1, F.concat(F.lit("-"), whole, F.lit(".5")))
        .when(key % 11 == 2, F.concat(whole, F.lit("e0")))
        .when(key % 11 == 3, F.concat(whole, F.lit("d")))
        .otherwise(whole)
    )
    return table(spark, sf, "orders").select("o_orderkey", T.safe_double(text).alias("value"))


def regex_extract_all(spark, sf):
    """Item ids in every order's formula text, in order of first use."""
    key = F.col("o_orderkey")
    text = F.concat(
        F.lit("avg_BS_"), (key % 9).cast("string"), F.lit(" / roll4_IS_"), (F.col("o_custkey") % 5).cast("string"),
        F.lit(" + BS_"), (key % 4).cast("string"), F.lit(" * quarter"),
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", F.concat_ws(",", T.item_references(text)).alias("items")
    )


def text_misc(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.length(F.trim(text)).alias("trimmed"),
        T.strip_prefix(F.concat(F.lit("'"), F.col("lang")), "'").alias("unguarded"),
        T.replace_first(F.concat(F.col("lang"), F.lit("_"), F.col("lang")), "_", "$").alias("first_replaced"),
        F.concat_ws(" | ", F.col("lang"), F.when(F.col("doc_id") % 2 == 0, F.col("source"))).alias("joined"),
        F.coalesce(F.when(F.col("doc_id") % 3 == 0, F.col("lang")), F.lit("?")).alias("filled"),
        F.md5(F.replace(text, F.lit("e"), F.lit("E"))).alias("replaced_md5"),
    )


def map_strict(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderkey", T.map_strict(F.col("o_orderstatus"), {"O": 0, "F": 1, "P": 2}).alias("position")
    )


def period_normalise(spark, sf):
    year, quarter = F.year("o_orderdate").cast("string"), F.quarter("o_orderdate").cast("string")
    kind = F.col("o_orderkey") % 4
    header = (
        F.when(kind == 0, F.concat(F.lit("q"), quarter, F.lit("_"), year))
        .when(kind == 1, year)
        .when(kind == 2, F.concat((F.quarter("o_orderdate") * 3).cast("string"), F.lit("m_"), year))
        .otherwise(F.concat(F.lit("note_"), F.lit("q"), quarter, F.lit("_"), year))
    )
    return table(spark, sf, "orders").select("o_orderkey", P.normalise_period(header).alias("period"))


QUERIES = {
    "fn_clean_names": (
        clean_names,
        """SELECT doc_id, regexp_replace(strip_accents(regexp_replace(regexp_replace(
             lower(replace(replace(text, 'đ', 'd'), 'Đ', 'D')), '[ /:,?().\\- ]', '_', 'g'),
             '[''’]', '', 'g')), '_+', '_', 'g') AS name FROM documents""",
    ),
    "fn_period_parts": (period_parts, f"WITH {PERIODS_SQL} SELECT o_orderkey, yq, year, quarter FROM parts"),
    "fn_period_index": (period_index, f"WITH {PERIODS_SQL} SELECT o_orderkey, year * 4 + quarter AS qidx FROM parts"),
    "fn_period_to_date": (
        period_to_date,
        f"""WITH {PERIODS_SQL} SELECT o_orderkey,
            strftime(make_date(year, quarter * 3 - 2, 1), '%Y-%m-%d') AS start FROM parts""",
    ),
    "fn_make_date": (
        make_date,
        "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS ym FROM orders",
    ),
    "fn_safe_cast": (
        safe_cast,
        """SELECT o_orderkey, CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 3 THEN NULL
             WHEN 1 THEN -CAST(round(o_totalprice * 100) AS DOUBLE) - 0.5
             ELSE CAST(round(o_totalprice * 100) AS DOUBLE) END AS value FROM orders""",
    ),
    "fn_regex_extract_all": (
        regex_extract_all,
        """SELECT o_orderkey, 'BS_' || (o_orderkey % 9) || ',IS_' || (o_custkey % 5) ||
             CASE WHEN o_orderkey % 9 = o_orderkey % 4 THEN '' ELSE ',BS_' || (o_orderkey % 4) END AS items
           FROM orders""",
    ),
    "fn_text_misc": (
        text_misc,
        """SELECT doc_id, CAST(length(trim(text)) AS INT) AS trimmed, lang AS unguarded, lang || '$' || lang AS first_replaced,
             CASE WHEN doc_id % 2 = 0 THEN lang || ' | ' || source ELSE lang END AS joined,
             CASE WHEN doc_id % 3 = 0 THEN lang ELSE '?' END AS filled,
             md5(replace(text, 'e', 'E')) AS replaced_md5 FROM documents""",
    ),
    "fn_map_strict": (
        map_strict,
        "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS position FROM orders",
    ),
    "src_period_normalise": (
        period_normalise,
        """SELECT o_orderkey, CASE o_orderkey % 4
             WHEN 0 THEN year(o_orderdate) || '_q' || quarter(o_orderdate)
             WHEN 1 THEN year(o_orderdate) || '_q4'
             WHEN 2 THEN year(o_orderdate) || '_q' || quarter(o_orderdate)
             ELSE 'note_' || year(o_orderdate) || '_q' || quarter(o_orderdate) END AS period FROM orders""",
    ),
}
