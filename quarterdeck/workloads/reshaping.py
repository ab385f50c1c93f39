"""Projection, filter, reshape, join, union and order queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.operators.panel import CUMULATIVE, QUARTERLY, uncovered_year_to_date
from quarterdeck.operators.reshape import (
    duplicate_keys,
    item_number,
    item_order,
    item_sheet,
    pivot_unique,
    union_relaxed,
    union_strict,
    unpivot,
)
from quarterdeck.operators.series import prior_year_end, same_quarter_last_year
from quarterdeck.workloads.panels import (
    COMPLETE_SQL,
    DENSE_RULES,
    DENSE_SQL,
    ITEMS,
    MERGED_SQL,
    SPARSE_SQL,
    cents,
    complete,
    customer_quarters,
    dense,
    dense_wide,
    r4,
    reports_by_period,
    sparse,
    table,
)


def proj_by_pattern(spark, sf):
    """Columns by substring, exclusion and type."""
    orders = table(spark, sf, "orders")
    numeric = [c for c, t in orders.dtypes if t in ("bigint", "int", "double")]
    named = [c for c in orders.columns if "order" in c and not c.endswith("date")]
    return orders.select(*dict.fromkeys(numeric + named))


def proj_rename_drop(spark, sf):
    customer = table(spark, sf, "customer").drop("c_acctbal", "c_mktsegment")
    return customer.withColumnsRenamed({c: c.removeprefix("c_") for c in customer.columns})


def cond_case(spark, sf):
    price = F.col("o_totalprice")
    band = F.when(price < 50000, "low").when(price < 250000, "mid").when(F.col("o_orderstatus") == "O", "open")
    return table(spark, sf, "orders").select("o_orderkey", band.alias("band"))


def filter_predicates(spark, sf):
    keep = (
        F.col("o_orderdate").isNotNull()
        & F.col("o_orderstatus").isin("O", "P")
        & ~F.col("o_orderpriority").rlike(r"^[45]-")
        | F.col("o_orderpriority").contains("URGENT")
    )
    return table(spark, sf, "orders").filter(keep).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def filter_period_range(spark, sf):
    start, end = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("2000-01-01").cast("timestamp_ntz")
    return (
        table(spark, sf, "orders")
        .filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end) & (F.quarter("o_orderdate") <= 3))
        .groupBy(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"))
        .agg(F.count("*").alias("n"))
    )


def unpivot_long(spark, sf):
    wide = customer_quarters(spark, sf).select(
        "o_custkey", "year", "quarter", *[F.col(i).cast("double").alias(i) for i in ITEMS]
    )
    return unpivot(wide, ["o_custkey", "year", "quarter"], "item", "value")


def pivot_cells(spark, sf):
    return pivot_unique(complete(spark, sf), ["entity", "year", "quarter"], "item", "value", ITEMS)


def pivot_rejects(spark, sf):
    """Keys that could not be pivoted, with the number of clashing rows."""
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def transpose_panel(spark, sf):
    """Items x quarters of a year to quarters x items."""
    long = complete(spark, sf).withColumn("q", F.concat(F.lit("q"), F.col("quarter").cast("string")))
    statement = pivot_unique(long, ["entity", "year", "item"], "q", "value", ["q1", "q2", "q3", "q4"])
    back = unpivot(statement, ["entity", "year", "item"], "q", "value")
    return pivot_unique(back, ["entity", "year", "q"], "item", "value", ITEMS)


def row_order_key(spark, sf):
    rows = complete(spark, sf)
    position, number = item_order(F.col("item"), ["BS", "IS", "CF", "NOTES"])
    return rows.select("entity", "qidx", "item", position.alias("sheet_pos"), number.alias("num")).orderBy(
        "sheet_pos", "num", "entity", "qidx"
    )


def sort_period(spark, sf):
    return complete(spark, sf).select("entity", "qidx", "item", r4("value").alias("value")).orderBy("entity", "qidx", "item")


def join_prior_q4(spark, sf):
    return sparse(spark, sf).select("entity", "item", "qidx", prior_year_end().alias("prior_q4"))


def join_prior_fy_py(spark, sf):
    return sparse(spark, sf).select(
        "entity", "item", "qidx", prior_year_end().alias("prior_fy"), same_quarter_last_year().alias("prior_year")
    )


def anti_source_precedence(spark, sf):
    """Quarterly-derived rows of the periods that no cumulative report covers, as the panel merge has them."""
    reports = reports_by_period(spark, sf).filter(F.col("freq").isin(QUARTERLY, CUMULATIVE))
    kept = uncovered_year_to_date(reports, DENSE_RULES)
    return kept.select("entity", "item", "year", "quarter", r4("value").alias("value"))


def union_diagonal(spark, sf):
    """Columns that one side lacks, and columns of two types: int and long, int and text, whole and fractional, date and time."""
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), "c_custkey", F.col("c_nationkey").cast("int").alias("nation"),
        F.col("c_custkey").cast("int").alias("code"), F.col("c_nationkey").cast("int").alias("amount"), F.lit("2024-01-02").cast("date").alias("at"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), "s_suppkey", F.col("s_nationkey").cast("bigint").alias("nation"), F.col("s_name").alias("code"),
        (F.col("s_suppkey") + 0.5).cast("double").alias("amount"), F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("at"),
    )
    return union_relaxed([customers, suppliers])


def union_same(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return union_strict([customers, suppliers])


def distinct_rows(spark, sf):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_custkey", status.alias("status"), F.year("o_orderdate").alias("year")).distinct()


def set_union_ids(spark, sf):
    """Ids from either side, once. Each side is reduced first, so the shuffle carries distinct ids only."""
    left = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"))
    return left.union(table(spark, sf, "part").select("p_partkey")).distinct()


def horizontal_sum(spark, sf):
    """Row-wise sum over a line's amounts, of which some are missing; all missing gives 0."""
    line = F.col("l_linenumber")
    amounts = F.array(
        F.when(line % 2 == 0, cents("l_extendedprice").cast("double")),
        F.when(line % 3 == 0, F.col("l_quantity")),
        F.when(line % 5 == 0, F.lit(7.0)),
    )
    total = F.aggregate(amounts, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", total.alias("total"))


QUERIES = {
    "proj_by_pattern": (
        proj_by_pattern,
        "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders",
    ),
    "proj_rename_drop": (
        proj_rename_drop,
        "SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey FROM customer",
    ),
    "cond_case": (
        cond_case,
        """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 250000 THEN 'mid'
             WHEN o_orderstatus = 'O' THEN 'open' END AS band FROM orders""",
    ),
    "filter_predicates": (
        filter_predicates,
        """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
           WHERE (o_orderdate IS NOT NULL AND o_orderstatus IN ('O', 'P') AND o_orderpriority NOT LIKE '4-%'
                  AND o_orderpriority NOT LIKE '5-%') OR o_orderpriority LIKE '%URGENT%'""",
    ),
    "filter_period_range": (
        filter_period_range,
        """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter, count(*) AS n
           FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999 AND quarter(o_orderdate) <= 3 GROUP BY 1, 2""",
    ),
    "unpivot_long": (
        unpivot_long,
        "WITH " + SPARSE_SQL.split(",\nsparse AS")[0] + " "
        + " UNION ALL ".join(
            f"SELECT o_custkey, year, quarter, '{i}' AS item, CAST({i.lower()} AS DOUBLE) AS value FROM cq" for i in ITEMS
        ),
    ),
    "pivot_unique": (
        pivot_cells,
        f"WITH {COMPLETE_SQL} SELECT entity, year, quarter, "
        + ", ".join(f"max(CASE WHEN item = '{i}' THEN value END) AS \"{i}\"" for i in ITEMS)
        + " FROM sparse GROUP BY entity, year, quarter",
    ),
    "pivot_unique_rejects": (
        pivot_rejects,
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "transpose_panel": (
        transpose_panel,
        f"""WITH {COMPLETE_SQL},
        years AS (SELECT DISTINCT entity, year FROM sparse),
        spine AS (SELECT entity, year, q FROM years CROSS JOIN (VALUES (1), (2), (3), (4)) v(q))
        SELECT s.entity, s.year, 'q' || s.q AS q, """
        + ", ".join(f"max(CASE WHEN item = '{i}' THEN value END) AS \"{i}\"" for i in ITEMS)
        + """ FROM spine s LEFT JOIN sparse p ON s.entity = p.entity AND s.year = p.year AND s.q = p.quarter
        GROUP BY s.entity, s.year, s.q""",
    ),
    "row_order_key": (
        row_order_key,
        f"""WITH {COMPLETE_SQL} SELECT entity, qidx, item,
            CASE WHEN item LIKE 'BS%' THEN 0 WHEN item LIKE 'IS%' THEN 1 WHEN item LIKE 'CF%' THEN 2 ELSE 3 END AS sheet_pos,
            CAST(split_part(item, '_', 2) AS BIGINT) AS num FROM sparse ORDER BY 4, 5, 1, 2""",
    ),
    "sort_period": (
        sort_period,
        f"WITH {COMPLETE_SQL} SELECT entity, qidx, item, round(value, 4) AS value FROM sparse ORDER BY 1, 2, 3",
    ),
    "join_prior_q4": (
        join_prior_q4,
        f"""WITH {SPARSE_SQL},
            ends AS MATERIALIZED (SELECT entity, item, year + 1 AS year, value FROM sparse WHERE quarter = 4)
            SELECT entity, item, p.qidx, e.value AS prior_q4 FROM sparse p LEFT JOIN ends e USING (entity, item, year)""",
    ),
    "join_prior_fy_py": (
        join_prior_fy_py,
        f"""WITH {SPARSE_SQL},
            ends AS MATERIALIZED (SELECT entity, item, year + 1 AS year, value FROM sparse WHERE quarter = 4),
            before AS MATERIALIZED (SELECT entity, item, qidx + 4 AS qidx, value FROM sparse)
            SELECT entity, item, qidx, e.value AS prior_fy, b.value AS prior_year FROM sparse p
            LEFT JOIN ends e USING (entity, item, year) LEFT JOIN before b USING (entity, item, qidx)""",
    ),
    "anti_source_precedence": (
        anti_source_precedence,
        f"""WITH {MERGED_SQL}
        SELECT entity, item, year, quarter, round(value, 4) AS value FROM ytd y
        WHERE NOT EXISTS (SELECT 1 FROM headed c WHERE c.freq = 'cumulative' AND c.entity = y.entity
                          AND c.year = y.year AND c.quarter = y.quarter)""",
    ),
    "union_diagonal": (
        union_diagonal,
        """SELECT c_name AS name, c_custkey, CAST(c_nationkey AS BIGINT) AS nation, NULL::BIGINT AS s_suppkey,
             CAST(c_custkey AS VARCHAR) AS code, CAST(c_nationkey AS DOUBLE) AS amount, TIMESTAMP '2024-01-02 00:00:00' AS at FROM customer
           UNION ALL SELECT s_name, NULL, s_nationkey, s_suppkey, s_name, s_suppkey + 0.5, TIMESTAMP '2024-01-02 03:04:05' FROM supplier""",
    ),
    "union_strict": (
        union_same,
        "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
    ),
    "distinct_rows": (
        distinct_rows,
        """SELECT DISTINCT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
             CAST(year(o_orderdate) AS INT) AS year FROM orders""",
    ),
    "set_union_ids": (
        set_union_ids,
        "SELECT l_partkey AS id FROM lineitem UNION SELECT p_partkey FROM part",
    ),
    "horizontal_sum": (
        horizontal_sum,
        """SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber % 2 = 0 THEN CAST(round(l_extendedprice * 100) AS DOUBLE) ELSE 0 END
             + CASE WHEN l_linenumber % 3 = 0 THEN l_quantity ELSE 0 END
             + CASE WHEN l_linenumber % 5 = 0 THEN 7.0 ELSE 0 END AS total FROM lineitem""",
    ),
}
