"""Sink queries: write to the shared scratch folder, read back, compare with the input."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarterdeck.plans.reports import monthly_sum, raw_panel
from quarterdeck.session import checkpointed, scratch_path
from quarterdeck.sinks.sql_script import row_tuples, write_script
from quarterdeck.sinks.writers import (
    replace_table,
    temporal_as_text,
    wide_raw_panel,
    write_csv,
    write_partitioned,
)
from quarterdeck.workloads.panels import COMPLETE_DENSE_SQL, COMPLETE_SQL, cents, complete, complete_dense, r4, table

PERIODS = [f"{y}_q{q}" for y in range(1995, 2002) for q in range(1, 5) if (y, q) != (2001, 4)]


def _orders(spark, sf):
    """Orders with all published kinds of columns and quotes in some texts."""
    quoted = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("it's "), F.col("o_orderpriority")))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.coalesce(quoted, F.col("o_orderpriority")).alias("priority"),
        (F.col("o_orderstatus") == "O").alias("open"),
        F.when(F.col("o_orderkey") % 5 != 0, cents("o_totalprice")).alias("cents"),
        F.to_date("o_orderdate").alias("day"),
        (F.col("o_orderdate") + F.expr("INTERVAL '01:02:03' HOUR TO SECOND")).alias("moment"),
    )


_ORDERS_SQL = """
o AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'it''s ' || o_orderpriority ELSE o_orderpriority END AS priority,
    o_orderstatus = 'O' AS open,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS cents,
    CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS TIMESTAMP) + INTERVAL '3723 seconds' AS moment FROM orders),
t AS (
  SELECT o_orderkey, priority, open, cents, strftime(day, '%Y-%m-%d') AS day,
    strftime(moment, '%Y-%m-%d %H:%M:%S') AS moment FROM o),
tuples AS (
  SELECT '(' || o_orderkey || ', ''' || replace(priority, '''', '''''') || ''', ' || CASE WHEN open THEN '1' ELSE '0' END
    || ', ' || coalesce(CAST(cents AS VARCHAR), 'NULL') || ', ''' || day || ''', ''' || moment || ''')' AS tuple FROM t)"""


def sql_literal(spark, sf):
    return row_tuples(_orders(spark, sf))


def temporal_text(spark, sf):
    return temporal_as_text(_orders(spark, sf)).select("o_orderkey", "day", "moment")


def sql_batches(spark, sf):
    """The row tuples of a written script with the largest number of rows of any statement.

    Texts may hold line breaks, quotes and separators, so statements and tuples are told apart by what ends them.
    """
    path = scratch_path(spark, "script")
    # a column that starts with an underscore is one like the others
    write_script(_orders(spark, sf).withColumn("_status", F.col("open").cast("string")), "orders_out", path)
    statement = spark.read.option("lineSep", ";\n").text(f"{path}/rows").select(F.rtrim("value").alias("s")).filter("s <> ''")
    body = F.regexp_extract("s", r"(?s)^INSERT INTO \"orders_out\" \([^)]*\) VALUES \((.*)\);?$", 1)
    rows = statement.select(F.split(body, r"\), \(").alias("rows"))
    largest = rows.agg(F.max(F.size("rows"))).scalar()
    return rows.select(F.explode("rows").alias("r"), (largest <= 200).alias("small")).select(
        F.concat(F.lit("("), F.col("r"), F.lit(")")).alias("tuple"), "small"
    )


def monthly_publish(spark, sf):
    """Monthly sums of urgent orders as a replaced table and as a script; both must hold the same."""
    name, path = f"monthly_{uuid.uuid4().hex}", scratch_path(spark, "monthly")
    rows = table(spark, sf, "orders").select(
        "o_orderpriority", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), cents("o_totalprice").alias("amount")
    )
    sums = monthly_sum(rows, F.col("o_orderpriority").contains("URGENT"), "amount", "urgent")
    replace_table(sums, name, f"{path}/table")
    write_script(sums, name, f"{path}/sql")
    published = checkpointed(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    script = spark.read.option("lineSep", ";\n").text(f"{path}/sql/rows").filter(F.trim("value") != "")
    tuples = F.split(F.regexp_extract("value", r"(?s) VALUES \((.*)\);?$", 1), r"\), \(")
    listed = script.select(F.explode(tuples).alias("t")).select(F.split("t", ", ").alias("v"))
    return published.join(
        listed.select(F.replace(F.col("v")[0], F.lit("'"), F.lit("")).alias("ym"), F.col("v")[1].cast("bigint").alias("scripted")), "ym", "full"
    )


def partitioned(spark, sf):
    path = scratch_path(spark, "metrics")
    rows = complete(spark, sf).select("entity", "qidx", r4("value").alias("value"), F.col("item").alias("sheet"))
    write_partitioned(rows, path)
    return spark.read.parquet(path)


def _exports(spark, sf):
    """Every cell in two exports: the older one holds other values."""
    cells = complete_dense(spark, sf).select(
        "item",
        F.concat(F.lit("Label "), F.col("item")).alias("label"),
        "entity",
        F.concat(F.col("year").cast("string"), F.lit("_q"), F.col("quarter").cast("string")).alias("period"),
        "value",
    )
    newer = cells.withColumn("export_date", F.lit("2024-02-01").cast("date")).withColumn("file", F.lit("b"))
    older = cells.withColumn("export_date", F.lit("2024-01-01").cast("date")).withColumn("file", F.lit("a"))
    return newer.unionByName(older.withColumn("value", -F.coalesce("value", F.lit(0.0)) - 1))


def raw(spark, sf):
    return raw_panel(_exports(spark, sf), PERIODS)


def sink_raw(spark, sf):
    path = scratch_path(spark, "raw-panel")
    rows = complete(spark, sf).select(
        "item",
        F.lit("x").alias("label"),
        "entity",
        F.concat(F.col("year").cast("string"), F.lit("_q"), F.col("quarter").cast("string")).alias("period"),
        "value",
    )
    wide_raw_panel(rows, PERIODS).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).drop("label")


def csv_guarded(spark, sf):
    path = scratch_path(spark, "csv")
    risky = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("="), F.col("source"))).when(
        F.col("doc_id") % 4 == 1, F.concat(F.lit('@"'), F.col("lang"), F.lit('",'))
    )
    rows = table(spark, sf, "documents").select("doc_id", F.coalesce(risky, F.col("source")).alias("note"), "n_chars")
    write_csv(rows, path)
    return spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(path)


def table_replace(spark, sf):
    """Write a table three times: the second content must have replaced the first, and the third, empty, must not."""
    rows = _orders(spark, sf).withColumn("half", F.col("cents") / 2)
    name, path = f"orders_published_{uuid.uuid4().hex}", scratch_path(spark, "table")
    for content in (rows.select("o_orderkey"), rows, rows.filter("o_orderkey < 0")):
        replace_table(content, name, path)
    # The version's files stay below `path` when the catalog entry goes.
    files = spark.table(name).inputFiles()
    written = spark.read.parquet(files[0].rsplit("/", 1)[0])
    spark.sql(f"DROP TABLE {name}")
    return written


QUERIES = {
    "sink_sql_literal": (sql_literal, f"WITH {_ORDERS_SQL} SELECT tuple FROM tuples"),
    "sink_temporal_text": (temporal_text, f"WITH {_ORDERS_SQL} SELECT o_orderkey, day, moment FROM t"),
    "sink_sql_batches": (
        sql_batches,
        f"""WITH {_ORDERS_SQL} SELECT regexp_replace(tuple, '\\)$', CASE WHEN tuple LIKE '%, 1, %' AND split_part(tuple, ', ', 3) = '1'
          THEN ', ''true'')' ELSE ', ''false'')' END) AS tuple, TRUE AS small FROM tuples""",
    ),
    "monthly_publish": (
        monthly_publish,
        """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ym, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS urgent,
             sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS scripted
           FROM orders WHERE o_orderpriority LIKE '%URGENT%' GROUP BY 1""",
    ),
    "sink_partitioned_metrics": (
        partitioned,
        f"WITH {COMPLETE_SQL} SELECT entity, qidx, round(value, 4) AS value, item AS sheet FROM sparse",
    ),
    "raw_panel": (
        raw,
        f"WITH {COMPLETE_DENSE_SQL} SELECT item, 'Label ' || item AS label, entity, "
        + ", ".join(f"max(CASE WHEN year || '_q' || quarter = '{p}' THEN value END) AS \"{p}\"" for p in PERIODS)
        + " FROM dense GROUP BY 1, 2, 3",
    ),
    "sink_raw_panel": (
        sink_raw,
        f"WITH {COMPLETE_SQL} SELECT item, entity, "
        + ", ".join(f"max(CASE WHEN year || '_q' || quarter = '{p}' THEN value END) AS \"{p}\"" for p in PERIODS)
        + " FROM sparse GROUP BY 1, 2",
    ),
    "sink_csv_guarded": (
        csv_guarded,
        """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '''=' || source WHEN 1 THEN '''@"' || lang || '",'
             ELSE source END AS note, n_chars FROM documents""",
    ),
    "sink_table_replace": (
        table_replace,
        f"""WITH {_ORDERS_SQL} SELECT o_orderkey, priority, CAST(open AS BIGINT) AS open, cents, day, moment,
            cents / 2.0 AS half FROM t""",
    ),
}
