"""The driver's tables in panel shape, in Spark and as SQL common table expressions.

Money is held as whole cents, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.config import ItemRules, PeerGroup
from quarterdeck.functions.period import normalise_period, period_quarter, period_year
from quarterdeck.operators.groups import membership_of
from quarterdeck.operators.panel import CUMULATIVE, QUARTERLY, YEARLY, with_index
from quarterdeck.session import checkpointed, dealt, more_tasks

ITEMS = ["IS_1", "IS_2", "BS_1", "CF_47", "CF_48", "NOTES_1"]
DENSE_RULES = ItemRules(semi_annual=("NATION_0", "NATION_10", "NATION_20"))
SPARSE_RULES = ItemRules()

G1 = [f"NATION_{i}" for i in range(0, 22, 5)]
G2 = [f"NATION_{i}" for i in range(1, 22, 5)]
EVERYONE = [f"NATION_{i}" for i in range(22)]
GROUPS = (
    PeerGroup("G1", "BQ %d G1"),
    PeerGroup("G2", "BQ %d G2"),
    PeerGroup("ALL", "BQ %d ALL", "Total %d ALL"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    return F.floor(F.col(amount) * 100 + 0.5)


def r4(value) -> Column:
    return F.round(value, 4)


def customer_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and quarter. Combined map-side, so a customer with very many orders costs 27 rows a task."""
    money, status = F.col("cents"), F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .select(
            "o_custkey",
            F.year("o_orderdate").alias("year"),
            F.quarter("o_orderdate").alias("quarter"),
            "o_orderstatus",
            cents("o_totalprice").alias("cents"),
        )
        .groupBy("o_custkey", "year", "quarter")
        .agg(
            F.sum(money).alias("IS_1"),
            F.count("*").alias("IS_2"),
            F.sum(F.when(status == "O", money)).alias("BS_1"),
            F.min(money).alias("CF_47"),
            F.max(money).alias("CF_48"),
            F.count_if(status == "F").alias("NOTES_1"),
        )
    )


def _long(wide: DataFrame, ids: list[str]) -> DataFrame:
    """Wide to long by a generator, which keeps the partitioning of the rows."""
    cells = [F.struct(F.lit(i).alias("item"), F.col(i).cast("double").alias("value")) for i in ITEMS]
    return with_index(wide.select(*ids, F.inline(F.array(*cells))))


def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers x quarters with orders, every item of each.

    Large tables are dealt out by customer once, after the orders were combined: all keys below contain it.
    """
    rows = customer_quarters(spark, sf_dir).withColumnRenamed("o_custkey", "entity")
    return _long(dealt(rows, "entity") if more_tasks(rows) else rows, ["entity", "year", "quarter"])


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where single orders and empty notes are not reported as lines: for the rules about missing cells."""
    rows = complete(spark, sf_dir)
    unlisted = ((F.col("item") == "IS_2") & (F.col("value") == 1)) | ((F.col("item") == "NOTES_1") & (F.col("value") == 0))
    return rows.filter(F.col("value").isNull() | ~unlisted)


def dense_wide(spark: SparkSession, sf_dir: str, semi_annual: bool = True) -> DataFrame:
    """Nations x quarters; semi-annual reporters have no odd quarters, if there are any.

    The customer totals are formed first, so the join to customer meets no hot key.
    """
    nations = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        customer_quarters(spark, sf_dir)
        .join(nations.select("c_custkey", "n_name"), F.col("o_custkey") == F.col("c_custkey"))
        .filter(~(F.lit(semi_annual) & F.col("n_name").isin(*DENSE_RULES.semi_annual) & F.col("quarter").isin(1, 3)))
        .groupBy(F.col("n_name").alias("entity"), "year", "quarter")
        .agg(
            *[F.sum(i).alias(i) for i in ("IS_1", "IS_2", "BS_1", "NOTES_1")],
            F.min("CF_47").alias("CF_47"),
            F.max("CF_48").alias("CF_48"),
        )
    )


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(dense_wide(spark, sf_dir), ["entity", "year", "quarter"])


def complete_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations x quarters without semi-annual reporters."""
    return _long(dense_wide(spark, sf_dir, semi_annual=False), ["entity", "year", "quarter"])


def three_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly, yearly and (for group G2) half-year reports with their header texts, in one pass over the panel."""
    rows = dense(spark, sf_dir)
    flow = F.col("item").startswith("IS_")
    quarter, year, value = F.col("quarter"), F.col("year").cast("string"), F.col("value")

    def report(freq: str, header: Column, cell: Column) -> Column:
        return F.struct(F.lit(freq).alias("freq"), header.alias("header"), cell.alias("cell"))

    half = F.when(
        F.col("entity").isin(*G2) & (quarter <= 2),
        report(CUMULATIVE, F.concat(F.lit("6m_"), year), F.when(flow | (quarter == 2), value)),
    )
    reports = F.array(
        report(QUARTERLY, F.concat(F.lit("q"), quarter.cast("string"), F.lit("_"), year), value),
        report(YEARLY, year, F.when(flow | (quarter == 4), value)),
        half,
    )
    one_cent = F.when(F.col("freq") == CUMULATIVE, 1.0).otherwise(0.0)
    last_due = F.when(F.col("freq") == YEARLY, 4).when(F.col("freq") == CUMULATIVE, 2)
    return (
        rows.select("entity", "item", "quarter", F.explode(F.array_compact(reports)).alias("r"))
        .groupBy("r.freq", "entity", "item", "r.header")
        .agg(F.sum("r.cell").alias("value"), F.max("quarter").alias("_last"))
        .filter(last_due.isNull() | (F.col("_last") == last_due))
        .withColumn("value", F.col("value") + one_cent)
        .drop("_last")
    )


def reports_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`three_frequencies` with the headers read as periods: the input of the merge."""
    period = normalise_period(F.col("header"))
    return three_frequencies(spark, sf_dir).select(
        "freq", "entity", "item", period_year(period).alias("year"), period_quarter(period).alias("quarter"), "value"
    )


def nation_groups(panel: DataFrame) -> DataFrame:
    return membership_of(panel, {"G1": G1, "G2": G2, "ALL": EVERYONE})


def part_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A formula table as long as `part`."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    bs = F.concat(F.lit("BS_"), (key % 97).cast("string"))
    notes = F.concat(F.lit("NOTES_"), (key % 13).cast("string"))
    kind = F.col("p_size") % 4
    text = (
        F.when(kind == 0, F.concat(bs, F.lit(" / avg_BS_"), size))
        .when(kind == 1, F.concat(F.lit("roll4_IS_"), size, F.lit(" / roll5_"), bs, F.lit(" + "), bs))
        .when(kind == 2, F.concat(F.lit("round(IS_"), size, F.lit(" / quarter * 4 / "), notes, F.lit(", 4)")))
        .otherwise(F.concat(F.lit("1 + "), size))
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("Metric "), key.cast("string")).alias("metric"), text.alias("formula"), F.col("p_brand").alias("sheet")
    )


def supplier_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary as long as `supplier`; some labels are NULL, some carry the guard apostrophe."""
    key = F.col("s_suppkey")
    prefix = F.when(key % 3 == 0, "BS_").when(key % 3 == 1, "IS_").otherwise("NOTES_")
    label = (
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 5 == 0, F.concat(F.lit("'"), F.col("s_name")))
        .otherwise(F.col("s_name"))
    )
    return table(spark, sf_dir, "supplier").select(
        F.concat(prefix, F.floor(key / 3).cast("string")).alias("item"), label.alias("label")
    )


def structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item structure of imagined workbooks, as distinct rows of `lineitem`.

    Landed once: the checks read it several times, and it is tiny beside the lines it comes from.
    """
    year, company = F.year("l_shipdate"), F.col("l_suppkey") % 5
    # the shorter form of company N4 in odd years ends with line 4
    short = (company == 4) & (year % 2 == 1)
    line = F.when(short, F.least("l_linenumber", F.lit(4))).otherwise(F.col("l_linenumber"))
    label = (
        F.when((company == 0) & (year == 1998) & (line == 3), F.lit("Item 3b"))
        .when((company == 1) & (year == 1999) & (line == 2), F.lit(None))
        .when((company == 2) & (year == 2000) & (line == 5), F.lit("Item 4"))
        .otherwise(F.concat(F.lit("Item "), line.cast("string")))
    )
    rows = (
        table(spark, sf_dir, "lineitem")
        .select(
            F.concat(F.lit("N"), company.cast("string")).alias("entity"),
            F.col("l_returnflag").alias("sheet"),
            F.concat(F.lit("f"), year.cast("string")).alias("file"),
            F.concat(F.col("l_returnflag"), F.lit("_"), line.cast("string")).alias("item"),
            label.alias("label"),
        )
        .distinct()
    )
    return checkpointed(rows)


def part_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as workbook cells: file = brand, sheet = type, one row per part below a header row."""
    key = F.col("p_partkey")
    price = F.when(key % 11 == 0, F.lit("1,234")).otherwise(cents("p_retailprice").cast("string"))

    def cell(row: Column, column: int, text: Column) -> Column:
        return F.struct(row.cast("bigint").alias("row_pos"), F.lit(column).alias("col_pos"), text.alias("text"))

    body = F.array(
        cell(key + 9, 0, F.col("p_name")),
        cell(key + 9, 1, F.when(F.col("p_size") % 5 != 0, F.lit("VND"))),
        cell(key + 9, 2, F.col("p_size").cast("string")),
        cell(key + 9, 3, price),
    )
    month = F.lpad((F.length("p_brand") + F.length("p_type")).cast("string"), 2, "0")
    head = F.array(
        cell(F.lit(1), 0, F.concat(F.lit("Export: 15/"), month, F.lit("/2024 (UTC)"))),
        cell(F.lit(8), 0, F.lit("Chỉ tiêu")),
        cell(F.lit(8), 1, F.lit("Đơn vị")),
        cell(F.lit(8), 2, F.lit("Q1 2024")),
        cell(F.lit(8), 3, F.lit("6M 2024")),
    )
    parts = table(spark, sf_dir, "part")
    place = [F.col("p_brand").alias("file"), F.col("p_type").alias("sheet")]
    bodies = parts.select(*place, F.inline(body)).filter(F.col("text").isNotNull())
    heads = parts.select("p_brand", "p_type").distinct().select(*place, F.inline(head))
    return bodies.unionByName(heads)


# ---- the same as SQL

CUSTOMER_QUARTERS_SQL = """
cq AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter,
         sum(cents) AS is_1, count(*) AS is_2, sum(CASE WHEN o_orderstatus = 'O' THEN cents END) AS bs_1,
         min(cents) AS cf_47, max(cents) AS cf_48, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS notes_1
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) o
  GROUP BY 1, 2, 3)"""


def _long_sql(source: str, ids: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, year, quarter, year * 4 + quarter AS qidx, '{i}' AS item, "
        f"CAST({i.lower()} AS DOUBLE) AS value FROM {source}"
        for i in ITEMS
    )


SPARSE_SQL = f"""{CUSTOMER_QUARTERS_SQL},
sparse AS MATERIALIZED (
  SELECT * FROM ({_long_sql('cq', 'o_custkey AS entity')}) s
  WHERE value IS NULL OR NOT (item = 'IS_2' AND value = 1 OR item = 'NOTES_1' AND value = 0))"""

#: Without rows left out; the tables keep their names.
COMPLETE_SQL = SPARSE_SQL.split("\n  WHERE value IS NULL OR NOT")[0] + ")"

DENSE_SQL = f"""
dq AS (
  SELECT n_name AS entity, CAST(year(o_orderdate) AS INT) AS year,
         CAST(quarter(o_orderdate) AS INT) AS quarter,
         sum(cents) AS is_1, count(*) AS is_2, sum(CASE WHEN o_orderstatus = 'O' THEN cents END) AS bs_1,
         min(cents) AS cf_47, max(cents) AS cf_48, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS notes_1
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) o
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE NOT (n_name IN ('NATION_0', 'NATION_10', 'NATION_20') AND quarter(o_orderdate) IN (1, 3))
  GROUP BY 1, 2, 3),
dense AS MATERIALIZED ({_long_sql('dq', 'entity')})"""

_SEMI_ROWS = "  WHERE NOT (n_name IN ('NATION_0', 'NATION_10', 'NATION_20') AND quarter(o_orderdate) IN (1, 3))\n"
COMPLETE_DENSE_SQL = DENSE_SQL.replace(_SEMI_ROWS, "")

REPORTS_SQL = f"""{DENSE_SQL},
headed AS (
  SELECT 'quarterly' AS freq, entity, item, 'q' || quarter || '_' || year AS header, year, quarter, value FROM dense
  UNION ALL
  SELECT 'yearly', entity, item, CAST(year AS VARCHAR), year, 4,
         sum(CASE WHEN item LIKE 'IS%' OR quarter = 4 THEN value END)
  FROM dense GROUP BY entity, item, year HAVING max(quarter) = 4
  UNION ALL
  SELECT 'cumulative', entity, item, '6m_' || year, year, 2,
         sum(CASE WHEN item LIKE 'IS%' OR quarter = 2 THEN value END) + 1
  FROM dense WHERE entity IN ('NATION_1', 'NATION_6', 'NATION_11', 'NATION_16', 'NATION_21') AND quarter <= 2 GROUP BY entity, item, year HAVING max(quarter) = 2)"""


def ytd_sql(source: str, name: str = "ytd") -> str:
    """Year to date by joins: the grid of items and periods, then the cells up to each quarter."""
    return f"""
{name}_grid AS (
  SELECT i.entity, i.item, p.year, p.quarter, p.qidx,
         min(p.quarter) OVER (PARTITION BY i.entity, i.item, p.year) AS first_quarter
  FROM (SELECT DISTINCT entity, item FROM {source}) i
  JOIN (SELECT DISTINCT entity, year, quarter, qidx FROM {source} WHERE quarter <= 3) p ON i.entity = p.entity),
{name} AS (
  SELECT g.entity, g.item, g.year, g.quarter, g.qidx,
         CASE WHEN g.item LIKE '%BS%' OR g.item LIKE 'NOTES%' OR g.item = 'CF_48'
                THEN max(CASE WHEN f.quarter = g.quarter THEN f.value END)
              WHEN g.item = 'CF_47' THEN max(CASE WHEN f.quarter = g.first_quarter THEN f.value END)
              ELSE coalesce(sum(f.value), 0) END AS value
  FROM {name}_grid g LEFT JOIN {source} f
    ON g.entity = f.entity AND g.item = f.item AND g.year = f.year AND f.quarter <= g.quarter
  GROUP BY g.entity, g.item, g.year, g.quarter, g.qidx, g.first_quarter)"""


MERGED_SQL = f"""{REPORTS_SQL},
quarterly AS (SELECT *, year * 4 + quarter AS qidx FROM headed WHERE freq = 'quarterly'),
{ytd_sql('quarterly')},
merged AS (
  SELECT entity, item, year, quarter, year * 4 + quarter AS qidx, value FROM headed WHERE freq = 'yearly'
  UNION ALL
  SELECT entity, item, year, quarter, year * 4 + quarter, value FROM headed WHERE freq = 'cumulative'
  UNION ALL
  SELECT y.entity, y.item, y.year, y.quarter, y.qidx, y.value FROM ytd y
  WHERE NOT EXISTS (SELECT 1 FROM headed c WHERE c.freq = 'cumulative'
                    AND c.entity = y.entity AND c.year = y.year AND c.quarter = y.quarter))"""

MEMBERS_SQL = """
members AS (
  SELECT 'G1' AS grp, n_name AS entity FROM nation WHERE n_nationkey < 22 AND n_nationkey % 5 = 0
  UNION ALL SELECT 'G2', n_name FROM nation WHERE n_nationkey < 22 AND n_nationkey % 5 = 1
  UNION ALL SELECT 'ALL', n_name FROM nation WHERE n_nationkey < 22)"""


def groups_sql(source: str, name: str = "grouped", means: bool = True) -> str:
    """The panel with its group rows, or with the totals alone."""
    kept = "TRUE" if means else "FALSE"
    return f"""{MEMBERS_SQL},
counts AS (
  SELECT grp, count(DISTINCT m.entity) AS n FROM members m
  JOIN (SELECT DISTINCT entity FROM {source}) s ON m.entity = s.entity GROUP BY grp),
{name} AS (
  SELECT entity, item, year, quarter, qidx, value FROM {source}
  UNION ALL
  SELECT 'BQ ' || c.n || ' ' || c.grp, s.item, s.year, s.quarter, s.qidx, avg(s.value)
  FROM {source} s JOIN members m ON s.entity = m.entity JOIN counts c ON m.grp = c.grp
  WHERE {kept}
  GROUP BY c.n, c.grp, s.item, s.year, s.quarter, s.qidx
  UNION ALL
  SELECT 'Total ' || c.n || ' ' || c.grp, i.item, p.year, p.quarter, p.qidx,
         coalesce((SELECT sum(s.value) FROM {source} s JOIN members m ON s.entity = m.entity
                   WHERE m.grp = 'ALL' AND s.item = i.item AND s.qidx = p.qidx), 0)
  FROM counts c
  JOIN (SELECT DISTINCT year, quarter, qidx FROM {source} s JOIN members m ON s.entity = m.entity
        WHERE m.grp = 'ALL') p ON c.grp = 'ALL'
  JOIN (SELECT DISTINCT item FROM {source}) i ON 1 = 1)"""


def series_sql(
    source: str, name: str = "derived", semi: str = "FALSE", series: tuple[str, ...] = ("avg", "roll5", "roll4")
) -> str:
    """The chosen series by self-joins; only the tables that they need are there."""
    odd = f"({semi.format('p')} AND p.quarter % 2 = 1)"
    sofar = f"""
{name}_sofar AS MATERIALIZED (
  SELECT p.entity, p.item, p.qidx, sum(y.value) AS total, count(y.value) AS points
  FROM {source} p JOIN {source} y ON p.entity = y.entity AND p.item = y.item AND p.year = y.year
   AND y.quarter <= p.quarter AND NOT ({semi.format('y')} AND y.quarter % 2 = 1)
  GROUP BY p.entity, p.item, p.qidx),"""
    five = f"""
{name}_five AS MATERIALIZED (
  SELECT p.entity, p.item, p.qidx, avg(w.value) AS mean, count(w.value) AS points
  FROM {source} p JOIN {source} w ON p.entity = w.entity AND p.item = w.item
   AND w.qidx BETWEEN p.qidx - 4 AND p.qidx
  GROUP BY p.entity, p.item, p.qidx),"""
    columns = {
        "avg": f"""CASE WHEN NOT {odd} AND q4.value IS NOT NULL
      AND a.points = CASE WHEN {semi.format('p')} THEN p.quarter // 2 ELSE p.quarter END
      THEN (a.total + q4.value) / (CASE WHEN {semi.format('p')} THEN p.quarter // 2 ELSE p.quarter END + 1) END AS avg""",
        "roll5": f"""CASE WHEN NOT {odd} AND f.points >= CASE WHEN {semi.format('p')} THEN 3 ELSE 5 END
      THEN f.mean END AS roll5""",
        "roll4": f"""CASE WHEN {odd} THEN NULL WHEN p.quarter = 4 THEN p.value
      ELSE p.value + q4.value - py.value END AS roll4""",
    }
    joins = {
        "q4": f"LEFT JOIN {source} q4 ON q4.entity = p.entity AND q4.item = p.item AND q4.year = p.year - 1 AND q4.quarter = 4",
        "py": f"LEFT JOIN {source} py ON py.entity = p.entity AND py.item = p.item AND py.year = p.year - 1 AND py.quarter = p.quarter",
        "a": f"LEFT JOIN {name}_sofar a ON a.entity = p.entity AND a.item = p.item AND a.qidx = p.qidx",
        "f": f"LEFT JOIN {name}_five f ON f.entity = p.entity AND f.item = p.item AND f.qidx = p.qidx",
    }
    needs = {"avg": ("q4", "a"), "roll5": ("f",), "roll4": ("q4", "py")}
    used = [j for j in joins if any(j in needs[s] for s in series)]
    return f"""{sofar if "a" in used else ""}{five if "f" in used else ""}
{name} AS MATERIALIZED (
  SELECT p.*, {", ".join(columns[s] for s in series)}
  FROM {source} p {" ".join(joins[j] for j in used)})"""


SEMI_SQL = "{0}.entity IN ('NATION_0', 'NATION_10', 'NATION_20')"

FORMULAS_SQL = """
formulas AS (
  SELECT 'Metric ' || p_partkey AS metric, p_brand AS sheet,
    CASE p_size % 4
      WHEN 0 THEN 'BS_' || (p_partkey % 97) || ' / avg_BS_' || p_size
      WHEN 1 THEN 'roll4_IS_' || p_size || ' / roll5_BS_' || (p_partkey % 97) || ' + BS_' || (p_partkey % 97)
      WHEN 2 THEN 'round(IS_' || p_size || ' / quarter * 4 / NOTES_' || (p_partkey % 13) || ', 4)'
      ELSE '1 + ' || p_size END AS formula
  FROM part),
refs AS (
  SELECT metric, formula, item, min(pos) - 1 AS first_pos FROM (
    SELECT metric, formula, unnest(regexp_extract_all(formula, '[A-Z]+_[0-9]+')) AS item,
           generate_subscripts(regexp_extract_all(formula, '[A-Z]+_[0-9]+'), 1) AS pos FROM formulas) r
  GROUP BY metric, formula, item),
used AS (
  SELECT metric, formula, item, CAST(row_number() OVER (PARTITION BY metric ORDER BY first_pos) - 1 AS INT) AS pos
  FROM refs),
dict AS (
  SELECT CASE s_suppkey % 3 WHEN 0 THEN 'BS_' WHEN 1 THEN 'IS_' ELSE 'NOTES_' END || (s_suppkey // 3) AS item,
         CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_name END AS label
  FROM supplier)"""

STRUCTURE_SQL = """
lines AS (
  SELECT l_suppkey % 5 AS company, year(l_shipdate) AS y, l_returnflag,
    CASE WHEN l_suppkey % 5 = 4 AND year(l_shipdate) % 2 = 1 AND l_linenumber > 4 THEN 4 ELSE l_linenumber END AS num
  FROM lineitem),
structure AS (
  SELECT DISTINCT 'N' || company AS entity, l_returnflag AS sheet, 'f' || y AS file,
    l_returnflag || '_' || num AS item, num,
    CASE WHEN company = 0 AND y = 1998 AND num = 3 THEN 'Item 3b'
         WHEN company = 1 AND y = 1999 AND num = 2 THEN NULL
         WHEN company = 2 AND y = 2000 AND num = 5 THEN 'Item 4'
         ELSE 'Item ' || num END AS label
  FROM lines)"""

PART_ITEMS_SQL = """
kept AS (
  SELECT p_brand AS file, p_type AS sheet, p_partkey + 9 AS row_pos, p_name AS label, p_size,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(round(p_retailprice * 100) AS DOUBLE) END AS price,
    p_type || '_' || row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS item
  FROM part WHERE p_size % 5 <> 0)"""
