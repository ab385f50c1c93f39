"""INSERT scripts for a remote SQL database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, NumericType

from quarterdeck.sinks.writers import storage_type, temporal_as_text

BATCH_ROWS = 200
#: Copies of a row that stay together.
RUN_ROWS = 10_000


def sql_literal(value: Column, data_type: DataType) -> Column:
    """SQL text of a value: NULL, 1/0, a number, or quoted text. NaN and infinities become NULL."""
    if isinstance(data_type, BooleanType):
        text = F.when(value, F.lit("1")).otherwise(F.lit("0"))
    elif isinstance(data_type, (FloatType, DoubleType)):
        finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
        text = F.when(finite, value.cast("string"))
    elif isinstance(data_type, NumericType):
        text = value.cast("string")
    else:
        text = F.concat(F.lit("'"), F.replace(value.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(F.when(value.isNotNull(), text), F.lit("NULL"))


def _literals(df: DataFrame) -> Column:
    """The parenthesised literals of a row of a frame without dates."""
    return F.concat(F.lit("("), F.concat_ws(", ", *(sql_literal(F.col(_cited(f.name)), f.dataType) for f in df.schema)), F.lit(")"))


def _cited(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_tuples(df: DataFrame) -> DataFrame:
    """One column `tuple` with the parenthesised literals of each row."""
    texts = temporal_as_text(df)
    return texts.select(_literals(texts).alias("tuple"))


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _quoted_column(name: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def create_statements(df: DataFrame, table: str) -> list[str]:
    columns = ", ".join(f"{_quoted(f.name)} {storage_type(f.dataType)}" for f in df.schema)
    return [f"DROP TABLE IF EXISTS {_quoted(table)};", f"CREATE TABLE {_quoted(table)} ({columns});"]


def insert_statements(df: DataFrame, table: str, batch_rows: int = BATCH_ROWS, by: str | None = None) -> DataFrame:
    """Multi-row INSERT statements (columns `table`, `batch`, `statement`) of at most `batch_rows` rows.

    All columns are inserted into `table`; with `by` they go to the table that this column names, and it alone is left out.
    Rows are dealt to tasks by their content and sorted by it, so their places, and with them the statements, are the same
    whenever a task or the whole job runs again with as many shuffle partitions. Equal rows are counted before they are
    dealt and then spread in runs of RUN_ROWS, so a row that comes very often does not end up in one task.
    """
    spark = df.sparkSession
    values = df.drop(by) if by else df
    texts = temporal_as_text(values)
    names = F.col(_cited(by)).cast("string") if by else F.lit(table)
    tuples = temporal_as_text(df).select(names.alias("table"), _literals(texts).alias("tuple"))
    counted = tuples.groupBy("table", "tuple").agg(F.count("*").alias("copies"))
    runs = counted.select(
        "table", "tuple", "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {RUN_ROWS}"))).alias("run")
    )
    left = F.least(F.col("copies") - F.col("run") * RUN_ROWS, F.lit(RUN_ROWS))
    content = ["table", "tuple", "run"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.select(*content, left.alias("copies")).repartition(partitions, *content).sortWithinPartitions(*content)
    copies = dealt.select("table", "tuple", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    placed = copies.select("table", "tuple", F.monotonically_increasing_id().alias("place"))
    part, local = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    batch = F.format_string("%08d-%012d", part, F.floor(local / batch_rows))
    batches = placed.groupBy("table", batch.alias("batch")).agg(F.sort_array(F.collect_list(F.struct("place", "tuple"))).alias("rows"))
    listed = ", ".join(map(_quoted, values.columns))
    body = F.array_join(F.transform("rows", lambda r: r["tuple"]), ", ")
    head = F.concat(F.lit("INSERT INTO "), _quoted_column(F.col("table")), F.lit(f" ({listed}) VALUES "))
    return batches.select("table", "batch", F.concat(head, body, F.lit(";")).alias("statement"))


def write_script(df: DataFrame, table: str, path: str, batch_rows: int = BATCH_ROWS) -> bool:
    """Text files below `path`: `create` (run first) and `rows`. An empty result has no `create`. Returns whether it has one.

    Values may hold line breaks: statements end with `;` and a line break and are not split by line on replay.
    """
    spark = df.sparkSession
    statements = insert_statements(df, table, batch_rows)
    statements.orderBy("batch").select("statement").write.mode("overwrite").text(f"{path}/rows")
    if spark.read.text(f"{path}/rows").isEmpty():
        return False
    ddl = spark.createDataFrame([("\n".join(create_statements(df, table)),)], "statement string")
    ddl.write.mode("overwrite").text(f"{path}/create")
    return True


def write_scripts(df: DataFrame, by: str, path: str, batch_rows: int = BATCH_ROWS) -> None:
    """Scripts of many tables in one job: `create` and `rows` below `path`, a folder `table=<name>` in each.

    Column `by` names the table of a row and is not inserted itself.
    """
    data = df.drop(by)
    statements = insert_statements(df, "", batch_rows, by).orderBy("table", "batch").select("table", "statement")
    statements.write.mode("overwrite").partitionBy("table").text(f"{path}/rows")
    kinds = ", ".join(f"{_quoted(f.name)} {storage_type(f.dataType)}" for f in data.schema)
    name = _quoted_column(F.col("table"))
    ddl = F.concat(F.lit("DROP TABLE IF EXISTS "), name, F.lit(";\nCREATE TABLE "), name, F.lit(f" ({kinds});"))
    tables = df.select(F.col(_cited(by)).cast("string").alias("table")).distinct()
    tables.select("table", ddl.alias("statement")).write.mode("overwrite").partitionBy("table").text(f"{path}/create")
