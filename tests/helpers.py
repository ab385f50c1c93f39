"""Small frames in, plain rows out."""

import re
from contextlib import contextmanager

from pyspark.sql import functions as F


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def facts(spark, data):
    """data: (entity, item, 'YYYY_qN', value)."""
    flat = [(e, i, int(p[:4]), int(p[-1]), None if v is None else float(v)) for e, i, p, v in data]
    return spark.createDataFrame(flat, "entity string, item string, year int, quarter int, value double")


def panel(spark, data):
    return facts(spark, data).withColumn("qidx", F.expr("cast(year * 4 + quarter as int)"))


def by_key(df, value="value"):
    """{(entity, item, 'YYYY_qN'): value}"""
    return {(r["entity"], r["item"], f"{r['year']}_q{r['quarter']}"): r[value] for r in df.collect()}


def exchanges(df):
    """(columns, keys) of every hash exchange, and the columns of every file scan, of a plan without broadcasts.

    Build `df` under `no_broadcasts`.
    """
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().explainString(modes.fromString("formatted")))
    found = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((.*?), \d+\)", plan)
    return [(columns.split(", "), keys) for columns, keys in found], re.findall(r"ReadSchema: struct<(.*?)>", plan)


@contextmanager
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
