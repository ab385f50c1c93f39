"""URL filter by a sort-merge range join.

A host is written with its labels reversed and a dot after each (`net.example.`), so a host rule covers exactly the keys
with its own key as a prefix, one interval of the key order, and the intervals of rules nest. URLs are range-partitioned
and sorted by key; the sweep over a partition meets interval borders and URLs in key order, and each border carries the
stack of rules that are active from there on. The longest rule of the stack whose path fits decides. All of it is
DataFrame work, without Python on the rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import landed, shuffle_partitions

#: (host, path, verdict). Fixed values.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _key_prefixes(key: Column) -> Column:
    """Every prefix of a key that ends after a label."""
    labels = F.split(key, r"\.")  # the last one is empty
    lengths = F.sequence(F.lit(1), F.size(labels) - 1)
    whole = F.transform(lengths, lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    return F.when(F.size(labels) > 1, whole).otherwise(F.array().cast("array<string>"))


def _stacks(at: DataFrame, host_rules: DataFrame, within: str) -> DataFrame:
    """Rules active at each row of `at` (columns border, within): those whose key is a prefix of `within`."""
    reached = at.withColumn("rule_key", F.explode_outer(_key_prefixes(F.col(within))))
    joined = reached.join(host_rules, "rule_key", "left")
    return joined.groupBy(*at.columns).agg(F.flatten(F.collect_list("entries")).alias("stack"))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to all rows of `urls`.

    Null urls and urls without `://` have empty host and path; no rule fits them, nor any url outside all rules: rule null,
    verdict `default`. Of several rules that fit the longest wins, equally long ones by text. Repeated rows stay repeated.
    Rules with a null host or path are left out. Column names that start with `_sweep` are reserved.
    """
    spark = urls.sparkSession
    entry = F.struct(
        F.length(F.concat("host", "path")).alias("size"), F.concat("host", "path").alias("rule"), "path", "verdict"
    )
    host_rules = (
        rules.dropna(subset=["host", "path"]).withColumn("rule_key", host_key(F.col("host")))
        .groupBy("rule_key").agg(F.sort_array(F.collect_set(entry), asc=False).alias("entries"))
    )
    host, key = host_of(F.col(url)), "_sweep_key"
    # Equal keys are told apart by the url's hash and a random number of fixed seed, so a hot host spreads over tasks.
    keyed = urls.withColumns({"host": host, "path": path_of(F.col(url))}).withColumns(
        {key: host_key(F.col("host")), "_sweep_tie": F.xxhash64(url), "_sweep_salt": F.rand(seed=1)}
    )
    ranged = keyed.repartitionByRange(shuffle_partitions(spark), key, "_sweep_tie", "_sweep_salt")
    swept = landed(ranged.withColumn("_sweep_part", F.spark_partition_id()).drop("_sweep_tie", "_sweep_salt"), "urls")

    # One row per partition, two per rule host: what follows is small whatever the number of urls.
    parts = swept.groupBy("_sweep_part").agg(F.min(key).alias("border")).withColumnRenamed("_sweep_part", "part")
    carried = _stacks(parts, host_rules, "border").select("part", "border", "stack")
    begins = host_rules.select(F.col("rule_key").alias("border"), F.col("rule_key").alias("within"))
    ends = host_rules.select(  # `/` follows `.`: the first key after all that start with the rule's
        F.regexp_replace("rule_key", r"\.$", "/").alias("border"),
        F.regexp_replace("rule_key", r"[^.]*\.$", "").alias("within"),
    )
    borders = _stacks(begins.unionByName(ends).distinct(), host_rules, "within").select("border", "stack")
    none = F.lit(None).cast(borders.schema["stack"].dataType).alias("stack")
    # A border belongs to the last partition that starts before it; earlier partitions have ended, later ones carry it in.
    order = Window.orderBy("border", "kind", "part")
    events = (
        borders.select("border", "stack", F.lit(None).cast("int").alias("part"), F.lit(0).alias("kind"))
        .unionByName(parts.select("border", none, "part", F.lit(1).alias("kind")))
        .withColumn("part", F.last("part", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter("kind = 0 and part is not null").select("part", "border", "stack")
        .unionByName(carried)
    )

    names = [c for c in swept.columns if c not in (key, "_sweep_part")]
    rows = swept.select(
        F.col("_sweep_part").alias("part"), F.col(key).alias("border"), none,
        F.struct(*names).alias("row"),
    )
    points = events.withColumn("row", F.lit(None).cast(rows.schema["row"].dataType))
    sweep = Window.partitionBy("part").orderBy("border", F.col("row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    active = (
        rows.unionByName(points).withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).filter("row is not null")
    )
    fitting = F.filter("active", lambda r: F.startswith(F.col("row.path"), r["path"]))
    best = F.try_element_at(F.sort_array(fitting, asc=False), F.lit(1))
    return active.withColumn("best", best).select(
        "row.*", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def judge_pages(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    return judge(pages.select("page_id", "url"), rules_table(pages.sparkSession)).drop("url")


SQL = """
WITH parsed AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS place FROM pages
), cut AS (
  SELECT page_id, CASE WHEN place = 0 THEN '' ELSE substr(url, place + 3) END AS rest FROM parsed
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, max_by(struct_pack(rule := rule_host || rule_path, verdict := rule_verdict),
    length(rule_host || rule_path)) AS best
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""
