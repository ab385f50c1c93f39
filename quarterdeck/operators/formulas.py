"""User formulas over the panel: one wide row per entity and period, one expression per metric."""

from __future__ import annotations

import json
import re
from collections.abc import Container, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from quarterdeck.config import Formula, ItemRules
from quarterdeck.functions.text import ITEM_ID, clean_name
from quarterdeck.operators.series import defined_series
from quarterdeck.session import lenient_arithmetic, scratch_path

SERIES = ("avg", "roll5", "roll4")
#: Nodes of a resolved formula whose value the moment or the session decides, or that fail the job. Fixed values; all nodes
#: whose name starts with Current count too, user functions (..UDF) and subqueries. Random ones say so themselves.
NOT_SCALAR = frozenset("Now LocalTimestamp SparkVersion RaiseError Exists ListQuery".split())
#: Formulas of a block at most, and panel columns that they may use between them.
BLOCK_FORMULAS, BLOCK_COLUMNS = 200, 128
_COLUMN = re.compile(rf"\b(?:({'|'.join(SERIES)})_)?({ITEM_ID})\b")
_IDS = ["entity", "year", "quarter", "qidx"]


def panel_columns(formulas: Sequence[Formula]) -> dict[str, tuple[str, str]]:
    """Columns the formulas name: column -> (item, series)."""
    return {
        m.group(0): (m.group(2), m.group(1) or "value") for f in formulas for m in _COLUMN.finditer(f.text)
    }


def referenced_items(formulas: Sequence[Formula]) -> list[str]:
    return sorted({item for item, _ in panel_columns(formulas).values()})


def known_columns(
    formulas: Sequence[Formula], items: Sequence[str], series: Sequence[str], rules: ItemRules = ItemRules()
) -> dict[str, tuple[str, str]]:
    """Columns the formulas name that exist: of the `items`, as value or as one of the `series` that the rules define."""
    present, kinds = set(items), {c for c in SERIES if c in series}
    return {
        name: (item, kind) for name, (item, kind) in sorted(panel_columns(formulas).items())
        if item in present and (kind == "value" or kind in kinds & defined_series(item, rules))
    }


@dataclass(frozen=True)
class Block:
    """Formulas that are evaluated together, and their columns in the order of the block's vector."""

    formulas: list[Formula]
    columns: list[str]


def in_blocks(formulas: Sequence[Formula], columns: Container[str]) -> list[Block]:
    """Formulas in order, in blocks of bounded formulas and columns; one formula may have more columns by itself.

    Names that are no `columns` stand in texts or comments of formulas that were checked.
    """
    blocks: list[Block] = []
    for formula in formulas:
        own = [c for c in panel_columns([formula]) if c in columns]
        if blocks and len(blocks[-1].formulas) < BLOCK_FORMULAS:
            joint = list(dict.fromkeys([*blocks[-1].columns, *own]))
            if len(joint) <= BLOCK_COLUMNS:
                blocks[-1] = Block([*blocks[-1].formulas, formula], joint)
                continue
        blocks.append(Block([formula], own))
    return blocks


def vectors(
    series: DataFrame, blocks: Sequence[Block], columns: Mapping[str, tuple[str, str]], calendar: DataFrame | None = None
) -> DataFrame:
    """One array of doubles per entity, period and block: entity, year, quarter, qidx, block, present, vector.

    Input is `derive_series` output. An element stands for a column of the block, in its order; it is null where the panel
    has no cell. `calendar` (entity, year, quarter, qidx, present) adds periods in which an entity has none of the items;
    `present` tells the entity's own ones from those that are there to fill a table. Cells are combined map-side, by one aggregate
    per element, so the plan does not grow with the columns of all formulas.
    """
    spark = series.sparkSession
    width = max([1, *(len(b.columns) for b in blocks)])
    uses = [(*columns[c], number, place) for number, b in enumerate(blocks) for place, c in enumerate(b.columns)]
    # As long as the formulas' text, which the driver holds.
    places = F.broadcast(spark.createDataFrame(uses, "item string, kind string, block int, place int"))
    kinds = [c for c in ("value", *SERIES) if c in series.columns]
    cell = F.coalesce(*(F.when(F.col("kind") == k, F.col(k)) for k in kinds)).alias("cell")
    cells = series.join(places, "item").select(*_IDS, "block", "place", cell, F.lit(True).alias("present"))
    every = F.explode(F.sequence(F.lit(0), F.lit(max(len(blocks), 1) - 1))).alias("block")
    spine = series.select(*_IDS, F.lit(True).alias("present"))
    if calendar is not None:
        spine = spine.unionByName(calendar.select(*_IDS, "present"))
    spine = spine.groupBy(*_IDS).agg(F.bool_or("present").alias("present")).select(
        *_IDS, every, F.lit(None).cast("int").alias("place"), F.lit(None).cast("double").alias("cell"), "present"
    )
    elements = F.array(*(F.max(F.when(F.col("place") == k, F.col("cell"))) for k in range(width)))
    return cells.unionByName(spine).groupBy(*_IDS, "block").agg(F.bool_or("present").alias("present"), elements.alias("vector"))


def table_names(spark: SparkSession, metrics: Sequence[str]) -> dict[str, str]:
    """Metric name -> the name of its table."""
    names = spark.createDataFrame([(m,) for m in metrics], "metric string")
    return {r["metric"]: r["name"] for r in names.select("metric", clean_name(F.col("metric")).alias("name")).collect()}


def _faults(node_classes: Sequence[str], deterministic: bool) -> str | None:
    """What makes a resolved formula's value depend on more than its row, if anything."""
    for name in node_classes:
        if name in NOT_SCALAR or name.startswith("Current") or name.endswith(("UDF", "Subquery")):
            return name
    return None if deterministic else "a value drawn at random or from where a row lies"


def _closes_early(text: str) -> bool:
    depths = accumulate((c == "(") - (c == ")") for c in text)
    return min(depths, default=0) < 0


def _resolved(probe: DataFrame, formulas: Sequence[Formula]) -> list[tuple[str, str] | None]:
    """For each formula nothing, or the reason and message of what is wrong with it in Spark's resolved plan.

    All are resolved in one projection; if that fails, or is more than a projection (windows and generators get a node of
    their own), each is resolved by itself, as it is the failures that take time.
    """
    try:
        # the plain column beside them makes an aggregate fail here
        resolved = probe.selectExpr("entity", *(f"CAST((\n{f.text}\n) AS DOUBLE) AS f{i}" for i, f in enumerate(formulas)))
        for formula in formulas:
            if _closes_early(formula.text):
                probe.selectExpr(formula.text)  # by itself, without the brackets that were put around it
        plan = resolved._jdf.queryExecution().analyzed()
        nodes = [plan, plan.children().head()]
        problem = None
    except PySparkException as error:
        problem = "unresolved", str(error).split("\n")[0]
    if problem is None and (nodes[0].nodeName() != "Project" or not nodes[1].children().isEmpty()):
        problem = "not scalar", f"{nodes[1].nodeName()} is not allowed: its value depends on more than the row"
    if problem is not None:
        if len(formulas) == 1:
            return [problem]
        return [_resolved(probe, [f])[0] for f in formulas]
    found: list[tuple[str, str] | None] = []
    trees = json.loads(plan.toJSON())[0]["projectList"][1:]
    expressions = plan.expressions()
    for k, tree in enumerate(trees):
        fault = _faults([n["class"].rsplit(".", 1)[-1] for n in tree], expressions.apply(k + 1).deterministic())
        found.append(fault and ("not scalar", f"{fault} is not allowed: its value depends on more than the row"))
    return found


def check_formulas(spark: SparkSession, columns: Sequence[str], formulas: Sequence[Formula]):
    """Resolve every formula over the columns. Returns the good ones and the failures as (formula, reason, message).

    Reasons: `table name` (none left after cleaning, or that of an earlier formula), `not scalar`, `unresolved`. What a
    formula is made of is read from Spark's resolved expression, so no spelling hides it.
    """
    names = [f.metric for f in formulas]
    repeated = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
    if repeated:
        raise ValueError(f"metric names must be unique: {repeated}")
    known = set(columns) - {"entity", "quarter"}
    problems: dict[str, tuple[str, str] | None] = {}
    # An unknown column is an error, unless it only stands in a text or a comment.
    likely, doubtful = [], []
    for formula in formulas:
        unknown = sorted(panel_columns([formula]).keys() - known)
        if not unknown:
            likely.append(formula)
        elif re.search(r"['\"]|--|/\*", formula.text):
            doubtful.append([formula])
        else:
            problems[formula.metric] = "unresolved", f"no column {', '.join(unknown)}"
    groups = [likely[start : start + BLOCK_FORMULAS] for start in range(0, len(likely), BLOCK_FORMULAS)]
    with lenient_arithmetic(spark):
        for some in [*groups, *doubtful]:
            used = [StructField(c, DoubleType()) for c in sorted(known & panel_columns(some).keys())]
            fields = [StructField("entity", StringType()), StructField("quarter", IntegerType()), *used]
            found = _resolved(spark.createDataFrame([], StructType(fields)), some)
            problems |= {f.metric: p for f, p in zip(some, found, strict=True)}
    cleaned, taken = table_names(spark, names), {}
    good, failed = [], []
    for formula in formulas:
        name, problem = cleaned[formula.metric], problems[formula.metric]
        if not name or name in taken:
            failed.append((formula, "table name", f"table name {name!r} is empty or that of {taken.get(name)!r}"))
        elif problem:
            failed.append((formula, *problem))
        else:
            good.append(formula)
            taken[name] = formula.metric
    return good, failed


def error_table(spark: SparkSession, failed) -> DataFrame:
    rows = [(f.metric, f.text, reason, message) for f, reason, message in failed]
    return spark.createDataFrame(rows, "metric string, formula string, reason string, error string")


def evaluate_blocks(found: DataFrame, blocks: Sequence[Block], annualise: bool = False) -> DataFrame:
    """One row per entity, period and metric, from `vectors`; none without formulas. Every block is a projection of its own.

    With several blocks the vectors are landed, a folder each, so that a block reads nothing of the others.
    """
    if len(blocks) > 1:
        path = scratch_path(found.sparkSession, "vectors")
        found.write.partitionBy("block").parquet(path)
        found = found.sparkSession.read.parquet(path)
    if not blocks:
        return found.select(*_IDS, F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value")).limit(0)
    parts = [evaluate(found.filter(F.col("block") == n), b, annualise) for n, b in enumerate(blocks)]
    while len(parts) > 1:  # pairs of pairs, as every union resolves what it holds again
        parts = [reduce(DataFrame.union, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def evaluate(found: DataFrame, block: Block, annualise: bool = False) -> DataFrame:
    """All formulas of a block: entity, year, quarter, qidx, metric, value.

    Division by zero gives NULL, and so does every formula where the period is not the entity's own. `annualise` evaluates
    with the variable `quarter` as 1.
    """
    elements = [f"get(vector, {k}) AS `{c}`" for k, c in enumerate(block.columns)]
    quarter = "1 AS quarter" if annualise else "quarter"
    source = found.selectExpr("entity", "year", "quarter AS _quarter", quarter, "qidx", "present", *elements)
    text = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    # A formula was resolved alone, so its brackets match; the line breaks end a comment that it may close with.
    pairs = ", ".join(f"{text(f.metric)}, CAST((\n{f.text}\n) AS DOUBLE)" for f in block.formulas)
    with lenient_arithmetic(found.sparkSession):
        rows = source.select(
            "entity", "year", "_quarter", "qidx", "present", F.expr(f"stack({len(block.formulas)}, {pairs})").alias("metric", "value")
        )
        rows.schema
    return rows.select("entity", "year", F.col("_quarter").alias("quarter"), "qidx", "metric", F.when(F.col("present"), F.col("value")).alias("value"))


def formula_batch(
    series: DataFrame,
    formulas: Sequence[Formula],
    items: Sequence[str],
    annualise: bool = False,
    rules: ItemRules = ItemRules(),
) -> tuple[DataFrame, DataFrame]:
    """Evaluate every formula; a bad one ends up in the error table and does not stop the rest."""
    spark = series.sparkSession
    columns = known_columns(formulas, items, series.columns, rules)
    good, failed = check_formulas(spark, list(columns), formulas)
    blocks = in_blocks(good, columns)
    return evaluate_blocks(vectors(series, blocks, columns), blocks, annualise), error_table(spark, failed)
