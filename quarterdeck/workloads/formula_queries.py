"""Formula, lineage and flagship queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.config import Formula, PeerGroup
from quarterdeck.operators import lineage as L
from quarterdeck.operators.audit import critical_items, rule_items
from quarterdeck.operators.formulas import formula_batch, referenced_items
from quarterdeck.operators.groups import membership_of
from quarterdeck.operators.panel import tag_quarterly
from quarterdeck.operators.ranking import wide_metric
from quarterdeck.operators.series import derive_series
from quarterdeck.plans.metrics import build_metrics, publish
from quarterdeck.session import land, scratch_path
from quarterdeck.sources.tables import FORMULA_HEADERS, formula_list, read_formulas
from quarterdeck.workloads.panels import (
    DENSE_RULES,
    EVERYONE,
    FORMULAS_SQL,
    G1,
    G2,
    GROUPS,
    ITEMS,
    MEMBERS_SQL,
    MERGED_SQL,
    SEMI_SQL,
    SPARSE_RULES,
    SPARSE_SQL,
    groups_sql,
    nation_groups,
    part_formulas,
    r4,
    reports_by_period,
    series_sql,
    sparse,
    supplier_dictionary,
    table,
    ytd_sql,
)

FORMULAS = (
    Formula("Tổng tài sản", "BS_1", "Assets"),
    Formula("Yield", "IS_1 / avg_BS_1", "Ratios"),
    Formula("TTM yield", "roll4_IS_1 / roll5_BS_1", "Ratios"),
    Formula("Annualised", "round(IS_1 / quarter * 4 / NOTES_1, 4)", "Ratios"),
    Formula("Zero division", "IS_2 / (NOTES_1 - NOTES_1)", "Checks"),
    Formula("Unknown item", "IS_1 / BS_999", "Checks"),
    Formula("No reference", "1 + 1", "Checks"),
)

SEGMENTS = tuple(
    PeerGroup(name, f"BQ %d {name}") for name in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
)

# metric, sheet, table name and expression over the pivoted columns
_SQL_FORMULAS = (
    ("Tổng tài sản", "Assets", "tong_tai_san", "bs_1"),
    ("Yield", "Ratios", "yield", "is_1 / nullif(avg_bs_1, 0)"),
    ("TTM yield", "Ratios", "ttm_yield", "roll4_is_1 / nullif(roll5_bs_1, 0)"),
    ("Annualised", "Ratios", "annualised", "round(is_1 / {quarter} * 4 / nullif(notes_1, 0), 4)"),
    ("Zero division", "Checks", "zero_division", "CAST(NULL AS DOUBLE)"),
    ("No reference", "Checks", "no_reference", "CAST(2 AS DOUBLE)"),
)


def _values_sql(source: str, quarter: str = "quarter") -> str:
    """Formulas written out over the pivoted series."""
    rows = " UNION ALL ".join(
        f"SELECT entity, year, quarter, qidx, '{m}' AS metric, '{s}' AS sheet, '{t}' AS table_name, "
        f"{e.format(quarter=quarter)} AS value FROM wide"
        for m, s, t, e in _SQL_FORMULAS
    )
    return f"""
wide AS (
  SELECT entity, year, quarter, qidx,
    max(CASE WHEN item = 'BS_1' THEN value END) AS bs_1, max(CASE WHEN item = 'IS_1' THEN value END) AS is_1,
    max(CASE WHEN item = 'IS_2' THEN value END) AS is_2, max(CASE WHEN item = 'NOTES_1' THEN value END) AS notes_1,
    max(CASE WHEN item = 'BS_1' THEN avg END) AS avg_bs_1, max(CASE WHEN item = 'BS_1' THEN roll5 END) AS roll5_bs_1,
    max(CASE WHEN item = 'IS_1' THEN roll4 END) AS roll4_is_1
  FROM {source} GROUP BY entity, year, quarter, qidx),
vals AS ({rows})"""


_DERIVED_SQL = f"{MERGED_SQL}, {groups_sql('merged')}, {series_sql('grouped', semi=SEMI_SQL)}, {_values_sql('derived')}"
_CUSTOMER_SQL = f"""{SPARSE_SQL}, {ytd_sql('sparse')},
counts AS (
  SELECT c_mktsegment AS grp, count(*) AS n FROM customer
  WHERE c_custkey IN (SELECT entity FROM ytd) GROUP BY 1),
grouped AS (
  SELECT CAST(entity AS VARCHAR) AS entity, item, year, quarter, qidx, value FROM ytd
  UNION ALL
  SELECT 'BQ ' || c.n || ' ' || c.grp, y.item, y.year, y.quarter, y.qidx, avg(y.value)
  FROM ytd y JOIN customer ON y.entity = c_custkey JOIN counts c ON c.grp = c_mktsegment
  GROUP BY c.n, c.grp, y.item, y.year, y.quarter, y.qidx),
{series_sql('grouped')}, {_values_sql('derived')}"""
_SPARSE_VALUES = f"{SPARSE_SQL}, {series_sql('sparse')}"


def _sparse_batch(spark, sf, formulas, annualise=False):
    """Formulas over customers x quarters."""
    panel = sparse(spark, sf)
    used = referenced_items(formulas)
    present = [i for i in used if i in ITEMS]
    values, _ = formula_batch(derive_series(panel, SPARSE_RULES), formulas, present, annualise)
    return values.select("entity", "qidx", "metric", r4("value").alias("value"))


def formula_eval(spark, sf):
    return _sparse_batch(spark, sf, [FORMULAS[2]])


def formula_annualise(spark, sf):
    return _sparse_batch(spark, sf, [FORMULAS[3]], annualise=True)


def formula_batch_all(spark, sf):
    return _sparse_batch(spark, sf, FORMULAS)


def _nation_metrics(spark, sf, published=None):
    facts = land(reports_by_period(spark, sf), scratch_path(spark, "facts"))
    members = membership_of(facts, {"G1": G1, "G2": G2, "ALL": EVERYONE})
    return build_metrics(facts, members, GROUPS, FORMULAS, DENSE_RULES, items=ITEMS, published=published)


def flagship(spark, sf):
    """Three report frequencies to metric values of nations and groups."""
    return _nation_metrics(spark, sf).values.select(
        "entity", "year", "quarter", "metric", r4("value").alias("value")
    )


def formula_publish(spark, sf):
    published = _nation_metrics(spark, sf, (G1 + G2, EVERYONE)).values
    return publish(published, FORMULAS).withColumn("value", r4("value"))


def formula_wide(spark, sf):
    wide = wide_metric(_nation_metrics(spark, sf).values, "TTM yield", G1 + G2, EVERYONE)
    return wide.select("year", "quarter", *[r4(c).alias(c) for c in wide.columns[2:]])


def customer_metrics(spark, sf):
    """The same job where entities and group members grow with the data: customers and their market segments."""
    facts = land(tag_quarterly(sparse(spark, sf).drop("qidx")), scratch_path(spark, "customer-facts"))
    members = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("group"), F.col("c_custkey").alias("entity"))
    values = build_metrics(facts, members, SEGMENTS, FORMULAS, SPARSE_RULES, items=ITEMS).values
    return values.select("entity", "year", "quarter", "metric", r4("value").alias("value"))


#: One wrong formula per line number, written over the number of a part.
_WRONG = (
    ("avg_IS_1 / {0}", "unresolved"),  # no average for income items
    ("roll4_BS_1 + {0}", "unresolved"),  # no trailing year for balances
    ("BS_1 / sum(BS_1) over ()", "not scalar"),
    ("IS_1 * rand({0})", "not scalar"),
    ("sum(IS_1) / {0}", "unresolved"),
    ("IS_1 / BS_9{0}", "unresolved"),
    ("IS_1 * `rand`({0})", "not scalar"),
    ("IS_1 + rand /* x */ ({0})", "not scalar"),
    ("year(`now`()) + {0}", "not scalar"),
    ("IS_1 * /* rand() BS_9 */ {0}", None),
    ("IS_1 / {0}", None),
)


def formula_errors(spark, sf):
    """Formulas of all brands, most of them wrong in some way, checked over the customer panel."""
    brands = table(spark, sf, "part").groupBy("p_brand").agg(F.min("p_size").cast("string").alias("n"))
    texts = [F.replace(F.lit(text), F.lit("{0}"), F.col("n")) for text, _ in _WRONG]
    named = [F.struct(F.concat_ws(" ", "p_brand", F.lit(i)).alias("metric"), t.alias("formula")) for i, t in enumerate(texts)]
    # cleaning drops an apostrophe, so this is the table of the last, right formula
    named.append(F.struct(F.concat("p_brand", F.lit(f" {len(texts) - 1}'")).alias("metric"), F.lit("1").alias("formula")))
    rows = brands.select(F.inline(F.array(*named))).orderBy("metric").select("metric", "formula", F.lit("").alias("sheet"))
    formulas = formula_list(rows)
    panel = derive_series(sparse(spark, sf), SPARSE_RULES)
    _, errors = formula_batch(panel, formulas, [i for i in referenced_items(formulas) if i in ITEMS], rules=SPARSE_RULES)
    return errors.select("metric", "formula", "reason")


def formula_refs(spark, sf):
    """References of a formula table that was written as CSV and read back."""
    path = scratch_path(spark, "formulas")
    headed = part_formulas(spark, sf).select(*[F.col(c).alias(h) for h, c in FORMULA_HEADERS.items()])
    headed.write.option("header", True).option("escape", '"').csv(path)
    return L.formula_references(read_formulas(spark, path))


def _references(spark, sf):
    return L.formula_references(part_formulas(spark, sf))


def join_dictionary(spark, sf):
    return L.with_labels(_references(spark, sf), supplier_dictionary(spark, sf))


def missing_definitions(spark, sf):
    return L.missing_definitions(_references(spark, sf), supplier_dictionary(spark, sf))


def formula_collapse(spark, sf):
    return L.collapse_definitions(join_dictionary(spark, sf))


def critical(spark, sf):
    return critical_items(part_formulas(spark, sf), rule_items(DENSE_RULES))


def _wide_names() -> list[str]:
    return [*G1, *G2, "NATION_22", "NATION_23", "NATION_24", "BQ 5 G1", "BQ 5 G2", "BQ 22 ALL", "Total 22 ALL"]


QUERIES = {
    "formula_errors": (
        formula_errors,
        """WITH brands AS (SELECT p_brand, CAST(min(p_size) AS VARCHAR) AS n FROM part GROUP BY p_brand),
        wrong(i, formula, reason) AS (VALUES """
        + ", ".join(f"({i}, '{text}', {repr(reason) if reason else 'NULL'})" for i, (text, reason) in enumerate(_WRONG))
        + """)
        SELECT p_brand || ' ' || i AS metric, replace(formula, '{0}', n) AS formula, reason FROM brands, wrong
        WHERE reason IS NOT NULL
        UNION ALL SELECT p_brand || ' """ + str(len(_WRONG) - 1) + """''', '1', 'table name' FROM brands""",
    ),
    "formula_eval": (
        formula_eval,
        f"""WITH {_SPARSE_VALUES}, {_values_sql('derived')}
        SELECT entity, qidx, metric, round(value, 4) AS value FROM vals WHERE metric = 'TTM yield'""",
    ),
    "formula_annualise": (
        formula_annualise,
        f"""WITH {_SPARSE_VALUES}, {_values_sql('derived', '1')}
        SELECT entity, qidx, metric, round(value, 4) AS value FROM vals WHERE metric = 'Annualised'""",
    ),
    "formula_batch": (
        formula_batch_all,
        f"""WITH {_SPARSE_VALUES}, {_values_sql('derived')}
        SELECT entity, qidx, metric, round(value, 4) AS value FROM vals""",
    ),
    "formula_publish": (
        formula_publish,
        f"""WITH {_DERIVED_SQL},
        shown AS (SELECT DISTINCT entity FROM vals WHERE entity NOT IN (SELECT entity FROM members)
                  OR entity IN (SELECT entity FROM members WHERE grp <> 'ALL')),
        cells AS (SELECT s.entity, p.year, p.quarter, m.metric, m.sheet, m.table_name FROM shown s
          CROSS JOIN (SELECT DISTINCT year, quarter FROM vals) p
          CROSS JOIN (SELECT DISTINCT metric, sheet, table_name FROM vals) m)
        SELECT c.sheet, c.table_name, strftime(make_date(c.year, c.quarter * 3 - 2, 1), '%Y-%m-%d') AS yq,
          c.entity AS name, round(v.value, 4) AS value
        FROM cells c LEFT JOIN vals v ON v.entity = c.entity AND v.year = c.year AND v.quarter = c.quarter
          AND v.metric = c.metric""",
    ),
    "formula_wide": (
        formula_wide,
        f"WITH {_DERIVED_SQL} SELECT year, quarter, "
        + ", ".join(f"round(max(CASE WHEN entity = '{n}' THEN value END), 4) AS \"{n}\"" for n in _wide_names())
        + " FROM vals WHERE metric = 'TTM yield' GROUP BY year, quarter",
    ),
    "metrics_flagship": (
        flagship,
        f"WITH {_DERIVED_SQL} SELECT entity, year, quarter, metric, round(value, 4) AS value FROM vals",
    ),
    "metrics_by_customer": (
        customer_metrics,
        f"WITH {_CUSTOMER_SQL} SELECT entity, year, quarter, metric, round(value, 4) AS value FROM vals",
    ),
    "formula_refs": (
        formula_refs,
        f"""WITH {FORMULAS_SQL} SELECT f.metric, f.formula, u.pos, u.item FROM formulas f
        LEFT JOIN used u ON f.metric = u.metric""",
    ),
    "join_dictionary": (
        join_dictionary,
        f"""WITH {FORMULAS_SQL} SELECT f.metric, f.formula, u.pos, u.item, d.label FROM formulas f
        LEFT JOIN used u ON f.metric = u.metric LEFT JOIN dict d ON u.item = d.item""",
    ),
    "anti_missing_defs": (
        missing_definitions,
        f"""WITH {FORMULAS_SQL} SELECT u.metric, u.formula, u.pos, u.item FROM used u
        WHERE u.item NOT IN (SELECT item FROM dict WHERE label IS NOT NULL)""",
    ),
    "formula_collapse": (
        formula_collapse,
        f"""WITH {FORMULAS_SQL} SELECT f.metric, f.formula,
          coalesce(string_agg(u.item || ':' || d.label, ' | ' ORDER BY u.pos), '') AS definition
        FROM formulas f LEFT JOIN used u ON f.metric = u.metric LEFT JOIN dict d ON u.item = d.item GROUP BY 1, 2""",
    ),
    "critical_items": (
        critical,
        f"""WITH {FORMULAS_SQL} SELECT DISTINCT item FROM used UNION SELECT 'CF_47' UNION SELECT 'CF_48'
        UNION SELECT 'NOTES_' || i FROM range(1, 120) r(i)""",
    ),
}
