import pytest
from pyspark.sql import functions as F

from quarterdeck.config import Formula, ItemRules, PeerGroup
from quarterdeck.operators import lineage as L
from quarterdeck.operators.audit import critical_items
from quarterdeck.operators.formulas import (
    check_formulas,
    formula_batch,
    panel_columns,
    referenced_items,
)
from quarterdeck.operators.groups import membership_of
from quarterdeck.operators.panel import QUARTERLY
from quarterdeck.operators.ranking import rank_latest_period, wide_metric
from quarterdeck.operators.series import derive_series
from quarterdeck.plans.metrics import build_metrics, publish
from tests.helpers import facts, panel, rows

RULES = ItemRules()


def test_columns_and_items():
    f = [Formula("a", "roll4_IS_3 / roll5_BS_1 + avg_BS_1 - abs(NOTES_2) * quarter")]
    assert panel_columns(f) == {
        "roll4_IS_3": ("IS_3", "roll4"), "roll5_BS_1": ("BS_1", "roll5"), "avg_BS_1": ("BS_1", "avg"), "NOTES_2": ("NOTES_2", "value"),
    }
    assert referenced_items(f) == ["BS_1", "IS_3", "NOTES_2"]


def _batch(spark, formulas, annualise=False):
    data = panel(spark, [("A", "IS_1", "2023_q2", 6), ("A", "BS_1", "2023_q2", 0), ("A", "IS_1", "2023_q3", None), ("A", "CF_1", "2023_q1", 1)])
    return formula_batch(derive_series(data, RULES), formulas, ["IS_1", "BS_1"], annualise)


def test_errors_stay_with_their_formula(spark):
    values, errors = _batch(spark, [
        Formula("good", "IS_1 * 2"), Formula("unknown", "IS_1 / BS_999"), Formula("syntax", "IS_1 +"), Formula("total", "sum(IS_1)"),
        Formula("zero", "IS_1 / BS_1"), Formula("constant", "1 + 1"),
    ])
    assert {r["metric"] for r in errors.collect()} == {"unknown", "syntax", "total"}
    out = {(r["metric"], r["quarter"]): r["value"] for r in values.collect()}
    assert out["good", 2] == 12.0 and out["good", 3] is None
    assert out["zero", 2] is None  # division by zero
    assert out["constant", 1] == 2.0  # a period without any referenced item keeps its row
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_undefined_series_windows_and_names_are_errors(spark):
    values, errors = _batch(spark, [
        Formula("avg flow", "avg_IS_1"), Formula("ttm stock", "roll4_BS_1 * 2"), Formula("share", "BS_1 / sum(BS_1) OVER ()"),
        Formula("chance", "IS_1 * rand()"), Formula("query", "(select 1)"), Formula("Tổng tài sản", "BS_1"), Formula("Tong tai san", "IS_1"),
        Formula("', '", "IS_1"), Formula("text", "if('over (select rand()' = 'x', 1, 2)"), Formula("good", "greatest(avg_BS_1, IS_1)"),
    ])
    reasons = {r["metric"]: r["reason"] for r in errors.collect()}
    assert reasons == {
        "avg flow": "unresolved", "ttm stock": "unresolved", "share": "not scalar", "chance": "not scalar", "query": "not scalar",
        "Tong tai san": "table name", **({"', '": "table name"} if "', '" in reasons else {}),
    }
    assert {r["metric"] for r in values.select("metric").distinct().collect()} >= {"Tổng tài sản", "text", "good"}


def test_formulas_in_groups(spark, monkeypatch):
    from quarterdeck.operators import formulas

    monkeypatch.setattr(formulas, "BLOCK_FORMULAS", 2)
    values, _ = _batch(spark, [Formula(f"m{k}", f"IS_1 + {k}") for k in range(5)])
    assert {(r["metric"], r["value"]) for r in values.collect() if r["quarter"] == 2} == {(f"m{k}", 6.0 + k) for k in range(5)}


HIDDEN = [
    "`rand`(3)", "rand /* x */ (1)", "`now`()", "IS_1 + uniform(1, 5)", "unix_timestamp()", "year(curdate())", "randstr(3)", "uuid()",
    "reflect('java.lang.Math', 'random')", "try_reflect('java.lang.Math', 'random')", "length(current_user())", "length(user)",
    "length(version())", "raise_error('x')", "if(assert_true(true) is null, 1, 2)", "IS_1 in (select 1)", "if(exists(select 1), 1, 2)",
    "(/* x */ select 1)", "lag(IS_1) over (order by entity)", "transform(array(IS_1), x -> x + rand())[0]",
    "shuffle(array(1, 2))[0]", "monotonically_increasing_id()", "spark_partition_id()", "length(current_timezone())",
    "sum(IS_1) over (partition by `entity`)", "length(input_file_name())", "length(current_schema())", "plus_one_udf(IS_1)",
]


def test_no_spelling_hides_what_is_not_scalar(spark):
    spark.udf.register("plus_one_udf", lambda x: x and x + 1, "double")
    plain = [Formula(f"ok{k}", t) for k, t in enumerate(["IS_1 /* now() */ + 1", "if('rand(3)' = 'x', 1, IS_1)", "`IS_1`", "round(IS_1 / 3, 2)"])]
    good, failed = check_formulas(spark, ["IS_1"], plain + [Formula(f"m{k}", t) for k, t in enumerate(HIDDEN)])
    assert {f.metric for f in good} == {f.metric for f in plain}
    assert {(f.text, reason) for f, reason, _ in failed} == {(t, "not scalar") for t in HIDDEN}


def test_brackets_and_comments(spark):
    texts = {"IS_1) + (2": False, "1) AS DOUBLE), CAST((2": False, "IS_1 -- note": True, "IS_1 /* (": False, "')' = ')' or true": True}
    good, _ = check_formulas(spark, ["IS_1"], [Formula(f"m{k}", t) for k, t in enumerate(texts)])
    assert [f.text for f in good] == [t for t, fine in texts.items() if fine]


def test_blocks_are_bounded(monkeypatch):
    from quarterdeck.operators import formulas

    monkeypatch.setattr(formulas, "BLOCK_FORMULAS", 3)
    monkeypatch.setattr(formulas, "BLOCK_COLUMNS", 4)
    texts = ["BS_1 + BS_2", "BS_2 + BS_3", "1", "BS_1", "BS_4 + BS_5 + BS_6 + BS_7 + BS_8", "BS_1 /* BS_9 */"]
    blocks = formulas.in_blocks([Formula(f"m{k}", t) for k, t in enumerate(texts)], {f"BS_{k}" for k in range(9)})
    assert [[f.metric for f in b.formulas] for b in blocks] == [["m0", "m1", "m2"], ["m3"], ["m4"], ["m5"]]
    assert blocks[0].columns == ["BS_1", "BS_2", "BS_3"]


def test_thousands_of_formulas(spark):
    items = [f"BS_{k}" for k in range(1, 2001)]
    cells = spark.range(6000).select(
        F.lit("A").alias("entity"), F.format_string("BS_%d", F.expr("id div 3 + 1")).alias("item"), F.lit(2023).alias("year"),
        (F.col("id") % 3 + 1).cast("int").alias("quarter"), (F.col("id") % 3 + 8093).cast("int").alias("qidx"),
        F.expr("cast((id div 3 + 1) * 10 + id % 3 as double)").alias("value"),
    )
    formulas = [Formula(f"m{k}", f"BS_{k % 2000 + 1} + BS_{(k * 7) % 2000 + 1} * {k}") for k in range(5000)]
    values, errors = formula_batch(cells, formulas, items)
    assert errors.count() == 0
    got = {(r["metric"], r["quarter"]): r["value"] for r in values.collect()}
    cell = lambda n, q: n * 10.0 + q - 1
    assert len(got) == 15000
    assert all(got[f"m{k}", q] == cell(k % 2000 + 1, q) + cell((k * 7) % 2000 + 1, q) * k for k in range(5000) for q in (1, 2, 3))


def test_annualise_binds_quarter_to_one(spark):
    formula = [Formula("a", "IS_1 / quarter * 4")]
    plain, annual = (_batch(spark, formula, flag)[0] for flag in (False, True))
    assert [r["value"] for r in plain.collect() if r["quarter"] == 2] == [12.0]
    assert [(r["quarter"], r["value"]) for r in annual.collect() if r["quarter"] == 2] == [(2, 24.0)]


def test_metric_names_must_differ(spark):
    with pytest.raises(ValueError, match="unique"):
        check_formulas(spark, ["IS_1"], [Formula("a", "IS_1"), Formula("a", "IS_1")])


def _values(spark):
    data = [("A", 8, 1.0), ("B", 8, None), ("C", 7, 9.0), ("D", 8, float("nan")), ("E", 8, 5.0), ("X", 8, 100.0)]
    return spark.createDataFrame([(e, q, "m", v) for e, q, v in data], "entity string, qidx int, metric string, value double")


def test_rank_nulls_first_then_nan_then_descending(spark):
    expected = ["B", "C", "D", "E", "A"]  # C has nothing at the latest period
    listed = rank_latest_period(_values(spark), ["A", "B", "C", "D", "E"])
    assert [r["entity"] for r in listed.orderBy("latest_rank").collect()] == expected
    table = spark.createDataFrame([(e,) for e in "ABCDE"], "entity string")
    ranged = rank_latest_period(_values(spark), table)
    assert [r["entity"] for r in ranged.orderBy("latest_rank").collect()] == expected


def test_ranking_reads_the_values_once(spark, tmp_path):
    path = str(tmp_path / "values")
    _values(spark).write.parquet(path)
    stored = spark.read.parquet(path)
    ranked = rank_latest_period(stored, ["A", "B", "C"])
    plan = ranked._jdf.queryExecution().toString()
    assert "parquet" not in plan.split("== Physical Plan ==")[1]  # the keys were aggregated when they were checkpointed
    assert [(r["entity"], r["value"]) for r in ranked.orderBy("latest_rank").collect()] == [("B", None), ("C", None), ("A", 1.0)]
    fixed = rank_latest_period(stored, ["A", "C"], F.lit(7))
    assert [(r["entity"], r["value"]) for r in fixed.orderBy("latest_rank").collect()] == [("A", None), ("C", 9.0)]


def test_wide_metric_orders_peers_then_groups(spark):
    values = spark.createDataFrame(
        [(e, 2023, q, 8092 + q, "m", v) for e, q, v in
         [("A", 1, 1.0), ("A", 2, 2.0), ("B", 2, 7.0), ("C", 1, 3.0), ("Mean", 2, 4.5), ("C", 3, 0.0)]],
        "entity string, year int, quarter int, qidx int, metric string, value double",
    )
    wide = wide_metric(values, "m", ["A", "B"], ["A", "B", "C"])
    assert wide.columns == ["year", "quarter", "A", "B", "Mean"]  # both NULL at the latest period: by name
    assert [tuple(r)[1:] for r in wide.collect()] == [(1, 1.0, None, None), (2, 2.0, 7.0, 4.5), (3, None, None, None)]


def _metrics(spark, **options):
    reports = facts(spark, [
        (e, i, f"{y}_q{q}", v * q) for e, v in (("A", 1), ("B", 3), ("C", 5)) for i in ("IS_1", "BS_1", "CF_9")
        for y in (2022, 2023) for q in (1, 2, 3) if not (e == "B" and y == 2023 and q == 3)
    ]).withColumn("freq", F.lit(QUARTERLY))
    members = membership_of(reports, {"all": ["A", "B", "C"]})
    formulas = [Formula("Tổng tài sản", "BS_1", "S1"), Formula("Ratio", "IS_1 / BS_1", "S2"), Formula("Bad", "XX_1", "S3")]
    groups = (PeerGroup("all", "BQ %d", "Sum %d"),)
    return build_metrics(reports, members, groups, formulas, RULES, **options), formulas


def test_group_ratio_is_the_ratio_of_means(spark):
    metrics, _ = _metrics(spark)
    out = {(r["entity"], r["metric"], r["year"], r["quarter"]): r["value"] for r in metrics.values.collect()}
    assert out["BQ 3", "Tổng tài sản", 2022, 2] == 6.0
    assert out["BQ 3", "Ratio", 2022, 2] == (9 / 6)  # mean YTD 9 over mean balance 6
    assert out["Sum 3", "Tổng tài sản", 2023, 3] == 18.0
    assert [r["metric"] for r in metrics.errors.collect()] == ["Bad"]


def test_published_tables_are_filled_and_named(spark):
    metrics, formulas = _metrics(spark, published=(["A", "B"], ["A", "B", "C"]))
    out = publish(metrics.values, formulas).collect()
    assert {r["name"] for r in out} == {"A", "B", "BQ 3", "Sum 3"}  # C is in the full list but not ranked
    assert {(r["sheet"], r["table_name"]) for r in out} == {("S1", "tong_tai_san"), ("S2", "ratio")}
    assert len(out) == 4 * 6 * 2
    hole = [r["value"] for r in out if r["name"] == "B" and r["yq"] == "2023-07-01"]
    assert hole == [None, None]


def test_lineage(spark):
    formulas = spark.createDataFrame(
        [("m1", "avg_BS_2 / IS_1 + BS_2"), ("m2", "1 + 1"), ("m3", "CF_7 + NOTES_1")], "metric string, formula string"
    )
    dictionary = spark.createDataFrame(
        [("BS_2", "'=Assets"), ("IS_1", "Income"), ("NOTES_1", None)], "item string, label string"
    )
    refs = L.formula_references(formulas)
    assert [tuple(r) for r in refs.orderBy("metric", "pos").select("metric", "pos", "item").collect()] == [
        ("m1", 0, "BS_2"), ("m1", 1, "IS_1"), ("m2", None, None), ("m3", 0, "CF_7"), ("m3", 1, "NOTES_1"),
    ]
    assert {r["item"] for r in L.missing_definitions(refs, dictionary).collect()} == {"CF_7", "NOTES_1"}
    collapsed = L.collapse_definitions(L.with_labels(refs, dictionary))
    assert rows(collapsed.select("metric", "definition")) == [("m1", "BS_2:=Assets | IS_1:Income"), ("m2", ""), ("m3", "")]
    assert {r[0] for r in critical_items(formulas, ["CF_47"]).collect()} == {"BS_2", "IS_1", "CF_7", "NOTES_1", "CF_47"}
