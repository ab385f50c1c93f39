from quarterdeck.operators import audit as A
from tests.helpers import rows


def _structure(spark, data):
    return spark.createDataFrame(data, "entity string, sheet string, file string, item string, label string")


DRIFTED = [
    ("A", "BS", "f1", "BS_1", "Cash"), ("A", "BS", "f1", "BS_2", "Loans"), ("A", "BS", "f2", "BS_1", None),
    ("A", "BS", "f2", "BS_2", "Cash"), ("A", "BS", "f2", "BS_3", " "), ("B", "BS", "f1", "BS_1", " "), ("B", "BS", "f1", "BS_2", " "),
]


def test_row_counts_compare_files_of_one_entity(spark):
    assert rows(A.row_count_diff(_structure(spark, DRIFTED)).select("entity", "file", "row_count")) == [("A", "f1", 2), ("A", "f2", 3)]


def test_null_is_a_label_variant(spark):
    out = {r["item"]: r for r in A.label_drift(_structure(spark, DRIFTED)).collect()}
    assert set(out) == {"BS_1", "BS_2"}
    assert out["BS_1"]["n_variants"] == 2 and out["BS_1"]["label_variants"] == [None, "Cash"]
    assert out["BS_2"]["files"] == ["f1", "f2"]


def test_blank_labels_do_not_count_as_item_drift(spark):
    out = A.item_drift(_structure(spark, DRIFTED)).collect()
    assert [(r["label"], r["item_variants"]) for r in out] == [("Cash", ["BS_1", "BS_2"])]


def test_report_counts_and_gate(spark):
    structure = _structure(spark, DRIFTED)
    report = A.audit_report(structure)
    assert rows(A.audit_counts(report)) == [("chi_tieu_drift", 2), ("row_count_diff", 2), ("rowid_drift", 1)]
    gate = A.audit_gate(report, A.data_dictionary(structure)).first()
    assert (gate["n_blocking"], gate["publish"]) == (4, False)
    critical = spark.createDataFrame([("BS_2",), ("BS_2",)], "item string")
    assert [r["item"] for r in A.critical_hits(report, critical).collect()] == ["BS_2"]


def test_clean_structure_may_be_published(spark):
    structure = _structure(spark, [("A", "BS", f, "BS_1", "Cash") for f in ("f1", "f2")] + [("B", "IS", "f1", "IS_10", "x"), ("B", "IS", "f1", "IS_9", "y")])
    dictionary = A.data_dictionary(structure)
    assert A.audit_gate(A.audit_report(structure), dictionary).first()["publish"]
    ordered = dictionary.orderBy("sheet_pos", "num").collect()
    assert [r["item"] for r in ordered] == ["BS_1", "IS_9", "IS_10"]


def test_folders_are_checked_separately(spark):
    from pyspark.sql import functions as F

    one = _structure(spark, [("A", "BS", "f1", "BS_1", "Cash")]).withColumn("folder", F.lit("q"))
    two = _structure(spark, [("A", "BS", "f1", "BS_1", "Money")]).withColumn("folder", F.lit("y"))
    assert A.audit_report(one.unionByName(two)).count() == 0
