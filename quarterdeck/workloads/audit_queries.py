"""Structure audit queries over `lineitem`, with lists as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.operators import audit as A
from quarterdeck.sinks.writers import join_lists
from quarterdeck.workloads.panels import STRUCTURE_SQL, structure, table
from quarterdeck.workloads.scans import FAULTS, rejected_files


def row_counts(spark, sf):
    return A.row_count_diff(structure(spark, sf))


def label_drift(spark, sf):
    return join_lists(A.label_drift(structure(spark, sf)))


def item_drift(spark, sf):
    return join_lists(A.item_drift(structure(spark, sf)))


def report(spark, sf):
    return join_lists(A.audit_report(structure(spark, sf)))


def counts(spark, sf):
    return A.audit_counts(A.audit_report(structure(spark, sf)))


def _critical(spark, sf):
    """Items that a formula table refers to: each order priority's formula sets two returned lines against another."""
    number = F.col("o_orderpriority").substr(1, 1)
    text = F.concat(F.lit("R_"), number, F.lit(" / (N_"), number, F.lit(" + A_1)"))
    formulas = table(spark, sf, "orders").select("o_orderpriority", text.alias("formula")).distinct()
    return A.critical_items(formulas, ["A_7"])


def critical_hits(spark, sf):
    return join_lists(A.critical_hits(A.audit_report(structure(spark, sf)), _critical(spark, sf)))


def dictionary(spark, sf):
    return A.data_dictionary(structure(spark, sf), ["A", "N", "R"])


def gate(spark, sf):
    """The gate over the line-item structure, beside what is rejected of the workbooks of all suppliers."""
    rows = structure(spark, sf)
    return A.audit_gate(A.audit_report(rows), A.data_dictionary(rows, ["A", "N", "R"]), rejected_files(spark, sf))


REPORT_SQL = f"""{STRUCTURE_SQL},
lengths AS (SELECT entity, sheet, file, max(num) AS row_count FROM structure GROUP BY 1, 2, 3),
row_counts AS (
  SELECT entity, sheet, file, row_count FROM lengths l
  WHERE (SELECT count(DISTINCT row_count) FROM lengths o WHERE o.entity = l.entity AND o.sheet = l.sheet) > 1),
label_drift AS (
  SELECT entity, sheet, item, count(DISTINCT coalesce(label, '<none>')) AS n_variants,
    string_agg(DISTINCT label, ' | ' ORDER BY label) AS label_variants,
    string_agg(DISTINCT file, ' | ' ORDER BY file) AS files
  FROM structure GROUP BY 1, 2, 3 HAVING count(DISTINCT coalesce(label, '<none>')) > 1),
item_drift AS (
  SELECT entity, sheet, label, count(DISTINCT item) AS n_variants,
    string_agg(DISTINCT item, ' | ' ORDER BY item) AS item_variants,
    string_agg(DISTINCT file, ' | ' ORDER BY file) AS files
  FROM structure WHERE label IS NOT NULL AND trim(label) <> '' GROUP BY 1, 2, 3 HAVING count(DISTINCT item) > 1),
report AS (
  SELECT entity, sheet, file, CAST(row_count AS BIGINT) AS row_count, 'row_count_diff' AS check_type, NULL AS item, NULL AS n_variants,
    NULL AS label_variants, NULL AS files, NULL AS label, NULL AS item_variants FROM row_counts
  UNION ALL SELECT entity, sheet, NULL, NULL, 'chi_tieu_drift', item, n_variants, label_variants, files, NULL, NULL
  FROM label_drift
  UNION ALL SELECT entity, sheet, NULL, NULL, 'rowid_drift', NULL, n_variants, NULL, files, label, item_variants
  FROM item_drift)"""

# concat_ws turns a missing list into an empty text
_REPORT_COLUMNS = """entity, sheet, file, row_count, check_type, item, n_variants,
  coalesce(label_variants, '') AS label_variants, coalesce(files, '') AS files, label,
  coalesce(item_variants, '') AS item_variants"""

QUERIES = {
    "audit_row_count": (
        row_counts,
        f"WITH {REPORT_SQL} SELECT entity, sheet, file, CAST(row_count AS BIGINT) AS row_count, 'row_count_diff' AS check_type FROM row_counts",
    ),
    "audit_label_drift": (
        label_drift,
        f"WITH {REPORT_SQL} SELECT *, 'chi_tieu_drift' AS check_type FROM label_drift",
    ),
    "audit_rowid_drift": (
        item_drift,
        f"WITH {REPORT_SQL} SELECT *, 'rowid_drift' AS check_type FROM item_drift",
    ),
    "audit_report": (report, f"WITH {REPORT_SQL} SELECT {_REPORT_COLUMNS} FROM report"),
    "audit_counts": (counts, f"WITH {REPORT_SQL} SELECT check_type, count(*) AS n FROM report GROUP BY 1"),
    "semi_critical_hits": (
        critical_hits,
        f"""WITH {REPORT_SQL} SELECT {_REPORT_COLUMNS} FROM report
        WHERE item IN (SELECT 'R_' || o_orderpriority[1] FROM orders UNION SELECT 'N_' || o_orderpriority[1] FROM orders
                       UNION SELECT 'A_1' UNION SELECT 'A_7')""",
    ),
    "data_dict": (
        dictionary,
        f"""WITH {STRUCTURE_SQL} SELECT DISTINCT item, label,
          CASE sheet WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS sheet_pos, CAST(num AS BIGINT) AS num FROM structure""",
    ),
    "audit_gate": (
        gate,
        f"""WITH {REPORT_SQL},
        d AS (SELECT DISTINCT item, label FROM structure),
        g AS (SELECT (SELECT count(*) FROM report WHERE check_type IN ('chi_tieu_drift', 'row_count_diff')) AS n_blocking,
          (SELECT count(*) FROM d WHERE item IN (SELECT item FROM d GROUP BY item HAVING count(*) > 1)) AS n_repeated)
        SELECT n_blocking, n_repeated,
          (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_suppkey % 20 IN ({', '.join(str(k) for k, *_ in FAULTS)})) AS n_rejected,
          n_blocking = 0 AND n_repeated = 0 AS publish FROM g""",
    ),
}
