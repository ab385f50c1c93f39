"""Year to date, series and group queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.operators import groups as G
from quarterdeck.operators import series as S
from quarterdeck.operators.panel import QUARTERLY, clashing_cells, merge_panel, ytd_cumulate
from quarterdeck.operators.ranking import rank_latest_period
from quarterdeck.plans.metrics import enrich_panel
from quarterdeck.plans.jobs import monthly_job
from quarterdeck.plans.reports import single_entity_ytd
from quarterdeck.session import land, scratch_path
from quarterdeck.workloads.scans import put_file, workbook_bytes, written_once
from quarterdeck.workloads.panels import (
    COMPLETE_DENSE_SQL,
    COMPLETE_SQL,
    DENSE_RULES,
    DENSE_SQL,
    G1,
    G2,
    GROUPS,
    MEMBERS_SQL,
    MERGED_SQL,
    SEMI_SQL,
    SPARSE_RULES,
    SPARSE_SQL,
    cents,
    complete,
    complete_dense,
    dense,
    groups_sql,
    nation_groups,
    r4,
    reports_by_period,
    series_sql,
    sparse,
    table,
    ytd_sql,
)


def _rounded(df, *names):
    return df.withColumns({n: r4(n) for n in names})


def _to_cent_parts(df, *names):
    """Means of amounts in cents, to three places: of a large total a double does not hold four, and at two the
    means of few members and quarters (fortieths) end in exact halves."""
    return df.withColumns({n: F.round(n, 3) for n in names})


def _sparse_facts(spark, sf):
    return sparse(spark, sf).drop("qidx")


def ytd(spark, sf):
    return _rounded(ytd_cumulate(_sparse_facts(spark, sf), SPARSE_RULES), "value")


def one_entity_ytd(spark, sf):
    return single_entity_ytd(dense(spark, sf).drop("qidx"), "NATION_7", 1999, 3, DENSE_RULES).select(
        "entity", "item", "year", "quarter", r4("value").alias("value")
    )


def running_sum(spark, sf):
    total, points = S.running_sum(SPARSE_RULES)
    return sparse(spark, sf).select("entity", "item", "qidx", total.alias("total"), points.alias("points"))


def _stock(spark, sf):
    return sparse(spark, sf).filter(F.col("item").isin("BS_1", "NOTES_1"))


def avg_balance(spark, sf):
    out = S.add_average_balance(_stock(spark, sf), SPARSE_RULES)
    return out.select("entity", "item", "qidx", r4("avg").alias("avg"))


def roll5_mean(spark, sf):
    out = S.add_five_point_mean(_stock(spark, sf), SPARSE_RULES)
    return out.select("entity", "item", "qidx", r4("roll5").alias("roll5"))


def roll4_ttm(spark, sf):
    rows = sparse(spark, sf).filter(F.col("item").startswith("IS_"))
    out = S.add_trailing_year(rows, SPARSE_RULES)
    return out.select("entity", "item", "qidx", r4("roll4").alias("roll4"))


def avg_two_point(spark, sf):
    """Balance-sheet items and notes; the entity's periods are those of all its items."""
    out = S.add_two_point_average(sparse(spark, sf))
    return out.filter(F.col("item").isin("BS_1", "NOTES_1")).select("entity", "item", "qidx", r4("avg").alias("avg"))


def semi_annual_points(spark, sf):
    return dense(spark, sf).select(
        "entity",
        "item",
        "qidx",
        S.expected_points(DENSE_RULES).alias("n_pts"),
        S.is_valid_quarter(DENSE_RULES).alias("valid"),
    )


def group_mean(spark, sf):
    panel = complete_dense(spark, sf)
    return _to_cent_parts(G.group_mean(panel, nation_groups(panel)), "value")


def group_sum(spark, sf):
    panel = complete_dense(spark, sf)
    return _to_cent_parts(G.group_sum(panel, nation_groups(panel)), "value")


def group_member_count(spark, sf):
    panel = complete_dense(spark, sf)
    return G.group_member_count(G.present_entities(panel), nation_groups(panel))


def summarize(spark, sf):
    panel = land(complete_dense(spark, sf), scratch_path(spark, "panel"))
    return _to_cent_parts(G.summarize_by_group(panel, nation_groups(panel), GROUPS), "value")


def totals_two_point(spark, sf):
    """The panel with group totals alone and two-point averages."""
    panel = land(complete_dense(spark, sf), scratch_path(spark, "panel"))
    out = enrich_panel(panel, nation_groups(panel), GROUPS, SPARSE_RULES, means=False, two_point=True)
    return _to_cent_parts(out.select("entity", "item", "year", "quarter", "qidx", "value", "avg"), "value", "avg")


def clashes(spark, sf):
    """Orders of one customer, priority and quarter as cells: several of them hold different amounts."""
    orders = table(spark, sf, "orders").select(
        F.lit(QUARTERLY).alias("freq"), F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("item"),
        F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), cents("o_totalprice").cast("double").alias("value"),
    )
    return clashing_cells(orders)


def customer_groups(spark, sf):
    """Groups whose membership is a table that grows with the data: customers by market segment."""
    members = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("group"), F.col("c_custkey").alias("entity"))
    return _to_cent_parts(G.group_mean(complete(spark, sf), members), "value")


def rank_nations(spark, sf):
    """Named peers by their value at the latest period."""
    values = complete_dense(spark, sf).select("entity", "qidx", F.col("item").alias("metric"), "value")
    return _rounded(rank_latest_period(values, G1 + G2), "value")


def rank_customers(spark, sf):
    """The same with a table of peers: every customer, ranked with range partitioning."""
    values = complete(spark, sf).select("entity", "qidx", F.col("item").alias("metric"), "value")
    peers = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"))
    return _rounded(rank_latest_period(values, peers), "value")


def manual_workbooks(spark, sf) -> str:
    """A workbook per year on disk, its sheets M2 and CREDIT being plain tables of a day's orders by priority."""

    def build(folder: str) -> None:
        def put(pdf):
            rows = pdf[["item", "year", "month", "day", "amount"]].values.tolist()
            sheet = [["Item", "Year", "Month", "Day", "Số dư"], *rows]
            content = workbook_bytes({"M2": sheet, "Notes": [["not read"]], "CREDIT": sheet})
            return pdf.assign(path=put_file(folder, f"{pdf['year'].iloc[0]}.xlsx", content))[["path"]].head(1)

        day = F.col("o_orderdate")
        orders = table(spark, sf, "orders").groupBy(
            F.col("o_orderpriority").alias("item"), F.year(day).alias("year"), F.month(day).alias("month"), F.day(day).alias("day")
        )
        days = orders.agg(F.sum(cents("o_totalprice")).alias("amount"))
        days.groupBy("year").applyInPandas(put, "path string").write.format("noop").mode("overwrite").save()

    return written_once("manual", spark, sf, build)


def monthly_urgent(spark, sf):
    folder = manual_workbooks(spark, sf)
    urgent = monthly_job(spark, folder, "M2", F.col("item").contains("URGENT"), "so_du", "urgent")
    low = monthly_job(spark, folder, "CREDIT", F.col("item") == "5-LOW", "so_du", "low")
    return urgent.join(low, "ym", "full").select("ym", *(F.col(c).cast("bigint").alias(c) for c in ("urgent", "low")))


def merged(spark, sf):
    return _rounded(merge_panel(reports_by_period(spark, sf), DENSE_RULES), "value")


def enriched(spark, sf):
    panel = land(merge_panel(reports_by_period(spark, sf), DENSE_RULES), scratch_path(spark, "panel"))
    out = enrich_panel(panel, nation_groups(panel), GROUPS, DENSE_RULES)
    return _to_cent_parts(out, "value", "avg", "roll5", "roll4")


def _series(*names: str) -> str:
    return series_sql("sparse", series=names)


QUERIES = {
    "ytd_cumulate": (
        ytd,
        f"WITH {SPARSE_SQL}, {ytd_sql('sparse')} SELECT entity, item, year, quarter, qidx, round(value, 4) AS value FROM ytd",
    ),
    "single_entity_ytd": (
        one_entity_ytd,
        f"""WITH {DENSE_SQL}, {ytd_sql('dense')}
        SELECT entity, item, year, quarter, round(value, 4) AS value FROM ytd
        WHERE entity = 'NATION_7' AND year = 1999 AND quarter =
          (SELECT max(quarter) FROM ytd WHERE entity = 'NATION_7' AND year = 1999 AND quarter <= 3)""",
    ),
    "win_running_sum": (
        running_sum,
        f"WITH {SPARSE_SQL}, {_series("avg")} SELECT entity, item, qidx, total, points FROM derived_sofar",
    ),
    "avg_balance": (
        avg_balance,
        f"""WITH {SPARSE_SQL}, {_series("avg")} SELECT entity, item, qidx, round(avg, 4) AS avg FROM derived
            WHERE item IN ('BS_1', 'NOTES_1')""",
    ),
    "roll5_mean": (
        roll5_mean,
        f"""WITH {SPARSE_SQL}, {_series("roll5")} SELECT entity, item, qidx, round(roll5, 4) AS roll5 FROM derived
            WHERE item IN ('BS_1', 'NOTES_1')""",
    ),
    "roll4_ttm": (
        roll4_ttm,
        f"""WITH {SPARSE_SQL}, {_series("roll4")} SELECT entity, item, qidx, round(roll4, 4) AS roll4 FROM derived
            WHERE item LIKE 'IS%'""",
    ),
    "avg_two_point": (
        avg_two_point,
        f"""WITH {SPARSE_SQL},
        periods AS (SELECT entity, qidx, lag(qidx) OVER (PARTITION BY entity ORDER BY qidx) AS before
                    FROM (SELECT DISTINCT entity, qidx FROM sparse) d)
        SELECT p.entity, p.item, p.qidx, round((p.value + b.value) / 2, 4) AS avg
        FROM sparse p JOIN periods q ON p.entity = q.entity AND p.qidx = q.qidx
        LEFT JOIN sparse b ON b.entity = p.entity AND b.item = p.item AND b.qidx = q.before
        WHERE p.item IN ('BS_1', 'NOTES_1')""",
    ),
    "semi_annual_points": (
        semi_annual_points,
        f"""WITH {DENSE_SQL} SELECT entity, item, qidx,
          CASE WHEN {SEMI_SQL.format('d')} THEN quarter // 2 ELSE quarter END AS n_pts,
          NOT ({SEMI_SQL.format('d')} AND quarter % 2 = 1) AS valid FROM dense d""",
    ),
    "group_mean": (
        group_mean,
        f"""WITH {COMPLETE_DENSE_SQL}, {MEMBERS_SQL}
        SELECT grp AS "group", year, quarter, qidx, item, round(avg(value), 3) AS value
        FROM dense d JOIN members m ON d.entity = m.entity GROUP BY 1, 2, 3, 4, 5""",
    ),
    "group_sum": (
        group_sum,
        f"""WITH {COMPLETE_DENSE_SQL}, {MEMBERS_SQL}
        SELECT grp AS "group", year, quarter, qidx, item, round(coalesce(sum(value), 0), 3) AS value
        FROM dense d JOIN members m ON d.entity = m.entity GROUP BY 1, 2, 3, 4, 5""",
    ),
    "group_member_count": (
        group_member_count,
        f"""WITH {COMPLETE_DENSE_SQL}, {MEMBERS_SQL} SELECT grp AS "group", count(DISTINCT d.entity) AS n_members
        FROM dense d JOIN members m ON d.entity = m.entity GROUP BY 1""",
    ),
    "summarize_by_group": (
        summarize,
        f"""WITH {COMPLETE_DENSE_SQL}, {groups_sql('dense')}
        SELECT entity, item, year, quarter, qidx, round(value, 3) AS value FROM grouped""",
    ),
    "enrich_options": (
        totals_two_point,
        f"""WITH {COMPLETE_DENSE_SQL}, {groups_sql('dense', means=False)},
        periods AS (SELECT entity, qidx, lag(qidx) OVER (PARTITION BY entity ORDER BY qidx) AS before
                    FROM (SELECT DISTINCT entity, qidx FROM grouped) d)
        SELECT p.entity, p.item, p.year, p.quarter, p.qidx, round(p.value, 3) AS value,
          CASE WHEN p.item LIKE '%BS%' OR p.item LIKE 'NOTES%' THEN round((p.value + b.value) / 2, 3) END AS avg
        FROM grouped p JOIN periods q ON p.entity = q.entity AND p.qidx = q.qidx
        LEFT JOIN grouped b ON b.entity = p.entity AND b.item = p.item AND b.qidx = q.before""",
    ),
    "panel_clashes": (
        clashes,
        """SELECT 'quarterly' AS freq, o_custkey AS entity, o_orderpriority AS item, CAST(year(o_orderdate) AS INT) AS year,
             CAST(quarter(o_orderdate) AS INT) AS quarter, CAST(min(round(o_totalprice * 100)) AS DOUBLE) AS smallest,
             CAST(max(round(o_totalprice * 100)) AS DOUBLE) AS largest
           FROM orders GROUP BY 1, 2, 3, 4, 5 HAVING min(round(o_totalprice * 100)) < max(round(o_totalprice * 100))""",
    ),
    "group_mean_by_segment": (
        customer_groups,
        f"""WITH {COMPLETE_SQL} SELECT c_mktsegment AS "group", year, quarter, qidx, item, round(avg(value), 3) AS value
        FROM sparse JOIN customer ON entity = c_custkey GROUP BY 1, 2, 3, 4, 5""",
    ),
    "rank_latest_period": (
        rank_nations,
        f"""WITH {COMPLETE_DENSE_SQL}, {MEMBERS_SQL},
        peers AS (SELECT DISTINCT d.item, d.entity FROM dense d JOIN members m ON d.entity = m.entity WHERE grp <> 'ALL'),
        last AS (SELECT p.item, p.entity, d.value FROM peers p LEFT JOIN dense d ON d.entity = p.entity
                 AND d.item = p.item AND d.qidx = (SELECT max(qidx) FROM dense))
        SELECT item AS metric, entity, round(value, 4) AS value,
          row_number() OVER (PARTITION BY item ORDER BY value DESC NULLS FIRST, entity) AS latest_rank FROM last""",
    ),
    "rank_latest_period_table": (
        rank_customers,
        f"""WITH {COMPLETE_SQL},
        last AS (SELECT item, entity, max(CASE WHEN qidx = (SELECT max(qidx) FROM sparse) THEN value END) AS value
                 FROM sparse JOIN customer ON entity = c_custkey GROUP BY item, entity)
        SELECT item AS metric, entity, round(value, 4) AS value,
          row_number() OVER (PARTITION BY item ORDER BY value DESC NULLS FIRST, entity) AS latest_rank FROM last""",
    ),
    "monthly_filtered_sum": (
        monthly_urgent,
        """WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ym, o_orderpriority AS p,
                       CAST(round(o_totalprice * 100) AS BIGINT) AS amount FROM orders),
        u AS (SELECT ym, CAST(sum(amount) AS BIGINT) AS urgent FROM o WHERE p LIKE '%URGENT%' GROUP BY ym),
        l AS (SELECT ym, CAST(sum(amount) AS BIGINT) AS low FROM o WHERE p = '5-LOW' GROUP BY ym)
        SELECT coalesce(u.ym, l.ym) AS ym, urgent, low FROM u FULL JOIN l ON u.ym = l.ym""",
    ),
    "panel_merge": (
        merged,
        f"WITH {MERGED_SQL} SELECT entity, item, year, quarter, qidx, round(value, 4) AS value FROM merged",
    ),
    "panel_enrich": (
        enriched,
        f"""WITH {MERGED_SQL}, {groups_sql('merged')}, {series_sql('grouped', semi=SEMI_SQL)}
        SELECT entity, item, year, quarter, qidx, round(value, 3) AS value,
          CASE WHEN item LIKE '%BS%' OR item LIKE 'NOTES%' THEN round(avg, 3) END AS avg,
          CASE WHEN item LIKE '%BS%' OR item LIKE 'NOTES%' THEN round(roll5, 3) END AS roll5,
          CASE WHEN item LIKE 'IS%' THEN round(roll4, 3) END AS roll4 FROM derived""",
    ),
}
