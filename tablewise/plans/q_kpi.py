"""Monthly KPI queries (W1-W7) on orders(o_orderdate, o_totalprice)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timeseries as TS
from .catalog import register, rnd, table

_MONEY = {"value_sum": 2, "latest_value": 2, "best_value": 2, "worst_value": 2, "total": 2, "change": 2}


def monthly_sql(tbl: str, date: str, metric: str) -> str:
    """CTEs ``mm`` (gap-filled monthly table) and ``ch`` (with changes)."""
    return f"""
WITH m AS (
  SELECT CAST(date_trunc('month', {date}) AS DATE) AS month_start,
         sum({metric}) AS s, avg({metric}) AS a, count({metric}) AS c
  FROM {tbl}
  WHERE {date} IS NOT NULL AND {metric} IS NOT NULL AND NOT isnan(CAST({metric} AS DOUBLE))
  GROUP BY 1),
b AS (SELECT min(month_start) AS m0, max(month_start) AS m1 FROM m),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(m0 AS TIMESTAMP), CAST(m1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_start,
         m0 FROM b),
mm AS (
  SELECT spine.month_start, strftime(spine.month_start, '%Y-%m') AS period,
         CAST((year(spine.month_start) - year(m0)) * 12 + month(spine.month_start) - month(m0) AS INTEGER) AS month_idx,
         coalesce(s, 0.0) AS value_sum, a AS value_mean, CAST(coalesce(c, 0) AS BIGINT) AS value_count
  FROM spine LEFT JOIN m ON spine.month_start = m.month_start),
lg AS (
  SELECT *, lag(value_sum, 1) OVER (ORDER BY month_idx) AS p1, lag(value_sum, 12) OVER (ORDER BY month_idx) AS p12,
         count(*) OVER () AS nm
  FROM mm),
ch AS (
  SELECT *, value_sum - p1 AS change,
         CASE WHEN p1 IS NULL OR p1 = 0 THEN NULL ELSE (value_sum / p1 - 1) * 100 END AS mom_pct,
         CASE WHEN nm <= 12 OR p12 IS NULL OR p12 = 0 THEN NULL ELSE (value_sum / p12 - 1) * 100 END AS yoy_pct
  FROM lg)"""


_ORD = monthly_sql("orders", "o_orderdate", "o_totalprice")

_SUMMARY_SQL = _ORD + """,
agg AS (
  SELECT count(*) AS n_months,
         arg_max(period, month_idx) AS latest_period,
         arg_max(value_sum, month_idx) AS latest_value,
         arg_max(mom_pct, month_idx) FILTER (WHERE mom_pct IS NOT NULL) AS mom_pct,
         arg_max(yoy_pct, month_idx) FILTER (WHERE yoy_pct IS NOT NULL) AS yoy_pct,
         (SELECT period FROM ch ORDER BY value_sum DESC, month_idx ASC LIMIT 1) AS best_period,
         max(value_sum) AS best_value,
         (SELECT period FROM ch ORDER BY value_sum ASC, month_idx ASC LIMIT 1) AS worst_period,
         min(value_sum) AS worst_value,
         sum(value_sum) AS total,
         coalesce(regr_slope(value_sum, month_idx), 0.0) AS trend_slope,
         coalesce(regr_slope(value_sum, month_idx), 0.0)
           / abs(CASE WHEN avg(value_sum) = 0 THEN 1.0 ELSE avg(value_sum) END) AS rel,
         (SELECT period FROM ch WHERE mom_pct IS NOT NULL ORDER BY mom_pct DESC, month_idx ASC LIMIT 1) AS rise_period,
         max(mom_pct) AS rise_pct,
         (SELECT period FROM ch WHERE mom_pct IS NOT NULL ORDER BY mom_pct ASC, month_idx ASC LIMIT 1) AS drop_period,
         min(mom_pct) AS drop_pct
  FROM ch)"""


@register("monthly_rollup", _ORD + """
SELECT period, month_idx, round(value_sum, 2) AS value_sum, round(value_mean, 6) AS value_mean, value_count FROM mm""")
def q_monthly_rollup(spark, sf):
    m = TS.monthly_rollup(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    return rnd(m.drop("month_start"), 6, _MONEY)


@register("mom_change", _ORD + """
SELECT period, round(change, 2) AS change, round(mom_pct, 6) AS mom_pct FROM ch""")
def q_mom_change(spark, sf):
    m = TS.with_changes(TS.monthly_rollup(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"))
    return rnd(m.select("period", "change", "mom_pct"), 6, _MONEY)


@register("yoy_change", _ORD + """
SELECT period, round(yoy_pct, 6) AS yoy_pct FROM ch""")
def q_yoy_change(spark, sf):
    m = TS.with_changes(TS.monthly_rollup(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"))
    return rnd(m.select("period", "yoy_pct"))


@register("trend", _SUMMARY_SQL + """
SELECT n_months, round(trend_slope, 6) AS trend_slope,
       CASE WHEN rel > 0.01 THEN 'up' WHEN rel < -0.01 THEN 'down' ELSE 'flat' END AS trend FROM agg""")
def q_trend(spark, sf):
    s = TS.kpi_summary(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    return rnd(s.select("n_months", "trend_slope", "trend"))


@register("kpi_extremes", _SUMMARY_SQL + """
SELECT best_period, round(best_value, 2) AS best_value, worst_period, round(worst_value, 2) AS worst_value,
       rise_period, round(rise_pct, 6) AS rise_pct, drop_period, round(drop_pct, 6) AS drop_pct FROM agg""")
def q_kpi_extremes(spark, sf):
    s = TS.kpi_summary(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    return rnd(s.select("best_period", "best_value", "worst_period", "worst_value",
                        "rise_period", "rise_pct", "drop_period", "drop_pct"), 6, _MONEY)


KPI_SUMMARY_SQL = _SUMMARY_SQL + """
SELECT n_months >= 2 AS available, CAST(NULL AS VARCHAR) AS reason, 'o_orderdate' AS date_column,
       'o_totalprice' AS metric_column, n_months, latest_period, round(latest_value, 2) AS latest_value,
       round(mom_pct, 6) AS mom_pct, round(yoy_pct, 6) AS yoy_pct, best_period, round(best_value, 2) AS best_value,
       worst_period, round(worst_value, 2) AS worst_value, round(total, 2) AS total,
       CASE WHEN rel > 0.01 THEN 'up' WHEN rel < -0.01 THEN 'down' ELSE 'flat' END AS trend,
       round(trend_slope, 6) AS trend_slope, rise_period, round(rise_pct, 6) AS rise_pct,
       drop_period, round(drop_pct, 6) AS drop_pct
FROM agg"""


def kpi_summary_query(spark, sf):
    """Flagship: detect the date and metric columns of orders, then the KPI summary."""
    s = TS.kpi_summary(table(spark, sf, "orders"))
    return rnd(s, 6, _MONEY)


register("kpi_summary", KPI_SUMMARY_SQL)(kpi_summary_query)


@register("period_difference", _ORD + """
SELECT period, round(value_sum, 2) AS value_sum, round(change, 2) AS change,
       CASE WHEN change IS NULL THEN NULL WHEN change >= 0 THEN 'up' ELSE 'down' END AS direction FROM ch""")
def q_period_difference(spark, sf):
    m = TS.with_changes(TS.monthly_rollup(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"))
    d = F.when(F.col("change").isNull(), F.lit(None).cast("string")).when(F.col("change") >= 0, "up").otherwise("down")
    return rnd(m.select("period", "value_sum", "change", d.alias("direction")), 6, _MONEY)


@register("kpi_unavailable", """
SELECT count(DISTINCT date_trunc('month', ts)) >= 2 AS available,
       CASE WHEN count(DISTINCT date_trunc('month', ts)) >= 2 THEN NULL
            ELSE 'Data spans less than two months — not enough for trends.' END AS reason,
       'ts' AS date_column, 'value' AS metric_column, CAST(count(DISTINCT date_trunc('month', ts)) AS BIGINT) AS n_months
FROM events WHERE ts IS NOT NULL AND value IS NOT NULL""")
def q_kpi_unavailable(spark, sf):
    """events span one month: the summary must say KPIs are unavailable."""
    s = TS.kpi_summary(table(spark, sf, "events"))
    return s.select("available", "reason", "date_column", "metric_column", "n_months")
