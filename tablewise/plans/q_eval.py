"""Evaluation queries on scored rows (M6-M11, W8-W14, P7, number format).

Scores come from fixed expressions over orders, the same in Spark and SQL, so
no model is needed for the oracle (SURVEY build step 5).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import format_kpi, signed_pct
from ..operators import evaluate as EV
from ..operators import timeseries as TS
from .catalog import register, rnd, table

_PRIOS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

REG_SQL = """
WITH f AS (SELECT o_orderkey, o_totalprice AS actual,
                  o_totalprice + (o_orderkey % 101 - 50) * 1000.0 AS predicted FROM orders)"""

CLS_SQL = """
WITH f0 AS (
  SELECT o_orderkey, o_orderpriority AS actual,
         CASE WHEN o_orderkey % 5 = 0 THEN (CASE o_orderpriority WHEN '1-URGENT' THEN '2-HIGH'
              WHEN '2-HIGH' THEN '3-MEDIUM' WHEN '3-MEDIUM' THEN '4-NOT SPECIFIED'
              WHEN '4-NOT SPECIFIED' THEN '5-LOW' ELSE '1-URGENT' END) ELSE o_orderpriority END AS predicted,
         ((o_orderkey * 37) % 100) / 100.0 + 0.01 AS confidence
  FROM orders),
f AS (SELECT *, actual = predicted AS correct FROM f0)"""


def reg_scores(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_totalprice").alias("actual"),
                    (F.col("o_totalprice") + ((F.col("o_orderkey") % 101) - 50) * 1000.0).alias("predicted"))


def cls_scores(spark, sf):
    o = table(spark, sf, "orders")
    p = F.col("o_orderpriority")
    nxt = F.when(p == _PRIOS[0], _PRIOS[1]).when(p == _PRIOS[1], _PRIOS[2]).when(p == _PRIOS[2], _PRIOS[3]) \
        .when(p == _PRIOS[3], _PRIOS[4]).otherwise(_PRIOS[0])
    pred = F.when(F.col("o_orderkey") % 5 == 0, nxt).otherwise(p)
    return o.select("o_orderkey", p.alias("actual"), pred.alias("predicted"),
                    (((F.col("o_orderkey") * 37) % 100) / 100.0 + 0.01).alias("confidence")) \
        .withColumn("correct", F.col("actual") == F.col("predicted"))


# --------------------------------------------------------------------------- #
@register("regression_metrics", REG_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n,
       round(1 - sum((actual - predicted) ^ 2) / (var_pop(actual) * count(actual)), 6) AS r2,
       round(avg(abs(actual - predicted)), 6) AS mae, round(sqrt(avg((actual - predicted) ^ 2)), 6) AS rmse,
       round(avg(CASE WHEN abs(actual) >= 1e-9 THEN abs((actual - predicted) / actual) END) * 100, 6) AS mape
FROM f""")
def q_regression_metrics(spark, sf):
    return rnd(EV.regression_metrics(reg_scores(spark, sf)))


_CLS_METRICS_SQL = CLS_SQL + """,
pc AS (SELECT actual, predicted, count(*) AS n FROM f GROUP BY 1, 2),
cls AS (SELECT actual AS c FROM pc UNION SELECT predicted FROM pc),
per AS (
  SELECT c,
         coalesce((SELECT sum(n) FROM pc WHERE actual = c), 0) AS support,
         coalesce((SELECT sum(n) FROM pc WHERE predicted = c), 0) AS npred,
         coalesce((SELECT sum(n) FROM pc WHERE actual = c AND predicted = c), 0) AS tp
  FROM cls),
pr AS (
  SELECT support, tp, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS p,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM per),
m AS (
  SELECT CAST(sum(support) AS BIGINT) AS n, sum(tp) / sum(support) AS accuracy,
         sum(p * support) / sum(support) AS precision_weighted, sum(r * support) / sum(support) AS recall_weighted,
         sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END * support) / sum(support) AS f1_weighted
  FROM pr)"""


@register("classification_metrics", _CLS_METRICS_SQL + """
SELECT n, round(accuracy, 6) AS accuracy, round(precision_weighted, 6) AS precision_weighted,
       round(recall_weighted, 6) AS recall_weighted, round(f1_weighted, 6) AS f1_weighted FROM m""")
def q_classification_metrics(spark, sf):
    return rnd(EV.classification_metrics(cls_scores(spark, sf)))


@register("confusion_matrix", CLS_SQL + """,
pc AS (SELECT actual, predicted, count(*) AS n FROM f GROUP BY 1, 2),
cls AS (SELECT actual AS c FROM pc UNION SELECT predicted FROM pc)
SELECT a.c AS actual, b.c AS predicted, CAST(coalesce(pc.n, 0) AS BIGINT) AS n
FROM cls a CROSS JOIN cls b LEFT JOIN pc ON pc.actual = a.c AND pc.predicted = b.c""")
def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(cls_scores(spark, sf))


# --------------------------------------------------------------------------- #
# M9: binary and one-vs-rest AUC
# --------------------------------------------------------------------------- #
def _auc_sql(src: str, label: str, score: str) -> str:
    """Rank-sum AUC (ties averaged) of ``label`` (0/1) against ``score`` over ``src``."""
    return f"""(SELECT (sum(ar) FILTER (WHERE y = 1) - np * (np + 1) / 2.0) / (np * nn)
  FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar,
               sum(y) OVER () AS np, count(*) OVER () - sum(y) OVER () AS nn
        FROM (SELECT CAST({label} AS DOUBLE) AS y, CAST({score} AS DOUBLE) AS s FROM {src})) GROUP BY np, nn)"""


def _bin_expr():
    y = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    s = 0.6 * y + 0.4 * (((F.col("o_orderkey") * 37) % 101) / 100.0)
    return y, s


@register("roc_auc", """
SELECT 'roc_auc' AS metric, round(""" + _auc_sql(
    "(SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS yy, "
    "0.6 * (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) + 0.4 * ((o_orderkey * 37) % 101) / 100.0 AS ss FROM orders)",
    "yy", "ss") + """, 6) AS value
UNION ALL
SELECT 'roc_auc_ovr_weighted', round(""" + " + ".join(
    f"(SELECT count(*) FILTER (WHERE o_orderpriority = '{c}') / count(*) FROM orders) * " + _auc_sql(
        f"(SELECT CASE WHEN o_orderpriority = '{c}' THEN 1 ELSE 0 END AS yy, "
        f"(CASE WHEN o_orderpriority = '{c}' THEN 0.3 ELSE 0.0 END) + ((o_orderkey * {i + 7}) % 97) / 97.0 * 0.7 AS ss "
        f"FROM orders)", "yy", "ss")
    for i, c in enumerate(_PRIOS)) + """, 6)""")
def q_roc_auc(spark, sf):
    o = table(spark, sf, "orders")
    y, s = _bin_expr()
    b = o.select(y.cast("string").alias("actual"), (1 - s).alias("p0"), s.alias("p1"))
    binary = EV.roc_auc(b, "actual", {"0": "p0", "1": "p1"})
    probs = {c: f"p{i}" for i, c in enumerate(_PRIOS)}
    m = o.select(F.col("o_orderpriority").alias("actual"),
                 *[((F.when(F.col("o_orderpriority") == c, 0.3).otherwise(0.0))
                    + ((F.col("o_orderkey") * (i + 7)) % 97) / 97.0 * 0.7).alias(f"p{i}") for i, c in enumerate(_PRIOS)])
    multi = EV.roc_auc(m, "actual", probs)
    return rnd(binary.unionByName(multi))


# --------------------------------------------------------------------------- #
# M10 / M11
# --------------------------------------------------------------------------- #
@register("quality_verdict", REG_SQL + """,
m AS (SELECT 1 - sum((actual - predicted) ^ 2) / (var_pop(actual) * count(actual)) AS r2 FROM f)
SELECT 'r2' AS headline_metric, round(r2, 6) AS headline_value,
       CASE WHEN r2 >= 0.0 THEN 'healthy' ELSE 'weak' END AS status,
       printf('R2 %.3f %s 0.0', r2, CASE WHEN r2 >= 0.0 THEN '>=' ELSE '<' END) AS status_reason,
       CASE WHEN r2 >= 0.8 THEN 'Good' WHEN r2 >= 0.5 THEN 'Fair' ELSE 'Poor' END AS grade
FROM m""")
def q_quality_verdict(spark, sf):
    return rnd(EV.quality_verdict(EV.regression_metrics(reg_scores(spark, sf)), "regression"))


# --------------------------------------------------------------------------- #
# W8 - W11
# --------------------------------------------------------------------------- #
def _rolling_sql(value_expr: str, fn: str, out: str, cte: str) -> str:
    return cte + f""",
nw AS (SELECT greatest(5, count(*) // 10) AS w FROM f),
p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, {value_expr} AS v FROM f)
SELECT a.o_orderkey, round({fn}(avg(b.v)), 6) AS {out}, CAST(any_value(w) AS INTEGER) AS window
FROM p a, nw JOIN p b ON b.pos BETWEEN a.pos - nw.w + 1 AND a.pos
GROUP BY a.o_orderkey"""


@register("rolling_rmse", _rolling_sql("(actual - predicted) ^ 2", "sqrt", "rolling_rmse", REG_SQL))
def q_rolling_rmse(spark, sf):
    r = EV.rolling_rmse(reg_scores(spark, sf), "o_orderkey")
    return rnd(r.select("o_orderkey", "rolling_rmse", "window"))


@register("rolling_accuracy", _rolling_sql("CAST(correct AS DOUBLE)", "", "rolling_accuracy", CLS_SQL))
def q_rolling_accuracy(spark, sf):
    r = EV.rolling_accuracy(cls_scores(spark, sf), "o_orderkey")
    return rnd(r.select("o_orderkey", "rolling_accuracy", "window"))


@register("residual_anomalies", REG_SQL + """,
r AS (SELECT actual - predicted AS res FROM f),
st AS (SELECT avg(res) AS mu, stddev_pop(res) AS sd FROM r)
SELECT CAST(count(*) AS BIGINT) AS n_points, CAST(sum(CASE WHEN abs(res - mu) > 2 * sd THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalies,
       round(sum(CASE WHEN abs(res - mu) > 2 * sd THEN 1 ELSE 0 END) / count(*) * 100, 6) AS anomaly_rate,
       round(any_value(mu), 6) AS residual_mean, round(any_value(sd), 6) AS residual_std
FROM r, st""")
def q_residual_anomalies(spark, sf):
    return rnd(EV.residual_anomalies(reg_scores(spark, sf)))


@register("misclassified", CLS_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n_points, CAST(sum(CASE WHEN actual <> predicted THEN 1 ELSE 0 END) AS BIGINT) AS n_misclassified,
       CAST(sum(CASE WHEN confidence < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_low_confidence FROM f""")
def q_misclassified(spark, sf):
    return EV.misclassified(cls_scores(spark, sf))


# --------------------------------------------------------------------------- #
# W12 - W14
# --------------------------------------------------------------------------- #
@register("linear_forecast", REG_SQL + """,
rm AS (SELECT sqrt(avg((actual - predicted) ^ 2)) AS rmse FROM f),
xy AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS x, o_totalprice AS y FROM orders),
fit AS (SELECT count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
               arg_max(y, x) AS last FROM xy),
steps AS (SELECT CAST(s AS INTEGER) AS step, n + s - 1 AS x, a + b * (n + s - 1) AS fc, a, b, n, last, 1.5 * rmse AS band
          FROM fit, rm, range(1, 7) t(s)),
d AS (SELECT *, (a + b * (n + 5)) - last AS change FROM steps)
SELECT step, CAST(x AS BIGINT) AS x, round(fc, 6) AS forecast, round(fc - band, 6) AS lower, round(fc + band, 6) AS upper,
       round(last, 6) AS last_actual, round(change, 6) AS change,
       round(CASE WHEN last <> 0 THEN change / abs(last) * 100 ELSE 0.0 END, 6) AS pct_change,
       CASE WHEN abs(change) <= greatest(band, 1e-9) THEN 'Stable' WHEN change > 0 THEN 'Up' ELSE 'Down' END AS direction,
       abs(CASE WHEN last <> 0 THEN change / abs(last) * 100 ELSE 0.0 END) > 10 AS spike_alert
FROM d""")
def q_linear_forecast(spark, sf):
    rmse = EV.regression_metrics(reg_scores(spark, sf)).first()["rmse"]
    return rnd(EV.linear_forecast(table(spark, sf, "orders"), "o_orderkey", "o_totalprice", rmse))


@register("recent_tail", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 60""")
def q_recent_tail(spark, sf):
    return EV.recent_tail(table(spark, sf, "orders"), "o_orderkey", "o_totalprice")


# --------------------------------------------------------------------------- #
# P7 preview, number formatting
# --------------------------------------------------------------------------- #
@register("preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50")
def q_preview(spark, sf):
    from ..operators.report import preview
    return preview(table(spark, sf, "orders"), "o_orderkey")


_FMT_SQL = """
SELECT period,
       CASE WHEN abs(value_sum) >= 1000000 THEN format('{:,.2f}', value_sum / 1000000) || 'M'
            WHEN abs(value_sum) >= 1000 THEN format('{:,.1f}', value_sum / 1000) || 'K'
            ELSE format('{:,.2f}', value_sum) END AS value_text,
       CASE WHEN mom_pct IS NULL THEN NULL ELSE printf('%+.1f', mom_pct) || '%' END AS mom_text
FROM ch"""


def _fmt_sql():
    from .q_kpi import monthly_sql
    return monthly_sql("orders", "o_orderdate", "o_totalprice") + _FMT_SQL


@register("format_kpi", _fmt_sql())
def q_format_kpi(spark, sf):
    m = TS.with_changes(TS.monthly_rollup(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"))
    return m.select("period", format_kpi(F.col("value_sum")).alias("value_text"),
                    signed_pct(F.col("mom_pct")).alias("mom_text"))
