"""Monthly KPIs, trends and change rates.

The heavy step is one ``groupBy(month)`` over the whole table (partial
aggregation before the shuffle). Everything after it works on one row per
calendar month, whose size is bounded by the time span, not by the data.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalars import col_, pct_change
from . import profile


def monthly_rollup(df: DataFrame, date_col: str, metric_col: str) -> DataFrame:
    """Sum, mean and count of ``metric_col`` per calendar month, gaps filled.

    Rows with a NULL date or metric are ignored. Empty months inside the span
    get sum 0, count 0 and a NULL mean. Columns: month_start (date), period
    ('yyyy-MM'), month_idx (0-based), value_sum, value_mean, value_count.
    """
    v = col_(metric_col).cast("double")
    base = (df.select(F.trunc(F.to_date(col_(date_col)), "month").alias("month_start"), v.alias("v"))
              .where(F.col("month_start").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v")))
    agg = base.groupBy("month_start").agg(F.sum("v").alias("value_sum"), F.avg("v").alias("value_mean"),
                                          F.count("v").alias("value_count"))
    # gaps are filled from each month to the next one: windows over one row a month, one scan of the table
    by_month = Window.orderBy("month_start")
    following = F.lead("month_start").over(by_month)
    filled = (agg.withColumn("m0", F.min("month_start").over(Window.partitionBy()))
              .withColumn("months", F.sequence(F.col("month_start"), F.coalesce(F.add_months(following, -1), F.col("month_start")),
                                               F.expr("interval 1 month")))
              .select("m0", "value_sum", "value_mean", "value_count", F.posexplode("months").alias("gap", "month_start")))
    real = F.col("gap") == 0
    return filled.select(
        "month_start", F.date_format("month_start", "yyyy-MM").alias("period"),
        ((F.year("month_start") - F.year("m0")) * 12 + F.month("month_start") - F.month("m0")).alias("month_idx"),
        F.when(real, F.col("value_sum")).otherwise(F.lit(0.0)).alias("value_sum"),
        F.when(real, F.col("value_mean")).alias("value_mean"),
        F.when(real, F.col("value_count")).otherwise(F.lit(0)).cast("bigint").alias("value_count"))


def with_changes(monthly: DataFrame, value_col: str = "value_sum") -> DataFrame:
    """Add change, mom_pct and yoy_pct (W2, W3, W7) to a monthly table.

    The window spans the monthly table only (one row per month).
    """
    w = Window.orderBy("month_idx")
    n_months = F.count(F.lit(1)).over(Window.partitionBy())
    v = F.col(value_col)
    prev = F.lag(v, 1).over(w)
    prev12 = F.lag(v, 12).over(w)
    return (monthly
            .withColumn("change", v - prev)
            .withColumn("mom_pct", pct_change(v, prev))
            .withColumn("yoy_pct", F.when(n_months > 12, pct_change(v, prev12)).otherwise(F.lit(None).cast("double"))))


def kpi_summary_from_monthly(monthly: DataFrame, date_col: str | None = None,
                             metric_col: str | None = None) -> DataFrame:
    """One-row KPI summary over a monthly table."""
    m = with_changes(monthly)
    v, idx, mom, yoy = F.col("value_sum"), F.col("month_idx"), F.col("mom_pct"), F.col("yoy_pct")
    mean_v = F.avg(v)
    safe_mean = F.when(mean_v == 0, F.lit(1.0)).otherwise(mean_v)
    slope = F.coalesce(F.regr_slope(v, idx.cast("double")), F.lit(0.0))
    s = m.agg(
        F.count(F.lit(1)).alias("n_months"),
        F.max_by("period", idx).alias("latest_period"),
        F.max_by(v, idx).alias("latest_value"),
        F.max_by(mom, F.when(mom.isNotNull(), idx)).alias("mom_pct"),
        F.max_by(yoy, F.when(yoy.isNotNull(), idx)).alias("yoy_pct"),
        F.max_by("period", F.struct(v, -idx)).alias("best_period"),
        F.max(v).alias("best_value"),
        F.min_by("period", F.struct(v, idx)).alias("worst_period"),
        F.min(v).alias("worst_value"),
        F.sum(v).alias("total"),
        slope.alias("trend_slope"),
        (slope / F.abs(safe_mean)).alias("_rel"),
        F.max_by("period", F.when(mom.isNotNull(), F.struct(mom, -idx))).alias("rise_period"),
        F.max(mom).alias("rise_pct"),
        F.min_by("period", F.when(mom.isNotNull(), F.struct(mom, idx))).alias("drop_period"),
        F.min(mom).alias("drop_pct"),
    )
    rel = F.col("_rel")
    available = F.col("n_months") >= 2
    out = (s.withColumn("trend", F.when(rel > K.TREND_REL_THRESHOLD, "up")
                        .when(rel < -K.TREND_REL_THRESHOLD, "down").otherwise("flat"))
            .withColumn("available", available)
            .withColumn("reason", F.when(available, F.lit(None).cast("string"))
                        .when(F.col("n_months") == 0, K.REASON_NO_ROWS).otherwise(K.REASON_ONE_MONTH))
            .withColumn("date_column", F.lit(date_col).cast("string"))
            .withColumn("metric_column", F.lit(metric_col).cast("string"))
            .drop("_rel"))
    cols = ["available", "reason", "date_column", "metric_column", "n_months", "latest_period", "latest_value",
            "mom_pct", "yoy_pct", "best_period", "best_value", "worst_period", "worst_value", "total",
            "trend", "trend_slope", "rise_period", "rise_pct", "drop_period", "drop_pct"]
    summary_cols = [c for c in cols if c not in ("available", "reason", "date_column", "metric_column", "n_months")]
    # Below two months only the flag and reason are meaningful.
    return out.select(*cols[:5], *[F.when(available, F.col(c)).alias(c) for c in summary_cols])


def time_kpis(df: DataFrame, date_col: str | None = None, metric_col: str | None = None,
              target: str | None = None) -> tuple[DataFrame | None, DataFrame]:
    """Detect the date and metric columns (if not given) and build the KPIs.

    Returns (monthly table with changes, or None; one-row summary).
    """
    date_col = date_col or profile.detect_date_column(df)
    metric_col = metric_col or profile.detect_metric_column(df, date_col, target)
    spark = df.sparkSession
    if not date_col or not metric_col:
        return None, spark.createDataFrame([(False, K.REASON_NO_DATE, date_col, metric_col)],
                                           "available boolean, reason string, date_column string, metric_column string")
    monthly = monthly_rollup(df, date_col, metric_col)
    return with_changes(monthly), kpi_summary_from_monthly(monthly, date_col, metric_col)


def kpi_summary(df: DataFrame, date_col: str | None = None, metric_col: str | None = None,
                target: str | None = None) -> DataFrame:
    return time_kpis(df, date_col, metric_col, target)[1]
