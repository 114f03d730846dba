"""Evaluation on scored rows (M6-M11) and holdout diagnostics.

Metrics are one aggregation over the scored rows (or over the small
(actual, predicted) count table). ROC-AUC is exact, ties averaged, all classes
in one grouped pass.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import stats as S
from ..functions.scalars import col_, grade
from ..plans.ordering import rolling_mean
from ..session import scratch_path


# --------------------------------------------------------------------------- #
# M6 regression metrics
# --------------------------------------------------------------------------- #
def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: n, r2, mae, rmse, mape (MAPE skips |actual| < 1e-9; NULL if none left)."""
    y, p = col_(actual).cast("double"), col_(predicted).cast("double")
    err = y - p
    denom_ok = F.abs(y) >= K.MAPE_EPS
    s = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(err * err).alias("ss_res"),
               (F.var_pop(y) * F.count(y)).alias("ss_tot"),
               F.avg(F.abs(err)).alias("mae"),
               F.avg(err * err).alias("mse"),
               F.avg(F.when(denom_ok, F.abs(err / y))).alias("_mape"))
    r2 = (F.when(F.col("ss_tot") == 0, F.when(F.col("ss_res") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
           .otherwise(F.lit(1.0) - F.col("ss_res") / F.col("ss_tot")))
    return s.select("n", r2.alias("r2"), "mae", F.sqrt("mse").alias("rmse"), (F.col("_mape") * 100).alias("mape"))


# --------------------------------------------------------------------------- #
# M7 / M8 classification
# --------------------------------------------------------------------------- #
# Classes of a confusion grid at most (a million cells).
MAX_GRID_CLASSES = 1000


def pair_counts(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(actual, predicted, n) counts; classes^2 rows at most, map-side combined."""
    return df.groupBy(col_(actual).cast("string").alias("actual"),
                      col_(predicted).cast("string").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: n, accuracy, support-weighted precision / recall / F1 (0 where 0/0)."""
    pc = pair_counts(df, actual, predicted)
    # each (actual, predicted) count speaks for two classes: one scan, one grouping by class
    sides = F.array(F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("npred"),
                             F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
                    F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                             F.col("n").alias("npred"), F.lit(0).cast("bigint").alias("tp")))
    per = (pc.select(F.explode(sides).alias("s")).groupBy("s.cls")
             .agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "npred", "tp")]))
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    per = per.select("support", "tp", prec.alias("p"), rec.alias("r"), f1.alias("f1"))
    total = F.sum("support")
    return per.agg(total.cast("bigint").alias("n"),
                   (F.sum("tp") / total).alias("accuracy"),
                   (F.sum(F.col("p") * F.col("support")) / total).alias("precision_weighted"),
                   (F.sum(F.col("r") * F.col("support")) / total).alias("recall_weighted"),
                   (F.sum(F.col("f1") * F.col("support")) / total).alias("f1_weighted"))


def confusion_matrix(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                     classes: list[str] | DataFrame | None = None) -> DataFrame:
    """(actual, predicted, n) for every pair of classes, zeros included.

    ``classes`` may be a list or a one-column frame of labels; without it the
    labels that occur are used. The grid has classes x classes rows, so more than
    MAX_GRID_CLASSES classes raise: ``pair_counts`` has the cells that occur, at any number of classes.
    """
    pc = pair_counts(df, actual, predicted)
    spark = df.sparkSession
    if classes is None:
        names = pc.select(F.explode(F.array("actual", "predicted")).alias("c")).where(F.col("c").isNotNull()).distinct()
    elif isinstance(classes, DataFrame):
        names = classes.toDF("c").distinct()
    else:
        names = spark.createDataFrame([(c,) for c in classes], "c string")
    if names.limit(MAX_GRID_CLASSES + 1).count() > MAX_GRID_CLASSES:
        raise ValueError(f"a grid of over {MAX_GRID_CLASSES} classes: use pair_counts, which has the cells that occur")
    # the label list, once as rows and once as an array in each of them: no join makes the grid
    every = names.agg(F.array_sort(F.collect_set("c")).alias("all"))
    grid = (every.select(F.explode("all").alias("actual"), "all").repartition("actual")
            .select("actual", F.explode("all").alias("predicted")))
    return (grid.join(pc, ["actual", "predicted"], "left")
                .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


# --------------------------------------------------------------------------- #
# M9 ROC-AUC
# --------------------------------------------------------------------------- #
def class_aucs(scores: DataFrame) -> DataFrame:
    """(cls, auc, support) from rows (cls, hit, score): hit is 1 where the row is of the class.

    Rank-sum form, ties averaged: the rows of each class and score are counted first, then
    running totals over the distinct scores of each class (cut into ranges, so that no
    class is one task's work) give every positive the negatives it outranks.
    """
    spark = scores.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tally = scores.groupBy("cls", "score").agg(F.sum("hit").alias("pos"), (F.count(F.lit(1)) - F.sum("hit")).alias("neg"))
    path = scratch_path(spark, "auc")
    (tally.repartitionByRange(parts, "cls", "score").withColumn("_part", F.spark_partition_id()).write.parquet(path))
    tally = spark.read.parquet(path)
    runs = tally.groupBy("cls", "_part").agg(F.sum("neg").alias("_neg"))
    before = Window.partitionBy("cls").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("cls", "_part", F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("cls", "_part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_base") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    won = (tally.join(runs, ["cls", "_part"])
           .withColumn("won", F.col("pos").cast("double") * (below + F.col("neg") / 2.0)))
    total = won.groupBy("cls").agg(F.sum("won").alias("won"), F.sum("pos").alias("support"), F.sum("neg").alias("neg"))
    return total.select("cls", (F.col("won") / (F.col("support") * F.col("neg").cast("double"))).alias("auc"), "support")


def roc_auc(df: DataFrame, actual: str, prob_cols: dict[str, str]) -> DataFrame:
    """Binary AUC (two classes present, score = probability of the second class),
    or one-vs-rest AUC weighted by support over the classes present.

    ``prob_cols`` maps class label (as text) -> probability column, in class order.
    All classes are evaluated by one grouped pass, whatever their number.
    """
    spark = df.sparkSession
    y = col_(actual).cast("string")
    labels = list(prob_cols)
    seen = (df.groupBy(y.alias("c")).agg(F.count(F.lit(1)).alias("n"))
            .limit(len(labels) + 1).collect())  # a row a known class at most, and one to notice a foreign one
    present = {r["c"] for r in seen}
    empty = spark.createDataFrame([], "metric string, value double")
    if len(present) == 2 and len(labels) >= 2:
        score = col_(prob_cols[labels[1]]).cast("double")
        rows = df.select(F.lit("positive").alias("cls"), (y == F.lit(max(present))).cast("bigint").alias("hit"),
                         score.alias("score"))
        return class_aucs(rows).select(F.lit("roc_auc").alias("metric"), F.col("auc").alias("value"))
    if len(present) > 2 and present <= set(labels):
        pairs = F.array(*[F.struct(F.lit(c).alias("cls"), col_(prob_cols[c]).cast("double").alias("score"))
                          for c in labels if c in present])
        rows = df.select(y.alias("_y"), F.explode(pairs).alias("p")).select(
            "p.cls", (F.col("_y") == F.col("p.cls")).cast("bigint").alias("hit"), "p.score")
        return class_aucs(rows).agg((F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("value")).select(
            F.lit("roc_auc_ovr_weighted").alias("metric"), "value")
    return empty


# --------------------------------------------------------------------------- #
# M10 / M11
# --------------------------------------------------------------------------- #
def verdict_rule(task: str) -> tuple[str, str, float]:
    """The metric that decides, its name in sentences, and the value from which a model is healthy."""
    return ("accuracy", "accuracy", K.MIN_ACCURACY) if task == "classification" else ("r2", "R2", K.MIN_R2)


def quality_verdict(metrics: DataFrame, task: str) -> DataFrame:
    """status healthy / weak with its reason, and a Good / Fair / Poor grade."""
    key, name, thr = verdict_rule(task)
    v = F.col(key)
    ok = v >= thr
    return metrics.select(
        F.lit(key).alias("headline_metric"), v.alias("headline_value"),
        F.when(ok, "healthy").otherwise("weak").alias("status"),
        F.format_string(f"{name} %.3f %s {thr}", v, F.when(ok, ">=").otherwise("<")).alias("status_reason"),
        grade(v).alias("grade"))


# --------------------------------------------------------------------------- #
# W8 / W9 rolling error, W10 / W11 anomalies
# --------------------------------------------------------------------------- #
def rolling_window(n: int) -> int:
    return max(K.ROLLING_MIN_WINDOW, n // K.ROLLING_DIVISOR)


def rolling_rmse(df: DataFrame, key: str, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """sqrt(mean squared error) over the last max(5, n // 10) rows in ``key`` order."""
    n = df.count()
    e = df.withColumn("_se", (col_(actual).cast("double") - col_(predicted).cast("double")) ** 2)
    r = rolling_mean(e, key, "_se", rolling_window(n), "_rm")
    return r.withColumn("rolling_rmse", F.sqrt("_rm")).withColumn("window", F.lit(rolling_window(n))).drop("_se", "_rm")


def rolling_accuracy(df: DataFrame, key: str, correct: str = "correct") -> DataFrame:
    """Share correct over the last max(5, n // 10) rows in ``key`` order."""
    n = df.count()
    e = df.withColumn("_c", col_(correct).cast("double"))
    r = rolling_mean(e, key, "_c", rolling_window(n), "rolling_accuracy")
    return r.withColumn("window", F.lit(rolling_window(n))).drop("_c")


def residual_flags(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """residual and anomaly flag: |residual - mean| > 2 * population std."""
    res = col_(actual).cast("double") - col_(predicted).cast("double")
    d = df.withColumn("residual", res)
    st = S.one_row(d, {"mu": F.avg("residual"), "sd": F.stddev_pop("residual")})
    mu, sd = st["mu"], st["sd"]
    if mu is None:
        return d.withColumn("anomaly", F.lit(False))
    return d.withColumn("anomaly", F.abs(F.col("residual") - F.lit(mu)) > F.lit(K.ANOMALY_SIGMAS * sd))


def residual_anomalies(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: n_points, n_anomalies, anomaly_rate (%), residual mean and population std."""
    f = residual_flags(df, actual, predicted)
    return f.agg(F.count(F.lit(1)).alias("n_points"),
                 F.sum(F.col("anomaly").cast("long")).alias("n_anomalies"),
                 (F.sum(F.col("anomaly").cast("long")) / F.count(F.lit(1)) * 100).alias("anomaly_rate"),
                 F.avg("residual").alias("residual_mean"), F.stddev_pop("residual").alias("residual_std"))


def misclassified(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                  confidence: str | None = "confidence") -> DataFrame:
    """One row: n_points, n_misclassified (text compare), n_low_confidence (< 0.5)."""
    mis = col_(actual).cast("string") != col_(predicted).cast("string")
    low = (F.sum((col_(confidence) < K.LOW_CONFIDENCE).cast("long")) if confidence and confidence in df.columns
           else F.lit(None).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("n_points"), F.sum(mis.cast("long")).alias("n_misclassified"),
                  low.alias("n_low_confidence"))


# --------------------------------------------------------------------------- #
# W12-W14 linear forecast of the target in row order
# --------------------------------------------------------------------------- #
def linear_fit(df: DataFrame, key: str, value: str) -> dict:
    """Least-squares line of ``value`` on its 0-based position in ``key`` order.

    Only the sums over (x, y) are needed, so positions come from
    ``ordered_index`` and the fit is one aggregation.
    """
    from ..plans.ordering import ordered_index
    d = df.select(col_(key), col_(value).try_cast("double").alias("_y")).where(F.col("_y").isNotNull() & ~F.isnan("_y"))
    n = d.count()
    if n < K.FORECAST_MIN_ROWS:
        return {"n": n, "slope": None, "intercept": None, "last": None}
    x = ordered_index(d, key, "_x")
    st = x.agg(F.regr_slope("_y", F.col("_x").cast("double")).alias("slope"),
               F.regr_intercept("_y", F.col("_x").cast("double")).alias("intercept")).first()
    last = d.orderBy(col_(key).desc()).limit(1).first()["_y"]
    return {"n": n, "slope": st["slope"], "intercept": st["intercept"], "last": last}


def linear_forecast(df: DataFrame, key: str, value: str, rmse: float, horizon: int = K.FORECAST_HORIZON,
                    spike_pct: float = K.FORECAST_SPIKE_PCT) -> DataFrame:
    """Next ``horizon`` points of the fitted line with a +-1.5 RMSE band, direction and spike flag."""
    spark = df.sparkSession
    fit = linear_fit(df, key, value)
    schema = ("step int, x bigint, forecast double, lower double, upper double, last_actual double, "
              "change double, pct_change double, direction string, spike_alert boolean")
    if fit["slope"] is None:
        return spark.createDataFrame([], schema)
    horizon = max(1, min(12, int(horizon)))
    n, a, b, last = fit["n"], fit["intercept"], fit["slope"], fit["last"]
    band = K.FORECAST_BAND_RMSE * float(rmse or 0.0)
    steps = spark.range(horizon).select((F.col("id") + 1).cast("int").alias("step"), (F.col("id") + n).alias("x"))
    fc = F.lit(a) + F.lit(b) * F.col("x").cast("double")
    final = F.lit(a + b * (n + horizon - 1))
    change = final - F.lit(last)
    pct = F.when(F.lit(last) != 0, change / F.abs(F.lit(last)) * 100).otherwise(F.lit(0.0))
    direction = (F.when(F.abs(change) <= F.greatest(F.lit(band), F.lit(1e-9)), "Stable")
                  .when(change > 0, "Up").otherwise("Down"))
    return steps.select("step", "x", fc.alias("forecast"), (fc - band).alias("lower"), (fc + band).alias("upper"),
                        F.lit(float(last)).alias("last_actual"), change.alias("change"), pct.alias("pct_change"),
                        direction.alias("direction"), (F.abs(pct) > spike_pct).alias("spike_alert"))


def recent_tail(df: DataFrame, key: str, value: str, rows: int = K.RECENT_TAIL_ROWS) -> DataFrame:
    """The last ``rows`` values in ``key`` order (top-k per task, then merged)."""
    d = df.select(col_(key), col_(value).try_cast("double").alias(value)).where(col_(value).isNotNull())
    return d.orderBy(col_(key).desc()).limit(rows)


# --------------------------------------------------------------------------- #
# headline metric of a task
# --------------------------------------------------------------------------- #
def headline(task: str, metrics_row: dict) -> tuple[str, float]:
    if task == "classification":
        return "accuracy", metrics_row["accuracy"]
    return "r2", metrics_row["r2"]

