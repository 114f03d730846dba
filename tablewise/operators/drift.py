"""Drift between runs, baseline carry-over, artifact health, run history."""
from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..sources.logs import LogTable
from ..sources.sinks import path_exists

STATS_SCHEMA = "column_name string, mean double, std double, min double, max double, nulls bigint, rows bigint"
RUN_SCHEMA = ("run_id string, timestamp string, source string, status string, duration_seconds double, "
              "headline_metric string, headline_value double, drift_events bigint, artifacts_ok bigint, "
              "artifacts_miss bigint")


# --------------------------------------------------------------------------- #
# D1 / J2 / J6
# --------------------------------------------------------------------------- #
def drift_check(current: DataFrame, previous: DataFrame, threshold: float = K.DRIFT_WARN_THRESHOLD) -> DataFrame:
    """Compare column stats of this run with the previous run (full outer join on column name).

    status: drift (|mean - prev mean| / prev std >= 2), ok, skipped (prev std 0 or
    missing), new (only now; noted, not an event) or dropped (only before; an event).
    """
    shift = F.abs(F.col("curr_mean") - F.col("prev_mean")) / F.col("prev_std")
    usable = F.col("prev_std").isNotNull() & ~F.isnan("prev_std") & (F.col("prev_std") > 0)
    in_prev = F.col("_in_prev")
    in_cur = F.col("_in_cur")
    c2 = current.select("column_name", F.lit(True).alias("_in_cur"), F.col("mean").alias("curr_mean"))
    p2 = previous.select("column_name", F.lit(True).alias("_in_prev"), F.col("mean").alias("prev_mean"),
                         F.col("std").alias("prev_std"))
    j = c2.join(p2, "column_name", "full")
    st = (F.when(in_prev.isNull(), "new")
           .when(in_cur.isNull(), "dropped")
           .when(~usable, "skipped")
           .when(shift >= threshold, "drift")
           .otherwise("ok"))
    return (j.select("column_name", "prev_mean", "curr_mean", "prev_std",
                     F.when(in_prev.isNotNull() & in_cur.isNotNull() & usable, shift).alias("shift_stds"),
                     st.alias("status"))
             .withColumn("is_event", F.col("status").isin("drift", "dropped")))


# --------------------------------------------------------------------------- #
# D2 baseline carry-over
# --------------------------------------------------------------------------- #
def latest_snapshot(history: DataFrame) -> DataFrame:
    """Stats rows of the most recent snapshot in a history table (run_id, ts, stats...)."""
    last = history.agg(F.max("ts").alias("_ts"))
    return history.join(F.broadcast(last), history["ts"] == last["_ts"]).drop("_ts")


def carry_over(spark: SparkSession, history_path: str, current: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame]:
    """Drift of ``current`` against the latest stored snapshot; then store ``current``.

    An empty ``current`` (no numeric features) leaves the stored baseline as it is,
    so every previous column reads as dropped.
    """
    history = LogTable(spark, history_path, f"{STATS_SCHEMA}, run_id string, ts double")
    first = not history.exists()  # any other trouble with the baseline is an error
    if first:
        previous = spark.createDataFrame([], STATS_SCHEMA)
    else:
        previous = latest_snapshot(history.read()).select(*[c.split()[0] for c in STATS_SCHEMA.split(", ")])
    events = drift_check(current, previous) if not first else spark.createDataFrame(
        [], "column_name string, prev_mean double, curr_mean double, prev_std double, shift_stds double, "
            "status string, is_event boolean")
    # Fix the comparison before the baseline is appended. One row per column.
    events = spark.createDataFrame(events.collect(), events.schema)
    if current.limit(1).count() > 0:
        history.append(current.withColumn("run_id", F.lit(run_id)).withColumn("ts", F.lit(time.time())))
    return events, previous


# --------------------------------------------------------------------------- #
# D3 artifact health
# --------------------------------------------------------------------------- #
def artifact_health(spark: SparkSession, run_dir: str, expected=K.EXPECTED_ARTIFACTS) -> DataFrame:
    """present, size (KB) and age (s) of each expected output under ``run_dir``.

    File metadata only: the binaryFile content column is never selected, so no
    file body is read.
    """
    base = run_dir.rstrip("/")
    exp = spark.createDataFrame([(a,) for a in expected], "artifact string")
    found = spark.createDataFrame([], "artifact string, bytes bigint, mtime timestamp")
    if path_exists(spark, base):
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
                 .select("path", "length", "modificationTime"))
        rel = F.regexp_replace(F.col("path"), r"^.*?" + _re_escape(base.split("://")[-1]) + "/", "")
        found = (files.withColumn("artifact", F.split(rel, "/").getItem(0))
                      .groupBy("artifact").agg(F.sum("length").alias("bytes"),
                                               F.max("modificationTime").alias("mtime")))
    now = F.current_timestamp()
    return (exp.join(found, "artifact", "left")
               .select("artifact", F.col("bytes").isNotNull().alias("present"),
                       F.round(F.col("bytes") / 1024, 1).alias("size_kb"),
                       F.round(F.unix_timestamp(now) - F.unix_timestamp("mtime")).cast("bigint").alias("age_seconds")))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


# --------------------------------------------------------------------------- #
# A13 / D4 run history
# --------------------------------------------------------------------------- #
def run_history(runs: DataFrame, keep: int = K.MAX_HISTORY) -> DataFrame:
    """Summary over the last ``keep`` runs: totals, success / failed counts, mean duration.

    ``failed_count`` counts status = 'failed'; ``not_success`` is total - success
    (the two differ when a run is still 'running').
    """
    last = runs.orderBy(F.col("timestamp").desc(), F.col("run_id").desc()).limit(keep)
    return last.agg(F.count(F.lit(1)).alias("total_runs"),
                    F.sum((F.col("status") == "success").cast("long")).alias("success_count"),
                    F.sum((F.col("status") == "failed").cast("long")).alias("failed_count"),
                    (F.count(F.lit(1)) - F.sum((F.col("status") == "success").cast("long"))).alias("not_success"),
                    F.round(F.avg(F.coalesce("duration_seconds", F.lit(0.0))), 3).alias("avg_duration"))


def recent_runs(runs: DataFrame, n: int = K.RECENT_RUNS) -> DataFrame:
    """The last ``n`` runs with the change of the headline metric from the run before."""
    newest = (F.col("timestamp").desc(), F.col("run_id").desc())
    w = Window.orderBy("timestamp", "run_id")
    # one run more than shown, for the change of the oldest
    d = runs.orderBy(*newest).limit(n + 1).withColumn("prev_headline", F.lag("headline_value").over(w)) \
            .withColumn("headline_change", F.col("headline_value") - F.col("prev_headline"))
    return d.orderBy(*newest).limit(n)


# --------------------------------------------------------------------------- #
# T3 manifest
# --------------------------------------------------------------------------- #
def manifest_frame(spark: SparkSession, manifest: dict) -> DataFrame:
    """Stage rows of a run manifest: order, name, status, seconds, error."""
    rows = [(i, s["name"], s["status"], s.get("duration_seconds"), s.get("error"))
            for i, s in enumerate(manifest["stages"])]
    return spark.createDataFrame(rows, "stage_order int, stage string, status string, duration_seconds double, "
                                       "error string")
