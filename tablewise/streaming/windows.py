"""KPIs of a stream of files by event time, in update mode.

Rows are summed per fixed span of event time. A watermark bounds the state: spans
older than the newest event by more than ``delay`` are closed, their state is
dropped, and rows that come later than that are not counted. Each trigger writes
only the spans it changed, tagged with its epoch, to a log; the last epoch of a
span counts. A trigger that is repeated after a failure writes the same rows again, so
nothing is counted twice, and no trigger rewrites the result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import col_
from ..sources.logs import LogTable

SPAN_SCHEMA = "span_start timestamp, span_end timestamp, value_sum double, value_count bigint, epoch bigint"


def span_sums(stream: DataFrame, date_col: str, metric_col: str, span: str = "1 day", delay: str = "0 seconds",
              key: list[str] | None = None) -> DataFrame:
    """Streaming sum and count of ``metric_col`` per span of ``date_col``.

    Rows without a date or value (null, NaN) do not count. With ``key``, a row whose key was
    seen within ``delay`` is a repetition and is left out; the keys are state of the same bound.
    """
    keys = [f"_k{i}" for i in range(len(key or []))]
    rows = stream.select(col_(date_col).cast("timestamp").alias("at"), col_(metric_col).cast("double").alias("v"),
                         *[col_(c).alias(k) for c, k in zip(key or [], keys, strict=True)])
    rows = rows.where(F.col("at").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v")).withWatermark("at", delay)
    if keys:
        rows = rows.dropDuplicatesWithinWatermark(keys)
    return (rows.groupBy(F.window("at", span).alias("w")).agg(F.sum("v").alias("value_sum"), F.count("v").alias("value_count"))
            .select(F.col("w.start").alias("span_start"), F.col("w.end").alias("span_end"), "value_sum", "value_count"))


def span_log(spark: SparkSession, path: str) -> LogTable:
    return LogTable(spark, path, SPAN_SCHEMA, key=["span_start"], order="epoch")


def run_span_stream(spark: SparkSession, source_dir: str, schema: T.StructType, date_col: str, metric_col: str,
                    out: str, checkpoint: str, span: str = "1 day", delay: str = "0 seconds", key: list[str] | None = None,
                    fmt: str = "parquet", files_per_trigger: int = 4) -> None:
    """Process the files that are now in ``source_dir`` and not yet in ``checkpoint``; changed spans go to ``out``."""
    stream = (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(source_dir))
    log = span_log(spark, out)

    def upsert(batch: DataFrame, epoch_id: int):
        log.append(batch.withColumn("epoch", F.lit(epoch_id).cast("bigint")))

    q = (span_sums(stream, date_col, metric_col, span, delay, key).writeStream.outputMode("update")
         .foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def spans(spark: SparkSession, out: str) -> DataFrame:
    """The latest sum and count of each span."""
    last = F.max_by(F.struct("span_end", "value_sum", "value_count"), "epoch").alias("r")
    return span_log(spark, out).read().groupBy("span_start").agg(last).select("span_start", "r.*")


def monthly(spark: SparkSession, out: str) -> DataFrame:
    """Spans of at most a day, rolled up to calendar months: period, value_sum, value_count, value_mean."""
    return (spans(spark, out).groupBy(F.date_format("span_start", "yyyy-MM").alias("period"))
            .agg(F.sum("value_sum").alias("value_sum"), F.sum("value_count").alias("value_count"))
            .withColumn("value_mean", F.col("value_sum") / F.col("value_count")))
