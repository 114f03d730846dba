"""Inbox of dataset files: listing (S10), content-hash dedupe (S9), and the
incremental run over new or changed files (T1).

The stream carries paths, not rows: every file brings its own schema, so each
new file is read as its own batch job inside ``foreachBatch`` (SURVEY H13).
A dataset is a file at the top of the inbox, or a folder Spark wrote whose
name carries the suffix (``orders.parquet/part-...``).
"""
from __future__ import annotations

import datetime as _dt
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..sources.digests import file_digests
from ..sources.logs import LogTable
from ..sources.sinks import make_folder, path_exists

RUNLOG_SCHEMA = "dataset string, md5 string, run_id string, status string, processed_at string, out string"

# Datasets that run side by side: the rounds of one fit are chains of small jobs that leave cores idle.
RUNS_TOGETHER = 2

_SUFFIX_RE = r"\.(csv|json|parquet)$"


def _dataset_of(inbox: str):
    """Column: the top-level inbox entry a listed file belongs to (full path)."""
    base = inbox.rstrip("/").split("://")[-1].replace("file:", "")
    rel = F.regexp_extract(F.col("path"), r"^.*?" + _escape(base) + r"/(.*)$", 1)
    top = F.split(rel, "/").getItem(0)
    return F.concat(F.regexp_extract(F.col("path"), r"^(.*?" + _escape(base) + r")/", 1), F.lit("/"), top)


def _escape(s: str) -> str:
    import re
    return re.escape(s)


def _files(spark: SparkSession, inbox: str, datasets: list[str] | None = None) -> DataFrame:
    """(path, modificationTime, length, dataset) of the files of supported datasets; no body is read.

    ``datasets`` names the top-level entries to list (default: all of the inbox).
    """
    none = spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, dataset string")
    paths = [inbox] if datasets is None else datasets
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return none
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
             .select("path", "modificationTime", "length").withColumn("dataset", _dataset_of(inbox)))
    name = F.element_at(F.split("dataset", "/"), -1)
    return files.where(F.lower(name).rlike(_SUFFIX_RE) & ~name.startswith("."))


def list_inbox(spark: SparkSession, inbox: str) -> DataFrame:
    """Supported datasets at the top of the inbox, oldest first (no file bodies read)."""
    return (_files(spark, inbox).groupBy("dataset")
            .agg(F.max("modificationTime").alias("modified"), F.sum("length").alias("bytes"),
                 F.count(F.lit(1)).alias("n_files")).orderBy("modified", "dataset"))


FILE_KEY = ["path", "length", "modificationTime"]
INDEX_SCHEMA = "path string, length bigint, modificationTime timestamp, digest string, bytes_read bigint, seen_at double"


def file_index(spark: SparkSession, path: str) -> LogTable:
    """The table of hashed files: one digest for each (path, length, modification time) that was met."""
    return LogTable(spark, path, INDEX_SCHEMA, key=["path"], order="seen_at")


def known_digests(files: DataFrame, index: LogTable) -> DataFrame:
    """``files`` with their digests; only files that the index does not know are read, and then added to it."""
    known = index.read().select(*FILE_KEY, "digest").dropDuplicates(FILE_KEY)
    fresh = files.select(*FILE_KEY).distinct().join(known, FILE_KEY, "left_anti")
    if fresh.limit(1).count():
        index.append(fresh.join(file_digests(fresh), "path").withColumn("seen_at", F.lit(time.time()))
                     .select(*[c.split()[0] for c in INDEX_SCHEMA.split(", ")]))
        known = index.read().select(*FILE_KEY, "digest").dropDuplicates(FILE_KEY)
    return files.join(known, FILE_KEY)


def dataset_hashes(spark: SparkSession, inbox: str, index: LogTable | None = None,
                   files: DataFrame | None = None) -> DataFrame:
    """(dataset, md5, modified, bytes, n_files) for every dataset of ``files`` (default: the whole inbox).

    Files are hashed in chunks by executors; with an ``index`` only those that are new or whose
    length or time has changed. File digests of a dataset are combined
    by an order-free sum, so no list of a dataset's files is gathered.
    """
    files = _files(spark, inbox) if files is None else files
    hashed = known_digests(files, index) if index else files.join(file_digests(files.select("path", "length")), "path")
    within = F.md5(F.concat_ws(":", F.substring_index("path", "/", -1), "digest"))
    parts = [F.conv(F.substring(within, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)") for i in range(4)]
    return (hashed.withColumns({f"_p{i}": p for i, p in enumerate(parts)}).groupBy("dataset")
            .agg(F.max("modificationTime").alias("modified"), F.sum("length").alias("bytes"),
                 F.count(F.lit(1)).alias("n_files"),
                 F.md5(F.concat_ws(",", F.count(F.lit(1)).cast("string"),
                                   *[F.sum(f"_p{i}").cast("string") for i in range(4)])).alias("md5")))


def run_log(spark: SparkSession, path: str) -> LogTable:
    """The log of processed datasets, one row a run."""
    return LogTable(spark, path, RUNLOG_SCHEMA)


def read_runlog(spark: SparkSession, runlog: str) -> DataFrame:
    """The rows of the run log; empty before the first run. An unreadable log raises."""
    return run_log(spark, runlog).read()


def pending(spark: SparkSession, inbox: str, runlog: str, index: LogTable | None = None,
            files: DataFrame | None = None) -> DataFrame:
    """Datasets whose (path, content hash) has no successful run yet, oldest first.

    A failed run is not remembered, so the same content is tried again.
    """
    done = read_runlog(spark, runlog).where(F.col("status") == "success").select("dataset", "md5")
    found = dataset_hashes(spark, inbox, index, files)
    return found.join(done, ["dataset", "md5"], "left_anti").orderBy("modified", "dataset")


def process_pending(spark: SparkSession, inbox: str, runlog: str, out_root: str, logs: str, trees: int,
                    index: LogTable | None = None, files: DataFrame | None = None, tried: set | None = None) -> list[dict]:
    """Run the whole flow for each pending dataset, oldest first, RUNS_TOGETHER of them side by side.

    Each run has its own folder; they are monitored and logged one at a time, oldest first. ``tried`` holds
    the (dataset, hash) that are not to be tried again now; what is run here is added to it.
    """
    from ..plans.run import RUN_BEFORE, run_dataset
    tried = set() if tried is None else tried
    todo = pending(spark, inbox, runlog, index, files).select("dataset", "md5").collect()  # one row per new file

    def one(row, before) -> dict:
        RUN_BEFORE.set(before)
        stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        out = f"{out_root.rstrip('/')}/{stamp}-{row['md5'][:8]}"  # two runs may begin at the same time
        return run_dataset(spark, row["dataset"], out, logs, trees=trees) | {"out": out}

    results, runs, trouble = [], [], None
    with ThreadPoolExecutor(max_workers=RUNS_TOGETHER) as pool:
        for row in todo:
            if tuple(row) in tried:
                continue
            tried.add(tuple(row))
            runs.append((row, pool.submit(one, row, runs[-1][1] if runs else None)))
        for row, run in runs:
            try:
                m = run.result()
            except Exception as failure:  # no run was made; those beside it are logged all the same
                trouble = trouble or failure
                pool.shutdown(wait=False, cancel_futures=True)
                continue
            rec = (row["dataset"], row["md5"], m["run_id"], m["status"], _dt.datetime.now(_dt.timezone.utc).isoformat(), m["out"])
            run_log(spark, runlog).append(spark.createDataFrame([rec], RUNLOG_SCHEMA))
            results.append({"dataset": row["dataset"], "status": m["status"], "out": m["out"]})
    if trouble:
        raise trouble
    return results


def new_files(spark: SparkSession, inbox: str, per_trigger: int) -> DataFrame:
    """Stream of (path, length, modificationTime) of files that appear in the inbox; no body is read."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return (spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", per_trigger).load(inbox).select(*FILE_KEY))


def stream_inbox(spark: SparkSession, inbox: str, work: str, trees: int = K.GBT_TREES,
                 available_now: bool = True, checkpoint: str | None = None, interval: str = "5 seconds",
                 recheck: int = 60, files_per_trigger: int = 1000):
    """Process new and rewritten datasets of the inbox, oldest first.

    New files come from a checkpointed file source, ``files_per_trigger`` at a time, and only
    the datasets they belong to are looked at. The source knows paths only, so a file
    rewritten in place would be missed: at the start, and every ``recheck`` seconds (a
    clock runs beside the source), the whole inbox is listed and compared with the index of
    hashed files by length and time. What differs is hashed, by chunks, and nothing else;
    datasets whose content has no successful run are run. A file rewritten
    with the same length within one clock tick of its file system is not noticed.

    A restart continues from the checkpoint; a batch that is repeated after a failure finds its
    files in the index and its datasets in the log. Returns the started query (already finished
    when ``available_now``).
    """
    work = work.rstrip("/")
    runlog, out_root, logs = f"{work}/runlog", f"{work}/runs", f"{work}/logs"
    checkpoint = checkpoint or f"{work}/_checkpoint"
    index = file_index(spark, f"{work}/files")
    make_folder(spark, inbox)
    tried: set = set()
    process_pending(spark, inbox, runlog, out_root, logs, trees, index, tried=tried)
    clock = (spark.readStream.format("rate").option("rowsPerSecond", 1).load().where(F.pmod("value", F.lit(recheck)) == 0)
             .select(F.lit(None).cast("string").alias("path"), F.lit(None).cast("bigint").alias("length"),
                     F.col("timestamp").alias("modificationTime")))
    events = new_files(spark, inbox, files_per_trigger).unionByName(clock)

    def on_batch(batch: DataFrame, epoch_id: int):
        session = batch.sparkSession
        told = batch.withColumn("dataset", _dataset_of(inbox)).select(
            F.col("path").isNull().alias("tick"), "dataset").distinct().collect()  # one row a dataset
        if any(r["tick"] for r in told):
            tried.clear()  # a failed dataset is tried again at every recheck and every start
            process_pending(session, inbox, runlog, out_root, logs, trees, index, tried=tried)
            return
        touched = sorted({r["dataset"] for r in told})
        if touched:
            process_pending(session, inbox, runlog, out_root, logs, trees, index, _files(session, inbox, touched), tried)

    w = events.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
