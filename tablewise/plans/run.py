"""One dataset end to end: ingest, clean, features, train, evaluate, deploy, report,
then monitor (T3, D1-D4, A13).

Stages hand over through written tables, as the original hands over files:
each stage reads its input back from Parquet, so lineage is cut at every
stage and a lost executor only recomputes work inside one stage.
"""
from __future__ import annotations

import datetime as _dt
import os
import time
import traceback
from concurrent.futures import wait
from contextvars import ContextVar

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import clean as C
from ..operators import drift as D
from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import model as M
from ..operators import profile as P
from ..operators import report as R
from ..sources import readers as RD
from ..sources.logs import LogTable
from ..sources.sinks import read_json_doc, write_json, write_table

ROW_KEY = "_row_id"

# Of runs side by side: the future of the run before this one. Its monitor comes first, so that drift and history
# are those of one run after the other.
RUN_BEFORE: ContextVar = ContextVar("RUN_BEFORE", default=None)


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


class Run:
    """Paths and settings of one run; every artifact lives under ``out``."""

    def __init__(self, spark: SparkSession, source: str, out: str, logs: str, trees: int, target: str | None):
        self.spark, self.source, self.out, self.logs = spark, source, out.rstrip("/"), logs.rstrip("/")
        self.trees, self.target = trees, target

    def p(self, name: str) -> str:
        return f"{self.out}/{name}"


# --------------------------------------------------------------------------- #
# stages
# --------------------------------------------------------------------------- #
def stage_ingest(r: Run):
    df, meta = RD.ingest(r.spark, r.source)
    if ROW_KEY in df.columns:
        raise ValueError(f"column name {ROW_KEY} is reserved")
    df = in_file_order(df)
    write_table(df, r.p("raw.parquet"))
    write_json(r.spark, meta, r.p("ingest_meta.json"))
    return r.p("raw.parquet")


def in_file_order(df):
    """Add the row key: position by (file, place of its block in the file, place in the block).

    Spark packs files into tasks by size, so a task's number says nothing about order.
    """
    from .ordering import ordered_index
    block = F.input_file_block_start()
    # rows of one block are read by one task, in order; a whole-file reader gives block 0
    keyed = df.withColumn(ROW_KEY, F.struct(F.input_file_name().alias("file"), block.alias("block"),
                                            F.monotonically_increasing_id().alias("row")))
    return ordered_index(keyed, ROW_KEY, ROW_KEY)


def stage_clean(r: Run):
    raw = r.spark.read.parquet(r.p("raw.parquet"))
    cleaned, report = C.clean(raw, key=ROW_KEY)
    report["cleaned_at"] = _now()
    write_table(cleaned, r.p("cleaned.parquet"))
    write_json(r.spark, report, r.p("clean_report.json"))
    return r.p("cleaned.parquet")


def stage_features(r: Run):
    cleaned = r.spark.read.parquet(r.p("cleaned.parquet"))
    feats, meta = FE.engineer(cleaned, target=r.target, key=ROW_KEY, labels=r.p("labels.parquet"))
    write_table(feats, r.p("features.parquet"))
    meta["engineered_at"] = _now()
    meta["n_rows"] = r.spark.read.parquet(r.p("features.parquet")).count()
    write_json(r.spark, meta, r.p("feature_meta.json"))
    return r.p("features.parquet")


def stage_train(r: Run):
    meta = read_json_doc(r.spark, r.p("feature_meta.json"))
    feats = r.spark.read.parquet(r.p("features.parquet"))
    split, info = M.holdout_split(feats, ROW_KEY, meta["target_name"], meta["task_type"])
    write_table(split, r.p("split.parquet"))  # decided once: scoring uses the same rows
    split = r.spark.read.parquet(r.p("split.parquet"))
    train = split if info["train_on_all"] else split.where(~F.col("is_test"))
    model = M.fit_model(train, meta["feature_columns"], meta["target_name"], meta["task_type"],
                        meta["n_classes"], trees=r.trees)
    model.save(r.p("model"))
    tm = {"trained_at": _now(), "task_type": meta["task_type"], "target_name": meta["target_name"],
          "feature_columns": meta["feature_columns"], "model_type": model.model_type,
          "model_params": {"trees": r.trees, "max_depth": K.GBT_MAX_DEPTH, "learning_rate": K.GBT_LEARNING_RATE,
                           "row_subsample": K.GBT_ROW_SUBSAMPLE, "feature_subsample": K.GBT_FEATURE_SUBSAMPLE,
                           "seed": K.RANDOM_STATE},
          "n_train": info["n_train"], "n_test": info["n_test"], "stratified": info["stratified"],
          "feature_importances": dict(model.importances()), "n_classes": meta["n_classes"],
          "class_names": meta["class_names"]}
    write_json(r.spark, tm, r.p("train_meta.json"))
    return r.p("model")


def stage_evaluate(r: Run):
    meta = read_json_doc(r.spark, r.p("feature_meta.json"))
    model = M.FittedModel.load(r.p("model"))
    # every test row is marked; where all rows train, all are marked too
    test = r.spark.read.parquet(r.p("split.parquet")).where(F.col("is_test"))
    classes = meta["task_type"] == "classification"
    # class probabilities travel with the predictions, so the model is applied once
    labels = r.spark.read.parquet(r.p("labels.parquet")) if classes else None
    preds = M.score(model, test, ROW_KEY, meta["class_names"], probs=classes, labels=labels)
    preds.write.mode("overwrite").parquet(r.p("predictions.parquet"))
    preds = r.spark.read.parquet(r.p("predictions.parquet"))
    if classes:
        m = EV.classification_metrics(preds).first().asDict()
        names = meta["class_names"]
        # the same form at any number of classes: the labels and the cells that occur, as tables; few labels as a list too
        EV.pair_counts(preds).write.mode("overwrite").parquet(r.p("confusion.parquet"))
        m.update(n_classes=meta["n_classes"], class_names=names, label_table=r.p("labels.parquet"),
                 confusion_cells=r.p("confusion.parquet"))
        names = names or []  # no ranking of all classes where they have no probability each
        aucs = preds.select("actual", *[F.col("probs")[i].alias(f"p{i}") for i in range(len(names))])
        for row in EV.roc_auc(aucs, "actual", {c: f"p{i}" for i, c in enumerate(names)}).collect():
            m[row["metric"]] = row["value"]
        m["headline_metric"], m["headline_value"] = "accuracy", m["accuracy"]
    else:
        m = EV.regression_metrics(preds).first().asDict()
        if m.get("mape") is None:
            m.pop("mape", None)
        m["headline_metric"], m["headline_value"] = "r2", m["r2"]
    m.update(task_type=meta["task_type"], target_name=meta["target_name"], n_test=m.pop("n"), evaluated_at=_now())
    write_json(r.spark, m, r.p("metrics.json"))
    return r.p("metrics.json")


def stage_deploy(r: Run):
    metrics = read_json_doc(r.spark, r.p("metrics.json"))
    tm = read_json_doc(r.spark, r.p("train_meta.json"))
    im = read_json_doc(r.spark, r.p("ingest_meta.json")) or {}
    model = M.FittedModel.load(r.p("model"))
    rec = M.deploy(r.spark, model, metrics, r.out, im.get("source_name"), tm.get("n_train"), tm.get("n_test"),
                   saved=r.p("model"))
    rec["live_model_path"] = r.p("model")
    write_json(r.spark, rec, r.p("deployment.json"))
    return r.p("deployment.json")


def stage_report(r: Run):
    s = r.spark
    docs = {n: read_json_doc(s, r.p(f"{n}.json")) for n in
            ("ingest_meta", "clean_report", "feature_meta", "train_meta", "metrics", "deployment")}
    bundle = R.generate(s, s.read.parquet(r.p("cleaned.parquet")), s.read.parquet(r.p("features.parquet")),
                        ROW_KEY, docs["ingest_meta"], docs["clean_report"], docs["feature_meta"],
                        docs["train_meta"], docs["metrics"], docs["deployment"], r.p("model"))
    write_json(s, bundle, r.p("dashboard_data.json"))
    return r.p("dashboard_data.json")


STAGE_FUNCS = (("ingestor", stage_ingest), ("cleaner", stage_clean), ("feature_eng", stage_features),
               ("trainer", stage_train), ("evaluator", stage_evaluate), ("deployer", stage_deploy),
               ("dashboard_gen", stage_report))


# --------------------------------------------------------------------------- #
# run + monitor
# --------------------------------------------------------------------------- #
STAGE_SCHEMA = ("run_id string, position int, name string, status string, duration_seconds double, "
                "output string, error string, traceback string, at string")


class StageLog:
    """Results of stages as rows of a table (one appended row an event); the manifest is read off them."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.run_id = spark, run_id
        self.table = LogTable(spark, path, STAGE_SCHEMA)
        self.events: list[tuple] = []

    def note(self, position: int, name: str, status: str, seconds: float | None = None, output: str | None = None,
             failure: BaseException | None = None) -> None:
        error = f"{type(failure).__name__}: {failure}" if failure else None
        trace = "".join(traceback.format_exception(failure)) if failure else None
        event = (self.run_id, position, name, status, seconds, output, error, trace, _now())
        self.events.append(event)
        self.table.append(self.spark.createDataFrame([event], STAGE_SCHEMA))

    def stages(self) -> list[dict]:
        """The latest event of each stage, in order of position."""
        names = [f.split()[0] for f in STAGE_SCHEMA.split(", ")]
        latest = {e[1]: dict(zip(names, e, strict=True)) for e in self.events}
        keep = ("name", "status", "duration_seconds", "output", "error", "traceback")
        return [{k: latest[p][k] for k in keep if k not in ("output", "traceback") or latest[p][k] is not None}
                for p in sorted(latest)]


def run_dataset(spark: SparkSession, source: str, out: str, logs: str | None = None,
                trees: int = K.GBT_TREES, target: str | None = None, monitor: bool = True) -> dict:
    """Run the stages over one dataset; the first that fails ends the run.

    Writes ``stages`` (a row an event, while the run goes on) and ``manifest.json``. A
    failing monitor is reported in the manifest and does not fail the run.
    """
    home = out.rstrip("/")
    run = Run(spark, source, home, logs or f"{os.path.dirname(home)}/logs", trees, target)
    head = {"run_id": _now(), "source_csv": source, "source_name": os.path.basename(source.rstrip("/"))}
    log = StageLog(spark, run.p("stages"), head["run_id"])
    begun, clock = _now(), time.perf_counter()

    def manifest(status: str) -> dict:
        over = status != "running"
        doc = head | {"status": status, "started_at": begun, "finished_at": _now() if over else None,
                      "duration_seconds": round(time.perf_counter() - clock, 3) if over else None, "stages": log.stages()}
        write_json(spark, doc, run.p("manifest.json"))
        return doc

    manifest("running")
    failure = None
    for position, (name, work) in enumerate(STAGE_FUNCS):
        log.note(position, name, "running")
        at = time.perf_counter()
        output, failure = _attempt(work, run)
        log.note(position, name, "failed" if failure else "success", round(time.perf_counter() - at, 3), output, failure)
        if failure:
            break
    doc = manifest("failed" if failure else "success")
    if monitor:
        if RUN_BEFORE.get() is not None:
            wait([RUN_BEFORE.get()])
        seen, trouble = _attempt(lambda r: observe(spark, doc, r), run)
        doc |= {"monitor_error": f"{type(trouble).__name__}: {trouble}"} if trouble else {"monitor": seen}
    return doc


def _attempt(work, run: Run) -> tuple:
    """(result, None) or (None, the exception)."""
    try:
        return work(run), None
    except Exception as failure:
        return None, failure


def observe(spark: SparkSession, manifest: dict, r: Run) -> dict:
    """Artifact health, metrics, drift against the previous run, run log and history."""
    health = [row.asDict() for row in D.artifact_health(spark, r.out).collect()]
    present = {a["artifact"] for a in health if a["present"]}
    metrics = read_json_doc(spark, r.p("metrics.json")) or {} if "metrics.json" in present else {}
    if "features.parquet" in present:
        current = P.column_stats(spark.read.parquet(r.p("features.parquet")).drop(ROW_KEY))
    else:  # the run ended before its features
        current = spark.createDataFrame([], D.STATS_SCHEMA)
    events, _prev = D.carry_over(spark, f"{r.logs}/column_stats", current, manifest["run_id"])
    drift = [row.asDict() for row in events.where("is_event").collect()]
    rec = (manifest["run_id"], _now(), manifest["source_name"], manifest["status"], manifest["duration_seconds"],
           metrics.get("headline_metric"), metrics.get("headline_value"), len(drift),
           sum(1 for a in health if a["present"]), sum(1 for a in health if not a["present"]))
    log = LogTable(spark, f"{r.logs}/runs", D.RUN_SCHEMA)
    log.append(spark.createDataFrame([rec], D.RUN_SCHEMA))
    runs = log.read()
    hist = D.run_history(runs).first().asDict()
    last = [row.asDict() for row in D.recent_runs(runs).limit(K.RECENT_RUNS).collect()]
    summary = {"generated_at": _now(), "run": {k: manifest[k] for k in ("run_id", "status", "duration_seconds")},
               "stages": [{k: s.get(k) for k in ("name", "status", "duration_seconds", "error")} for s in manifest["stages"]],
               "artifact_health": health, "model_metrics": metrics, "drift_events": drift, "history": hist, "recent_runs": last}
    write_json(spark, summary, f"{r.logs}/monitor.json")
    return summary
