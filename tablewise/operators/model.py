"""Split, fit, score, importances, promotion, ranges and what-if.

The learner is that of Spark ML's gradient-boosted trees (``boosting``). More than two
classes are fitted one-vs-rest (one binary booster per class) and the class
probabilities are normalised, since Spark's boosted classifier is binary.
"""
from __future__ import annotations

import datetime as _dt
import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import stats as S
from ..functions.scalars import col_
from ..session import scratch_path
from .boosting import GBTClassifier, GBTRegressor, binned

# Bytes of assembled training rows in one partition, at most; and those that are worth a task of their own.
FIT_PARTITION_BYTES = 16 << 20
FIT_TASK_BYTES = 2 << 20

MAX_BINS = 64  # of a feature

_BLOCK_BITS = 20  # hash order is cut into 2^20 blocks per stratum


# --------------------------------------------------------------------------- #
# M1 holdout split
# --------------------------------------------------------------------------- #
def stratum_quotas(strata: DataFrame, n: int, n_test: int) -> DataFrame:
    """Largest-remainder allocation of ``n_test`` of ``n`` rows over strata (s, n): adds ``quota``.

    Ties go by label. A row a stratum, ranked by a distributed sort, so the number of
    strata is not limited.
    """
    from ..plans.ordering import ordered_index
    share = strata.withColumn("base", F.expr(f"({n_test} * n) div {n}")).withColumn(
        "order", F.struct((-F.expr(f"({n_test} * n) % {n}")).alias("rest"), F.col("s").alias("label")))
    ranked = ordered_index(share, "order", "place")
    extra = n_test - (ranked.agg(F.sum("base")).first()[0] or 0)
    return ranked.select("s", "n", (F.col("base") + (F.col("place") < extra).cast("bigint")).alias("quota"))


def holdout_split(df: DataFrame, key: str, target: str | None = None, task: str = "regression",
                  test_size: float = K.TEST_SIZE, seed: int = K.RANDOM_STATE) -> tuple[DataFrame, dict]:
    """Add boolean ``is_test``: an exact ceil(test_size * n) rows, stratified by class when
    there is more than one class and every class has at least two rows.

    Rows are ordered by xxhash64(key, seed), so the split is fixed for a table
    whatever its partitioning. Per-stratum quotas are met without sorting a
    stratum in one task: counts per (stratum, hash block) locate the block
    holding each quota boundary, and only that block's rows are ranked. Quotas and
    boundaries stay tables (a row a stratum) that are joined to the rows.
    Under 10 rows every row is both train and test. ``info["strata"]`` holds (s, n, quota).
    """
    strat = F.lit("_all")
    info = {"stratified": False, "train_on_all": False}
    whole = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if task == "classification" and target is not None:
        label = F.coalesce(col_(target).cast("string"), F.lit(""))
        sizes = df.groupBy(label.alias("s")).agg(F.count(F.lit(1)).alias("n"))
        seen = sizes.agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
        if seen["k"] > 1 and seen["least"] >= 2:
            strat, info["stratified"] = label, True
    if whole < K.MIN_ROWS_FOR_HOLDOUT:
        info.update(train_on_all=True, n_test=whole, n_train=whole)
        return df.withColumn("is_test", F.lit(True)), info
    n_test = math.ceil(test_size * whole)
    h = F.xxhash64(col_(key), F.lit(seed))
    blk = (F.shiftright(h, 64 - _BLOCK_BITS) + F.lit(1 << (_BLOCK_BITS - 1))).cast("int")
    d = df.withColumn("_s", strat).withColumn("_h", h).withColumn("_b", blk)
    spark = df.sparkSession

    def kept(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    blocks = kept(d.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n")), "split-blocks")
    strata = stratum_quotas(blocks.groupBy(F.col("_s").alias("s")).agg(F.sum("_n").alias("n")), whole, n_test)
    w = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (blocks.withColumn("_cum", F.sum("_n").over(w)).join(strata.select(F.col("s").alias("_s"), "quota"), "_s")
             .where((F.col("_cum") >= F.col("quota")) & (F.col("quota") > 0))
             .groupBy("_s").agg(F.min(F.struct("_b", "_cum", "_n", "quota")).alias("e"))
             .select("_s", F.col("e._b").alias("_eb"), (F.col("e.quota") - F.col("e._cum") + F.col("e._n")).alias("_need")))
    edges = kept(edges, "split-edges")
    # rank inside the boundary blocks only (about n / 2^20 rows per stratum)
    rank = Window.partitionBy("_s").orderBy("_h", col_(key))
    last = (d.join(edges, "_s").where(F.col("_b") == F.col("_eb")).withColumn("_r", F.row_number().over(rank))
            .where(F.col("_r") == F.col("_need")).select("_s", "_eb", F.col("_h").alias("_lh"), col_(key).alias("_lk")))
    last = kept(last, "split-last")
    in_test = ((F.col("_b") < F.col("_eb")) | ((F.col("_b") == F.col("_eb")) & (
        (F.col("_h") < F.col("_lh")) | ((F.col("_h") == F.col("_lh")) & (col_(key) <= F.col("_lk"))))))
    out = (d.join(last, "_s", "left").withColumn("is_test", F.coalesce(in_test, F.lit(False)))
           .select(*[col_(c) for c in df.columns], "is_test"))
    info.update(n_test=n_test, n_train=whole - n_test, strata=strata)
    return out, info


# --------------------------------------------------------------------------- #
# M2 fit
# --------------------------------------------------------------------------- #
class FittedModel:
    """A fitted booster, one booster per class, or (``coded``: the number of classes) one per bit of the class code,
    with its feature assembler."""

    def __init__(self, task, feature_cols, target, classes, models, assembler, coded=None):
        self.task, self.feature_cols, self.target = task, feature_cols, target
        self.classes, self.models, self.assembler, self.coded = classes, models, assembler, coded

    @property
    def model_type(self) -> str:
        if self.task == "regression":
            return "GBTRegressor"
        if self.coded:
            return "GBTClassifier(bits)"
        return "GBTClassifier" if len(self.models) == 1 else "GBTClassifier(one-vs-rest)"

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (double: value, or class code) and, for classes, ``confidence`` and ``probs`` (array).

        A coded model has no probability for every class: its confidence is the product of the bits' and ``probs`` is null.
        """
        x = self.assembler.transform(df)
        if self.task == "regression":
            return self.models[0].transform(x).drop("_features")
        if self.coded:
            return self._decoded(x)
        return self._classes(x).withColumn("confidence", F.array_max("probs"))

    def _decoded(self, x: DataFrame) -> DataFrame:
        x, bits = self._side_by_side(x)
        code, sure = F.lit(0.0), F.lit(1.0)
        for i, p in enumerate(bits):
            code = code + F.when(p >= 0.5, float(1 << i)).otherwise(0.0)
            sure = sure * F.greatest(p, 1 - p)
        # codes beyond the last class exist where the classes are no power of two
        x = x.withColumns({"prediction": F.least(code, F.lit(float(self.coded - 1))), "confidence": sure,
                           "probs": F.lit(None).cast("array<double>")})
        return x.drop(*self._own())

    def _own(self) -> list[str]:
        return ["_features"] + [f"_{t}{i}" for i in range(len(self.models)) for t in "pv"]

    def _side_by_side(self, x: DataFrame) -> tuple:
        """Every booster's probability of a yes, as columns. No other output is asked for: each walks all trees again."""
        for i, m in enumerate(self.models):
            x = m.copy().setProbabilityCol(f"_v{i}").setRawPredictionCol("").setPredictionCol("").transform(x)
        x = x.withColumns({f"_p{i}": vector_to_array(F.col(f"_v{i}"))[1] for i in range(len(self.models))})
        return x, [F.col(f"_p{i}") for i in range(len(self.models))]

    def _classes(self, x: DataFrame) -> DataFrame:
        if len(self.models) == 1:
            m = self.models[0]
            out = m.transform(x)
            return (out.withColumn("probs", vector_to_array(F.col("probability")))
                       .drop("_features", "rawPrediction", "probability"))
        x, ps = self._side_by_side(x)
        tot = sum(ps[1:], ps[0])
        probs = F.array(*[p / tot for p in ps])
        x = x.withColumn("probs", probs)
        pred = (F.array_position(F.col("probs"), F.array_max(F.col("probs"))) - 1).cast("double")
        return x.withColumn("prediction", pred).drop(*self._own())

    def importances(self) -> list[tuple[str, float]]:
        acc = [0.0] * len(self.feature_cols)
        for m in self.models:
            v = m.featureImportances.toArray()
            for i in range(len(acc)):
                acc[i] += float(v[i]) / len(self.models)
        pairs = list(zip(self.feature_cols, acc))
        return sorted(pairs, key=lambda kv: kv[1], reverse=True)

    def save(self, path: str) -> None:
        # each booster is written by its own small jobs; the writes are independent
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=min(len(self.models), 8)) as pool:
            list(pool.map(lambda im: im[1].write().overwrite().save(f"{path}/booster_{im[0]}"), enumerate(self.models)))
        self.assembler.write().overwrite().save(f"{path}/assembler")
        meta = {"task": self.task, "feature_cols": self.feature_cols, "target": self.target,
                "classes": self.classes, "n_models": len(self.models), "coded": self.coded}
        from ..sources.sinks import write_json
        write_json(_active(), meta, f"{path}/meta.json")

    @staticmethod
    def load(path: str) -> "FittedModel":
        from ..sources.sinks import read_json_doc
        meta = read_json_doc(_active(), f"{path}/meta.json")
        cls = GBTRegressionModel if meta["task"] == "regression" else GBTClassificationModel
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=min(meta["n_models"], 8)) as pool:
            models = list(pool.map(lambda i: cls.load(f"{path}/booster_{i}"), range(meta["n_models"])))
        assembler = PipelineModel.load(f"{path}/assembler")
        return FittedModel(meta["task"], meta["feature_cols"], meta["target"], meta["classes"], models, assembler,
                           meta.get("coded"))


def _active():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def _cores(spark) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # a remote session has no local context
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fit_partitions(size: int, cores: int, together: int = 1) -> int:
    """Partitions of ``size`` bytes of training rows: every core gets its part of a round once tasks are worth it,
    and above FIT_PARTITION_BYTES a core all cores get the same number, so that no core waits for a last few.
    Boosters fitted ``together`` share the cores: each fills its share only, with tasks that are worth as much more."""
    least = max(1, math.ceil(size / FIT_PARTITION_BYTES))
    if least > cores:
        return math.ceil(least / cores) * cores
    return max(least, min(cores // together, size // (FIT_TASK_BYTES * together)))


def fit_model(train: DataFrame, feature_cols: list[str], target: str, task: str, n_classes: int | None = None,
              trees: int = K.GBT_TREES, max_depth: int = K.GBT_MAX_DEPTH, seed: int = K.RANDOM_STATE,
              parallelism: int = 8) -> FittedModel:
    """Gradient-boosted trees: rate 0.1, row and feature sampling 0.9.

    Above two classes, one binary booster per class is fitted, ``parallelism``
    of them at a time as concurrent jobs (each boosting round is a chain of
    small jobs, so running the classes side by side keeps the cores busy; on a
    large input each job's own tasks fill the cluster anyway). Above
    MAX_LISTED_CLASSES the classes' codes are learned bit by bit: log2(classes) boosters.
    """
    from pyspark.ml import Pipeline
    assembler = Pipeline(stages=[VectorAssembler(inputCols=feature_cols, outputCol="_features",
                                                 handleInvalid="keep")]).fit(train.limit(0))
    k = n_classes or 2
    coded = task != "regression" and k > K.MAX_LISTED_CLASSES
    boosters = 1 if task == "regression" or k <= 2 else (k - 1).bit_length() if coded else k
    together = min(boosters, parallelism)
    # each round is a few small jobs: as many partitions as the input's bytes ask for, no more
    n = train.agg(F.count(F.lit(1))).first()[0]
    parts = fit_partitions(n * (len(feature_cols) + 1) * 8, _cores(train.sparkSession), together)
    path = scratch_path(train.sparkSession, "fit")
    rows, cuts = binned(train, feature_cols, target, MAX_BINS)
    rows.repartition(parts).write.parquet(path)
    x = train.sparkSession.read.parquet(path)
    common = dict(featuresCol="_features", maxIter=trees, maxDepth=max_depth, stepSize=K.GBT_LEARNING_RATE,
                  subsamplingRate=K.GBT_ROW_SUBSAMPLE, featureSubsetStrategy=str(K.GBT_FEATURE_SUBSAMPLE),
                  seed=seed, maxBins=MAX_BINS, cuts=cuts, rows=n, partitions=parts, together=together)
    if task == "regression":
        m = GBTRegressor(labelCol="_t", **common).fit(x)
        return FittedModel(task, feature_cols, target, None, [m], assembler)
    if k <= 2:
        m = GBTClassifier(labelCol="_t", **common).fit(x)
        return FittedModel(task, feature_cols, target, list(range(k)), [m], assembler)

    def fit_one(c: int):
        hit = F.floor(F.col("_t") / (1 << c)) % 2 == 1 if coded else F.col("_t") == c
        return GBTClassifier(labelCol="_y", **common).fit(x.withColumn("_y", hit.cast("double")))

    # the per-class boosters are independent: submit them as concurrent Spark jobs
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=together) as pool:
        models = list(pool.map(fit_one, range(boosters)))
    return FittedModel(task, feature_cols, target, None if coded else list(range(k)), models, assembler, k if coded else None)


# --------------------------------------------------------------------------- #
# M3 / M4 importances
# --------------------------------------------------------------------------- #
def feature_importance(spark, model: FittedModel, top: int = K.MAX_TOP_FEATURES) -> DataFrame:
    """Features by importance, descending, first ``top``."""
    rows = [(i + 1, f, v) for i, (f, v) in enumerate(model.importances()[:top])]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def importance_summary(imp: DataFrame) -> DataFrame:
    """Top feature, its share of the shown total, and the two runners-up."""
    w = Window.orderBy("rank")
    d = imp.withColumn("_tot", F.sum("importance").over(Window.partitionBy()))
    return (d.withColumn("_rn", F.row_number().over(w))
             .agg(F.max(F.when(F.col("_rn") == 1, F.col("feature"))).alias("top_feature"),
                  F.max(F.when(F.col("_rn") == 1, F.col("importance") / F.when(F.col("_tot") > 0, F.col("_tot"))
                                .otherwise(F.lit(1.0)) * 100)).alias("top_share_pct"),
                  F.concat_ws(", ", F.sort_array(F.collect_list(F.when(F.col("_rn").between(2, 3),
                                                 F.struct("_rn", "feature")))).getField("feature")).alias("runners_up")))


# --------------------------------------------------------------------------- #
# M5 scoring
# --------------------------------------------------------------------------- #
def score(model: FittedModel, df: DataFrame, key: str, class_names: list[str] | None = None,
          probs: bool = False, labels: DataFrame | None = None) -> DataFrame:
    """Predictions table: row, actual, predicted, and confidence + correct, or abs_error.

    With ``probs`` the probabilities of all classes are kept (column ``probs``). Classes are named by
    the list ``class_names``, or by joins with the table ``labels`` (value, code), else by their codes.
    """
    out = model.transform(df)
    y = col_(model.target)
    if model.task == "regression":
        return out.select(col_(key).alias("row"), y.cast("double").alias("actual"),
                          F.col("prediction").alias("predicted"),
                          F.abs(y.cast("double") - F.col("prediction")).alias("abs_error"))
    if labels is not None and not class_names:
        named = labels.select(F.col("code").cast("bigint").alias("_code"), F.col("value").alias("_value"))
        for code, name in ((y, "_actual"), (F.col("prediction"), "_predicted")):
            out = (out.withColumn("_want", code.cast("bigint")).join(named, F.col("_want") == F.col("_code"), "left")
                   .withColumn(name, F.col("_value")).drop("_want", "_code", "_value"))
        act, prd = F.col("_actual"), F.col("_predicted")
    elif class_names:
        names = F.array(*[F.lit(c) for c in class_names])
        act = F.element_at(names, y.cast("int") + 1)
        prd = F.element_at(names, F.col("prediction").cast("int") + 1)
    else:
        act, prd = y.cast("string"), F.col("prediction").cast("int").cast("string")
    return (out.select(col_(key).alias("row"), act.alias("actual"), prd.alias("predicted"),
                       "confidence", *(["probs"] if probs else []))
               .withColumn("correct", F.col("actual") == F.col("predicted")))


# --------------------------------------------------------------------------- #
# M12 versioned promotion
# --------------------------------------------------------------------------- #
def deploy(spark, model: FittedModel, metrics: dict, base: str, source: str | None,
           n_train: int | None, n_test: int | None, saved: str | None = None) -> dict:
    """Keep the model under a UTC-stamped version, append a registry row, mark it live.

    ``saved`` is the folder of the model if it is saved already: its files are copied.
    """
    from .evaluate import headline, verdict_rule
    now = _dt.datetime.now(_dt.timezone.utc)
    version = now.strftime("%Y%m%dT%H%M%S%f")
    path = f"{base.rstrip('/')}/deployments/{version}"
    from ..sources.sinks import copy_folder, write_json
    if saved:
        copy_folder(spark, saved, path)
    else:
        model.save(path)
    write_json(spark, metrics, f"{path}/metrics.json")  # the version keeps its own metrics copy
    name, value = headline(model.task, metrics)
    _, label, thr = verdict_rule(model.task)
    ok = value is not None and value >= thr
    rec = {"deployed_at": now.isoformat(), "version": version, "status": "healthy" if ok else "weak",
           "status_reason": f"{label} {value:.3f} {'>=' if ok else '<'} {thr}" if value is not None else "no metric",
           "task_type": model.task, "target_name": model.target, "headline_metric": name,
           "headline_value": value, "model_type": model.model_type, "model_path": path,
           "source_dataset": source, "n_train": n_train, "n_test": n_test}
    schema = ("deployed_at string, version string, status string, status_reason string, task_type string, "
              "target_name string, headline_metric string, headline_value double, model_type string, "
              "model_path string, source_dataset string, n_train bigint, n_test bigint")
    row = spark.createDataFrame([tuple(rec[k.split()[0]] for k in schema.split(", "))], schema)
    row.write.mode("append").parquet(f"{base.rstrip('/')}/registry")
    return rec


def registry(spark, base: str) -> DataFrame:
    """All promotions with ``live`` marking the latest one."""
    reg = spark.read.parquet(f"{base.rstrip('/')}/registry")
    last = reg.agg(F.max(F.struct("deployed_at", "version")).alias("m")).first()["m"]
    return reg.withColumn("live", (F.col("deployed_at") == last["deployed_at"]) & (F.col("version") == last["version"]))


# --------------------------------------------------------------------------- #
# M13 / M14
# --------------------------------------------------------------------------- #
def feature_ranges(features: DataFrame, ordered: list[str]) -> DataFrame:
    """min, max, mean per feature (NaN ignored), in the given (importance) order; one aggregation."""
    exprs = {}
    for c in ordered:
        v = col_(c).cast("double")
        v = F.when(~F.isnan(v), v)
        exprs[(c, "min")], exprs[(c, "max")], exprs[(c, "mean")] = F.min(v), F.max(v), F.avg(v)
    st = S.one_row(features, exprs)
    rows = [(i, c, st[(c, "min")], st[(c, "max")], st[(c, "mean")]) for i, c in enumerate(ordered)]
    return features.sparkSession.createDataFrame(rows, "position int, feature string, min double, max double, mean double")


def what_if(model: FittedModel, scenarios: DataFrame, features: str = "features",
            class_names: list[str] | None = None) -> DataFrame:
    """Predictions for scenarios; ``features`` is a struct of feature values, so any number of them
    may be moved at once and no feature's name can clash with a scenario column.

    Regression adds ``prediction``; classes add ``predicted_class``, ``confidence`` and
    ``class_probs`` (one probability a class; null for a coded model).
    """
    keep = [c for c in scenarios.columns if c != features]
    rows = scenarios.select(F.struct(*[col_(c) for c in keep]).alias("_scenario"),
                            *[col_(features).getField(f).cast("double").alias(f) for f in model.feature_cols])
    if "_scenario" in model.feature_cols:
        raise ValueError("a feature is called _scenario")
    pred = model.transform(rows)
    back = [F.col("_scenario").getField(c).alias(c) for c in keep]
    if model.task == "regression":
        return pred.select(*back, F.col("prediction"))
    code = F.col("prediction").cast("int")
    label = F.element_at(F.array(*[F.lit(c) for c in class_names]), code + 1) if class_names else code.cast("string")
    return pred.select(*back, label.alias("predicted_class"), "confidence",
                       F.col("probs").alias("class_probs"))


def what_if_grid(model: FittedModel, ranges: DataFrame, steps: int = 11,
                 max_features: int = K.MAX_WHATIF_FEATURES, class_names: list[str] | None = None) -> DataFrame:
    """Predictions when one influential feature moves across its range, the rest at their means.

    Constant features are skipped; at most 12 features; scenario rows: features x steps.
    Regression: ``baseline`` is the all-means prediction, ``delta`` the change from it. Classes:
    ``baseline_class``, and ``class_changed`` tells whether the predicted class is another one.
    """
    spark = ranges.sparkSession
    rg = {r["feature"]: r for r in ranges.collect()}
    base = {f: float(rg[f]["mean"]) if f in rg and rg[f]["mean"] is not None else 0.0 for f in model.feature_cols}
    movable = [r["feature"] for r in sorted(rg.values(), key=lambda r: r["position"])
               if r["max"] is not None and r["max"] > r["min"]][:max_features]
    rows = [(None, 0, None, tuple(base.values()))]
    for f in movable:
        lo, hi = float(rg[f]["min"]), float(rg[f]["max"])
        for i in range(steps):
            v = lo + (hi - lo) * i / (steps - 1)
            rows.append((f, i, v, tuple(v if g == f else base[g] for g in model.feature_cols)))
    fields = T.StructType([T.StructField(c, T.DoubleType()) for c in model.feature_cols])
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("step", T.IntegerType()),
                           T.StructField("value", T.DoubleType()), T.StructField("features", fields)])
    out = what_if(model, spark.createDataFrame(rows, schema), class_names=class_names)
    rest = out.where(F.col("feature").isNull()).first()
    moved = out.where(F.col("feature").isNotNull())
    if model.task == "regression":
        b = F.lit(rest["prediction"])
        return moved.withColumn("baseline", b).withColumn("delta", F.col("prediction") - b)
    b = F.lit(rest["predicted_class"])
    return moved.withColumn("baseline_class", b).withColumn("class_changed", F.col("predicted_class") != b)
