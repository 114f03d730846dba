"""The booster against Spark's own; models do not depend on how the rows lie; bin borders."""
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tablewise.operators import boosting as B
from tablewise.operators import model as M

COLS = ["a", "b", "c"]
SAME = dict(featuresCol="_features", maxIter=12, maxDepth=4, stepSize=0.1, subsamplingRate=1.0, seed=3, maxBins=64)


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(1)
    a, b, c = r.integers(0, 50, 1500), r.integers(-3, 4, 1500), r.integers(0, 2, 1500)
    y = np.sin(a / 5) * 10 + b * c + r.integers(0, 100, 1500) / 50
    rows = [(i, float(p), float(q), float(s), float(t), float(t > 4), i % 3)
            for i, (p, q, s, t) in enumerate(zip(a, b, c, y, strict=True))]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y double, yes double, kind int").cache()


def outputs(model, x, classes):
    out = vector_to_array("probability")[1] if classes else F.col("prediction")
    return np.array([r[1] for r in sorted(model.transform(x).select("k", out).collect())])


@pytest.mark.parametrize("classes", [False, True])
def test_booster_without_samples_is_that_of_spark(frame, classes):
    label, spark_own, own = ("yes", GBTClassifier, B.GBTClassifier) if classes else ("y", GBTRegressor, B.GBTRegressor)
    x = VectorAssembler(inputCols=COLS, outputCol="_features").transform(frame)
    want = spark_own(labelCol=label, **SAME).fit(x)
    rows, cuts = B.binned(frame, COLS, label, 64)
    assert [len(c) for c in cuts] == [49, 6, 1]
    got = own(labelCol="_t", cuts=cuts, rows=1500, featureSubsetStrategy="1.0", **SAME).fit(rows)
    assert np.allclose(outputs(got, x, classes), outputs(want, x, classes), rtol=0, atol=1e-9)
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-9)
    assert got.getNumTrees == 12 and got.treeWeights == want.treeWeights and got.totalNumNodes == want.totalNumNodes
    impurity = [m.trees[1]._call_java("rootNode").impurity() for m in (got, want)]
    assert abs(impurity[0] - impurity[1]) < 1e-6 * impurity[1]


@pytest.mark.parametrize("task,label,k", [("regression", "y", None), ("classification", "kind", 3)])
def test_a_model_does_not_depend_on_the_partitions(spark, frame, monkeypatch, task, label, k):
    """Rows were sampled by their place in a partition, and the number of partitions follows the size and the cores."""
    seen = []
    make = M.scratch_path
    monkeypatch.setattr(M, "scratch_path", lambda s, n: seen.append(make(s, n)) or seen[-1])
    found = []
    for task_bytes, rows in ((1 << 20, frame.coalesce(1)), (2000, frame.repartition(5)), (2000, frame.orderBy(F.desc("k")))):
        monkeypatch.setattr(M, "FIT_TASK_BYTES", task_bytes)
        model = M.fit_model(rows, COLS, label, task, k, trees=6, parallelism=1)
        out = model.transform(frame)
        found.append([tuple(map(str, r)) for r in sorted(out.select("k", "prediction", *(["probs"] if k else [])).collect())])
    assert [spark.read.parquet(p).rdd.getNumPartitions() for p in seen] == [1, 4, 4]
    assert found[0] == found[1] == found[2] and len(found[0]) == 1500


def test_tasks_exchange_large_histograms_in_pieces(frame, monkeypatch):
    x = VectorAssembler(inputCols=COLS, outputCol="_features").transform(frame)
    rows, cuts = B.binned(frame, COLS, "y", 64)
    fit = lambda n: outputs(B.GBTRegressor(labelCol="_t", cuts=cuts, rows=1500, partitions=n, featureSubsetStrategy="0.5",
                                           **(SAME | {"subsamplingRate": 0.7, "maxIter": 3})).fit(rows), x, False)
    want = fit(1)
    assert len(set(want)) > 8
    monkeypatch.setattr(B, "EXCHANGE_BYTES", 100)
    monkeypatch.setattr(B, "CHUNK", 64)
    monkeypatch.setattr(B, "GROUP_BINS", 64)
    assert (fit(3) == want).all()


def test_borders_come_from_all_rows(spark):
    """A value of one row among 100,000 is cut off; bins of many values hold about equally many rows, wherever these lie."""
    n, inf = 100_000, float("inf")
    r = np.random.default_rng(2)
    few, many, far = np.where(np.arange(n) == 77, 7.5, np.arange(n) % 3), r.normal(size=n), np.exp(r.normal(size=n) * 30)
    odd = np.where(np.arange(n) % 4 == 0, np.nan, np.where(np.arange(n) % 4 == 1, inf, np.where(np.arange(n) % 4 == 2, -inf, -0.0)))
    df = spark.createDataFrame(pd.DataFrame({"few": few, "many": many, "far": far, "odd": odd, "one": np.ones(n)})).repartition(3)
    cuts = B.feature_cuts(df, 5, 64)
    assert cuts[0].tolist() == [0.5, 1.5, 4.75] and len(cuts[4]) == 0
    assert cuts[3].tolist() == [-inf, 0.0]
    for c, v in ((cuts[1], many), (cuts[2], far)):
        held = np.bincount(np.searchsorted(c, v), minlength=64)
        assert len(c) == 63 and held.min() > 0.7 * n / 64 and held.max() < 1.3 * n / 64


def test_null_labels_and_no_rows_raise(spark, frame):
    for bad in (frame.withColumn("y", F.when(F.col("k") > 0, F.col("y"))), frame.where("k < 0")):
        with pytest.raises(Exception, match="boosted trees|no training rows"):
            M.fit_model(bad, COLS, "y", "regression", trees=2)
