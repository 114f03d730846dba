"""A text target of thousands of values runs to the metrics; labels stay in tables."""
import json
import os

from pyspark.sql import functions as F
from tablewise import constants as K
from tablewise.operators import evaluate as EV
from tablewise.operators import features as FE
from tablewise.operators import model as M
from tablewise.plans.run import run_dataset

import pytest

N = 1500


def table(spark):
    rows = spark.range(2 * N).select((F.col("id") % N).alias("c"), "id")
    return rows.select((F.col("c") * 10 + F.col("id") % 3).cast("double").alias("x"), (F.col("c") % 7).alias("z"),
                       F.format_string("label-%05d", "c").alias("y"))


def test_run_with_many_classes_lists_no_label(spark, tmp_out):
    table(spark).write.parquet(f"{tmp_out}/in/many.parquet")
    done = run_dataset(spark, f"{tmp_out}/in/many.parquet", f"{tmp_out}/run", f"{tmp_out}/logs", trees=2, target="y")
    assert done["status"] == "success" and "monitor_error" not in done, done
    metrics = json.load(open(f"{tmp_out}/run/metrics.json", encoding="utf-8"))
    assert metrics["n_classes"] == N and metrics["class_names"] is None and 0 <= metrics["accuracy"] <= 1
    for name in os.listdir(f"{tmp_out}/run"):
        if name.endswith("meta.json") or name == "metrics.json":
            assert "label-0" not in open(f"{tmp_out}/run/{name}", encoding="utf-8").read(), name
    assert spark.read.parquet(f"{tmp_out}/run/labels.parquet").count() == N
    preds = spark.read.parquet(f"{tmp_out}/run/predictions.parquet")
    assert preds.where("actual is null or predicted is null or not actual like 'label-%' or not predicted like 'label-%'").count() == 0
    cells = spark.read.parquet(f"{tmp_out}/run/confusion.parquet")
    assert cells.agg(F.sum("n")).first()[0] == metrics["n_test"]


def test_bits_of_codes_are_learned_and_decoded(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(K, "MAX_LISTED_CLASSES", 4)
    df = spark.range(600).select((F.col("id") % 11).cast("double").alias("x"), F.rand(1).alias("e"),
                                 F.format_string("c%02d", F.col("id") % 11).alias("y"), F.col("id").alias("k"))
    feats, meta = FE.engineer(df, "y", "k", labels=f"{tmp_out}/labels")
    assert meta["n_classes"] == 11 and meta["class_names"] is None and meta["label_mapping"] is None
    model = M.fit_model(feats, meta["feature_columns"], "y", "classification", 11, trees=5)
    assert len(model.models) == 4 and model.model_type == "GBTClassifier(bits)"
    model.save(f"{tmp_out}/model")
    model = M.FittedModel.load(f"{tmp_out}/model")
    got = M.score(model, feats, "k", labels=spark.read.parquet(f"{tmp_out}/labels"))
    assert got.columns == ["row", "actual", "predicted", "confidence", "correct"]
    rows = got.collect()
    assert len(rows) == 600 and all(r.actual == f"c{r.row % 11:02d}" and 0 < r.confidence <= 1 for r in rows)
    assert sum(r.correct for r in rows) > 570
    assert EV.classification_metrics(got).first().accuracy > 0.95
    sure = M.what_if_grid(model, M.feature_ranges(feats, meta["feature_columns"]), steps=3).collect()
    assert sure and all(r.class_probs is None and 0 < r.confidence <= 1 for r in sure)


def test_a_grid_of_too_many_classes_raises(spark, monkeypatch):
    df = spark.createDataFrame([("a", "b"), ("b", "b"), ("c", "a")], "actual string, predicted string")
    assert EV.confusion_matrix(df).count() == 9
    monkeypatch.setattr(EV, "MAX_GRID_CLASSES", 2)
    with pytest.raises(ValueError, match="pair_counts"):
        EV.confusion_matrix(df)
    assert EV.pair_counts(df).count() == 3
