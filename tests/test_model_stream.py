"""Model fit/score bounds and repeatability; streaming equals batch; inbox dedupe; full run."""
import math

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tablewise.operators import features as FE
from tablewise.operators import model as M
from tablewise.operators import timeseries as TS
from tablewise.streaming import inbox as IB
from tablewise.streaming.monthly import run_monthly_stream


def _prep(spark, name, key):
    df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
    feats, meta = FE.engineer(df, key=key)
    split, info = M.holdout_split(feats, key, meta["target_name"], meta["task_type"])
    return split, meta, info


def test_regression_fit_score_repeatable(spark):
    split, meta, info = _prep(spark, "part", "p_partkey")
    assert meta["task_type"] == "regression"
    train = split.where(~F.col("is_test"))
    m1 = M.fit_model(train, meta["feature_columns"], meta["target_name"], "regression", trees=5)
    m2 = M.fit_model(train, meta["feature_columns"], meta["target_name"], "regression", trees=5)
    test = split.where("is_test")
    p1 = {r["row"]: r["predicted"] for r in M.score(m1, test, "p_partkey").collect()}
    p2 = {r["row"]: r["predicted"] for r in M.score(m2, test, "p_partkey").collect()}
    assert p1 == p2 and len(p1) == info["n_test"]
    imp = M.feature_importance(spark, m1).collect()
    assert imp and all(r["importance"] >= 0 for r in imp)


def test_multiclass_probabilities(spark):
    split, meta, info = _prep(spark, "orders", "o_orderkey")
    assert meta["n_classes"] == 5
    model = M.fit_model(split.where(~F.col("is_test")), meta["feature_columns"], meta["target_name"],
                        "classification", 5, trees=3)
    out = model.transform(split.where("is_test")).select("probs", "prediction").collect()
    for r in out:
        assert math.isclose(sum(r["probs"]), 1.0, rel_tol=1e-9)
        assert r["probs"][int(r["prediction"])] == max(r["probs"])
    preds = M.score(model, split.where("is_test"), "o_orderkey", meta["class_names"]).collect()
    assert all(0 <= r["confidence"] <= 1 and r["predicted"] in meta["class_names"] for r in preds)


def test_stream_monthly_equals_batch(spark, tmp_out):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.repartition(5).write.parquet(f"{tmp_out}/src")
    s = run_monthly_stream(spark, f"{tmp_out}/src", orders.schema, "o_orderdate", "o_totalprice",
                           f"{tmp_out}/res", f"{tmp_out}/ck")
    b = TS.monthly_rollup(orders, "o_orderdate", "o_totalprice").where("value_count > 0")
    got = {r["period"]: (round(r["value_sum"], 2), r["value_count"]) for r in s.collect()}
    exp = {r["period"]: (round(r["value_sum"], 2), r["value_count"]) for r in b.collect()}
    assert got == exp


def test_inbox_runs_new_and_changed_files_once(spark, tmp_out):
    inbox = f"{tmp_out}/inbox"
    spark.read.parquet(f"{SF_SMALL}/part.parquet").write.parquet(f"{inbox}/part.parquet")
    work = f"{tmp_out}/work"
    IB.stream_inbox(spark, inbox, work, trees=3)
    log = IB.read_runlog(spark, f"{work}/runlog").collect()
    assert len(log) == 1 and log[0]["status"] == "success"
    assert IB.pending(spark, inbox, f"{work}/runlog").count() == 0  # same content: skipped
    # rewrite the dataset with different content: it is pending again
    spark.read.parquet(f"{SF_SMALL}/part.parquet").withColumn("p_size", F.col("p_size") + 1) \
        .write.mode("overwrite").parquet(f"{inbox}/part.parquet")
    assert IB.pending(spark, inbox, f"{work}/runlog").count() == 1
    IB.stream_inbox(spark, inbox, work, trees=3)
    assert len(IB.read_runlog(spark, f"{work}/runlog").collect()) == 2
    assert IB.pending(spark, inbox, f"{work}/runlog").count() == 0
    listed = IB.list_inbox(spark, inbox).collect()
    assert [r["dataset"].rsplit("/", 1)[-1] for r in listed] == ["part.parquet"]


def test_file_rewritten_in_place_runs_again(spark, tmp_out):
    """One file, same path, new content: the next start of the stream runs it, and only then."""
    import os
    inbox, work = f"{tmp_out}/inbox", f"{tmp_out}/work"
    os.mkdir(inbox)

    def put(shift):
        with open(f"{inbox}/a.csv", "w", encoding="utf-8") as f:
            f.write("x,y\n" + "".join(f"{i},{i * 2 + shift}\n" for i in range(40)))

    runs = lambda: [(r["dataset"].rsplit("/", 1)[-1], r["status"])
                    for r in IB.read_runlog(spark, f"{work}/runlog").collect()]
    put(0)
    IB.stream_inbox(spark, inbox, work, trees=2)
    IB.stream_inbox(spark, inbox, work, trees=2)
    assert runs() == [("a.csv", "success")]
    put(7)
    IB.stream_inbox(spark, inbox, work, trees=2)
    assert runs() == [("a.csv", "success")] * 2
    assert IB.list_inbox(spark, f"{tmp_out}/nothing").count() == 0


def test_what_if_with_clashing_names_and_classes(spark):
    """Features called value, feature and step; classes tell the class, its change and all probabilities."""
    rows = [(i, float(i % 7), float(i % 5), float(i % 3), i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "k long, value double, feature double, step double, y long")
    cols = ["value", "feature", "step"]
    model = M.fit_model(df, cols, "y", "classification", 3, trees=3, max_depth=3)
    grid = M.what_if_grid(model, M.feature_ranges(df, cols), steps=5, class_names=["a", "b", "c"])
    got = grid.collect()
    assert {r["feature"] for r in got} == set(cols) and len(got) == 15
    assert all(abs(sum(r["class_probs"]) - 1) < 1e-9 and r["predicted_class"] in "abc" for r in got)
    assert all(r["class_changed"] == (r["predicted_class"] != r["baseline_class"]) for r in got)
    both = spark.createDataFrame([("s", (6.0, 4.0, 2.0))], "name string, features struct<value:double,feature:double,step:double>")
    assert M.what_if(model, both, class_names=["a", "b", "c"]).first()["predicted_class"] == "c"
    reg = M.fit_model(df, cols, "y", "regression", trees=3, max_depth=3)
    assert {"baseline", "delta", "prediction"} <= set(M.what_if_grid(reg, M.feature_ranges(df, cols), steps=3).columns)


def test_fit_deals_rows_evenly_over_the_cores(spark, monkeypatch):
    """Twelve megabytes were one task whatever the cores, and 14 files of 16 MB two rounds on 12 cores."""
    assert M.fit_partitions(1000, 12) == M.fit_partitions(2 << 20, 12) == 1
    assert M.fit_partitions(12 << 20, 12) == 6 and M.fit_partitions(100 << 20, 12) == 12
    assert [M.fit_partitions(n << 20, 12) for n in (192, 193, 384, 450)] == [12, 24, 24, 36]
    monkeypatch.setattr(M, "FIT_TASK_BYTES", 1000)
    read = []
    regressor = M.GBTRegressor

    class Seen(regressor):
        def fit(self, x):
            read.append((x.rdd.getNumPartitions(), x.count()))
            return super().fit(x)
    monkeypatch.setattr(M, "GBTRegressor", Seen)
    df = spark.range(4000).select((F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("y"))
    M.fit_model(df, ["a"], "y", "regression", trees=2)
    assert read == [(4, 4000)]


def test_boosters_side_by_side_share_the_cores(spark, monkeypatch):
    """Five boosters of ten megabytes were dealt over four tasks each, twenty small tasks at a time on 12 cores."""
    assert [M.fit_partitions(n << 20, 12, 5) for n in (1, 9, 20, 40, 100, 192, 193)] == [1, 1, 2, 3, 7, 12, 24]
    assert M.fit_partitions(100 << 20, 4, 8) == 8 and M.fit_partitions(12 << 20, 4, 8) == 1
    monkeypatch.setattr(M, "FIT_TASK_BYTES", 10000)
    read = []
    classifier = M.GBTClassifier

    class Seen(classifier):
        def fit(self, x):
            read.append((x.rdd.getNumPartitions(), x.count()))
            return super().fit(x)
    monkeypatch.setattr(M, "GBTClassifier", Seen)
    df = spark.range(4000).select((F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("y"))
    M.fit_model(df, ["a"], "y", "classification", 3, trees=2)
    assert read == [(1, 4000)] * 3  # 64 KB on 4 cores: four tasks a booster before
    M.fit_model(df, ["a"], "y", "classification", 3, trees=2, parallelism=1)
    assert read[3:] == [(4, 4000)] * 3
