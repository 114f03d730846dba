"""The large-input code paths, forced on small data, equal the plain ones."""
import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewise.operators import evaluate as EV
from tablewise.operators import model as M
from tablewise.plans import ordering as O


def _frame(spark, n=5000, seed=3):
    rng = np.random.default_rng(seed)
    keys = rng.permutation(n * 7)[:n]
    vals = rng.normal(size=n)
    return spark.createDataFrame([(int(k), float(v)) for k, v in zip(keys, vals)], "k long, v double").repartition(5)


def test_ordered_index_equals_window(spark):
    df = _frame(spark)
    plain = {r["k"]: r["i"] for r in df.withColumn("i", F.row_number().over(Window.orderBy("k")) - 1).collect()}
    assert {r["k"]: r["idx"] for r in O.ordered_index(df, "k").collect()} == plain


def test_ordered_index_any_key(spark):
    """Text keys, NULL keys, a key that a third of the rows share, keys beyond 2**53, an empty table."""
    rows = [(None if i % 10 == 0 else "hot" if i % 3 == 0 else f"k{i:04d}", (1 << 60) + i) for i in range(900)]
    df = spark.createDataFrame(rows, "s string, n long").repartition(5)
    got = sorted((r["idx"], r["s"]) for r in O.ordered_index(df, "s").collect())
    assert [i for i, _ in got] == list(range(900))
    keys = [s for _, s in got]
    assert keys == sorted(keys, key=lambda s: (s is not None, s or ""))
    assert [r["n"] for r in O.ordered_index(df, "n").orderBy("idx").collect()] == sorted(n for _, n in rows)
    assert O.ordered_index(df.limit(0), "s").count() == 0


def test_rolling_mean_equals_window(spark):
    df = _frame(spark, 3000)
    for window in (1, 5, 37, 1000, 5000):
        w = Window.orderBy("k").rowsBetween(1 - window, 0)
        plain = {r["k"]: r["m"] for r in df.withColumn("m", F.avg("v").over(w)).collect()}
        for sub in (7, 100_000):
            got = {r["k"]: r["m"] for r in O.rolling_mean(df, "k", "v", window, "m", sub_rows=sub).collect()}
            assert got.keys() == plain.keys()
            assert all(math.isclose(plain[k], got[k], abs_tol=1e-9) for k in plain)


def test_rolling_mean_spike_nan_and_null(spark):
    """A spike or NaN marks only the windows that hold it; NULLs are not counted."""
    vals = [0.3] * 40
    vals[5], vals[17], vals[25], vals[26], vals[27] = 1e16, float("nan"), None, None, None
    df = spark.createDataFrame(list(enumerate(vals)), "k long, v double")
    got = [r["m"] for r in O.rolling_mean(df, "k", "v", 3, "m").orderBy("k").collect()]
    assert all(math.isclose(got[i], 0.3) for i in range(40) if i not in (5, 6, 7, 17, 18, 19, 27))
    assert all(math.isnan(got[i]) for i in (17, 18, 19)) and got[27] is None and got[7] > 1e15


def test_split_is_exact_stratified_and_partition_independent(spark):
    rows = [(i, ["a", "b", "c"][i % 3] if i % 10 else "d") for i in range(2003)]
    df = spark.createDataFrame(rows, "k long, y string")
    s1, info = M.holdout_split(df, "k", "y", "classification")
    s2, _ = M.holdout_split(df.repartition(7), "k", "y", "classification")
    t1 = {r["k"] for r in s1.where("is_test").collect()}
    t2 = {r["k"] for r in s2.where("is_test").collect()}
    assert t1 == t2 and len(t1) == math.ceil(0.2 * 2003)
    per = {r["y"]: r["n"] for r in s1.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert per == {r["s"]: r["quota"] for r in info["strata"].collect()}


def test_quotas_are_largest_remainders(spark):
    counts = {f"c{i:03d}": 2 + i * 7 % 31 for i in range(200)}
    n = sum(counts.values())
    n_test = math.ceil(0.2 * n)
    base = {c: n_test * k // n for c, k in counts.items()}
    rest = sorted(counts, key=lambda c: (-(n_test * counts[c] % n), c))[:n_test - sum(base.values())]
    strata = spark.createDataFrame(list(counts.items()), "s string, n long")
    got = {r["s"]: r["quota"] for r in M.stratum_quotas(strata, n, n_test).collect()}
    assert got == {c: base[c] + (c in rest) for c in counts} and sum(got.values()) == n_test


def test_rolling_rmse_matches_pandas(spark):
    import pandas as pd
    rng = np.random.default_rng(1)
    a, p = rng.normal(size=120), rng.normal(size=120)
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, p))],
                               "k long, actual double, predicted double")
    got = [r["rolling_rmse"] for r in EV.rolling_rmse(df, "k").orderBy("k").collect()]
    w = max(5, 120 // 10)
    exp = np.sqrt(pd.Series((a - p) ** 2).rolling(w, min_periods=1).mean()).tolist()
    assert all(math.isclose(x, y, rel_tol=1e-9) for x, y in zip(got, exp))


def test_linear_forecast_matches_polyfit(spark):
    y = [3.0, 5.0, 4.0, 8.0, 9.0, 12.0, 11.0]
    df = spark.createDataFrame([(i * 10, v) for i, v in enumerate(y)], "k long, y double")
    fc = EV.linear_forecast(df, "k", "y", rmse=1.0, horizon=3).orderBy("step").collect()
    b, a = np.polyfit(np.arange(len(y)), y, 1)
    for i, r in enumerate(fc):
        assert math.isclose(r["forecast"], a + b * (len(y) + i), rel_tol=1e-9)
    assert fc[0]["lower"] == fc[0]["forecast"] - 1.5


def test_top_k_uses_partial_window_limit(spark):
    from tablewise.functions import stats as S
    df = spark.range(100000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    plan = S.top_k_per_group(df, ["g"], [F.col("v").desc()], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_quantiles_of_several_columns(spark):
    from tablewise.functions import stats as S
    rng = np.random.default_rng(5)
    rows = [(float(rng.normal()), float(rng.integers(0, 5)), float(rng.normal())) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = S.exact_quantiles(df, ["a", "b", "c"], [0.1, 0.5, 0.9])
    arr = np.array(rows)
    for i, c in enumerate("abc"):
        for g, e in zip(got[c], np.quantile(arr[:, i], [0.1, 0.5, 0.9])):
            assert math.isclose(g, e, rel_tol=1e-12, abs_tol=1e-12)


def test_wide_correlation_in_chunks(spark):
    from tablewise.operators import profile as P
    rng = np.random.default_rng(9)
    base = rng.normal(size=200)
    cols = {f"c{i}": base * (i % 3 - 1) + rng.normal(size=200) * 0.1 for i in range(40)}
    names = list(cols)
    df = spark.createDataFrame([tuple(float(cols[n][r]) for n in names) for r in range(200)],
                               ", ".join(f"{n} double" for n in names))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    old = P._CORR_EXPRS_PER_JOB
    P._CORR_EXPRS_PER_JOB = 50
    try:
        r = P._pair_corr(df, pairs)
    finally:
        P._CORR_EXPRS_PER_JOB = old
    m = np.corrcoef(np.array([cols[n] for n in names]))
    for a, b in pairs:
        exp = m[names.index(a), names.index(b)]
        exp = 0.0 if np.isnan(exp) else exp
        assert math.isclose(r[(a, b)], exp, abs_tol=1e-9)


def test_hot_key_is_combined_before_the_shuffle(spark):
    from tablewise.functions import stats as S
    from tablewise.operators import clean as C
    from tablewise.operators import features as FE
    n = 9000
    rows = [(i, "hot" if i % 3 == 0 else f"u{i % 500}", 1.0 if i % 3 == 0 else float(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, user string, v double").repartition(6)
    enc = FE.frequency_encode(df, "user", n_rows=n, n_unique=501)
    got = {r["k"]: r["user"] for r in enc.collect()}
    assert math.isclose(got[0], 1 / 3) and math.isclose(got[1], (n // 3 * 2 / 500) / n, rel_tol=0.05)
    plan = enc._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "BroadcastHashJoin" in plan
    # a third of the rows are copies of one row: de-duplication combines them map-side
    dup = df.select("user", "v")
    out = C.drop_duplicates(dup)
    assert out.where("user = 'hot'").count() == 1
    assert "HashAggregate" in out._jdf.queryExecution().executedPlan().toString()
    assert S.modes(df, ["user"]) == {"user": "hot"}


def test_selection_with_hot_value(spark, monkeypatch):
    """A value holding a third of the rows, NaN and NULL mixed in; many and few cells a pass."""
    from tablewise.functions import stats as S
    rng = np.random.default_rng(11)
    vals = [7.0 if i % 3 == 0 else float(rng.normal() * 100) for i in range(6000)]
    rows = [(None if i % 50 == 1 else (float("nan") if i % 70 == 2 else v),) for i, v in enumerate(vals)]
    rows = [(x, float(rng.exponential() * 10)) for (x,) in rows]
    df = spark.createDataFrame(rows, "x double, y double").repartition(4)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    expected = {}
    for i, c in enumerate("xy"):
        arr = np.array([r[i] for r in rows if r[i] is not None and not math.isnan(r[i])])
        expected[c] = np.quantile(arr, probs)
    for buckets in (2048, 16, 2):
        monkeypatch.setattr(S, "_SELECT_BUCKETS", buckets)
        got = S.exact_quantiles(df, ["x", "y"], probs)
        for c in "xy":
            for g, e in zip(got[c], expected[c]):
                assert math.isclose(g, e, rel_tol=1e-12, abs_tol=1e-12)


def test_selection_with_infinities_and_extremes(spark):
    from tablewise.functions import stats as S
    vals = [float("-inf")] * 3 + [-1.7e308, -1e-300, 0.0, 1e-300, 5.0, 1.7e308] + [float("inf")] * 2
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    n = len(vals)
    got = S.select_ranks(df, {"x": list(range(n))}, {("x", "min"): min(vals), ("x", "max"): max(vals)})["x"]
    assert [got[i] for i in range(n)] == sorted(vals)


def test_auc_of_many_classes_equals_rank_sums(spark):
    rng = np.random.default_rng(2)
    labels = [f"c{i:02d}" for i in range(12)]
    y = [labels[i] for i in rng.integers(0, 12, 600)]
    p = np.round(rng.random((600, 12)), 2)  # many ties
    df = spark.createDataFrame([(y[i], *map(float, p[i])) for i in range(600)],
                               "actual string, " + ", ".join(f"p{k} double" for k in range(12)))
    want = 0.0
    for k, c in enumerate(labels):
        pos, neg = p[[v == c for v in y], k], p[[v != c for v in y], k]
        auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
        want += auc * len(pos) / 600
    got = EV.roc_auc(df, "actual", {c: f"p{k}" for k, c in enumerate(labels)}).first()
    assert got["metric"] == "roc_auc_ovr_weighted" and math.isclose(got["value"], want, rel_tol=1e-9)


def test_encoding_many_columns_scans_grow_linearly(spark):
    from tablewise.operators import features as FE
    rows = [tuple(f"{c}{(i * (k + 3)) % 97}" for k, c in enumerate("abcdef")) + (float(i),) for i in range(500)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in "abcdef") + ", y double")
    out, info = FE.encode_categoricals(df, ("y",))
    assert info["frequency"] == list("abcdef")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 6 and plan.count("Relation") <= 6
    got = {r["y"]: r for r in out.collect()}
    for k, c in enumerate("abcdef"):
        n = sum((j * (k + 3)) % 97 == (7 * (k + 3)) % 97 for j in range(500))
        assert math.isclose(got[7.0][c], n / 500)
