"""Merged column statistics, sketches and wide correlations against one computation over all rows."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tablewise.functions import crossprod as X
from tablewise.operators import drift as D
from tablewise.operators import profile as P
from tablewise.operators import snapshots as SN


def frame(spark, rows):
    return spark.createDataFrame(rows, "a double, b bigint, c string, d double")


ROWS = [(1e9 + i * 0.001 if i % 7 else None, i % 5, "x", float("nan") if i % 3 else float(i)) for i in range(400)]


def test_only_new_files_are_scanned_and_merged_equals_whole(spark, tmp_out):
    path = f"{tmp_out}/t"
    snap = SN.TableSnapshot(spark, path, f"{tmp_out}/log")
    frame(spark, ROWS[:150]).repartition(3).write.parquet(path)
    assert snap.update() == 3 and snap.update() == 0
    before = snap.stats()
    frame(spark, ROWS[150:]).repartition(2).write.mode("append").parquet(path)
    frame(spark, [(None, None, None, None)]).coalesce(1).write.mode("append").parquet(path)
    assert snap.update() == 3
    parts = snap.parts()
    assert parts.select("path").distinct().count() == 6 and parts.agg(F.sum("rows")).first()[0] == 3 * 401
    got = {r.column_name: r for r in snap.stats().collect()}
    want = {r.column_name: r for r in P.column_stats(spark.read.parquet(path)).collect()}
    assert set(got) == {"a", "b", "d"}
    for c, w in want.items():
        g = got[c]
        assert (g.rows, g.min, g.max, g.nulls) == (w.rows, w.min, w.max, w.nulls)
        assert math.isclose(g.mean, w.mean, rel_tol=1e-12) and math.isclose(g.std, w.std, rel_tol=1e-5)
    drift = {r.column_name: r.shift_stds for r in D.drift_check(snap.stats(), before).collect()}
    full = {r.column_name: r.shift_stds for r in D.drift_check(
        P.column_stats(spark.read.parquet(path)), P.column_stats(frame(spark, ROWS[:150]))).collect()}
    assert all(math.isclose(drift[c], full[c], rel_tol=1e-4) for c in full)


def test_files_of_the_grown_table_do_not_grow_with_it(spark, tmp_out, monkeypatch):
    from tablewise.plans import q_profile as Q
    li = spark.range(900).select(*[(F.col("id") * (i + 1) % 97 if c != "l_orderkey" else F.col("id")).alias(c)
                                   for i, c in enumerate(Q._LI_NUM)])
    li.write.parquet(f"{tmp_out}/lineitem.parquet")
    few, scanned = Q._grown(spark, tmp_out)
    assert scanned == [3, 3]
    monkeypatch.setattr(Q, "FILE_ROWS", 50, raising=False)
    many, scanned = Q._grown(spark, tmp_out)
    assert scanned == [6, 12]
    for a, b in zip(few, many, strict=True):
        exact = "column_name", "rows", "nulls", "min", "max"
        assert sorted(map(tuple, a.select(*exact).collect())) == sorted(map(tuple, b.select(*exact).collect()))


def test_rewritten_files_do_not_count_twice(spark, tmp_out):
    path = f"{tmp_out}/t"
    snap = SN.TableSnapshot(spark, path, f"{tmp_out}/log", ["b"])
    frame(spark, ROWS[:50]).coalesce(1).write.parquet(path)
    snap.update()
    frame(spark, ROWS[50:90]).coalesce(1).write.mode("overwrite").parquet(path)
    assert snap.update() == 1
    assert [(r.rows, r.min, r.max) for r in snap.stats().collect()] == [(40, 0.0, 4.0)]


def test_column_without_values(spark, tmp_out):
    path = f"{tmp_out}/t"
    frame(spark, [(None, 1, "x", float("nan"))] * 3).write.parquet(path)
    snap = SN.TableSnapshot(spark, path, f"{tmp_out}/log")
    snap.update()
    got = {r.column_name: r for r in snap.stats().collect()}
    assert got["a"].mean is None and got["d"].median is None and got["d"].nulls == 3 and got["b"].median == 1.0 and got["b"].std == 0.0


def test_sketch_ranks_and_merge_over_two_runs(spark, tmp_out):
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=40_000), 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for part in np.array_split(values, 2):
        spark.createDataFrame([(float(v),) for v in part], "v double").coalesce(2).write.mode("append").parquet(f"{tmp_out}/t")
    snap = SN.TableSnapshot(spark, f"{tmp_out}/t", f"{tmp_out}/log")
    snap.update()
    one, two = SN.describe_approx(df).first(), snap.stats().first()
    ordered = np.sort(values)
    for got in (one, two):
        for p, q in ((0.25, got.q25), (0.5, got["median"]), (0.75, got.q75)):
            assert np.searchsorted(ordered, q, "left") / len(ordered) <= p + SN.RANK_ERROR
            assert np.searchsorted(ordered, q, "right") / len(ordered) >= p - SN.RANK_ERROR
    assert one.n == 40_000 and one.min == two.min == ordered[0]


def reference(x):
    n = x.shape[1]
    out = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if ok.sum() >= 2 and np.isfinite(x[ok][:, [i, j]]).all() and np.ptp(x[ok, i]) > 0 and np.ptp(x[ok, j]) > 0:
                out[i, j] = np.corrcoef(x[ok, i], x[ok, j])[0, 1]
    return out


@pytest.mark.parametrize("block, scan, fanin", [(256, 64, 16), (3, 4, 2)])
def test_matrix_of_pairs(spark, monkeypatch, block, scan, fanin):
    monkeypatch.setattr(X, "BLOCK", block)
    monkeypatch.setattr(X, "PAIRS_A_SCAN", scan)
    monkeypatch.setattr(X, "FANIN", fanin)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 11)) + 1e7 * np.arange(11)
    x[:, 3] += x[:, 2] - x[:, 1]
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 7], x[:, 8], x[5, 9] = 4.0, np.nan, np.inf
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"`c.{i}` double" for i in range(11))).repartition(7)
    got = X.correlations(df, df.columns)
    want = reference(x)
    want[:, 9], want[9] = np.where(np.isnan(want[:, 9]), 0, want[:, 9]), np.where(np.isnan(want[9]), 0, want[9])
    assert np.abs(got - want).max() < 1e-6
    assert np.abs(X.correlations(df.limit(0), df.columns)).max() == 0


def test_a_thousand_columns_in_one_scan(spark, tmp_out):
    rng = np.random.default_rng(6)
    n, width = 120, 1000
    x = rng.normal(size=(n, width))
    x[:, 1:] += 0.5 * x[:, :-1]
    x[rng.random(x.shape) < 0.1] = np.nan
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "v array<double>").select(
        *[F.col("v")[i].alias(f"c{i}") for i in range(width)])
    df = df.mapInArrow(count, df.schema)
    num, r = P.correlation_pairs(df)
    assert seen.value == n and len(r) == width * (width + 1) // 2
    want = reference(x[:, :12])
    assert max(abs(r[f"c{i}", f"c{j}"] - want[i, j]) for i in range(12) for j in range(i, 12)) < 1e-9
