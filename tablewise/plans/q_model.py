"""Split / fit / score / promote queries (M1-M5, M12-M14), with the default number of trees."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import model as M
from ..session import scratch_path
from .catalog import register, rnd, table

QUERY_TREES = K.GBT_TREES
_CACHE: dict = {}


def _prepared(spark, sf, name, key):
    """Engineered table + meta + split, cached per session and input."""
    ck = (id(spark), sf, name, "prep")
    if ck not in _CACHE:
        feats, meta = FE.engineer(table(spark, sf, name), key=key)
        split, info = M.holdout_split(feats, key, meta["target_name"], meta["task_type"])
        _CACHE[ck] = (split, meta, info)
    return _CACHE[ck]


def _fitted(spark, sf, name, key):
    ck = (id(spark), sf, name, "model")
    if ck not in _CACHE:
        split, meta, info = _prepared(spark, sf, name, key)
        model = M.fit_model(split.where(~F.col("is_test")), meta["feature_columns"], meta["target_name"],
                            meta["task_type"], meta["n_classes"], trees=QUERY_TREES)
        _CACHE[ck] = model
    return _CACHE[ck]


@register("stratified_split", """
WITH c AS (SELECT CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS cls FROM orders),
k AS (SELECT cls, count(*) AS n FROM c GROUP BY cls),
t AS (SELECT sum(n) AS total, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_test FROM k),
q AS (SELECT cls, n, (n_test * n) // total AS base, (n_test * n) % total AS rem, n_test, total FROM k, t),
r AS (SELECT *, row_number() OVER (ORDER BY rem DESC, CAST(cls AS VARCHAR)) AS rk,
             n_test - sum(base) OVER () AS extra FROM q)
SELECT cls, CAST(n AS BIGINT) AS n, CAST(base + CASE WHEN rk <= extra THEN 1 ELSE 0 END AS BIGINT) AS n_test FROM r""")
def q_stratified_split(spark, sf):
    split, meta, _ = _prepared(spark, sf, "orders", "o_orderkey")
    t = meta["target_name"]
    return (split.groupBy(F.col(t).alias("cls"))
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_test").cast("long")).alias("n_test")))


@register("fit_regression")
def q_fit_regression(spark, sf):
    split, meta, info = _prepared(spark, sf, "part", "p_partkey")
    model = _fitted(spark, sf, "part", "p_partkey")
    preds = M.score(model, split.where(F.col("is_test")), "p_partkey")
    m = EV.regression_metrics(preds)
    return rnd(m.select(F.lit(info["n_train"]).cast("bigint").alias("n_train"), "n", "r2", "mae", "rmse", "mape",
                        F.lit(model.model_type).alias("model_type")))


@register("fit_classification")
def q_fit_classification(spark, sf):
    split, meta, info = _prepared(spark, sf, "orders", "o_orderkey")
    model = _fitted(spark, sf, "orders", "o_orderkey")
    preds = M.score(model, split.where(F.col("is_test")), "o_orderkey", meta["class_names"])
    m = EV.classification_metrics(preds)
    return rnd(m.select(F.lit(info["n_train"]).cast("bigint").alias("n_train"), "n", "accuracy",
                        "precision_weighted", "recall_weighted", "f1_weighted",
                        F.lit(meta["n_classes"]).alias("n_classes"), F.lit(model.model_type).alias("model_type")))


@register("feature_importance")
def q_feature_importance(spark, sf):
    model = _fitted(spark, sf, "part", "p_partkey")
    imp = M.feature_importance(spark, model)
    summ = M.importance_summary(imp)
    top = summ.first()
    return rnd(imp.select("*", F.lit(top["top_feature"]).alias("top_feature"),
                          F.lit(top["top_share_pct"]).cast("double").alias("top_share_pct"),
                          F.lit(top["runners_up"]).alias("runners_up")))


@register("score_holdout")
def q_score_holdout(spark, sf):
    split, meta, _ = _prepared(spark, sf, "orders", "o_orderkey")
    model = _fitted(spark, sf, "orders", "o_orderkey")
    return rnd(M.score(model, split.where(F.col("is_test")), "o_orderkey", meta["class_names"]))


@register("model_registry")
def q_model_registry(spark, sf):
    split, meta, info = _prepared(spark, sf, "part", "p_partkey")
    model = _fitted(spark, sf, "part", "p_partkey")
    preds = M.score(model, split.where(F.col("is_test")), "p_partkey")
    metrics = EV.regression_metrics(preds).first().asDict()
    base = scratch_path(spark, "registry")
    M.deploy(spark, model, metrics, base, "part.parquet", info["n_train"], info["n_test"])
    M.deploy(spark, model, metrics, base, "part.parquet", info["n_train"], info["n_test"])
    return M.registry(spark, base).drop("deployed_at", "version", "model_path")


def _ranges_sql() -> str:
    cols = ["o_custkey", "o_totalprice", "o_orderdate__year", "o_orderdate__month", "o_orderdate__day",
            "o_orderdate__dayofweek", "o_orderstatus_F", "o_orderstatus_O", "o_orderstatus_P"]
    exprs = {"o_orderdate__year": "year(o_orderdate)", "o_orderdate__month": "month(o_orderdate)",
             "o_orderdate__day": "day(o_orderdate)", "o_orderdate__dayofweek": "isodow(o_orderdate) - 1",
             "o_orderstatus_F": "CAST(o_orderstatus = 'F' AS INTEGER)",
             "o_orderstatus_O": "CAST(o_orderstatus = 'O' AS INTEGER)",
             "o_orderstatus_P": "CAST(o_orderstatus = 'P' AS INTEGER)"}
    parts = []
    for i, c in enumerate(cols):
        e = f"CAST({exprs.get(c, c)} AS DOUBLE)"
        parts.append(f"SELECT {i} AS position, '{c}' AS feature, round(min({e}), 6) AS min, round(max({e}), 6) AS max, "
                     f"round(avg({e}), 6) AS mean FROM orders")
    return "\nUNION ALL\n".join(parts)


@register("feature_ranges", _ranges_sql())
def q_feature_ranges(spark, sf):
    feats, meta = FE.engineer(table(spark, sf, "orders"), key="o_orderkey")
    return rnd(M.feature_ranges(feats, meta["feature_columns"]))


@register("what_if_grid")
def q_what_if_grid(spark, sf):
    split, meta, _ = _prepared(spark, sf, "part", "p_partkey")
    model = _fitted(spark, sf, "part", "p_partkey")
    order = [f for f, _ in model.importances()]
    ranges = M.feature_ranges(split, order)
    return rnd(M.what_if_grid(model, ranges))
