"""Checks on ordinary, awkward input: text with quotes and line ends, JSON forms, many classes,
encodings of many columns, spikes in rolling windows, run logs, sinks."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import drift as D
from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import model as M
from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks
from . import q_model as QM
from .catalog import register, rnd, table


# Suppliers of one JSON object of columns.
ROWS_A_DOC = 1000


# --------------------------------------------------------------------------- #
# Whole texts of documents through files
# --------------------------------------------------------------------------- #
_TEXTS = """
SELECT doc_id, concat('"', text, '"', chr(10), ', end') AS quoted, lang, source, n_chars FROM documents"""


def _texts(spark, sf):
    quoted = F.concat(F.lit('"'), F.col("text"), F.lit('"\n, end'))
    return table(spark, sf, "documents").select("doc_id", quoted.alias("quoted"), "lang", "source", "n_chars")


@register("scan_csv_text", _TEXTS)
def q_scan_csv_text(spark, sf):
    """Texts with quotes, delimiters and line ends, written and read as CSV."""
    path = scratch_path(spark, "texts") + "/texts.csv"
    _texts(spark, sf).write.options(header=True, quote='"', escape='"').csv(path)
    return R.read_dataset(spark, path)


@register("scan_json_text", _TEXTS)
def q_scan_json_text(spark, sf):
    """The same texts as JSON lines."""
    path = scratch_path(spark, "texts") + "/texts.json"
    _texts(spark, sf).write.json(path)
    return R.read_dataset(spark, path)


@register("scan_json_columns", """
SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier""")
def q_scan_json_columns(spark, sf):
    """Objects of columns, each an object of row label -> value (about ROWS_A_DOC suppliers an object)."""
    path = scratch_path(spark, "columns") + "/columns.json"
    s = table(spark, sf, "supplier")
    label = F.col("s_suppkey").cast("string")
    n_docs = -(-s.count() // ROWS_A_DOC) or 1
    docs = s.groupBy(F.pmod(F.xxhash64("s_suppkey"), F.lit(n_docs)).alias("doc")).agg(*[
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(label.alias("key"), F.col(c).alias("value"))))).alias(c)
        for c in s.columns])
    docs.drop("doc").write.json(path)
    return R.read_json_columns(spark, path)


@register("write_table", "SELECT * FROM orders")
def q_write_table(spark, sf):
    """The table sink, read back."""
    path = scratch_path(spark, "sink") + "/orders.parquet"
    return spark.read.parquet(sinks.write_table(table(spark, sf, "orders"), path))


@register("write_json", """
SELECT o_orderstatus AS status, CAST(count(*) AS BIGINT) AS n, strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS last
FROM orders GROUP BY 1""")
def q_write_json(spark, sf):
    """The document sink (dates as ISO text), read back: one entry a status."""
    rows = (table(spark, sf, "orders").groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last")).collect())
    path = sinks.write_json(spark, {r["o_orderstatus"]: {"n": r["n"], "last": r["last"]} for r in rows},
                            scratch_path(spark, "doc") + "/doc.json")
    doc = sinks.read_json_doc(spark, path)
    return spark.createDataFrame([(k, v["n"], v["last"]) for k, v in doc.items()], "status string, n bigint, last string")


# --------------------------------------------------------------------------- #
# C1 / C3 on more spellings
# --------------------------------------------------------------------------- #
@register("datetime_layouts", """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS iso_zone, CAST(o_orderdate AS TIMESTAMP) - INTERVAL 2 HOUR AS shifted,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS named, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS short_year,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 15 HOUR + INTERVAL 4 MINUTE AS clock
FROM orders""")
def q_datetime_layouts(spark, sf):
    """Dates of orders in five further layouts, parsed back."""
    from ..functions.scalars import parse_datetime
    d = F.col("o_orderdate")
    text = {"iso_zone": F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), "shifted": F.date_format(d, "yyyy-MM-dd HH:mm:ss'+02:00'"),
            "named": F.date_format(d, "d-MMM-yyyy"), "short_year": F.date_format(d, "MM/dd/yy"),
            "clock": F.concat(F.date_format(d, "M/d/yyyy"), F.lit(" 3:04 PM"))}
    return table(spark, sf, "orders").select("o_orderkey", *[parse_datetime(F.concat(F.lit("\t "), v, F.lit(" "))).alias(k)
                                                            for k, v in text.items()])


# --------------------------------------------------------------------------- #
# F5 / F7 / M1
# --------------------------------------------------------------------------- #
_MANY = {"a": "concat('a', l_orderkey % 30)", "b": "concat('b', l_partkey % 61)", "c": "concat('c', l_suppkey % 23)",
         "d": "concat('d', (l_orderkey * 7 + l_linenumber) % 211)", "e": "concat('e', CAST(l_quantity AS INTEGER) % 47)",
         "f": "concat('f', (l_orderkey + l_partkey) % 101)"}


@register("frequency_encode_many", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(count(*) OVER (PARTITION BY {e}) / CAST(count(*) OVER () AS DOUBLE), 9) AS {c}" for c, e in _MANY.items())
    + " FROM lineitem")
def q_frequency_encode_many(spark, sf):
    """Six text columns encoded at once."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[
        F.expr(e.replace("INTEGER", "INT")).alias(c) for c, e in _MANY.items()])
    return rnd(FE.frequency_encode_all(li, list(_MANY), li.count()), 9)


@register("finite_target_engineered", """
SELECT p_partkey, CAST(p_size AS INTEGER) AS p_size, round(p_retailprice / (p_partkey % 11), 6) AS price
FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 <> 0""")
def q_finite_target_engineered(spark, sf):
    """A regression target with infinite and missing values, engineered."""
    price = F.when(F.col("p_partkey") % 13 == 0, F.lit("no price")).otherwise(
        F.when(F.col("p_partkey") % 11 == 0, F.lit("Infinity")).otherwise(
            (F.col("p_retailprice") / (F.col("p_partkey") % 11)).cast("string")))
    part = table(spark, sf, "part").select("p_partkey", "p_size", price.try_cast("double").alias("price"))
    out, _ = FE.engineer(part, target="price", key="p_partkey")
    return rnd(out)


@register("split_many_classes", """
WITH k AS (SELECT strftime(l_shipdate, '%Y-%m') AS cls, count(*) AS n FROM lineitem GROUP BY 1),
t AS (SELECT sum(n) AS total, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_test FROM k),
q AS (SELECT cls, n, (n_test * n) // total AS base, (n_test * n) % total AS rem, n_test FROM k, t),
r AS (SELECT *, row_number() OVER (ORDER BY rem DESC, cls) AS rk, n_test - sum(base) OVER () AS extra FROM q)
SELECT cls, CAST(n AS BIGINT) AS n, CAST(base + CASE WHEN rk <= extra THEN 1 ELSE 0 END AS BIGINT) AS n_test,
       CAST(n AS BIGINT) AS n_distinct
FROM r""")
def q_split_many_classes(spark, sf):
    """A class for each month of shipping; no row may be lost or doubled by the split."""
    li = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("k"),
        F.date_format("l_shipdate", "yyyy-MM").alias("cls"))
    split, _ = M.holdout_split(li, "k", "cls", "classification")
    return split.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_test").cast("bigint")).alias("n_test"),
                                    F.count_distinct("k").alias("n_distinct"))


# --------------------------------------------------------------------------- #
# W8 on awkward values
# --------------------------------------------------------------------------- #
@register("rolling_rmse_spikes", """
WITH f AS (SELECT o_orderkey, o_totalprice AS actual,
                  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 301 = 0 THEN 1e12 ELSE o_totalprice + o_orderkey % 101 END
                    AS predicted FROM orders),
n AS (SELECT count(*) AS n, greatest(5, count(*) // 10) AS w FROM f),
p AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS i FROM f),
b AS (SELECT i, CASE WHEN predicted IS NOT NULL AND predicted < 1e11 THEN (actual - predicted) ^ 2 END AS e,
             CAST(predicted >= 1e11 AS INTEGER) AS big FROM p)
SELECT o_orderkey, CAST(n.w AS INTEGER) AS "window", coalesce(s.big, 0) > 0 AS spike,
       CASE WHEN coalesce(s.big, 0) = 0 THEN round(sqrt(s.e), 4) END AS rolling_rmse
FROM p, n, LATERAL (SELECT avg(e) AS e, sum(big) AS big FROM b WHERE b.i > p.i - n.w AND b.i <= p.i) s""")
def q_rolling_rmse_spikes(spark, sf):
    """Windows without a spike are exact whatever came before; NULLs are not counted."""
    k = F.col("o_orderkey")
    predicted = F.when(k % 17 == 0, F.lit(None)).when(k % 301 == 0, 1e12).otherwise(F.col("o_totalprice") + k % 101)
    scores = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("actual"), predicted.alias("predicted"))
    out = EV.rolling_rmse(scores, "o_orderkey")
    spike = F.coalesce(F.col("rolling_rmse") > 1e8, F.lit(False))
    return out.select("o_orderkey", "window", spike.alias("spike"),
                      F.when(~spike, F.round("rolling_rmse", 4)).alias("rolling_rmse"))


# --------------------------------------------------------------------------- #
# A13 / D4 on run rows derived from orders
# --------------------------------------------------------------------------- #
_RUNS = """
WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "timestamp",
                  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'running' ELSE 'success' END AS status,
                  o_totalprice / 1000 AS duration_seconds, (o_orderkey * 37) % 100 / 100.0 AS headline_value FROM orders)"""


def _runs(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "P", "running").otherwise("success")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        status.alias("status"), (F.col("o_totalprice") / 1000).alias("duration_seconds"),
        ((F.col("o_orderkey") * 37) % 100 / 100.0).alias("headline_value"))


@register("run_history_orders", _RUNS + f""",
l AS (SELECT * FROM r ORDER BY "timestamp" DESC, run_id DESC LIMIT {K.MAX_HISTORY})
SELECT count(*) AS total_runs, sum(CAST(status = 'success' AS BIGINT))::BIGINT AS success_count,
       sum(CAST(status = 'failed' AS BIGINT))::BIGINT AS failed_count,
       (count(*) - sum(CAST(status = 'success' AS BIGINT)))::BIGINT AS not_success, round(avg(duration_seconds), 3) AS avg_duration
FROM l""")
def q_run_history_orders(spark, sf):
    return D.run_history(_runs(spark, sf))


@register("metric_history_orders", _RUNS + f""",
h AS (SELECT *, lag(headline_value) OVER (ORDER BY "timestamp", run_id) AS prev_headline FROM r)
SELECT run_id, "timestamp", status, round(headline_value, 6) AS headline_value, round(prev_headline, 6) AS prev_headline,
       round(headline_value - prev_headline, 6) AS headline_change
FROM h ORDER BY "timestamp" DESC, run_id DESC LIMIT {K.RECENT_RUNS}""")
def q_metric_history_orders(spark, sf):
    return rnd(D.recent_runs(_runs(spark, sf)).drop("duration_seconds"))


@register("drift_carry_over", """
WITH s AS (SELECT l_linenumber % 2 AS half, avg(l_quantity) AS q, stddev_samp(l_quantity) AS qs, avg(l_tax) AS t,
                  stddev_samp(l_tax) AS ts FROM lineitem GROUP BY 1),
a AS (SELECT * FROM s WHERE half = 0), b AS (SELECT * FROM s WHERE half = 1)
SELECT 'l_quantity' AS column_name, round(a.q, 6) AS prev_mean, round(b.q, 6) AS curr_mean,
       round(abs(b.q - a.q) / a.qs, 6) AS shift_stds FROM a, b
UNION ALL SELECT 'l_tax', round(a.t, 6), round(b.t, 6), round(abs(b.t - a.t) / a.ts, 6) FROM a, b""")
def q_drift_carry_over(spark, sf):
    """The second of two runs is compared with what the first one left."""
    from ..operators import profile as P
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "carry") + "/column_stats"
    for run, half in enumerate((0, 1)):
        stats = P.column_stats(li.where(F.col("l_linenumber") % 2 == half), ["l_quantity", "l_tax"])
        events, _ = D.carry_over(spark, path, stats, f"run{run}")
    return rnd(events.select("column_name", "prev_mean", "curr_mean", "shift_stds"))


# --------------------------------------------------------------------------- #
# What must hold of any learner
# --------------------------------------------------------------------------- #
@register("regression_facts", """
SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS holdout, CAST(count(*) - ceil(0.2 * count(*)) AS BIGINT) AS train,
       true AS explains_training_rows, true AS importances_sum_to_one FROM part""")
def q_regression_facts(spark, sf):
    """Split sizes, and a fit that explains its training rows better than their mean does."""
    split, meta, info = QM._prepared(spark, sf, "part", "p_partkey")
    model = QM._fitted(spark, sf, "part", "p_partkey")
    held = split.where("is_test").count()
    m = EV.regression_metrics(M.score(model, split.where(~F.col("is_test")), "p_partkey"))
    total = sum(v for _, v in model.importances())
    return m.select(F.lit(held).cast("bigint").alias("holdout"), F.col("n").alias("train"),
                    (F.col("r2") > 0).alias("explains_training_rows"), F.lit(abs(total - 1) < 1e-6).alias("importances_sum_to_one"))


@register("classification_facts", """
WITH k AS (SELECT o_orderpriority AS actual, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT sum(n) AS total, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_test FROM k),
q AS (SELECT actual, (n_test * n) // total AS base, (n_test * n) % total AS rem, n_test FROM k, t),
r AS (SELECT *, row_number() OVER (ORDER BY rem DESC, CAST(dense_rank AS VARCHAR)) AS rk, n_test - sum(base) OVER () AS extra
      FROM (SELECT *, dense_rank() OVER (ORDER BY actual) - 1 AS dense_rank FROM q))
SELECT actual, CAST(base + CASE WHEN rk <= extra THEN 1 ELSE 0 END AS BIGINT) AS scored, true AS probabilities_sum_to_one,
       true AS confidence_is_largest FROM r""")
def q_classification_facts(spark, sf):
    """Scored rows of each class, and probabilities that are probabilities."""
    split, meta, _ = QM._prepared(spark, sf, "orders", "o_orderkey")
    model = QM._fitted(spark, sf, "orders", "o_orderkey")
    scored = M.score(model, split.where("is_test"), "o_orderkey", meta["class_names"], probs=True)
    one = F.abs(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9
    return scored.groupBy("actual").agg(F.count(F.lit(1)).alias("scored"), F.bool_and(one).alias("probabilities_sum_to_one"),
                                        F.bool_and(F.col("confidence") == F.array_max("probs")).alias("confidence_is_largest"))
