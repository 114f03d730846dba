"""Feature-engineering queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from .catalog import register, rnd, table

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "embeddings", "labels")


@register("detect_target", f"""
WITH cols AS (
  SELECT table_name, column_name, ordinal_position AS pos FROM information_schema.columns
  WHERE table_name IN ({", ".join(f"'{t}'" for t in _TABLES)})),
cand AS (
  SELECT table_name, column_name,
         CASE lower(column_name) WHEN 'target' THEN 1 WHEN 'label' THEN 2 WHEN 'y' THEN 3
              WHEN 'class' THEN 4 WHEN 'outcome' THEN 5 WHEN 'result' THEN 6 END AS prio, pos
  FROM cols),
named AS (SELECT table_name, arg_min(column_name, prio) AS target FROM cand WHERE prio IS NOT NULL GROUP BY 1),
last AS (SELECT table_name, arg_max(column_name, pos) AS target FROM cols GROUP BY 1)
SELECT last.table_name, coalesce(named.target, last.target) AS target
FROM last LEFT JOIN named ON last.table_name = named.table_name""")
def q_detect_target(spark, sf):
    rows = [(t, FE.detect_target(table(spark, sf, t))) for t in _TABLES]
    return spark.createDataFrame(rows, "table_name string, target string")


_TASK_TABLES = {"orders": "o_orderpriority", "part": "p_retailprice", "embeddings": "label",
                "labels": "toxic", "customer": "c_mktsegment", "lineitem": "l_shipdate",
                "supplier": "s_acctbal", "nation": "n_regionkey"}


def _task_sql() -> str:
    parts = []
    for t, c in _TASK_TABLES.items():
        parts.append(f"""
SELECT '{t}' AS table_name, '{c}' AS target, CASE
  WHEN (SELECT data_type FROM information_schema.columns WHERE table_name = '{t}' AND column_name = '{c}')
       NOT SIMILAR TO '(TINYINT|SMALLINT|INTEGER|BIGINT|HUGEINT|FLOAT|DOUBLE|DECIMAL.*)' THEN 'classification'
  WHEN count(DISTINCT {c}) <= 20 AND coalesce(bool_and(TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) % 1 = 0), true) THEN 'classification'
  ELSE 'regression' END AS task_type FROM {t}""")
    return "\nUNION ALL\n".join(parts)


@register("detect_task", _task_sql())
def q_detect_task(spark, sf):
    rows = []
    for t in _TASK_TABLES:
        df = table(spark, sf, t)
        tgt = FE.detect_target(df)
        rows.append((t, tgt, FE.detect_task_type(df, tgt)))
    return spark.createDataFrame(rows, "table_name string, target string, task_type string")


@register("datetime_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate__year,
       CAST(month(o_orderdate) AS INTEGER) AS o_orderdate__month,
       CAST(day(o_orderdate) AS INTEGER) AS o_orderdate__day,
       CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate__dayofweek
FROM orders""")
def q_datetime_parts(spark, sf):
    return FE.expand_datetimes(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"))


_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@register("one_hot", "SELECT event_id, " + ", ".join(
    f"CAST(coalesce(event_type = '{v}', false) AS TINYINT) AS event_type_{v}" for v in _EVENT_TYPES) + " FROM events")
def q_one_hot(spark, sf):
    df, _ = FE.encode_categoricals(table(spark, sf, "events").select("event_id", "event_type"), ("event_id",))
    return df


@register("frequency_encode", """
SELECT event_id, round(count(*) OVER (PARTITION BY CAST(user_id AS VARCHAR)) / CAST(count(*) OVER () AS DOUBLE), 9) AS user_id
FROM events""")
def q_frequency_encode(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("user_id"))
    df, _ = FE.encode_categoricals(ev, ("event_id",))
    return rnd(df, 9)


@register("label_encode", """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS c_mktsegment FROM customer""")
def q_label_encode(spark, sf):
    cu = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return FE.apply_label_mapping(cu, "c_mktsegment", FE.label_mapping(cu, "c_mktsegment"))


@register("engineer_features", """
SELECT o_orderkey, o_custkey, o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS o_orderdate__year, CAST(month(o_orderdate) AS INTEGER) AS o_orderdate__month,
       CAST(day(o_orderdate) AS INTEGER) AS o_orderdate__day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate__dayofweek,
       CAST(o_orderstatus = 'F' AS TINYINT) AS o_orderstatus_F, CAST(o_orderstatus = 'O' AS TINYINT) AS o_orderstatus_O,
       CAST(o_orderstatus = 'P' AS TINYINT) AS o_orderstatus_P,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS o_orderpriority
FROM orders""")
def q_engineer_features(spark, sf):
    out, _meta = FE.engineer(table(spark, sf, "orders"))
    return out


@register("numeric_features", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders""")
def q_numeric_features(spark, sf):
    o = table(spark, sf, "orders")
    dirty = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")))
    return FE.numeric_features(dirty)


@register("finite_target", """
SELECT p_partkey, p_retailprice FROM part
WHERE p_partkey % 13 <> 0 AND p_partkey % 17 <> 0 AND p_partkey % 19 <> 0""")
def q_finite_target(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    y = (F.when(k % 13 == 0, F.lit(None).cast("double")).when(k % 17 == 0, F.lit(float("nan")))
          .when(k % 19 == 0, F.lit(float("inf"))).otherwise(F.col("p_retailprice")))
    return FE.finite_target(p.select("p_partkey", y.alias("p_retailprice")), "p_retailprice")
