"""Source and cleaning queries (S1-S8, P1-P4, C1-C9) on fixtures derived from the tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..session import scratch_path
from ..sources import readers as R
from .catalog import register, rnd, table

# --------------------------------------------------------------------------- #
# Dirty orders fixture: the same expressions in Spark and in SQL.
# --------------------------------------------------------------------------- #
DIRTY_SQL = """
WITH base AS (
  SELECT o_orderkey,
         CASE o_orderkey % 9 WHEN 0 THEN ' N/A ' WHEN 1 THEN '?' WHEN 2 THEN '' ELSE o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 33 = 0 THEN 'bad' ELSE CAST(o_totalprice AS VARCHAR) END AS price_txt,
         CASE WHEN o_orderkey % 10 = 0 THEN 'bad' ELSE CAST(o_custkey AS VARCHAR) END AS cust_txt,
         CASE WHEN o_orderkey % 33 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_txt,
         CASE WHEN o_orderkey % 10 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_txt90,
         CASE WHEN o_orderkey % 3 <> 0 THEN NULL ELSE o_totalprice END AS sparse67,
         CASE WHEN o_orderkey % 2 <> 0 THEN NULL ELSE o_orderstatus END AS sparse50,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS qty_nulls,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS date_nulls,
         CAST(NULL AS DOUBLE) AS empty_col
  FROM orders),
dirty AS (
  SELECT * FROM base
  UNION ALL SELECT * FROM base WHERE o_orderkey % 20 = 0
  UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)"""


def dirty_orders(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    null = F.lit(None)
    base = o.select(
        k,
        F.when(k % 9 == 0, " N/A ").when(k % 9 == 1, "?").when(k % 9 == 2, "").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 33 == 0, "bad").otherwise(F.col("o_totalprice").cast("string")).alias("price_txt"),
        F.when(k % 10 == 0, "bad").otherwise(F.col("o_custkey").cast("string")).alias("cust_txt"),
        F.when(k % 33 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_txt"),
        F.when(k % 10 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_txt90"),
        F.when(k % 3 != 0, null).otherwise(F.col("o_totalprice")).alias("sparse67"),
        F.when(k % 2 != 0, null).otherwise(F.col("o_orderstatus")).alias("sparse50"),
        F.when(k % 7 == 0, null).otherwise(F.col("o_totalprice")).alias("qty_nulls"),
        F.when(k % 11 == 0, null).otherwise(F.col("o_orderdate")).alias("date_nulls"),
        null.cast("double").alias("empty_col"))
    empty = base.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in base.schema.fields])
    return base.unionByName(base.where(k % 20 == 0)).unionByName(empty)


def _prep(spark, sf):
    """P3 + C1 + C4 on the fixture (shared first steps)."""
    d = C.drop_empty(dirty_orders(spark, sf))
    return C.drop_duplicates(C.strip_null_tokens(d))


# --------------------------------------------------------------------------- #
# P3
# --------------------------------------------------------------------------- #
@register("drop_empty", DIRTY_SQL + """
SELECT o_orderkey, priority, price_txt, cust_txt, date_txt, date_txt90, sparse67, sparse50, qty_nulls, date_nulls
FROM dirty
WHERE NOT (o_orderkey IS NULL AND priority IS NULL AND price_txt IS NULL AND cust_txt IS NULL AND date_txt IS NULL
           AND date_txt90 IS NULL AND sparse67 IS NULL AND sparse50 IS NULL AND qty_nulls IS NULL
           AND date_nulls IS NULL AND empty_col IS NULL)""")
def q_drop_empty(spark, sf):
    return C.drop_empty(dirty_orders(spark, sf))


# --------------------------------------------------------------------------- #
# C1
# --------------------------------------------------------------------------- #
@register("null_tokens", """
SELECT o_orderkey,
       CASE WHEN lower(trim(p)) IN _NULL_TOKENS_ THEN NULL ELSE trim(p) END AS priority
FROM (SELECT o_orderkey,
             CASE o_orderkey % 9 WHEN 0 THEN ' N/A ' WHEN 1 THEN '?' WHEN 2 THEN '' ELSE o_orderpriority END AS p
      FROM orders)""")
def q_null_tokens(spark, sf):
    base = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 9 == 0, " N/A ").when(F.col("o_orderkey") % 9 == 1, "?")
         .when(F.col("o_orderkey") % 9 == 2, "").otherwise(F.col("o_orderpriority")).alias("priority"))
    return C.strip_null_tokens(base, key="o_orderkey")


# --------------------------------------------------------------------------- #
# C4
# --------------------------------------------------------------------------- #
@register("drop_duplicates", DIRTY_SQL + """,
c1 AS (
  SELECT o_orderkey,
         CASE WHEN lower(trim(priority)) IN _NULL_TOKENS_ THEN NULL ELSE trim(priority) END AS priority,
         trim(price_txt) AS price_txt, trim(cust_txt) AS cust_txt, trim(date_txt) AS date_txt, trim(date_txt90) AS date_txt90,
         sparse67, sparse50, qty_nulls, date_nulls
  FROM dirty WHERE o_orderkey IS NOT NULL)
SELECT DISTINCT * FROM c1""")
def q_drop_duplicates(spark, sf):
    return _prep(spark, sf)


# --------------------------------------------------------------------------- #
# C2 / C3 / P4 (decisions checked through the values they produce)
# --------------------------------------------------------------------------- #
_C4_SQL = DIRTY_SQL + """,
c4 AS (
  SELECT DISTINCT o_orderkey,
         CASE WHEN lower(trim(priority)) IN _NULL_TOKENS_ THEN NULL ELSE trim(priority) END AS priority,
         trim(price_txt) AS price_txt, trim(cust_txt) AS cust_txt, trim(date_txt) AS date_txt, trim(date_txt90) AS date_txt90,
         sparse67, sparse50, qty_nulls, date_nulls
  FROM dirty WHERE o_orderkey IS NOT NULL),
co AS (
  SELECT o_orderkey, priority, TRY_CAST(price_txt AS DOUBLE) AS price_txt, cust_txt,
         TRY_CAST(TRY_STRPTIME(date_txt, '%Y-%m-%d') AS TIMESTAMP) AS date_txt, date_txt90,
         sparse50, qty_nulls, date_nulls
  FROM c4)"""


@register("coerce_numeric", _C4_SQL + """
SELECT o_orderkey, price_txt, cust_txt FROM co""")
def q_coerce_numeric(spark, sf):
    d, _ = C.coerce_numeric(_prep(spark, sf).select("o_orderkey", "price_txt", "cust_txt"), key="o_orderkey")
    return d


@register("coerce_datetime", _C4_SQL + """
SELECT o_orderkey, date_txt, date_txt90 FROM co""")
def q_coerce_datetime(spark, sf):
    d, _ = C.coerce_datetime(_prep(spark, sf).select("o_orderkey", "date_txt", "date_txt90"), key="o_orderkey")
    return d


@register("drop_sparse_columns", _C4_SQL + """,
ns AS (
  SELECT count(*) AS n,
         sum(CASE WHEN priority IS NULL THEN 1 ELSE 0 END) AS priority,
         sum(CASE WHEN price_txt IS NULL THEN 1 ELSE 0 END) AS price_txt,
         sum(CASE WHEN cust_txt IS NULL THEN 1 ELSE 0 END) AS cust_txt,
         sum(CASE WHEN date_txt IS NULL THEN 1 ELSE 0 END) AS date_txt,
         sum(CASE WHEN date_txt90 IS NULL THEN 1 ELSE 0 END) AS date_txt90,
         sum(CASE WHEN sparse67 IS NULL THEN 1 ELSE 0 END) AS sparse67,
         sum(CASE WHEN sparse50 IS NULL THEN 1 ELSE 0 END) AS sparse50,
         sum(CASE WHEN qty_nulls IS NULL THEN 1 ELSE 0 END) AS qty_nulls,
         sum(CASE WHEN date_nulls IS NULL THEN 1 ELSE 0 END) AS date_nulls
  FROM (SELECT c4.o_orderkey, co.priority, co.price_txt, co.cust_txt, co.date_txt, co.date_txt90, c4.sparse67,
               co.sparse50, co.qty_nulls, co.date_nulls
        FROM c4 JOIN co ON c4.o_orderkey = co.o_orderkey)),
lf AS (
  UNPIVOT ns ON priority, price_txt, cust_txt, date_txt, date_txt90, sparse67, sparse50, qty_nulls, date_nulls
  INTO NAME column_name VALUE nulls)
SELECT column_name, round(nulls / n, 6) AS null_share, nulls / n > 0.6 AS dropped FROM lf""")
def q_drop_sparse_columns(spark, sf):
    d = _prep(spark, sf)
    st = C.coercion_stats(d, key="o_orderkey")
    plan = C.plan_coercion(d, st, key="o_orderkey")
    rows = [(c, round(v, 6), c in plan["sparse"]) for c, v in plan["null_share"].items()]
    return spark.createDataFrame(rows, "column_name string, null_share double, dropped boolean")


# --------------------------------------------------------------------------- #
# C5 / C6 / C7 and the whole clean
# --------------------------------------------------------------------------- #
_CLEAN_SQL = _C4_SQL + """,
fills AS (
  SELECT (SELECT priority FROM co WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1) AS f_priority,
         (SELECT sparse50 FROM co WHERE sparse50 IS NOT NULL GROUP BY sparse50 ORDER BY count(*) DESC, sparse50 LIMIT 1) AS f_sparse50,
         (SELECT quantile_cont(price_txt, 0.5) FROM co) AS f_price,
         (SELECT quantile_cont(qty_nulls, 0.5) FROM co) AS f_qty,
         (SELECT CAST(quantile_cont(epoch_us(date_txt), 0.5) AS BIGINT) FROM co) AS f_date,
         (SELECT CAST(quantile_cont(epoch_us(date_nulls), 0.5) AS BIGINT) FROM co) AS f_date_nulls),
cleaned AS (
  SELECT o_orderkey, coalesce(priority, f_priority) AS priority, coalesce(price_txt, f_price) AS price_txt, cust_txt,
         coalesce(date_txt, make_timestamp(f_date)) AS date_txt, date_txt90,
         coalesce(sparse50, f_sparse50) AS sparse50, coalesce(qty_nulls, f_qty) AS qty_nulls,
         coalesce(date_nulls, make_timestamp(f_date_nulls)) AS date_nulls
  FROM co, fills)"""


@register("impute_median", _CLEAN_SQL + """
SELECT o_orderkey, round(price_txt, 6) AS price_txt, round(qty_nulls, 6) AS qty_nulls FROM cleaned""")
def q_impute_median(spark, sf):
    d, _ = C.coerce_numeric(_prep(spark, sf).select("o_orderkey", "price_txt", "qty_nulls"), key="o_orderkey")
    out, _ = C.impute(d, key="o_orderkey")
    return rnd(out)


@register("impute_datetime", _CLEAN_SQL + """
SELECT o_orderkey, date_txt, date_nulls FROM cleaned""")
def q_impute_datetime(spark, sf):
    d, _ = C.coerce_datetime(_prep(spark, sf).select("o_orderkey", "date_txt", "date_nulls"), key="o_orderkey")
    out, _ = C.impute(d, key="o_orderkey")
    return out


@register("impute_mode", _CLEAN_SQL + """
SELECT o_orderkey, priority, sparse50 FROM cleaned""")
def q_impute_mode(spark, sf):
    out, _ = C.impute(_prep(spark, sf).select("o_orderkey", "priority", "sparse50"), key="o_orderkey")
    return out


@register("clean_table", _CLEAN_SQL + """
SELECT o_orderkey, priority, round(price_txt, 6) AS price_txt, cust_txt, date_txt, date_txt90, sparse50,
       round(qty_nulls, 6) AS qty_nulls, date_nulls FROM cleaned""")
def q_clean_table(spark, sf):
    out, _ = C.clean(dirty_orders(spark, sf))
    return rnd(out)


@register("clean_report", DIRTY_SQL + """
SELECT CAST((SELECT count(*) FROM dirty) AS BIGINT) AS rows_before,
       CAST((SELECT count(*) FROM orders) AS BIGINT) AS rows_after,
       CAST(11 AS BIGINT) AS cols_before, CAST(9 AS BIGINT) AS cols_after,
       CAST((SELECT count(*) FROM orders WHERE o_orderkey % 20 = 0) AS BIGINT) AS duplicate_rows_removed,
       'sparse67' AS high_missing_columns_dropped, 'price_txt' AS coerced_to_numeric,
       'date_txt' AS coerced_to_datetime,
       'priority:mode,price_txt:median,date_txt:median(datetime),sparse50:mode,qty_nulls:median,date_nulls:median(datetime)'
         AS imputed_columns""")
def q_clean_report(spark, sf):
    _, rep = C.clean(dirty_orders(spark, sf))
    return C.report_frame(spark, rep)


# --------------------------------------------------------------------------- #
# Sources
# --------------------------------------------------------------------------- #
_CUSTOMER_TYPED = """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"""


def _write_copy(spark, sf, name, fmt):
    path = scratch_path(spark, name) + f"/{name}.{fmt}"
    df = table(spark, sf, name)
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
    return path


@register("scan_parquet", "SELECT * FROM customer")
def q_scan_parquet(spark, sf):
    return R.read_dataset(spark, f"{sf.rstrip('/')}/customer.parquet")


@register("scan_csv", _CUSTOMER_TYPED)
def q_scan_csv(spark, sf):
    return R.read_dataset(spark, _write_copy(spark, sf, "customer", "csv"))


@register("scan_json", _CUSTOMER_TYPED)
def q_scan_json(spark, sf):
    return R.read_dataset(spark, _write_copy(spark, sf, "customer", "json"))


@register("ingest_profile", """
SELECT 'csv' AS source_format, CAST(count(*) AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_cols,
       'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns,
       'c_custkey:bigint,c_name:string,c_nationkey:bigint,c_acctbal:double,c_mktsegment:string' AS dtypes,
       '' AS dropped_unnamed_columns
FROM customer""")
def q_ingest_profile(spark, sf):
    _, meta = R.ingest(spark, _write_copy(spark, sf, "customer", "csv"))
    return R.ingest_profile_frame(spark, meta).drop("source_name")


@register("normalize_columns", """
SELECT c_custkey AS "id", c_name AS "name", c_nationkey AS "id.1" FROM customer""")
def q_normalize_columns(spark, sf):
    cu = table(spark, sf, "customer").toDF("id", " name ", "id", "", "Unnamed: 4")
    out, _junk = R.normalize_columns(cu)
    return out


@register("nested_to_text")
def q_nested_to_text(spark, sf):
    return R.nested_to_text(table(spark, sf, "embeddings"))


@register("nested_struct_to_text", """
SELECT o_orderkey,
       to_json({'k': o_orderkey, 'status': o_orderstatus, 'parts': [o_custkey, o_orderkey % 7]}) AS nested
FROM orders""")
def q_nested_struct_to_text(spark, sf):
    """A struct holding an array, derived from orders, becomes JSON text."""
    o = table(spark, sf, "orders")
    nested = F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"),
                      F.array(F.col("o_custkey"), F.col("o_orderkey") % 7).alias("parts"))
    return R.nested_to_text(o.select("o_orderkey", nested.alias("nested")))
