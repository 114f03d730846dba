"""Profiling queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats as S
from ..operators import drift as D
from ..operators import profile as P
from ..operators import snapshots as SN
from ..session import scratch_path
from .catalog import register, rnd, table

_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---- A10 / A11 -------------------------------------------------------------
@register("detect_date_column", """
SELECT 'orders' AS table_name, 'o_orderdate' AS date_column,
       CAST(datediff('day', min(o_orderdate), max(o_orderdate)) AS BIGINT) AS span_days FROM orders
UNION ALL
SELECT 'lineitem', 'l_shipdate', CAST(datediff('day', min(l_shipdate), max(l_shipdate)) AS BIGINT) FROM lineitem
UNION ALL
SELECT 'events', 'ts', CAST(datediff('day', min(ts), max(ts)) AS BIGINT) FROM events""")
def q_detect_date_column(spark, sf):
    out = None
    for t in ("orders", "lineitem", "events"):
        df = table(spark, sf, t)
        c = P.detect_date_column(df)
        part = df.agg(F.lit(t).alias("table_name"), F.lit(c).alias("date_column"),
                      F.datediff(F.max(c), F.min(c)).cast("bigint").alias("span_days"))
        out = part if out is None else out.unionByName(part)
    return out


@register("detect_metric_column", """
SELECT 'orders' AS table_name, 'o_totalprice' AS metric_column
UNION ALL SELECT 'lineitem', 'l_quantity'
UNION ALL SELECT 'events', 'value'
UNION ALL SELECT 'part', 'p_retailprice'
UNION ALL
SELECT 'customer', arg_max(c, cov) FROM (
  SELECT 0 AS pos, 'c_custkey' AS c, CASE WHEN avg(c_custkey) <> 0 THEN stddev_samp(c_custkey) / abs(avg(c_custkey)) ELSE 0 END AS cov FROM customer
  UNION ALL SELECT 1, 'c_nationkey', CASE WHEN avg(c_nationkey) <> 0 THEN stddev_samp(c_nationkey) / abs(avg(c_nationkey)) ELSE 0 END FROM customer
  UNION ALL SELECT 2, 'c_acctbal', CASE WHEN avg(c_acctbal) <> 0 THEN stddev_samp(c_acctbal) / abs(avg(c_acctbal)) ELSE 0 END FROM customer)""")
def q_detect_metric_column(spark, sf):
    rows = []
    for t in ("orders", "lineitem", "events", "part", "customer"):
        df = table(spark, sf, t)
        rows.append((t, P.detect_metric_column(df, P.detect_date_column(df), df.columns[-1])))
    return spark.createDataFrame(rows, "table_name string, metric_column string")


# ---- A1 / A4 ---------------------------------------------------------------
def _summary_sql() -> str:
    cols = [("l_orderkey", "bigint", "numeric"), ("l_partkey", "bigint", "numeric"),
            ("l_suppkey", "bigint", "numeric"), ("l_linenumber", "int", "numeric"),
            ("l_quantity", "double", "numeric"), ("l_extendedprice", "double", "numeric"),
            ("l_discount", "double", "numeric"), ("l_tax", "double", "numeric"),
            ("l_returnflag", "string", "categorical"), ("l_linestatus", "string", "categorical"),
            ("l_shipdate", "timestamp_ntz", "datetime")]
    parts = []
    for i, (c, dt, kind) in enumerate(cols):
        miss = f"count(*) - count({c})" if dt != "double" else f"count(*) - count({c}) + count(*) FILTER (WHERE isnan({c}))"
        distinct = f"count(DISTINCT {c})" if dt != "double" else f"count(DISTINCT {c}) FILTER (WHERE NOT isnan({c}))"
        mn = f"CAST(strftime(min({c}), '%Y-%m-%d %H:%M:%S') AS VARCHAR)" if kind == "datetime" else "CAST(NULL AS VARCHAR)"
        mx = f"CAST(strftime(max({c}), '%Y-%m-%d %H:%M:%S') AS VARCHAR)" if kind == "datetime" else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT {i} AS position, '{c}' AS column_name, '{dt}' AS dtype, '{kind}' AS kind, "
                     f"CAST({miss} AS BIGINT) AS missing, CAST({distinct} AS BIGINT) AS n_unique, "
                     f"{mn} AS min_value, {mx} AS max_value FROM lineitem")
    return _union(parts)


@register("column_summary", _summary_sql())
def q_column_summary(spark, sf):
    return P.column_summary(table(spark, sf, "lineitem"))


# ---- A2 --------------------------------------------------------------------
def _describe_sql() -> str:
    parts = []
    for i, c in enumerate(_LI_NUM):
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT {i} AS position, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS median, "
            f"round(quantile_cont({x}, 0.75), 6) AS q75, round(max({x}), 6) AS max FROM lineitem")
    return _union(parts)


@register("numeric_describe", _describe_sql())
def q_numeric_describe(spark, sf):
    return rnd(P.numeric_describe(table(spark, sf, "lineitem")))


# ---- A3 --------------------------------------------------------------------
def _hist_sql() -> str:
    specs = []
    for c in _LI_NUM:
        specs.append(f"SELECT '{c}' AS column_name, min(CAST({c} AS DOUBLE)) AS mn, max(CAST({c} AS DOUBLE)) AS mx, "
                     f"count(DISTINCT {c}) AS nd FROM lineitem")
    vals = [f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM lineitem WHERE {c} IS NOT NULL" for c in _LI_NUM]
    return f"""
WITH st AS ({_union(specs)}),
spec AS (
  SELECT column_name,
         CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS f,
         CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS l,
         CAST(least(20, greatest(5, nd)) AS INTEGER) AS bins
  FROM st WHERE mn IS NOT NULL),
v AS ({_union(vals)}),
b0 AS (
  SELECT v.column_name, x, f, l, bins,
         CAST(least(floor((x - f) * (bins / (l - f))), bins - 1) AS INTEGER) AS b
  FROM v JOIN spec USING (column_name)),
b1 AS (
  SELECT column_name,
         CASE WHEN x < (CASE WHEN b = bins THEN l ELSE f + b * ((l - f) / bins) END) THEN b - 1
              WHEN x >= (CASE WHEN b + 1 = bins THEN l ELSE f + (b + 1) * ((l - f) / bins) END) AND b <> bins - 1 THEN b + 1
              ELSE b END AS bin
  FROM b0),
cnt AS (SELECT column_name, bin, count(*) AS c FROM b1 GROUP BY 1, 2),
grid AS (SELECT column_name, f, l, bins, CAST(unnest(range(0, bins)) AS INTEGER) AS bin FROM spec)
SELECT g.column_name, g.bin,
       round(CASE WHEN g.bin = 0 THEN f ELSE f + g.bin * ((l - f) / bins) END, 6) AS lo,
       round(CASE WHEN g.bin + 1 = bins THEN l ELSE f + (g.bin + 1) * ((l - f) / bins) END, 6) AS hi,
       CAST(coalesce(c, 0) AS BIGINT) AS cnt
FROM grid g LEFT JOIN cnt ON g.column_name = cnt.column_name AND g.bin = cnt.bin"""


@register("histogram", _hist_sql())
def q_histogram(spark, sf):
    return rnd(P.histogram(table(spark, sf, "lineitem"), _LI_NUM))


# ---- A5 --------------------------------------------------------------------
def _topcat_sql() -> str:
    vals = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM orders WHERE {c} IS NOT NULL"
            for c in ("o_orderstatus", "o_orderpriority")]
    vals.append("SELECT 'p_type', CAST(p_type AS VARCHAR) FROM part WHERE p_type IS NOT NULL")
    return f"""
WITH v AS ({_union(vals)}),
c AS (SELECT column_name, value, count(*) AS cnt FROM v GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY cnt DESC, value ASC) AS rank FROM c)
SELECT column_name, value, CAST(cnt AS BIGINT) AS cnt, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 12"""


@register("top_categories", _topcat_sql())
def q_top_categories(spark, sf):
    o = P.top_categories(table(spark, sf, "orders"))
    p = P.top_categories(table(spark, sf, "part"), ["p_type"])
    return o.unionByName(p)


# ---- A12 -------------------------------------------------------------------
def _colstats_sql() -> str:
    parts = []
    for c in _LI_NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, "
                     f"round(min({x}), 6) AS min, round(max({x}), 6) AS max, "
                     f"CAST(count(*) - count({c}) AS BIGINT) AS nulls, CAST(count(*) AS BIGINT) AS rows FROM lineitem")
    return _union(parts)


@register("column_stats", _colstats_sql())
def q_column_stats(spark, sf):
    return rnd(P.column_stats(table(spark, sf, "lineitem")))


# ---- A6-A9 -----------------------------------------------------------------
def _corr_expr(a: str, b: str) -> str:
    return f"coalesce(CASE WHEN isnan(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) THEN NULL ELSE corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) END, 0.0)"


_CUST_COLS = ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _corr_matrix_sql() -> str:
    # customer: target c_mktsegment (text) -> label code by text order, placed last.
    cols = _CUST_COLS
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            parts.append(f"SELECT {i} AS i, {j} AS j, '{a}' AS col_a, '{b}' AS col_b, round({_corr_expr(a, b)}, 4) AS r FROM enc")
    return f"""
WITH codes AS (SELECT c_mktsegment AS v, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS code
               FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL)),
enc AS (SELECT c_custkey, c_nationkey, c_acctbal, codes.code AS c_mktsegment
        FROM customer LEFT JOIN codes ON CAST(customer.c_mktsegment AS VARCHAR) = codes.v)
{_union(parts)}"""


@register("correlation_matrix", _corr_matrix_sql())
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(table(spark, sf, "customer"), "c_mktsegment")


def _pairs_cte() -> str:
    li_cols = _LI_NUM + ["l_shipdate"]
    part_cols = ["p_partkey", "p_size", "p_retailprice"]
    parts = []
    for tname, src, cols in (("lineitem", "enc", li_cols), ("part", "part", part_cols)):
        k = 0
        for i, a in enumerate(cols):
            for b in cols[i + 1:]:
                parts.append(f"SELECT '{tname}' AS table_name, '{cols[-1]}' AS target, {k} AS pair, '{a}' AS col_a, "
                             f"'{b}' AS col_b, {_corr_expr(a, b)} AS r FROM {src}")
                k += 1
    return f"""
WITH codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS code
               FROM (SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS v FROM lineitem WHERE l_shipdate IS NOT NULL)),
enc AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               codes.code AS l_shipdate
        FROM lineitem LEFT JOIN codes ON strftime(lineitem.l_shipdate, '%Y-%m-%d %H:%M:%S') = codes.v),
pairs AS ({_union(parts)})"""


@register("top_correlations", _pairs_cte() + """
, sel AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY abs(round(r, 3)) DESC, pair ASC) AS rank
          FROM pairs WHERE abs(r) >= 0.3)
SELECT table_name, CAST(rank AS INTEGER) AS rank, col_a, col_b, round(r, 3) AS r,
       CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.4 THEN 'moderate' ELSE 'weak' END AS strength,
       CASE WHEN r > 0 THEN 'positively' ELSE 'negatively' END AS direction,
       printf('`%s` and `%s` are %sly %s correlated (r = %+.2f).', col_a, col_b,
              CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.4 THEN 'moderate' ELSE 'weak' END,
              CASE WHEN r > 0 THEN 'positively' ELSE 'negatively' END, r) AS text
FROM sel WHERE rank <= 6""")
def q_top_correlations(spark, sf):
    li = P.top_correlations(table(spark, sf, "lineitem"), "l_shipdate").select(F.lit("lineitem").alias("table_name"), "*")
    pa = P.top_correlations(table(spark, sf, "part"), "p_retailprice").select(F.lit("part").alias("table_name"), "*")
    return li.unionByName(pa)


@register("target_correlations", _pairs_cte() + """
, t AS (SELECT table_name, target, pair, col_a AS feature, r FROM pairs WHERE col_b = target AND abs(r) >= 0.1),
sel AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY abs(r) DESC, pair ASC) AS rank FROM t)
SELECT table_name, CAST(rank AS INTEGER) AS rank, feature, round(r, 3) AS r,
       printf('As `%s` rises, `%s` tends to %s (r = %+.2f).', feature, target,
              CASE WHEN r > 0 THEN 'increase' ELSE 'decrease' END, r) AS text
FROM sel WHERE rank <= 5""")
def q_target_correlations(spark, sf):
    li = P.target_correlations(table(spark, sf, "lineitem"), "l_shipdate").select(F.lit("lineitem").alias("table_name"), "*")
    pa = P.target_correlations(table(spark, sf, "part"), "p_retailprice").select(F.lit("part").alias("table_name"), "*")
    return li.unionByName(pa)


# ---- wide tables, sketches, growing tables ---------------------------------
_WIDE = 40


def _wide(i: int) -> str:
    """The i-th of forty columns made of lineitem's, each with gaps of its own (the same text in Spark and DuckDB)."""
    return (f"CASE WHEN (l_orderkey * {i} + l_linenumber) % {5 + i % 7} = 0 THEN NULL ELSE "
            f"CAST(l_quantity * {i % 5} + l_extendedprice * {(i * 3) % 4} / 1000 + (l_partkey * {i}) % 23 + {1000 * i} AS DOUBLE) END")


@register("correlation_wide", f"""
WITH w AS (SELECT {", ".join(f"{_wide(i)} AS w{i:02d}" for i in range(1, _WIDE + 1))} FROM lineitem),
r AS (SELECT unnest([{", ".join(f"{{'col_a': 'w{i:02d}', 'col_b': 'w{j:02d}', 'r': corr(w{i:02d}, w{j:02d})}}"
                              for i in range(1, _WIDE + 1) for j in range(i + 1, _WIDE + 1))}], recursive := true) FROM w)
SELECT col_a, col_b, round(r, 6) AS r FROM r""")
def q_correlation_wide(spark, sf):
    """All pairs of forty columns with gaps, in one scan."""
    names = [f"w{i:02d}" for i in range(1, _WIDE + 1)]
    wide = table(spark, sf, "lineitem").select(*[F.expr(_wide(i + 1)).alias(n) for i, n in enumerate(names)])
    r = P.correlation_pairs(wide)[1]
    return rnd(spark.createDataFrame([(a, b, r[a, b]) for i, a in enumerate(names) for b in names[i + 1:]],
                                     "col_a string, col_b string, r double"))


@register("numeric_describe_approx", _union([
    f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
        round(min(CAST({c} AS DOUBLE)), 6) AS min, round(max(CAST({c} AS DOUBLE)), 6) AS max, true AS ranks_within_bound FROM lineitem"""
    for c in _LI_NUM]))
def q_numeric_describe_approx(spark, sf):
    """Describe with sketched quantiles; how far their ranks are off is counted exactly."""
    li = table(spark, sf, "lineitem")
    got = SN.describe_approx(li, _LI_NUM)
    found = {r["column_name"]: r for r in got.collect()}
    ends = {}
    for c in _LI_NUM:
        for p, q in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
            v = F.lit(found[c][q])
            # the share of smaller values, and of smaller or equal ones, must hold p between them up to the bound
            ends[c, q] = ((F.avg((F.col(c) < v).cast("int")) <= p + SN.RANK_ERROR)
                          & (F.avg((F.col(c) <= v).cast("int")) >= p - SN.RANK_ERROR))
    ok = S.one_row(li, ends)
    good = F.create_map(*[x for c in _LI_NUM for x in (F.lit(c), F.lit(all(ok[c, q] for q in ("q25", "median", "q75"))))])
    return rnd(got.select("column_name", "n", "mean", "min", "max", good[F.col("column_name")].alias("ranks_within_bound")))


# Rows of one file of the table that grows, at most; three files a step at least.
FILE_ROWS = 1 << 20


def _grown(spark, sf):
    """A table written in two steps and its snapshot after each: (stats before, stats after, files scanned)."""
    base = scratch_path(spark, "grown")
    li = table(spark, sf, "lineitem")
    snap = SN.TableSnapshot(spark, f"{base}/table", f"{base}/log", _LI_NUM)
    stats, scanned = [], []
    for step in (0, 1):
        part = li.where(F.col("l_orderkey") % 3 == 0) if step == 0 else li.where(F.col("l_orderkey") % 3 != 0)
        files = max(3, -(-part.count() // FILE_ROWS))  # a task writes one file: their size stays, their number grows
        part.repartition(files).write.mode("append").parquet(f"{base}/table")
        scanned.append(snap.update())
        stats.append(snap.stats())
    return stats, scanned


# Means of values with two decimals can lie exactly between two roundings: both sides add this before they round.
_NUDGE = 1e-9


def _nudged(df, *cols):
    return rnd(df.withColumns({c: F.col(c) + _NUDGE for c in cols}))


@register("column_stats_incremental", _colstats_sql().replace("round(avg(", f"round({_NUDGE} + avg("))
def q_column_stats_incremental(spark, sf):
    """Column statistics of a table that grew: each file was scanned once, and the merged parts equal one scan of all."""
    (_, after), _ = _grown(spark, sf)
    return _nudged(after.select("column_name", "mean", "std", "min", "max", "nulls", "rows"), "mean")


@register("drift_incremental", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, round({_NUDGE} + avg(CAST({c} AS DOUBLE)) FILTER (l_orderkey % 3 = 0), 6) AS prev_mean,
        round({_NUDGE} + avg(CAST({c} AS DOUBLE)), 6) AS curr_mean,
        round(abs(avg(CAST({c} AS DOUBLE)) - avg(CAST({c} AS DOUBLE)) FILTER (l_orderkey % 3 = 0))
              / stddev_samp(CAST({c} AS DOUBLE)) FILTER (l_orderkey % 3 = 0), 6) AS shift_stds, 'ok' AS status FROM lineitem"""
    for c in _LI_NUM))
def q_drift_incremental(spark, sf):
    """Drift of the grown table against what it was, from the merged snapshots alone."""
    (before, after), _ = _grown(spark, sf)
    return _nudged(D.drift_check(after, before).select("column_name", "prev_mean", "curr_mean", "shift_stds", "status"),
                   "prev_mean", "curr_mean")
