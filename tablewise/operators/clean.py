"""Cleaning and coercion.

The whole clean costs a fixed number of jobs whatever the column count:
  1. one aggregation: rows, non-null count per column, all-null rows (P3);
  2. one count of the de-duplicated rows (C4);
  3. one aggregation: parse shares and post-coercion null shares for every
     text column (C2, C3, P4 decided together);
  4. imputation values: exact medians (one aggregation, or distributed
     selection for very many distinct values) and modes (one grouped count).
The de-duplicated frame feeds steps 3-4, so it is persisted once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import stats as S
from ..functions.scalars import INTEGER_PATTERN, col_, has_date_hint, null_token, parse_datetime, strip, to_number
from ..session import scratch_path


def _cols(df: DataFrame, key: str | None) -> list[str]:
    return [c for c in df.columns if c != key]


# --------------------------------------------------------------------------- #
# P3
# --------------------------------------------------------------------------- #
def empty_stats(df: DataFrame, key: str | None = None) -> dict:
    cols = _cols(df, key)
    all_null = F.lit(True)
    for c in cols:
        all_null = all_null & col_(c).isNull()
    exprs = {"rows": F.count(F.lit(1)), "null_rows": F.sum(all_null.cast("long"))}
    exprs.update({("nn", c): F.count(col_(c)) for c in cols})
    return S.one_row(df, exprs)


def drop_empty(df: DataFrame, key: str | None = None, stats: dict | None = None) -> DataFrame:
    """Drop rows whose every value is NULL, then columns that are entirely NULL."""
    cols = _cols(df, key)
    st = stats or empty_stats(df, key)
    keep_cols = [c for c in cols if st[("nn", c)] > 0]
    rows = df.na.drop(how="all", subset=cols) if cols else df
    return rows.select(*[col_(c) for c in df.columns if c == key or c in keep_cols])


# --------------------------------------------------------------------------- #
# C1
# --------------------------------------------------------------------------- #
def strip_null_tokens(df: DataFrame, key: str | None = None) -> DataFrame:
    """Trim text columns; null tokens become NULL. Float NaN becomes NULL too."""
    out = []
    for f in df.schema.fields:
        c = col_(f.name)
        if f.name != key and isinstance(f.dataType, T.StringType):
            out.append(null_token(c).alias(f.name))
        elif f.name != key and S.is_floating(f.dataType):
            out.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


# --------------------------------------------------------------------------- #
# C4
# --------------------------------------------------------------------------- #
def drop_duplicates(df: DataFrame, key: str | None = None) -> DataFrame:
    """Exact-row de-duplication (NULL equals NULL); with a key the lowest key is kept.

    A group of copies holding a third of the table is combined map-side by
    the partial aggregation, so it never lands whole in one task.
    """
    cols = _cols(df, key)
    if key is None:
        return df.dropDuplicates()
    return df.groupBy(*[col_(c) for c in cols]).agg(F.min(col_(key)).alias(key)).select(*[col_(c) for c in df.columns])


# --------------------------------------------------------------------------- #
# C2 / C3 / P4 decisions
# --------------------------------------------------------------------------- #
def coercion_stats(df: DataFrame, key: str | None = None) -> dict:
    """One aggregation: for every text column, numeric / integer / datetime parse
    counts; for every column, NULL count."""
    exprs = {"rows": F.count(F.lit(1))}
    for f in df.schema.fields:
        if f.name == key:
            continue
        c = col_(f.name)
        exprs[("null", f.name)] = F.sum(c.isNull().cast("long"))
        if isinstance(f.dataType, T.StringType):
            exprs[("nn", f.name)] = F.count(c)
            exprs[("num", f.name)] = F.count(to_number(c))
            exprs[("int", f.name)] = F.count(F.when(strip(c).rlike(INTEGER_PATTERN), strip(c).try_cast("bigint")))
            exprs[("hint", f.name)] = F.max(has_date_hint(c).cast("int"))
            exprs[("dt", f.name)] = F.count(parse_datetime(c))
    return S.one_row(df, exprs)


def plan_coercion(df: DataFrame, st: dict, key: str | None = None) -> dict:
    """Decide numeric / datetime conversion and sparse columns from ``coercion_stats``."""
    rows = st["rows"]
    numeric, integer, datetime_, nulls_after = [], [], [], {}
    for f in df.schema.fields:
        if f.name == key:
            continue
        n_null = st[("null", f.name)] or 0
        after = n_null
        if isinstance(f.dataType, T.StringType):
            nn = st[("nn", f.name)] or 0
            if nn > 0 and st[("num", f.name)] / nn >= K.COERCE_MIN_PARSE_SHARE:
                numeric.append(f.name)
                if n_null == 0 and st[("int", f.name)] == nn:
                    integer.append(f.name)
                after = rows - st[("num", f.name)]
            elif nn > 0 and st[("hint", f.name)] and st[("dt", f.name)] / nn >= K.COERCE_MIN_PARSE_SHARE:
                datetime_.append(f.name)
                after = rows - st[("dt", f.name)]
        nulls_after[f.name] = after
    sparse = [c for c, n in nulls_after.items() if rows > 0 and n / rows > K.MAX_MISSING_FRACTION]
    return {"numeric": numeric, "integer": integer, "datetime": datetime_, "sparse": sparse,
            "null_share": {c: (n / rows if rows else 0.0) for c, n in nulls_after.items()},
            "nulls_after": nulls_after, "rows": rows}


def apply_coercion(df: DataFrame, plan: dict) -> DataFrame:
    out = []
    for c in df.columns:
        if c in plan["sparse"]:
            continue
        if c in plan["integer"]:
            out.append(strip(col_(c)).try_cast("bigint").alias(c))
        elif c in plan["numeric"]:
            out.append(to_number(col_(c)).alias(c))
        elif c in plan["datetime"]:
            out.append(parse_datetime(col_(c)).alias(c))
        else:
            out.append(col_(c))
    return df.select(*out)


def coerce_numeric(df: DataFrame, key: str | None = None) -> tuple[DataFrame, list[str]]:
    """C2 alone: text columns where >= 95% of non-null values parse become numbers."""
    st = coercion_stats(df, key)
    p = plan_coercion(df, st, key)
    p = {**p, "datetime": [], "sparse": []}
    return apply_coercion(df, p), p["numeric"]


def coerce_datetime(df: DataFrame, key: str | None = None) -> tuple[DataFrame, list[str]]:
    """C3 alone (after C2): hinted text columns where >= 95% parse become timestamps."""
    st = coercion_stats(df, key)
    p = plan_coercion(df, st, key)
    p = {**p, "numeric": [], "integer": [], "sparse": []}
    return apply_coercion(df, p), p["datetime"]


def drop_sparse_columns(df: DataFrame, key: str | None = None) -> tuple[DataFrame, list[str]]:
    """P4 alone: drop columns whose NULL share is strictly above 0.6."""
    rows_nulls = S.one_row(df, {"rows": F.count(F.lit(1)),
                                **{c: F.sum(col_(c).isNull().cast("long")) for c in _cols(df, key)}})
    rows = rows_nulls["rows"]
    drop = [c for c in _cols(df, key) if rows and (rows_nulls[c] or 0) / rows > K.MAX_MISSING_FRACTION]
    return df.drop(*drop), drop


# --------------------------------------------------------------------------- #
# C5 / C6 / C7
# --------------------------------------------------------------------------- #
def impute(df: DataFrame, key: str | None = None, null_counts: dict | None = None) -> tuple[DataFrame, dict]:
    """Fill NULLs: exact median (numbers), midpoint median (datetimes), mode (else).

    Mode ties take the lowest value; a column with no value at all gets 'missing'.
    Mode-filled columns become text.
    """
    cols = _cols(df, key)
    if null_counts is None:
        null_counts = S.one_row(df, {c: F.sum(col_(c).isNull().cast("long")) for c in cols})
    todo = [c for c in cols if (null_counts.get(c) or 0) > 0]
    if not todo:
        return df, {}
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in todo if S.is_numeric(types[c])]
    dts = [c for c in todo if S.is_datetime(types[c])]
    other = [c for c in todo if c not in num and c not in dts]
    fills: dict = {}
    imputed: dict[str, str] = {}
    if num or dts:
        probe = df.select(*[col_(c) for c in num],
                          *[F.unix_micros(col_(c).cast("timestamp")).alias(c) for c in dts])
        med = S.exact_quantiles(probe, num + dts, [0.5])
        for c in num:
            fills[c] = med[c][0]
            imputed[c] = "median"
        for c in dts:
            fills[c] = med[c][0]
            imputed[c] = "median(datetime)"
    if other:
        texted = df.select(*[_text(df, c).alias(c) for c in other])
        modes = S.modes(texted, other)
        for c in other:
            fills[c] = modes[c] if modes[c] is not None else "missing"
            imputed[c] = "mode"
    out = []
    for c in df.columns:
        x = col_(c)
        if c in num:
            v = fills[c]
            # a numeric column with gaps is floating (as a NaN-holding column would be)
            out.append(x if v is None else F.coalesce(x.cast("double"), F.lit(float(v))).alias(c))
        elif c in dts:
            v = fills[c]
            fill = F.timestamp_micros(F.lit(int(v))).cast(types[c]) if v is not None else None
            out.append(x if fill is None else F.coalesce(x, fill).alias(c))
        elif c in other:
            out.append(F.coalesce(_text(df, c), F.lit(fills[c])).alias(c))
        else:
            out.append(x)
    return df.select(*out), {c: imputed[c] for c in df.columns if c in imputed}


def _text(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    if isinstance(dt, T.BooleanType):
        return F.when(col_(c), "True").when(~col_(c), "False")
    return col_(c).cast("string")


# --------------------------------------------------------------------------- #
# C8 / C9
# --------------------------------------------------------------------------- #
def clean(df: DataFrame, key: str | None = None) -> tuple[DataFrame, dict]:
    """Raw table -> cleaned table and report.

    Order: P3, C1, C4, C2, C3, P4, C5-C7, P8. The de-duplicated table is written to the shared
    folder once: three aggregations and the result read it, and nothing stays in executors.
    """
    st0 = empty_stats(df, key)
    rows_before, cols_before = st0["rows"], len(df.columns)
    d = drop_empty(df, key, st0)
    d = strip_null_tokens(d, key)
    rows_nonempty = rows_before - (st0["null_rows"] or 0)
    d = drop_duplicates(d, key)
    path = scratch_path(df.sparkSession, "clean")
    d.write.parquet(path)
    d = df.sparkSession.read.parquet(path)
    st = coercion_stats(d, key)
    rows_after = st["rows"]
    plan = plan_coercion(d, st, key)
    c = apply_coercion(d, plan)
    nulls = {k: v for k, v in plan["nulls_after"].items() if k not in plan["sparse"]}
    out, imputed = impute(c, key, nulls)
    n_cols_after = len(out.columns)
    if rows_after == 0 or n_cols_after < 2:
        raise ValueError(f"after cleaning {rows_after} rows and {n_cols_after} columns are left; a feature and a target are needed")
    report = {
        "rows_before": int(rows_before), "rows_after": int(rows_after),
        "cols_before": int(cols_before), "cols_after": int(n_cols_after),
        "duplicate_rows_removed": int(rows_nonempty - rows_after),
        "high_missing_columns_dropped": plan["sparse"],
        "coerced_to_numeric": plan["numeric"], "coerced_to_datetime": plan["datetime"],
        "imputed_columns": imputed,
    }
    return out, report


def report_frame(spark, report: dict) -> DataFrame:
    """The clean report as a one-row DataFrame (lists as comma-joined text)."""
    row = (report["rows_before"], report["rows_after"], report["cols_before"], report["cols_after"],
           report["duplicate_rows_removed"], ",".join(report["high_missing_columns_dropped"]),
           ",".join(report["coerced_to_numeric"]), ",".join(report["coerced_to_datetime"]),
           ",".join(f"{k}:{v}" for k, v in report["imputed_columns"].items()))
    return spark.createDataFrame([row], "rows_before bigint, rows_after bigint, cols_before bigint, "
                                        "cols_after bigint, duplicate_rows_removed bigint, "
                                        "high_missing_columns_dropped string, coerced_to_numeric string, "
                                        "coerced_to_datetime string, imputed_columns string")
