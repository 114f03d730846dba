"""Aggregate building blocks shared by the operators.

Every helper here runs as one (or a few) distributed aggregations over all
columns at once; only one small row (or a few hundred rows) per column reaches
the driver.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .scalars import col_

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)
DATETIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def is_datetime(dt: T.DataType) -> bool:
    return isinstance(dt, DATETIME_TYPES)


def is_floating(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_datetime(f.dataType)]


def categorical_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude]


def one_row(df: DataFrame, exprs: dict[str, Column]) -> dict:
    """Evaluate many aggregate expressions in ONE job; return name -> value."""
    if not exprs:
        return {}
    keys = list(exprs)
    aliases = [f"_a{i}" for i in range(len(keys))]
    row = df.agg(*[exprs[k].alias(a) for k, a in zip(keys, aliases)]).first()
    return {k: row[a] for k, a in zip(keys, aliases)}


def long_form(df: DataFrame, cols: list[str], value_type: str = "double",
              name_col: str = "column_name", value_col: str = "value",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Unpivot ``cols`` to (name, value) rows; a narrow, per-row transformation."""
    pairs = F.array(*[F.struct(F.lit(c).alias("n"), col_(c).cast(value_type).alias("v")) for c in cols])
    return (df.select(*[col_(k) for k in keep], F.explode(pairs).alias("_p"))
              .select(*[col_(k) for k in keep], F.col("_p.n").alias(name_col), F.col("_p.v").alias(value_col)))


# --------------------------------------------------------------------------- #
# Exact quantiles (linear interpolation between closest ranks)
# --------------------------------------------------------------------------- #
_SELECT_BUCKETS = 2048


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], stats: dict | None = None) -> dict[str, list]:
    """Exact quantiles of numeric columns, NULL and NaN ignored; one method at every size.

    ``stats`` may hold n, min and max of each column, else one pass gathers them. The two
    ranks around each quantile are then found by ``select_ranks``.
    """
    if not cols:
        return {}
    clean = {c: _finite(df, c) for c in cols}
    if stats is not None:
        st = {(c, k): stats[c][k] for c in cols for k in ("n", "min", "max")}
    else:
        st = one_row(df, {(c, k): f(clean[c]) for c in cols
                          for k, f in (("n", F.count), ("min", F.min), ("max", F.max))})
    place = {c: [p * (st[(c, "n")] - 1) for p in probs] for c in cols if st[(c, "n")]}
    found = select_ranks(df, {c: sorted({r for x in at for r in (math.floor(x), math.ceil(x))})
                              for c, at in place.items()}, st)
    out: dict[str, list] = {c: [None] * len(probs) for c in cols}
    for c, at in place.items():
        low = [(found[c][math.floor(x)], found[c][math.ceil(x)], x - math.floor(x)) for x in at]
        out[c] = [lo + (hi - lo) * part for lo, hi, part in low]
    return out


def _finite(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    v = col_(c).cast("double")
    if is_floating(dt):
        v = F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)
    return v


def select_ranks(df: DataFrame, ranks: dict[str, list[int]], st: dict) -> dict[str, dict[int, float]]:
    """Exact k-th smallest values (0-based ranks) of several columns by histogram refinement.

    Each pass counts, for every interval that still holds a wanted rank, the values in equal
    parts of it (all columns in one aggregation, combined map-side) and keeps the part
    that holds the rank, cut to its least and largest value. A part of one value is the
    answer. At most _SELECT_BUCKETS numbers an interval are read here.
    """
    done: dict[str, dict[int, float]] = {c: {} for c in ranks}
    state = {(c, k): (float(st[(c, "min")]), float(st[(c, "max")]), 0) for c, ks in ranks.items() for k in ks}
    while state:
        for (c, k), (lo, hi, _) in list(state.items()):
            if lo == hi:
                done[c][k] = lo
                del state[(c, k)]
        spans = list(dict.fromkeys((c, *s) for (c, _), s in state.items()))
        if not spans:
            break
        pieces = []
        for i, (c, lo, hi, _) in enumerate(spans):
            v = _finite(df, c)
            # halves first: hi - lo may exceed the largest double
            part = (v / 2 - lo / 2) / (hi / 2 - lo / 2) * _SELECT_BUCKETS
            cell = F.least(F.floor(part), F.lit(_SELECT_BUCKETS - 1)).cast("int")
            # infinities have cells of their own; beside one of them all finite values share a cell
            cell = F.when(v == F.lit(float("inf")), _SELECT_BUCKETS).when(v == F.lit(float("-inf")), -1).otherwise(
                F.when(F.isnan(part), 0).otherwise(cell))
            pieces.append(F.when(v.between(F.lit(lo), F.lit(hi)), F.struct(F.lit(i).alias("t"), cell.alias("b"), v.alias("x"))))
        cells = (df.select(F.explode(F.array(*pieces)).alias("r")).where(F.col("r").isNotNull()).select("r.*")
                 .groupBy("t", "b").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
        by: dict[int, list] = {}
        for r in cells.collect():
            by.setdefault(r["t"], []).append(r)
        for i, span in enumerate(spans):
            parts = sorted(by[i], key=lambda r: r["lo"])
            for (c, k), s in list(state.items()):
                if (c, *s) != span:
                    continue
                below = s[2]
                for r in parts:
                    if k < below + r["n"]:
                        state[(c, k)] = (r["lo"], r["hi"], below)
                        break
                    below += r["n"]
    return done


# --------------------------------------------------------------------------- #
# Mode and top-k
# --------------------------------------------------------------------------- #
def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, cnt) for every non-null value of every column, as text.

    groupBy with map-side partial aggregation: a value holding a third of the
    rows is combined before the shuffle.
    """
    return (long_form(df, cols, "string")
            .where(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count("*").alias("cnt")))


def modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent value per column, lowest value on ties; NULL if none.

    Two aggregations (max count per column, then min value among those at
    the max) rather than a window over all distinct values of a column.
    """
    if not cols:
        return {}
    vc = value_counts(df, cols)
    top = vc.groupBy("column_name").agg(F.max("cnt").alias("cnt"))
    best = (vc.join(F.broadcast(top), ["column_name", "cnt"])
              .groupBy("column_name").agg(F.min("value").alias("mode")))
    got = {r["column_name"]: r["mode"] for r in best.collect()}
    return {c: got.get(c) for c in cols}


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group by ``order``.

    ``row_number() <= k`` lets Catalyst insert a partial WindowGroupLimit before
    the shuffle, so only k rows per group and map task are moved.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
