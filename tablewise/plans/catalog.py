"""Registered queries: each is (spark, sf_dir) -> DataFrame over the given tables,
paired with an equivalent DuckDB SQL string where one exists.

Floating outputs are rounded on both sides (sums of money to 2 places, other
doubles to 6) so that summation order does not decide equality.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


# the spellings of a missing value, where a query's SQL says _NULL_TOKENS_
_NULL_TOKENS = "(" + ", ".join(f"'{t}'" for t in K.NULL_TOKENS) + ")"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip().replace("_NULL_TOKENS_", _NULL_TOKENS)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rnd(df: DataFrame, places: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (``overrides`` gives per-column places)."""
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f"`{f.name}`"), overrides.get(f.name, places)).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


# Importing the modules fills QUERIES / SQL.
from . import q_kpi  # noqa: E402,F401
from . import q_profile  # noqa: E402,F401
from . import q_features  # noqa: E402,F401
from . import q_clean  # noqa: E402,F401
from . import q_eval  # noqa: E402,F401
from . import q_model  # noqa: E402,F401
from . import q_monitor  # noqa: E402,F401
from . import q_more  # noqa: E402,F401
