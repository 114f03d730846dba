"""Helpers shared by the corpus operators."""
from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.session import ensure_checkpoint_dir, travels

__all__ = ["travels"]  # used by the modules whose code runs in Python workers

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows handed to Python at once. Whole texts travel in these batches, so the
# number is small: it bounds a worker's memory when the texts are long.
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the fast built-in."""
    plain = F.octet_length(col) == F.length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Partitions that ``shuffle_partitions`` adds at most. Tables with a row a partition stay small with it.
MAX_PARTITIONS = 20_000


def shuffle_partitions(spark: SparkSession, n_bytes: int = 0, per: int = 64 << 20) -> int:
    """The session's shuffle width, or more if ``n_bytes`` in pieces of ``per`` need more (to MAX_PARTITIONS)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), min(MAX_PARTITIONS, math.ceil(n_bytes / per)))


def small_batches(spark: SparkSession) -> None:
    """Keep the batches sent to Python workers small (texts may be long)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def others(df: DataFrame, taken: list[str]) -> list[str]:
    """Columns of ``df`` that do not clash with the columns an operator adds."""
    low = {c.lower() for c in taken}
    return [c for c in df.columns if c.lower() not in low]


def col(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def bundle(cols: list[str]) -> Column:
    """The columns an operator carries along, as one column that clashes with none of its own."""
    return F.struct(*[col(c).alias(c) for c in cols]).alias("_row")


def unbundle(cols: list[str]) -> list[Column]:
    return [F.col("_row").getField(c).alias(c) for c in cols]
