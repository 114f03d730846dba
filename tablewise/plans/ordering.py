"""Row-order work without a single-task global window.

Rows are range-partitioned by (key, hash of the row), so one key value that
holds very many rows is split too, sorted inside each partition and written. A
row's place inside its partition is known from the sort; the rows of the
partitions before it (one number a partition) are added. The same path runs at
every size and for every key type; NULL keys come first.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import col_
from ..session import scratch_path

# Rows of a rolling window's block that one task sums; blocks hold any number of these.
SUB_BLOCK_ROWS = 100_000


def ordered_index(df: DataFrame, key: str, name: str = "idx") -> DataFrame:
    """Add a contiguous 0-based position ``name`` in ``key`` order.

    Rows with equal keys follow each other in an order that depends on their content only.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[col_(c) for c in df.columns])
    path = scratch_path(spark, "ordered")
    (df.withColumn("_tie", tie).repartitionByRange(parts, col_(key).asc_nulls_first(), F.col("_tie"))
       .sortWithinPartitions(col_(key).asc_nulls_first(), F.col("_tie"))
       .withColumn("_n", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
       .drop("_tie").write.parquet(path))
    rows = spark.read.parquet(path)
    # one row a partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("_part").agg(F.min("_n").alias("_from"), F.count(F.lit(1)).alias("_rows"))
              .select("_part", "_from", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base")))
    return (rows.join(F.broadcast(starts), "_part")
            .withColumn(name, (F.col("_n") - F.col("_from") + F.col("_base")).cast("bigint"))
            .select(*[col_(c) for c in df.columns if c != name], name))


def rolling_mean(df: DataFrame, key: str, value: str, window: int, out: str = "rolling_mean",
                 sub_rows: int = SUB_BLOCK_ROWS) -> DataFrame:
    """Mean of the non-null ``value`` over the last ``window`` rows by ``key`` (partial windows at the start).

    Positions are cut into blocks of ``window``. A window is the end of one block
    and the beginning of the next, so it is one running sum from the block's end plus
    one from the next block's start: every row is added once each way and
    nothing is ever subtracted. A spike or NaN therefore leaves the windows that do
    not hold it untouched. Blocks are summed in pieces of ``sub_rows`` rows.
    """
    v = col_(value).cast("double")
    rows = (ordered_index(df.withColumn("_v", v), key, "_pos")
            .withColumn("_c", F.col("_v").isNotNull().cast("bigint"))
            .withColumn("_block", F.floor(F.col("_pos") / window).cast("bigint"))
            .withColumn("_sub", F.floor(F.pmod(F.col("_pos"), F.lit(window)) / sub_rows).cast("bigint")))
    piece = ["_block", "_sub"]
    totals = rows.groupBy(*piece).agg(F.sum("_v").alias("_tv"), F.sum("_c").alias("_tc"))
    order = Window.partitionBy("_block").orderBy("_sub")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(1, Window.unboundedFollowing)
    totals = totals.select(*piece, *[F.sum(t).over(w).alias(a) for a, t, w in (
        ("_av", "_tv", ahead), ("_ac", "_tc", ahead), ("_bv", "_tv", behind), ("_bc", "_tc", behind))])
    up = Window.partitionBy(*piece).orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*piece).orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def plus(a, b):
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)

    sums = rows.join(totals, piece).select(
        *[col_(c) for c in df.columns], "_pos",
        plus(F.col("_av"), F.sum("_v").over(up)).alias("_pv"), plus(F.col("_ac"), F.sum("_c").over(up)).alias("_pc"),
        plus(F.col("_bv"), F.sum("_v").over(down)).alias("_sv"), plus(F.col("_bc"), F.sum("_c").over(down)).alias("_sc"))
    # the window that ends at p starts at p - window + 1: in the block before, unless p ends its block
    tails = (sums.where(F.pmod(F.col("_pos"), F.lit(window)) != 0)
             .select((F.col("_pos") + window - 1).alias("_pos"), F.col("_sv").alias("_wv"), F.col("_sc").alias("_wc")))
    total = plus(F.col("_pv"), F.col("_wv"))
    count = F.col("_pc") + F.coalesce("_wc", F.lit(0))
    return (sums.join(tails, "_pos", "left")
            .withColumn(out, F.when(count > 0, total / count))
            .select(*[col_(c) for c in df.columns if c != out], out))
