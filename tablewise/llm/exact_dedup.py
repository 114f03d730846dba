"""Exact de-duplication by content sort.

Every row is range-partitioned by the head of its normalised text (Spark
samples the splitters), sorted externally by the whole normalised text, and
neighbours are compared in full: rows whose texts are identical form a group.

A head shared by very many rows (many copies, or many texts with one opening)
would land in one task. Such heads are counted first; their rows are dealt over
salts, each salt is sorted on its own, and the one row that each (salt, text)
leaves is sorted again, split by a hash of the whole text. No row is dropped
or sampled: sampling only places the splitters.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, bundle, col, others, shuffle_partitions, unbundle, written

# Characters of the normalised text that decide the range partition.
HEAD_CHARS = 64
# Heads with no more rows than this are never salted.
MIN_HOT_ROWS = 256

ADDED = ["keep_id", "group_size", "kept", "text_sha256"]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: bool = True) -> DataFrame:
    """Group rows whose texts are identical after lower-casing A-Z.

    Adds ``keep_id`` (the largest id of the group), ``group_size``, ``kept``
    (true for one row per group) and ``text_sha256`` (of the normalised text).
    With ``carry`` the input's columns are returned too, otherwise the id only.

    Null text counts as empty text. A null id is smaller than any id;
    ``keep_id`` is null only if all ids of the group are. Of rows that repeat
    the largest id exactly one is kept. An empty table gives no rows. Input
    columns named like the added ones are replaced by them.
    """
    spark = docs.sparkSession
    keep = others(docs, ADDED) if carry else [id_col]
    text = F.coalesce(col(text_col), F.lit(""))
    src = docs.select(
        bundle(keep), col(id_col).alias("_x_id"), text.alias("_x_text"),
        ascii_lower(F.substring(text, 1, HEAD_CHARS)).alias("_x_head"))

    total = src.agg(F.count("*").alias("n"), F.sum(F.octet_length("_x_text")).alias("b")).first()
    parts = shuffle_partitions(spark, total["b"] or 0)
    share = max(MIN_HOT_ROWS, math.ceil(total["n"] / parts / 2))
    # at most n / share <= 2 * parts heads have more than `share` rows: a small broadcast at any size
    hot = (src.groupBy(F.xxhash64("_x_head").alias("_x_hot")).agg(F.count("*").alias("c"))
           .where(F.col("c") > share)
           .select("_x_hot", F.ceil(F.col("c") / share).cast("int").alias("_x_salts")).collect())

    def grouped(df: DataFrame, by: list[str]) -> DataFrame:
        """Sort by content inside ranges of ``by``; neighbours with equal texts share a window."""
        df = (df.repartitionByRange(parts, *by)
              .withColumn("_x_norm", ascii_lower(F.col("_x_text"))))
        same = Window.partitionBy(*by, "_x_norm")
        return df.withColumn("_x_rank", F.row_number().over(same.orderBy(F.desc_nulls_last("_x_id"))))

    digest = F.sha2("_x_norm", 256).alias("text_sha256")
    same = Window.partitionBy("_x_head", "_x_norm")

    def plain(df: DataFrame) -> DataFrame:
        return grouped(df, ["_x_head"]).select(
            *unbundle(keep), F.max("_x_id").over(same).alias("keep_id"), F.count("*").over(same).alias("group_size"),
            (F.col("_x_rank") == 1).alias("kept"), digest)

    if not hot:
        return plain(src)
    hot_df = F.broadcast(spark.createDataFrame(hot, "_x_hot long, _x_salts int"))
    on = F.xxhash64("_x_head") == F.col("_x_hot")
    cold = plain(src.join(hot_df, on, "left_anti"))

    salted = (src.join(hot_df, on)
              .withColumn("_x_salt", F.pmod(F.xxhash64("_x_id", F.octet_length("_x_text"), F.lit(7)), F.col("_x_salts"))
                          .cast("int"))
              .drop("_x_hot", "_x_salts"))
    # rows repeating one id have one salt; a hot repeated row is dealt by its place instead
    salted = _deal_repeats(salted, share, parts)
    near = Window.partitionBy("_x_head", "_x_salt", "_x_norm")
    first = grouped(salted, ["_x_head", "_x_salt"]).select(
        "_row", "_x_head", "_x_salt", "_x_rank", digest,
        F.max("_x_id").over(near).alias("_x_local"), F.count("*").over(near).alias("_x_size"),
        F.when(F.col("_x_rank") == 1, F.col("_x_norm")).alias("_x_norm"))
    first = written(first, "exact-dedup-hot")
    reps = (first.where(F.col("_x_rank") == 1)
            .withColumn("_x_rep", F.xxhash64("_x_norm"))
            .repartitionByRange(parts, "_x_head", "_x_rep"))
    whole = Window.partitionBy("_x_head", "_x_rep", "_x_norm")
    reps = reps.select(
        F.col("_x_salt").alias("_x_s"), F.col("text_sha256").alias("_x_sha"),
        F.max("_x_local").over(whole).alias("keep_id"), F.sum("_x_size").over(whole).alias("group_size"),
        F.row_number().over(whole.orderBy(F.desc_nulls_last("_x_local"), "_x_salt")).alias("_x_rep"))
    warm = (first.join(reps, (F.col("_x_salt") == F.col("_x_s")) & (F.col("text_sha256") == F.col("_x_sha")))
            .select(*unbundle(keep), "keep_id", "group_size",
                    ((F.col("_x_rank") == 1) & (F.col("_x_rep") == 1)).alias("kept"), "text_sha256"))
    return cold.unionByName(warm)


def _deal_repeats(df: DataFrame, share: int, parts: int) -> DataFrame:
    """Spread ids that repeat more than ``share`` times over further salts, by scan position."""
    repeated = (df.groupBy("_x_id").agg(F.count("*").alias("c")).where(F.col("c") > share)
                .select(F.col("_x_id").alias("_x_r"), F.ceil(F.col("c") / share).alias("_x_k")).collect())
    if not repeated:
        return df
    bound = F.broadcast(df.sparkSession.createDataFrame(
        [(r["_x_r"], int(r["_x_k"])) for r in repeated], f"_x_r {dict(df.dtypes)['_x_id']}, _x_k long"))
    place = F.pmod(F.monotonically_increasing_id(), F.col("_x_k")).cast("int")
    return (df.join(bound, F.col("_x_id").eqNullSafe(F.col("_x_r")), "left")
            .withColumn("_x_salt", F.when(F.col("_x_k").isNull(), F.col("_x_salt"))
                        .otherwise(F.col("_x_salt") + 1_000_000 * (place + 1)))
            .drop("_x_r", "_x_k"))
