"""Column statistics of a growing table, kept a file at a time and merged.

For every file of a table and every numeric column the log holds what can be
merged: rows, nulls, count, mean, sum of squared deviations (M2), least and largest
value and a quantile sketch. When files are added only those are scanned; rows
of files that are gone or rewritten no longer count. Counts and means of files
are combined around the common mean (the pairwise rule, for any number of
parts), not from sums of squares; sketches are merged by Spark's own KLL
aggregate, whose rank error depends on ``k`` and not on the number of parts.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as S
from ..functions.scalars import col_
from ..sources.logs import LogTable

# Sketch size: the rank of a quantile is off by more than RANK_ERROR with a probability of about one in a hundred.
SKETCH_K = 1024
RANK_ERROR = 0.004

FILE_KEY = ["path", "length", "modified"]
PART_SCHEMA = ("path string, length bigint, modified timestamp, column_name string, rows bigint, nulls bigint, n bigint, "
               "mean double, m2 double, min double, max double, sketch binary")


def _value(df: DataFrame, c: str) -> Column:
    v = col_(c).cast("double")
    return F.when(~F.isnan(v), v)


def file_parts(df: DataFrame, cols: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """Mergeable statistics of each file and numeric column of a file-based table: one aggregation for all columns."""
    cols = S.numeric_columns(df) if cols is None else cols
    by = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
          F.col("_metadata.file_modification_time").alias("modified")]
    values = df.select(*by, *[_value(df, c).alias(f"_v{i}") for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(cols)):
        v = F.col(f"_v{i}")
        aggs.append(F.struct(F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
                             F.min(v).alias("min"), F.max(v).alias("max"),
                             F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")).alias(f"_s{i}"))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("s")) for i, c in enumerate(cols)]))
    return (values.groupBy(*FILE_KEY).agg(*aggs).select(*FILE_KEY, "rows", each.alias("p"))
            .select(*FILE_KEY, "p.column_name", "rows", (F.col("rows") - F.col("p.s.n")).alias("nulls"), "p.s.*")
            .select(*[c.split()[0] for c in PART_SCHEMA.split(", ")]))


def merged(parts: DataFrame) -> DataFrame:
    """Statistics of all parts together: column_name, mean, std, min, max, nulls, rows, q25, median, q75 (approximate)."""
    whole = parts.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("n").alias("n"), F.min("min").alias("min"),
        F.max("max").alias("max"), (F.sum(F.col("n") * F.col("mean")) / F.sum(F.when(F.col("n") > 0, F.col("n")))).alias("mean"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch"))).alias("sketch"))
    off = F.col("mean") - F.col("_m")
    spread = (parts.join(whole.select("column_name", F.col("mean").alias("_m")), "column_name")
              .groupBy("column_name").agg(F.sum(F.when(F.col("n") > 0, F.col("m2") + F.col("n") * off * off)).alias("m2")))
    std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    quantiles = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias(name)
                 for p, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))]
    return whole.join(spread, "column_name").select("column_name", "mean", std.alias("std"), "min", "max", "nulls", "rows", *quantiles)


class TableSnapshot:
    """The statistics of a Parquet table at ``path``, updated from its new files; the log lives at ``log``."""

    def __init__(self, spark: SparkSession, path: str, log: str, cols: list[str] | None = None, k: int = SKETCH_K):
        self.spark, self.path, self.cols, self.k = spark, path, cols, k
        self.log = LogTable(spark, log, PART_SCHEMA)

    def _files(self) -> DataFrame:
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet").load(self.path)
        return files.select("path", "length", F.col("modificationTime").alias("modified"))

    def update(self) -> int:
        """Scan files the log does not know; their number. Nothing else of the table is read."""
        new = self._files().join(self.log.read().select(*FILE_KEY).distinct(), FILE_KEY, "left_anti")
        paths = sorted(r["path"] for r in new.select("path").collect())  # one row a new file
        if paths:
            self.log.append(file_parts(self.spark.read.parquet(*paths), self.cols, self.k))
        return len(paths)

    def parts(self) -> DataFrame:
        """The log's rows of files as they are now."""
        return self.log.read().dropDuplicates([*FILE_KEY, "column_name"]).join(self._files(), FILE_KEY, "left_semi")

    def stats(self) -> DataFrame:
        return merged(self.parts())


def describe_approx(df: DataFrame, cols: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """``numeric_describe`` in one pass: quantiles from a sketch, the rest exact."""
    cols = S.numeric_columns(df) if cols is None else cols
    values = df.select(*[_value(df, c).alias(f"_v{i}") for i, c in enumerate(cols)])
    exprs = {}
    for i, c in enumerate(cols):
        v = F.col(f"_v{i}")
        exprs |= {(c, "n"): F.count(v), (c, "mean"): F.avg(v), (c, "std"): F.stddev_samp(v), (c, "min"): F.min(v), (c, "max"): F.max(v)}
        for p, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
            exprs[(c, name)] = F.when(F.count(v) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(v, F.lit(k)), F.lit(p)))
    st = S.one_row(values, exprs)
    names = ["n", "mean", "std", "min", "q25", "median", "q75", "max"]
    return df.sparkSession.createDataFrame(
        [(i, c, *[st[(c, x)] for x in names]) for i, c in enumerate(cols)],
        "position int, column_name string, n bigint, mean double, std double, min double, "
        "q25 double, median double, q75 double, max double")
