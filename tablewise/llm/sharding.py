"""Byte-balanced shards by histogram sort.

Rows are ordered by (hash of the text, hash of the id, place in the scan): equal
texts are neighbours. Shard boundaries are keys of that order. To find them, the
exact bytes below evenly spaced probe keys are counted over all partitions, the
probes around each wanted boundary are moved closer, and so on until every
boundary is within tolerance of its target. Then the rows are exchanged once, to
the partitions that the boundaries name, and numbered inside their shard.

A boundary that falls inside a group of equal texts moves to the nearer edge of
the group if the group is small (``whole_group``); a larger one (it may hold a
third of all rows) is cut by the id hash, rows repeating one id by their place.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bundle, col, others, shuffle_partitions, unbundle, written

SHARDS = 40
ROW_OVERHEAD = 16
# Probe keys counted at once for one boundary.
PROBES = 512
# A boundary may miss its target by this part of a shard's bytes.
TOLERANCE = 1e-4
# Default part of a shard's bytes up to which a group of equal texts stays in one shard.
WHOLE_GROUP = 5e-3

ADDED = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "group_cut"]
KEYS = ["_h", "_d", "_x"]  # hashes of text and id, place in the scan
_LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class _Span:
    """Keys that hold a wanted boundary: values lo..hi of the key after those that ``fixed`` gives."""
    lo: int
    hi: int
    below: int
    fixed: tuple[int, ...] = ()

    def holds(self) -> Column:
        ok = F.col(self.name).between(self.lo, self.hi)
        for name, value in zip(KEYS, self.fixed, strict=False):
            ok = ok & (F.col(name) == value)
        return ok

    @property
    def name(self) -> str:
        return KEYS[len(self.fixed)]

    @property
    def width(self) -> int:
        return (self.hi - self.lo) // PROBES + 1

    def first(self, value: int) -> tuple[int, ...]:
        """The smallest key with this value."""
        return (*self.fixed, value, *[0] * (len(KEYS) - len(self.fixed) - 1))


def _boundaries(keys: DataFrame, shards: int, whole_group: float) -> list[tuple[int, ...]]:
    """The first key of shards 1, 2, ...; equal ones leave a shard empty."""
    whole = keys.agg(F.sum("size").alias("b"), F.min("_h").alias("lo"), F.max("_h").alias("hi")).first()
    if whole["b"] is None:
        return []
    total = whole["b"]
    near, group = total / shards * TOLERANCE, total / shards * whole_group
    spans = {i: _Span(whole["lo"], whole["hi"], 0) for i in range(1, shards)}
    found: dict[int, tuple[int, ...]] = {}
    while spans:
        distinct = list(dict.fromkeys(spans.values()))
        which = probe = at = F.lit(None).cast("long")
        for k, s in enumerate(distinct):
            which = F.when(s.holds(), F.lit(k)).otherwise(which)
            probe = F.when(s.holds(), F.expr(f"({s.name} - {s.lo}L) div {s.width}L")).otherwise(probe)
            at = F.when(s.holds(), F.col(s.name)).otherwise(at)
        counted: dict[int, list] = {k: [] for k in range(len(distinct))}
        rows = (keys.withColumn("_w", which).where(F.col("_w").isNotNull()).withColumn("_p", probe).withColumn("_k", at)
                .groupBy("_w", "_p").agg(F.sum("size").alias("b"), F.count("*").alias("n"),
                                         F.min("_k").alias("lo"), F.max("_k").alias("hi")).collect())
        for r in rows:
            counted[r["_w"]].append(r)
        for k in counted:
            counted[k].sort(key=lambda r: r["lo"])
        for i, s in list(spans.items()):
            want = total * i / shards
            step = _narrow(s, counted[distinct.index(s)], want, near, group)
            if isinstance(step, _Span):
                spans[i] = step
            else:
                found[i] = step
                del spans[i]
    return [found[i] for i in range(1, shards)]


def _narrow(s: _Span, bins: list, want: float, near: float, group: float) -> _Span | tuple[int, ...]:
    """The boundary itself, or the narrower span that holds it."""
    below = s.below
    for r in bins:
        after = below + r["b"]
        if want < after or r is bins[-1]:
            one = r["lo"] == r["hi"]
            edge = below if want - below <= after - want else after
            # small groups of equal texts stay whole; rows that repeat an id are cut wherever the boundary falls
            cut = one and len(s.fixed) < len(KEYS) - 1 and r["n"] > 1 and (s.fixed or r["b"] > group)
            if abs(edge - want) <= near or one and not cut:
                return s.first(r["lo"] if edge == below else r["hi"] + 1)
            if one:
                return _Span(0, _LARGEST, below, (*s.fixed, r["lo"]))
            return _Span(r["lo"], r["hi"], below, s.fixed)
        below = after
    return s.first(s.hi)


def _partition(bounds: list[tuple[int, ...]], each: int) -> Column:
    """The partition of a row: ``each`` consecutive key ranges for every shard.

    A shard's range is cut evenly in the first key that differs between its boundaries.
    """
    edges = [(0, 0, 0), *bounds, (_LARGEST, _LARGEST, _LARGEST)]
    which, low, width = [], [], []
    for a, b in zip(edges, edges[1:], strict=False):
        k = next((k for k in range(len(KEYS)) if a[k] != b[k]), 0)
        which.append(k)
        low.append(a[k])
        width.append(min((b[k] - a[k]) // each + 1, _LARGEST))
    shard = F.col("shard")
    value = F.get(F.array(*KEYS), F.get(F.array(*map(F.lit, which)), shard))
    low, width = (F.get(F.array(*[F.lit(x).cast("long") for x in v]), shard) for v in (low, width))
    return (shard * each + F.least(F.call_function("div", value - low, width), F.lit(each - 1))).cast("int")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                   overhead: int = ROW_OVERHEAD, whole_group: float = WHOLE_GROUP, carry: bool = True) -> DataFrame:
    """Deal all rows over ``shards`` shards of near equal bytes.

    Adds ``size`` (UTF-8 bytes of the text plus ``overhead``), ``text_crc32``,
    ``law`` ('bytes'), ``shard``, ``slot`` (0, 1, ... in each shard, in key
    order), ``grown_shard`` (null: the law is not 'key') and ``group_cut`` (true for texts
    whose group was opened to place a boundary). With ``carry`` the input's columns are
    returned too, otherwise the id only.

    A group of equal texts of at most ``whole_group`` of a shard's bytes stays in one shard,
    which moves a boundary by half of that at most; 0 cuts every group that a boundary meets.
    Null text has no bytes. Null ids are allowed. Rows that repeat an id and text are told
    apart by their place, so any number of them is spread evenly. With fewer rows than shards
    some shards are empty; an empty table gives no rows. Input columns named
    like the added ones are replaced.
    """
    spark = docs.sparkSession
    cols = others(docs, ADDED) if carry else [id_col]
    text = F.coalesce(col(text_col), F.lit(""))
    raw = text.cast("binary")
    # written once: a row keeps its place, and texts that are not carried are read once
    rows = written(docs.select(
        bundle(cols), (F.octet_length(raw) + overhead).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 1).alias("_h"),
        F.shiftrightunsigned(F.xxhash64(col(id_col), F.lit(1)), 1).alias("_d"),
        F.monotonically_increasing_id().alias("_x")), "shard-keys")
    bounds = _boundaries(rows.select(*KEYS, "size"), shards, whole_group)
    shard = F.lit(0)
    for h, d, x in bounds:
        later = (F.col("_h") == h) & ((F.col("_d") > d) | ((F.col("_d") == d) & (F.col("_x") >= x)))
        shard = shard + ((F.col("_h") > h) | later).cast("int")
    opened = [h for h, d, x in bounds if d or x]
    volume = rows.agg(F.sum("size")).first()[0] or 0
    each = -(-shuffle_partitions(spark, volume if carry else 0) // shards)
    place = written(
        rows.withColumn("shard", shard).repartitionById(shards * each, _partition(bounds or [(0, 0, 0)] * (shards - 1), each))
        .sortWithinPartitions("shard", *KEYS)
        .withColumn("_n", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()),
        "shard-rows")
    # a row for each partition and shard that meet: at most parts + shards
    runs = place.groupBy("shard", "_part").agg(F.min("_n").alias("_from"), F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "_part", "_from", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    return (place.join(F.broadcast(runs), ["shard", "_part"])
            .select(*unbundle(cols), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_n") - F.col("_from") + F.col("_base")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.col("_h").isin(opened).alias("group_cut")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
