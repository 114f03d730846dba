"""Near-duplicate groups by bottom-k sketches.

One hash function gives every word shingle a 64-bit value. A document's sketch
is the ``SKETCH`` smallest values of its shingle set. Documents with equal sets are
one class from here on, so copies cost nothing further.

1. Inverted lists of retained values. Two sets with a similarity of 0.8 share
   at least ``SHARED`` of 40 retained values (a miss needs more than five standard
   deviations); so, ordered by rarity, their first ``SKETCH - SHARED + 1`` values
   share one, and only those enter the lists. Passages that many
   documents share are frequent values and stay out of the lists.
2. Short lists give their pairs; the merged sketch of a pair estimates its
   similarity and drops hopeless ones. Long lists never do: their members are
   compared with one centre only (the member with the most widely shared values).
3. Exact Jaccard on the full shingle sets confirms a link.
4. The comparisons with a centre tell how each member differs from what most members
   hold. Members that differ little are one component. Any other link needs a number
   of shared elements in the two differences, which follows from their sizes (see
   ``_settle``). So members that share one of the rarest elements of their
   differences are looked at again, by the same rule, in ever smaller groups.

No link between components is lost, and no list gives more than a few pairs a member.
"""
from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bundle, col, others, small_batches, travels, unbundle, written

travels(__name__)

SHINGLE = 5
SIMILARITY = 80  # percent
SKETCH = 40
SHARED = 17
# Lists of at most this many members give all their pairs; longer ones are compared with a centre.
SHORT_LIST = 6
# Tasks over which the members of one list or group are dealt, and rows of one key that a join leaves in one task.
SALTS = 16
HOT_ROWS = 1000
# Groups of at most this many members are tested pair by pair inside a join; larger ones are split again.
SMALL_GROUP = 128
# Bits of the filter that tells which texts need their full sets (sent to every task: 1 MB).
FILTER_BITS = 1 << 23
# Bits of it that one task puts together.
FILTER_BLOCK = 1 << 20
# Word hashes a worker remembers.
CACHE = 500_000

ADDED = ["n_shingles", "component_id", "kept"]

_MULT = np.random.default_rng(10).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


class Shingler:
    """Distinct shingle hashes of texts, sorted."""

    def __init__(self, width: int):
        self.width = width
        self.seen: dict[bytes, int] = {}

    def values(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # on bytes: A-Z, and space or \t to \r
        if not words:
            return np.zeros(0, dtype=np.int64)
        seen = self.seen
        if len(seen) > CACHE:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter((seen[w] for w in words), dtype=np.uint64, count=len(words))
        size = min(self.width, len(words))
        with np.errstate(over="ignore"):
            out = np.full(len(h) - size + 1, size, dtype=np.uint64)
            for j in range(size):
                out = (out ^ h[j:len(h) - size + 1 + j]) * _MULT[j % len(_MULT)]
                out ^= out >> np.uint64(32)
        return np.unique(out.view(np.int64))


def _digest(values: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(values.tobytes())
    return tuple(x - (1 << 64) if x >= 1 << 63 else x for x in (whole >> 64, whole & ((1 << 64) - 1)))


def _sketch(width: int):
    """(row, text key, text) to (row, text key, set digest, set size, sketch)."""
    def run(batches):
        shingler = Shingler(width)
        for batch in batches:
            sets = [shingler.values(t) for t in batch.column(2).to_pylist()]
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([d[0] for d in digests], pa.int64()),
                 pa.array([d[1] for d in digests], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "tkey", "d1", "d2", "n", "sketch"])
    return run


def _full_sets(width: int, bits):
    """(text key, text) to (set digest, full set) of texts that the filter lets through, once a task."""
    def run(batches):
        shingler, done, mask = Shingler(width), set(), np.frombuffer(bits.value, dtype=np.uint8)
        for batch in batches:
            keys = batch.column(0).to_numpy() % FILTER_BITS
            wanted = np.flatnonzero(mask[keys >> 3] >> (keys & 7).astype(np.uint8) & 1)
            rows = []
            for t in batch.column(1).take(pa.array(wanted)).to_pylist():
                s = shingler.values(t)
                d = _digest(s)
                if len(s) and d not in done:
                    done.add(d)
                    rows.append((*d, s))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["d1", "d2", "full"])
    return run


def _similar(inter: Column, na: Column, nb: Column, percent: int) -> Column:
    return inter * 100 >= (na + nb - inter) * percent


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and merged sketch allow the similarity."""
    side = classes.select("node", "n", "sketch")
    both = (pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
            .withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH))
            .withColumn("i", F.size(F.array_intersect(F.array_intersect("u", "sa"), "sb"))))
    whole = (F.col("na") <= SKETCH) & (F.col("nb") <= SKETCH)
    exact = _similar(F.size(F.array_intersect("sa", "sb")), F.col("na"), F.col("nb"), percent)
    return both.where(F.when(whole, exact).otherwise(F.col("i") * SKETCH >= F.size("u") * SHARED)).select("a", "b")


def _block_bits(table: pa.Table) -> pa.Table:
    """Bits (block, at) of one block of the filter, as bytes."""
    held = np.zeros(FILTER_BLOCK, dtype=bool)
    held[table.column("at").to_numpy() % FILTER_BLOCK] = True
    return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})


def _bit_filter(keys: DataFrame) -> bytes:
    """Bits set for the text keys. Executors put the bytes together, so FILTER_BITS / FILTER_BLOCK rows are read here."""
    at = F.pmod(F.col("tkey"), F.lit(FILTER_BITS)).alias("at")
    blocks = (keys.select(at).distinct().withColumn("block", F.floor(F.col("at") / FILTER_BLOCK))
              .groupBy("block").applyInArrow(_block_bits, "block long, bits binary").collect())
    out = bytearray(FILTER_BITS // 8)
    for r in blocks:
        out[r["block"] * FILTER_BLOCK // 8:(r["block"] + 1) * FILTER_BLOCK // 8] = r["bits"]
    return bytes(out)


def _compared(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Pairs (a, b, ...) with the full shingle sets of both: columns na, fa, nb, fb."""
    spark = pairs.sparkSession
    ends = pairs.select("a").union(pairs.select("b")).toDF("node").distinct()
    wanted = written(classes.select("node", "n", "d1", "d2", "tkey").join(ends, "node"), "near-wanted")
    bits = spark.sparkContext.broadcast(_bit_filter(wanted))
    sets = (texts.mapInArrow(_full_sets(width, bits), "d1 long, d2 long, full array<long>")
            .groupBy("d1", "d2").agg(F.first("full").alias("full")))
    sets = written(wanted.select("node", "n", "d1", "d2").join(sets, ["d1", "d2"]).select("node", "n", "full"),
                   "near-sets")
    # a centre may stand in very many pairs
    return _join_hot(pairs.join(sets.toDF("b", "nb", "fb"), "b"), sets.toDF("a", "na", "fa"), ["a"], "b", counted=pairs)


def _join_hot(rows: DataFrame, other: DataFrame, keys: list[str], member: str, how: str = "inner",
              counted: DataFrame | None = None) -> DataFrame:
    """Join a table with one row a key; keys of over HOT_ROWS rows (of ``counted``) are dealt over salts."""
    hot = F.broadcast((rows if counted is None else counted).groupBy(*keys).count().where(F.col("count") > HOT_ROWS)
                      .select(*keys, F.ceil(F.col("count") / HOT_ROWS).cast("int").alias("_salts")))  # at most rows / HOT_ROWS
    salts = F.coalesce("_salts", F.lit(1))
    left = rows.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(member), salts).cast("int")).drop("_salts")
    right = (other.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _with_group(rows: DataFrame, groups: DataFrame, member: str = "b", how: str = "inner") -> DataFrame:
    """Join one row a group to its members: those of a large group are dealt over SALTS tasks."""
    spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64(member), F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(groups.withColumn("_salt", spread), ["g", "_salt"], how).drop("_salt")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the links (a, b), for nodes that have any.

    Smallest neighbouring label, then the label's own label, until nothing changes.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    label = written(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label"))
                    .withColumnRenamed("a", "node"), "labels")
    while True:
        near = (both.join(label.toDF("b", "l"), "b").groupBy("a").agg(F.min("l").alias("l"))
                .withColumnRenamed("a", "node"))
        step = label.join(near, "node").select("node", F.col("label").alias("old"),
                                               F.least("label", "l").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        step = written(step.join(jump, "label").select("node", "old", F.col("up").alias("label")), "labels")
        label = step.select("node", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return label


def _lists(classes: DataFrame) -> DataFrame:
    """(g, node, weight): lists of the rarest retained values of each class.

    ``weight`` is large for a class most of whose retained values are widely shared.
    """
    entry = classes.select("node", F.size("sketch").alias("m"), F.explode("sketch").alias("g"))
    often = entry.groupBy("g").agg(F.count("*").alias("c")).where(F.col("c") > 1)
    mine = Window.partitionBy("node")
    rank = F.row_number().over(mine.orderBy("c", "g")) + F.col("m") - F.count("*").over(mine)
    need = F.ceil(F.col("m") * SHARED / SKETCH)
    shared = entry.join(often, "g").select("g", "node", "m", rank.alias("r"), F.sum(F.log2("c")).over(mine).alias("weight"))
    return shared.where(F.col("r") <= F.col("m") - need + 1).select("g", "node", "weight")


def _all_pairs(entries: DataFrame) -> DataFrame:
    """Pairs (a, b) of a list's members; for lists that hold few."""
    x, y = entries.select("g", F.col("node").alias("a")), entries.select("g", F.col("node").alias("b"))
    return x.join(y, "g").where(F.col("a") < F.col("b")).select("a", "b").distinct()


def _star(entries: DataFrame) -> DataFrame:
    """Each member of a list (b) with the list's centre (a)."""
    centre = entries.groupBy("g").agg(F.max_by("node", F.struct("weight", "node")).alias("a"))
    return (_with_group(entries, centre, "node").where(F.col("node") != F.col("a"))
            .select("a", F.col("node").alias("b")).distinct())


def _consensus(groups: DataFrame, percent: int) -> DataFrame:
    """Measure the members (g, b, c_size, lost, new, lost1, new1) of each group against their consensus.

    On entry ``lost`` and ``new`` tell what b lacks of, and holds beyond, some set of ``c_size``
    elements that all members of g are measured against; ``lost1`` and ``new1`` are the numbers of
    further such elements that no other member shares. On return that set is the group's
    consensus: the elements that most of its members hold. Adds ``w``, ``room``, the size ``m`` of the
    difference, the least ``w`` of the group ``wz`` and its member ``z``, and whether b is ``free`` (see
    ``_settle``).
    """
    changed = F.concat(F.transform("lost", lambda e: F.struct(e.alias("e"), F.lit(True).alias("held"))),
                       F.transform("new", lambda e: F.struct(e.alias("e"), F.lit(False).alias("held"))))
    members = groups.groupBy("g").agg(F.count("*").alias("members"))
    # an element that most members changed; all of them are no more than twice a mean difference
    turned = (_with_group(groups, members).select("g", "members", F.explode(changed).alias("x")).groupBy("g", "x")
              .agg(F.count("*").alias("c"), F.max("members").alias("members")).where(F.col("c") * 2 > F.col("members"))
              .groupBy("g").agg(F.collect_list(F.when(F.col("x.held"), F.col("x.e"))).alias("out"),
                                F.collect_list(F.when(~F.col("x.held"), F.col("x.e"))).alias("in")))
    none = F.array().cast("array<long>")
    d = _with_group(groups, turned, how="left").withColumns({"out": F.coalesce("out", none), "in": F.coalesce("in", none)})
    d = d.select("g", "b", "lost1", "new1", (F.col("c_size") - F.size("out") + F.size("in")).alias("c_size"),
                 F.concat(F.array_except("lost", "out"), F.array_except("in", "new")).alias("lost"),
                 F.concat(F.array_except("new", "in"), F.array_except("out", "lost")).alias("new"))
    lacks, adds = F.size("lost") + F.col("lost1"), F.size("new") + F.col("new1")
    d = written(d.withColumns({"room": F.col("c_size") * (100 - percent), "w": lacks * 100 + adds * percent,
                               "m": lacks + adds}), "near-diff")
    nearest = d.groupBy("g").agg(F.min(F.struct("w", "b")).alias("z")).select(
        "g", F.col("z.w").alias("wz"), F.col("z.b").alias("z"))
    return _with_group(d, nearest).withColumn("free", F.col("w") > F.col("room") - F.col("wz"))


def _settle(groups: DataFrame, label: DataFrame | None, percent: int) -> list[DataFrame]:
    """Links (a, b) that connect all members of a group which any links inside it connect.

    Let C be a group's consensus of m elements, x lack lx of them and hold nx others, p be the
    percentage and W(x) = 100 lx + p nx. Members x and y are linked exactly if their differences from C
    share at least (W(x) + W(y) - (100 - p) m) / (100 + p) elements. Let z have the least W:

    - x with W(x) <= (100 - p) m - W(z) is linked with z, whatever they share. All these form
      one component and need no test among themselves. The other members are called free.
    - A free x is linked only with members that share more than (W(y) - W(z)) / (100 + p) elements with it,
      for x itself and for every partner y; and, a difference being no smaller than a part of it, at
      least (W(x) - (100 - p) m) / 100.

    So the first rule gives every member a prefix of its difference, rarest first; the second gives a
    free one a longer prefix, which only meets members that are not free. Members that share an element of
    their prefixes are a new group. Small groups are tested pair by pair, by the first sentence, inside the
    join; large ones are settled like this one. Their members share an element that their new consensus
    takes up, so differences shrink from step to step. What all members have in common is in no difference.
    """
    found: list[DataFrame] = []
    while True:
        d = _consensus(groups, percent)
        alone = F.greatest(F.ceil((F.col("w") - F.col("room")) / 100),
                           F.ceil((F.col("w") + F.col("wz") - F.col("room")) / (100 + percent)), F.lit(1))
        short = F.col("m") - F.floor((F.col("w") - F.col("wz")) / (100 + percent))
        d = d.withColumn("short", short).withColumn(
            "long", F.when(F.col("free"), F.greatest("short", F.col("m") - alone + 1)).otherwise(F.col("short")))
        d = written(d if label is None else d.join(label.toDF("b", "comp"), "b", "left").withColumn(
            "comp", F.coalesce("comp", "b")), "near-measured")
        if label is None:
            d = d.withColumn("comp", F.col("b"))
        found.append(d.where(~F.col("free") & (F.col("b") != F.col("z"))).select(F.col("z").alias("a"), "b"))

        element = F.concat(F.transform("lost", lambda e: F.struct(e.alias("e"), F.lit(True).alias("held"))),
                           F.transform("new", lambda e: F.struct(e.alias("e"), F.lit(False).alias("held"))))
        entry = d.select("g", "b", F.explode(element).alias("x")).select("g", "b", "x.e", "x.held")
        often = entry.groupBy("g", "e").agg(F.count("*").alias("c")).where(F.col("c") > 1)
        # what no other member shares decides nothing from here on but its number
        shared = written(entry.join(often, ["g", "e"]), "near-shared")
        facts = shared.groupBy("g", "b").agg(F.collect_list(F.when(F.col("held"), F.col("e"))).alias("lost_s"),
                                             F.collect_list(F.when(~F.col("held"), F.col("e"))).alias("new_s"))
        facts = written(d.join(facts, ["g", "b"]).select(
            "g", "b", "c_size", "room", "w", "m", "free", "short", "long", "comp", F.col("lost_s").alias("lost"),
            F.col("new_s").alias("new"), (F.size("lost") + F.col("lost1") - F.size("lost_s")).alias("lost1"),
            (F.size("new") + F.col("new1") - F.size("new_s")).alias("new1")), "near-facts")
        mine = Window.partitionBy("g", "b")
        rank = F.row_number().over(mine.orderBy("c", "e")) + F.col("m") - F.count("*").over(mine)
        kept = (shared.join(facts.select("g", "b", "m", "free", "short", "long", "comp"), ["g", "b"])
                .withColumn("r", rank).where(F.col("r") <= F.col("long"))
                .withColumn("only", F.col("r") > F.col("short")))
        # a group needs a free member and two components; long prefixes need a member that is not free
        use = (kept.groupBy("g", "e").agg(F.max("free").alias("some"), F.max(~F.col("free")).alias("met"),
                                          F.min("comp").alias("lo"), F.max("comp").alias("hi"))
               .where(F.col("some") & (F.col("lo") != F.col("hi"))))
        kept = kept.join(use, ["g", "e"]).where(~F.col("only") | F.col("met"))
        sizes = kept.groupBy("g", "e").agg(F.count("*").alias("members")).where("members > 1")
        kept = written(kept.join(sizes, ["g", "e"]).select(
            F.xxhash64("g", "e").alias("h"), "g", "b", "free", "only", "comp", "members"), "near-groups")
        small = kept.where(F.col("members") <= SMALL_GROUP)
        found.append(written(_tested(small.join(facts.select("g", "b", "room", "w", "lost", "new"), ["g", "b"]), percent),
                             "near-links"))
        large = kept.where(F.col("members") > SMALL_GROUP)
        if large.isEmpty():
            return found
        groups = written(large.select("h", "g", "b").join(facts, ["g", "b"]).select(
            F.col("h").alias("g"), "b", "c_size", "lost", "new", "lost1", "new1"), "near-large")


def _tested(rows: DataFrame, percent: int) -> DataFrame:
    """Linked pairs (a, b) of small groups h, decided inside the join from the differences."""
    side = rows.select("h", "b", "free", "only", "comp", "w", "room", F.concat("lost", "new").alias("diff"))
    x = side.select(*[F.col(c).alias(f"x_{c}") for c in side.columns])
    y = side.select(*[F.col(c).alias(f"y_{c}") for c in side.columns])
    sum_w = F.col("x_w") + F.col("y_w") - F.col("x_room")
    return x.join(y, (F.col("x_h") == F.col("y_h")) & (F.col("x_b") < F.col("y_b")) & (F.col("x_comp") != F.col("y_comp"))
                  & (F.col("x_free") | F.col("y_free")) & ~(F.col("x_only") & F.col("y_only"))
                  & (sum_w <= F.least(F.size("x_diff"), F.size("y_diff")) * (100 + percent))
                  & (sum_w <= F.size(F.array_intersect("x_diff", "y_diff")) * (100 + percent))
                  ).select(F.col("x_b").alias("a"), F.col("y_b").alias("b")).distinct()


def near_dedup(docs: DataFrame, width: int = SHINGLE, percent: int = SIMILARITY, id_col: str = "doc_id",
               text_col: str = "text", carry: bool = True) -> DataFrame:
    """Group documents whose sets of ``width``-word shingles have a Jaccard similarity of ``percent`` or more.

    Adds ``n_shingles``, ``component_id`` (the smallest id reachable over links,
    its own included) and ``kept`` (the id is the component's). With ``carry`` the
    input's columns are returned too, otherwise the id only.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer words
    is one shingle; null, empty and blank texts have none and link with nothing.
    Null ids never name a component, unless it has no other (then it is null and
    its rows are kept). Repeated rows are all returned; those of the kept id are all
    kept. An empty table gives no rows. Input columns named like the added
    ones are replaced.
    """
    if percent < SIMILARITY:
        raise ValueError(f"the sketches are made for a similarity of {SIMILARITY} percent or more")
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(col(text_col), F.lit("")).cast("binary")
    src = docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    rows = written(src.mapInArrow(_sketch(width), f"doc_id {kind}, tkey long, d1 long, d2 long, n long, "
                                                  "sketch array<long>"), "near-rows")
    classes = written(
        rows.where("n > 0").groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("id"), F.min("tkey").alias("tkey"), F.max("n").alias("n"),
             F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    lists = written(_lists(classes), "near-lists")
    label = _link(lists, classes, src.select("tkey", "text"), width, percent)

    named = classes.select("node", "id", "d1", "d2")
    if label is not None:
        named = named.join(label, "node", "left").withColumn("comp", F.coalesce("label", "node"))
        least = named.groupBy("comp").agg(F.min("id").alias("component_id"))
        named = named.join(least, "comp")
    else:
        named = named.withColumn("component_id", F.col("id"))
    found = _join_hot(rows.select("doc_id", "tkey", "d1", "d2", "n"), named.select("d1", "d2", "component_id"),
                      ["d1", "d2"], "doc_id", "left")
    mine = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.select("doc_id", "tkey", F.col("n").alias("n_shingles"), mine.alias("component_id")).withColumn(
        "kept", F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    if not carry:
        return found.select(F.col("doc_id").alias(id_col), *ADDED)
    cols = others(docs, ADDED)
    facts = found.dropDuplicates(["doc_id", "tkey"]).toDF("_i", "_k", *ADDED)
    whole = docs.select(bundle(cols), col(id_col).alias("_id"),
                        F.xxhash64(F.coalesce(col(text_col), F.lit("")).cast("binary")).alias("_key"))
    return (whole.join(facts, (F.col("_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_i")))
            .select(*unbundle(cols), *ADDED))


def _link(lists: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Labels (node, label) of all classes that have a link; None if there is no link."""
    sizes = lists.groupBy("g").agg(F.count("*").alias("members")).where("members > 1")
    lists = written(_with_group(lists, sizes, "node"), "near-open")
    few = written(_promising(_all_pairs(lists.where(F.col("members") <= SHORT_LIST)), classes, percent), "near-pairs")
    star = written(_star(lists.where(F.col("members") > SHORT_LIST)), "near-star")
    pairs = few.withColumn("star", F.lit(False)).unionByName(star.withColumn("star", F.lit(True)))
    if pairs.isEmpty():
        return None
    shared = _similar(F.size(F.array_intersect("fa", "fb")), F.col("na"), F.col("nb"), percent)
    # the full sets end here: what goes on is the verdict and, for centres, the differences
    compared = written(_compared(pairs, classes, texts, width).select(
        "a", "b", "na", "star", shared.alias("similar"),
        F.when(F.col("star"), F.array_except("fa", "fb")).alias("lost"),
        F.when(F.col("star"), F.array_except("fb", "fa")).alias("new")), "near-compared")
    links = [compared.where("similar").select("a", "b")]
    label = None if links[0].isEmpty() else components(links[0])
    if not star.isEmpty():
        met = compared.where("star").select(F.col("a").alias("g"), "b", F.col("na").alias("c_size"), "lost", "new")
        centre = (compared.where("star").select(F.col("a").alias("g"), F.col("a").alias("b"), F.col("na").alias("c_size"))
                  .distinct().withColumns({c: F.array().cast("array<long>") for c in ("lost", "new")}))
        members = met.unionByName(centre).withColumns({c: F.lit(0) for c in ("lost1", "new1")})
        more = _settle(members, label, percent)
        new = written(reduce(DataFrame.union, more), "near-links")
        if not new.isEmpty():
            label = components(links[0].union(new))
    return label
