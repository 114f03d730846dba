"""Document fingerprints by SpotSigs, in built-in expressions only.

Common words are anchors. A signature is a run of anchors and the chain of
content words that follows it (further anchors inside the chain are skipped); the
start of a text is an anchor too, so that short texts have one. A fingerprint
is the set of the 32-bit hashes of a text's signatures: it depends on the text
alone, so fingerprints of different runs can be compared.

Fingerprints are compared by Jaccard likeness. ``search`` partitions sets by
length: sets whose lengths differ too much for the wanted likeness never meet,
and the others meet only over the first signatures of their sorted sets, of which
two sets that are alike enough must share one.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, shuffle_partitions

# Function words of English, German, French and Spanish.
ANCHORS = """
a an and are as at be been but by for from he her his i if in is it its not of on or our she so than that the their
then these they this those to was we were with you
als an auch auf aus bei das dem den der des die ein eine einem einen einer eines er es für ich im in ist mit nach nicht
oder sie sind und von war wir zu
au aux avec ce ces cette dans de des du elle en est et il la le les ne nous ou par pas pour que qui sa se ses son sont
sur un une vous à
al como con de del el en es esta este la las lo los más no o para por que se son su sus un una unas unos y
""".split()
# Content words of a chain.
CHAIN = 2
# Anchors of a run; one more counts as a content word (a pattern without a bound would recurse as deep as the run is long).
LONGEST_RUN = 8
SIMILAR = 0.8

_START, _END = "^", "|"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _any_of(words: list[str]) -> str:
    """A pattern for one of the words that looks at each letter once."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        heads.setdefault(w[:1], []).append(w[1:])
    ends = "" in heads
    parts = [h + _any_of(rest) for h, rest in heads.items() if h]
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)}){'?' if ends else ''}" if ends or len(parts) > 1 else parts[0]


def _segments(text: Column, anchors: list[str]) -> Column:
    """The text as segments: a run of anchors (or none) and one content word; the last word is the end mark."""
    words = F.trim(F.regexp_replace(F.lower(text), _BETWEEN, " "))
    marked = F.concat(F.lit(_START + " "), words, F.lit(f" {_END} "))
    # each alternative ends at a space, so one anchor cannot be the beginning of a longer word
    run = rf"(?:(?:\{_START}|{_any_of(anchors)}) +){{0,{LONGEST_RUN}}}+"
    return F.regexp_extract_all(marked, F.lit(f" *+{run}[^ ]+ "), F.lit(0))


def _signatures(segments: str, chain: int) -> Column:
    """Sorted distinct hashes of the chains of a column of segments."""
    seg = F.col(segments)

    def last(x: Column) -> Column:
        return F.substring_index(x, " ", -2)

    def signature(x: Column, i: Column) -> Column:
        follow = F.transform(F.slice(seg, i + 2, F.lit(chain - 1)), last) if chain > 1 else F.array().cast("array<string>")
        spot = F.concat(F.ltrim(x), F.array_join(follow, ""))
        here = (F.ltrim(x) != last(x)) & (last(x) != f"{_END} ")
        return F.when(here, F.shiftright(F.xxhash64(spot), 32).cast("int"))

    return F.array_sort(F.array_distinct(F.array_compact(F.transform(seg, signature))))


def with_signatures(df: DataFrame, text: Column, name: str, chain: int = CHAIN, anchors: list[str] = ANCHORS) -> DataFrame:
    """Add the array ``name`` of the sorted signatures of a text (null: empty)."""
    return (df.withColumn(f"_segments_{name}", _segments(F.coalesce(text, F.lit("")), anchors))
            .withColumn(name, _signatures(f"_segments_{name}", chain)).drop(f"_segments_{name}"))


def as_text(signatures: Column) -> Column:
    """A fingerprint as a string: eight hex digits a signature."""
    digits = F.transform(signatures, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; 0 without a look inside where the lengths rule out ``least``.

    Two empty sets are alike (1), an empty and another one are not (0).
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    share = (both / (small + large - both)).cast("double")
    return F.when(large == 0, F.lit(1.0)).when(small < least * large, F.lit(0.0)).when(small == 0, F.lit(0.0)).otherwise(share)


# ---- a document and its neighbour

def _bucket(key: Column, cuts: list[Column]) -> Column:
    """How many of the (descending) cuts are above the key: first among every n-th cut, then between two of those."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    coarse = F.array(*cuts[step - 1::step]) if len(cuts) >= step else None
    jump = F.size(F.filter(coarse, lambda c: key < c)) * step if coarse is not None else F.lit(0)
    return jump + F.size(F.filter(F.slice(F.array(*cuts), jump + 1, F.lit(step)), lambda c: key < c))


def with_next(docs: DataFrame, id_col: str, text_col: str, cols: list[str]) -> DataFrame:
    """Add ``next_<col>`` of the next row by descending id (nulls last; the first row follows the last).

    Rows that share an id follow each other by a hash of their text. Ids are cut into
    ranges, the rows go to their range in one exchange, and the first row
    of each range goes to the range before it as well: no window spans the table, no text is joined.
    Rows repeating both id and text stay in one range.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("_h", F.xxhash64(text_col))
    parts = shuffle_partitions(spark, docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)
    key = F.struct(F.col(id_col).alias("i"), F.col("_h").alias("h"))
    ranges = (rows.select(key.alias("k")).repartitionByRange(parts, F.desc("k"))
              .groupBy(F.spark_partition_id()).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
              .orderBy(F.desc("hi")).collect())  # one row a partition
    id_type = dict(docs.dtypes)[id_col]

    def lit(k) -> Column:
        return F.struct(F.lit(k["i"]).cast(id_type).alias("i"), F.lit(k["h"]).cast("long").alias("h"))

    n = max(1, len(ranges))
    heads = F.array(*[lit(r["hi"]) for r in ranges]) if ranges else F.array()
    placed = rows.withColumn("_b", _bucket(key, [lit(r["lo"]) for r in ranges[:-1]]))
    own = F.struct(F.col("_b").alias("b"), F.lit(False).alias("copy"))
    before = F.struct(F.pmod(F.col("_b") + n - 1, F.lit(n)).alias("b"), F.lit(True).alias("copy"))
    if ranges:
        first = key.eqNullSafe(F.get(heads, F.col("_b")))
        placed = placed.withColumn("_at", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))))
    else:
        placed = placed.withColumn("_at", F.explode(F.array(own)))
    placed = placed.withColumn("_b", F.col("_at.b")).withColumn("_copy", F.col("_at.copy")).drop("_at")
    order = Window.partitionBy("_b").orderBy("_copy", F.desc_nulls_last(id_col), F.desc("_h"))
    dealt = placed.repartitionById(n, F.col("_b")).withColumns({f"next_{c}": F.lead(c).over(order) for c in cols})
    return dealt.where(~F.col("_copy")).drop("_b", "_copy", "_h")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """Fingerprints of all documents and of their edited texts.

    The edited text of a document of n code points has its last floor(n / 2) replaced by the
    first as many (or all) of the next document by descending id; the first
    document follows the last. Returns the id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` (hex, eight digits a signature) and the likenesses ``near_edited`` (to the
    edited text) and ``near_next`` (to the next document).

    Null text is empty; a text without a content word has an empty fingerprint. A
    null id comes after all others. Rows that share an id are ordered by a hash of
    their text; a single row is its own next one. An empty table gives no rows. Ids of any orderable type
    are allowed; other input columns are not read.
    """
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    rows = with_next(with_signatures(rows, F.col("text"), "own", chain), "doc_id", "text", ["text", "own"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.expr("left(text, n_chars - n_chars div 2)"), F.left("next_text", half))
    rows = rows.withColumn("n_chars", F.length("text")).withColumn("edited", edited)
    rows = with_signatures(rows, F.col("edited"), "changed", chain)
    return rows.select(
        F.col("doc_id").alias(id_col), F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))


# ---- search

def search(queries: DataFrame, corpus: DataFrame, least: float = SIMILAR, id_col: str = "doc_id",
           text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """All documents of ``corpus`` whose fingerprint has a likeness of at least ``least`` (above 0) to a query's.

    Returns query_id, class_id (the smallest id of the documents with that same
    fingerprint), members (their number) and likeness: equal fingerprints are one class, so
    copies do not multiply. Texts without a signature match nothing. Null ids are never a class id
    unless all of a class are null.
    """
    def sets(df: DataFrame) -> DataFrame:
        rows = df.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
        return with_signatures(rows, F.col("text"), "s", chain).select("id", "s").where(F.size("s") > 0)

    def lists(df: DataFrame, *keep: str) -> DataFrame:
        # sets of the wanted likeness share one of these signatures
        n = F.size("s") - F.ceil(F.size("s") * least - 1e-9).cast("int") + 1
        return df.select(*keep, "s", F.explode(F.slice("s", 1, n)).alias("v"))

    def band(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) / math.log(1 / least) + 1e-9).cast("int")

    classes = sets(corpus).groupBy("s").agg(F.min("id").alias("class_id"), F.count("*").alias("members"))
    right = lists(classes, "class_id", "members").select(
        "class_id", "members", F.col("s").alias("t"), "v", band(F.size("s")).alias("band"))
    own = band(F.size("s"))
    left = lists(sets(queries).withColumnRenamed("id", "query_id"), "query_id").withColumn(
        "band", F.explode(F.array(own - 1, own, own + 1)))
    near = F.col("near")
    return (left.join(right, ["v", "band"]).where(
        (F.size("s") >= least * F.size("t") - 1e-9) & (F.size("t") >= least * F.size("s") - 1e-9)
        # a pair is measured at the first signature that its two lists share
        & (F.col("v") == F.get(F.array_intersect("s", "t"), F.lit(0))))
        .select("query_id", "class_id", "members", likeness(F.col("s"), F.col("t"), least - 1e-9).alias("near"))
        .where(near >= least).withColumnRenamed("near", "likeness"))
