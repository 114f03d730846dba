"""Ranked lexical search by dual trees.

Items and documents each get a hierarchy. A node holds, for every term below it,
the largest coordinate: the weight of the term (items) or the largest gain of the
term in a document (documents). The product of two nodes' maxima, summed over the
terms they share, bounds the score of every document below the one for every item
below the other. A pair of nodes is dropped as a whole if its bound is below the
weakest k-th best score among its items, else it is opened; at the leaves scores are exact.

1. Documents are read once: length and counts of the terms that items use, written as a thin table.
2. Totals and document frequencies are aggregations of that table.
3. First look: in blocks of documents, each item scores its most promising leaf. The
   k-th best score so found over all blocks is a floor that the true result reaches.
4. Search: tasks walk item tree against document trees, block by block, with the
   floors and what they find as bounds. The best k of all tasks are the result.

Items are sent to tasks in sets of at most MAX_SET_BYTES of text; a larger
benchmark is searched set by set.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.plans.ordering import ordered_index

from .common import col, small_batches, travels, written
from .decontaminate import words_of

travels(__name__)

TOP = 10
FANOUT = 8
LEAF_DOCS = 32
# Documents, and (document, term) pairs, of one document tree.
BLOCK_DOCS = 4096
BLOCK_PAIRS = 2_000_000
# Bytes of item text that one broadcast holds.
MAX_SET_BYTES = 4 << 20
# Bytes of text cut into words at once.
SECTION = 4 << 20

_NULL_KEY = -(1 << 63)


# ---- documents as counts of the items' terms

def _counts(text: bytes, get) -> tuple[int, Counter]:
    """Words of a text, and how often each known term occurs."""
    n, found, at = 0, Counter(), 0
    while at < len(text):
        to = min(len(text), at + SECTION)
        while to < len(text) and not _ends_word(text[to]):
            to += 1
        words = words_of(text[at:to])
        n += len(words)
        found.update(map(get, words))
        at = to
    found.pop(None, None)
    return n, found


def _ends_word(byte: int) -> bool:
    return not words_of(bytes([byte]))


def _reader(vocabulary):
    def read(batches):
        get = vocabulary.value.get
        for batch in batches:
            n, terms, times = [], [], []
            for text in batch.column(1):
                words, found = _counts(text.as_py() or b"", get)
                n.append(words)
                terms.append(list(found))
                times.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, type=pa.int64()), pa.array(terms, type=pa.list_(pa.int32())),
                pa.array(times, type=pa.list_(pa.int32()))], names=["key", "n", "terms", "times"])
    return read


# ---- the two hierarchies

class ItemTree:
    """Items in an order that puts alike ones together; level 0 has the items, each level above FANOUT fewer nodes."""

    def __init__(self, terms: list[np.ndarray], weight: np.ndarray):
        self.weight, self.n = weight, len(terms)
        self.order = self._alike(terms, weight)
        item = np.repeat(np.arange(self.n), [len(terms[k]) for k in self.order])
        term = np.concatenate([terms[k] for k in self.order]) if self.n else np.zeros(0, dtype=np.int64)
        used = weight[term] > 0
        item, term = item[used], term[used]
        # (first posting of each term, nodes that hold it) of each level
        self.levels = []
        while True:
            pairs = np.unique(term.astype(np.int64) * max(self.n, 1) + item)
            self.levels.append((np.searchsorted(pairs, np.arange(len(weight) + 1) * max(self.n, 1)), pairs % max(self.n, 1)))
            if self.n <= FANOUT ** (len(self.levels) - 1):
                break
            item = item // FANOUT

    def parts(self) -> tuple:
        """Plain data, which a worker can read without this module."""
        return self.weight, self.n, self.order, self.levels

    @classmethod
    def of(cls, parts: tuple) -> ItemTree:
        tree = cls.__new__(cls)
        tree.weight, tree.n, tree.order, tree.levels = parts
        return tree

    @staticmethod
    def _alike(terms: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
        """Sort by which of the terms that carry most weight over all items an item has."""
        if not terms:
            return np.zeros(0, dtype=np.int64)
        total = np.bincount(np.concatenate(terms), minlength=len(weight)) * weight
        heavy = np.argsort(-total, kind="stable")[:32]
        has = np.array([np.isin(heavy, t) for t in terms])
        return np.lexsort(has.T[::-1])

    def nodes(self, level: int) -> int:
        return -(-self.n // FANOUT ** level)

    def sums(self, level: int, rows: np.ndarray, terms: np.ndarray, gains: np.ndarray, n_rows: int) -> np.ndarray:
        """[row, node] sums of weight x gain over the terms that a row and a node share (exact: below 2**53)."""
        first, node = self.levels[level]
        lo, many = first[terms], first[terms + 1] - first[terms]
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        width = self.nodes(level)
        cell = np.repeat(rows, many) * width + node[at]
        got = np.bincount(cell, weights=np.repeat(self.weight[terms] * gains, many).astype(np.float64), minlength=n_rows * width)
        return got.astype(np.int64).reshape(n_rows, width)


class DocumentTree:
    """One block of documents: leaves of LEAF_DOCS alike documents, FANOUT nodes under each node."""

    def __init__(self, keys: np.ndarray, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, weight: np.ndarray):
        n = len(keys)
        value = weight[term] * gain
        by = np.lexsort((-value, doc))
        first = np.searchsorted(doc[by], np.arange(n))
        strongest = term[by][first]
        second = term[by][np.minimum(first + 1, len(by) - 1)]
        place = np.empty(n, dtype=np.int64)
        place[np.lexsort((keys, second, -value[by][first], strongest))] = np.arange(n)
        by = np.argsort(place[doc], kind="stable")
        self.doc, self.term, self.gain = place[doc][by], term[by], gain[by]
        self.keys = np.empty(n, dtype=np.int64)
        self.keys[place] = keys
        # (first entry of each node, terms, largest gains, smallest key) of each level, leaves first
        self.levels = []
        node, t, g, size = self.doc // LEAF_DOCS, self.term, self.gain, LEAF_DOCS
        while True:
            by = np.lexsort((t, node))
            node, t, g = node[by], t[by], g[by]
            start = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (t[1:] != t[:-1]))))
            node, t, g = node[start], t[start], np.maximum.reduceat(g, start)
            smallest = np.minimum.reduceat(self.keys, np.arange(0, n, size))
            self.levels.append((np.searchsorted(node, np.arange(len(smallest) + 1)), t, g, smallest))
            if len(smallest) == 1:
                break
            node, size = node // FANOUT, size * FANOUT

    def maxima(self, level: int, node: int) -> tuple[np.ndarray, np.ndarray]:
        first, t, g, _ = self.levels[level]
        return t[first[node]:first[node + 1]], g[first[node]:first[node + 1]]

    def leaf(self, node: int) -> tuple[int, int, slice]:
        """First document, end, and entries of a leaf."""
        lo, hi = node * LEAF_DOCS, min((node + 1) * LEAF_DOCS, len(self.keys))
        return lo, hi, slice(*np.searchsorted(self.doc, [lo, hi]))


# ---- search of one task

class Search:
    """The best k documents of each item so far (in the order of the item tree)."""

    def __init__(self, items: ItemTree, k: int, floor: tuple[np.ndarray, np.ndarray] | None = None):
        self.items, self.k = items, k
        self.score = np.zeros((items.n, k), dtype=np.int64)
        self.key = np.full((items.n, k), np.iinfo(np.int64).max)
        # no document below the floor (score, then smaller key) can be in the result
        none = np.zeros(items.n, dtype=np.int64), np.full(items.n, np.iinfo(np.int64).max)
        self.floor_score, self.floor_key = floor or none
        self.pairs = self.scored = 0

    def _weakest(self) -> tuple[np.ndarray, np.ndarray]:
        s, key = self.score[:, -1], self.key[:, -1]
        higher = (self.floor_score > s) | ((self.floor_score == s) & (self.floor_key < key))
        return np.where(higher, self.floor_score, s), np.where(higher, self.floor_key, key)

    def _open(self, level: int, bound: np.ndarray, smallest: int) -> np.ndarray:
        """Item nodes of a level that a document node with these bounds may still serve."""
        score, key = self._weakest()
        if level:
            score = np.minimum.reduceat(score, np.arange(0, self.items.n, FANOUT ** level))
            return (bound >= score) & (bound > 0)
        # the floor's own document must come through: equal keys count
        return (bound > 0) & ((bound > score) | ((bound == score) & (smallest <= key)))

    def add(self, tree: DocumentTree) -> None:
        top = len(self.items.levels) - 1
        self._visit(tree, len(tree.levels) - 1, 0, top, np.ones(self.items.nodes(top), dtype=bool))

    def _visit(self, tree: DocumentTree, level: int, node: int, item_level: int, active: np.ndarray) -> None:
        t, g = tree.maxima(level, node)
        smallest = tree.levels[level][3][node]
        while True:
            bound = self.items.sums(item_level, np.zeros(len(t), dtype=np.int64), t, g, 1)[0]
            self.pairs += int(active.sum())
            active = active & self._open(item_level, bound, smallest)
            if not active.any():
                return
            single = item_level == 0
            if not single:
                item_level -= 1
                active = np.repeat(active, FANOUT)[:self.items.nodes(item_level)]
            if level:
                for child in range(node * FANOUT, min((node + 1) * FANOUT, len(tree.levels[level - 1][3]))):
                    self._visit(tree, level - 1, child, item_level, active)
                return
            if single:
                break
        self.score_leaf(tree, node, np.flatnonzero(active))

    def score_leaf(self, tree: DocumentTree, node: int, items: np.ndarray) -> None:
        lo, hi, entries = tree.leaf(node)
        got = self.items.sums(0, tree.doc[entries] - lo, tree.term[entries], tree.gain[entries], hi - lo)[:, items].T
        self.scored += got.size
        keys = tree.keys[lo:hi]
        score, key = (x[items] for x in self._weakest())
        better = (got > score[:, None]) | ((got == score[:, None]) & (keys <= key[:, None]) & (got > 0))
        for row in np.flatnonzero(better.any(axis=1)):
            i, some = items[row], better[row]
            s = np.concatenate((self.score[i], got[row][some]))
            q = np.concatenate((self.key[i], keys[some]))
            best = np.lexsort((q, -s))[:self.k]
            self.score[i], self.key[i] = s[best], q[best]

    def look(self, tree: DocumentTree) -> None:
        """Score each item's most promising leaf only."""
        first, t, g, smallest = tree.levels[0]
        leaf = np.repeat(np.arange(len(smallest)), np.diff(first))
        bound = self.items.sums(0, leaf, t, g, len(smallest))
        best = bound.argmax(axis=0)
        for node in np.unique(best):
            self.score_leaf(tree, int(node), np.flatnonzero((best == node) & (bound.max(axis=0) > 0)))

    def found(self) -> pa.RecordBatch:
        rows, ranks = np.nonzero(self.score)
        return pa.RecordBatch.from_arrays([
            pa.array(self.items.order[rows].astype(np.int64)), pa.array(self.key[rows, ranks]),
            pa.array(self.score[rows, ranks])], names=["item", "key", "score"])


def _norm(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """The m of documents with n terms (in Python integers: the products may pass 64 bits)."""
    return np.array([10 + 90 * x * docs // length for x in n.tolist()], dtype=np.int64)


def _trees(batches, weight: np.ndarray, docs: int, length: int) -> Iterator[DocumentTree]:
    """The rows of a task as document trees; rows without a weighted term are in none."""
    held, rows, pairs = [], 0, 0

    def block():
        keys, n, many, term, times = (np.concatenate(x) for x in zip(*held, strict=True))
        doc = np.repeat(np.arange(len(keys)), many)
        gain = 1_000_000_000 * times // (1000 * times + 8 * np.repeat(_norm(n, docs, length), many))
        used = weight[term] > 0
        doc, term, gain = doc[used], term[used], gain[used]
        have, doc = np.unique(doc, return_inverse=True)
        return DocumentTree(keys[have], doc, term, gain, weight) if len(have) else None

    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            terms = part.column(2)
            held.append((part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(),
                         pc.list_value_length(terms).to_numpy().astype(np.int64),
                         terms.flatten().to_numpy().astype(np.int64), part.column(3).flatten().to_numpy().astype(np.int64)))
            rows, pairs = rows + part.num_rows, pairs + len(held[-1][3])
            if rows >= BLOCK_DOCS or pairs >= BLOCK_PAIRS:
                tree = block()
                held, rows, pairs = [], 0, 0
                if tree:
                    yield tree
    if held and (tree := block()):
        yield tree


def _searcher(items, k: int, docs: int, length: int, floor=None):
    def search(batches):
        tree = ItemTree.of(items.value)
        task = Search(tree, k, floor.value if floor else None)
        for block in _trees(batches, tree.weight, docs, length):
            if floor:
                task.add(block)
            else:
                task.look(block)
        yield task.found()
    return search


# ---- the operator

def _sets(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """Items (id, text) in sets of bounded size; one set for any usual benchmark."""
    items = benchmark.select(col(item_col).alias("i"), F.coalesce(col(text_col), F.lit("")).alias("t"))
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = math.ceil(total / MAX_SET_BYTES)
    if n <= 1:
        yield items.collect()
        return
    # repeated items are dealt by their place, so no set holds them all
    dealt = written(items.withColumn("b", F.pmod(F.xxhash64("i", "t", F.monotonically_increasing_id()), F.lit(n))), "items")
    for b in range(n):
        yield dealt.where(F.col("b") == b).select("i", "t").collect()


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_set(spark: SparkSession, texts: DataFrame, items: list, k: int) -> DataFrame:
    vocabulary: dict[bytes, int] = {}
    terms = [np.array(sorted({vocabulary.setdefault(w, len(vocabulary)) for w in words_of(r["t"].encode())}), dtype=np.int64)
             for r in items]
    sc = spark.sparkContext
    thin = written(texts.mapInArrow(_reader(sc.broadcast(vocabulary)),
                                    "key long, n long, terms array<int>, times array<int>"), "lexical-terms")
    total = thin.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length")).first()
    docs, length = total["docs"] or 0, max(total["length"] or 0, 1)
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for r in thin.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term of the set
        weight[r["t"]] = math.floor(1000 * math.log((2 * docs + 2) / (2 * r["count"] + 1)))
    item_tree = ItemTree(terms, weight)
    tree = sc.broadcast(item_tree.parts())
    schema = "item long, key long, score long"
    rows = thin.where(F.size("terms") > 0)
    looked = _best(rows.mapInArrow(_searcher(tree, k, docs, length), schema), k).where(F.col("rank") == k).collect()
    place = np.empty(len(items), dtype=np.int64)
    place[item_tree.order] = np.arange(len(items))
    floor = np.zeros(len(items), dtype=np.int64), np.full(len(items), np.iinfo(np.int64).max)
    for r in looked:  # at most one row an item
        floor[0][place[r["item"]]], floor[1][place[r["item"]]] = r["score"], r["key"]
    return _best(rows.mapInArrow(_searcher(tree, k, docs, length, sc.broadcast(floor)), schema), k)


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score.

    Terms are runs of digits, letters and non-ASCII characters, A-Z lowered. With N
    documents that have a term, L terms in all and n in a document, a term of
    frequency tf in it and document frequency df adds
    ``w * (10**9 tf div (1000 tf + 8 m))``, w = floor(1000 ln((2N+2)/(2df+1))),
    m = 10 + 90 n N div L, once for each distinct term of the item. Ranks go by score,
    then by ascending id; only scores above 0 count.

    Null or empty text has no terms: such a document is never found, such an item
    has no rows. Each row of the benchmark is an item of its own, each row of the
    documents a document of its own, also if ids repeat. Null document ids come
    first among equal scores (the smallest 64-bit integer stands for null). Ids of any
    orderable type are allowed; other input columns are not read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type, item_type = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    whole = isinstance(id_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    source = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    if not whole:
        source = ordered_index(source, "id", "key")
    else:
        source = source.withColumn("key", F.coalesce(F.col("id").cast("long"), F.lit(_NULL_KEY)))
    texts = source.select("key", F.col("text").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_type)])
    out = None
    for items in _sets(benchmark, item_col, item_text_col):
        names = F.broadcast(spark.createDataFrame([(k_, r["i"]) for k_, r in enumerate(items)], schema))
        part = _search_set(spark, texts, items, k).join(names, "item")
        out = part if out is None else out.unionByName(part)
    if whole:
        out = out.withColumn("doc_id", F.when(F.col("key") != _NULL_KEY, F.col("key")).cast(id_type))
    else:
        out = out.join(source.select("key", F.col("id").alias("doc_id")), "key")
    return out.select("item_id", "rank", "doc_id", "score")
