"""Benchmark decontamination: broadcast hash set of normalised benchmark n-grams.

Benchmark items are cut into windows of ``n`` consecutive words. Their hashes
are broadcast; each document is scanned once, window by window; a window whose
hash is in the set is compared word by word with the item windows of that
hash before it counts. The broadcast is bounded: a benchmark with more words than
``MAX_BLOCK_WORDS`` is scanned in blocks of items, one pass after another, each
pass adding its hits to those carried from the pass before.
"""
from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bundle, col, others, small_batches, travels, unbundle, written

travels(__name__)

WINDOW = 10
# Benchmark words whose windows one broadcast holds (about 200 bytes a word in a worker).
MAX_BLOCK_WORDS = 1_000_000

ADDED = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_items", "hit_spans"]

# byte -> lower-case word byte, or a space for bytes outside words (0-9, a-z and non-ASCII are words)
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
              for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Grams:
    """The windows of one block of benchmark items, by length and hash."""

    def __init__(self, items: list[tuple[object, str]], n: int):
        self.vocab: dict[bytes, int] = {}
        self.windows: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of((text or "").encode())]
            if not ids:
                continue
            size = min(n, len(ids))
            row = np.array(ids, dtype=np.int32)
            for i in range(len(ids) - size + 1):
                self.windows[size][row[i:i + size].tobytes()].add(item_id)
        self.windows = {k: dict(v) for k, v in self.windows.items()}
        self.hashes = {k: np.unique(np.array([_roll(np.frombuffer(w, dtype=np.int32), k)[0] for w in v],
                                             dtype=np.uint64)) for k, v in self.windows.items()}

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """(position, length, item ids) of every verified window in a row of word ids (0: not a benchmark word)."""
        known = np.concatenate(([0], np.cumsum(ids != 0)))
        for size, table in self.windows.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            found = at[np.isin(_roll(ids, size)[at], self.hashes[size])]
            for p in found.tolist():
                items = table.get(ids[p:p + size].tobytes())
                if items:
                    yield p, size, items


def _roll(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each window of ``size`` ids."""
    x = ids.astype(np.uint64)
    out = np.zeros(len(x) - size + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + x[j:len(x) - size + 1 + j]
            out ^= out >> np.uint64(29)
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[list[tuple]]:
    """Benchmark items in blocks of bounded size; one block for any usual benchmark."""
    size = F.length(F.coalesce(col(text_col), F.lit(""))) / 2 + 1  # no text has more words than that
    items = benchmark.select(col(item_col).alias("i"), col(text_col).alias("t"), size.alias("w"))
    total = items.agg(F.sum("w").alias("w")).first()["w"] or 0
    n = int(total // MAX_BLOCK_WORDS) + 1
    if n == 1:
        return [[(r["i"], r["t"]) for r in items.select("i", "t").collect()]]
    dealt = items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    return ([(r["i"], r["t"]) for r in dealt.where(F.col("b") == b).select("i", "t").collect()] for b in range(n))


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       carry: bool = True) -> DataFrame:
    """Find benchmark windows in documents.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window),
    ``n_items``, ``items_sha256`` (of the item ids, sorted as strings and
    comma-joined), ``contaminated``, ``hit_items`` (those ids) and ``hit_spans``
    (word ranges ``[start, end)``). With ``carry`` the input's columns come too.

    An item of fewer than ``n`` words is one window; an item without words is
    none. Null or empty text has no words. Repeated rows give repeated results;
    a null item id is written as an empty string. An empty benchmark marks
    nothing, an empty table gives no rows. Input columns named like the added
    ones are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cols = others(docs, ADDED) if carry else [id_col]
    df = docs.select(bundle(cols),
                     F.coalesce(col(text_col), F.lit("")).cast("binary").alias("_d_text"),
                     F.lit(None).cast("array<string>").alias("hit_items"),
                     F.lit(None).cast("array<struct<s:int,e:int>>").alias("hit_spans"),
                     F.lit(0).cast("long").alias("n_words"))
    schema = df.schema
    first = True
    for block in _blocks(benchmark, item_col, item_text_col):
        if not first:
            df = written(df, "decontaminate")
        first = False
        df = df.mapInArrow(_scanner(spark.sparkContext.broadcast(block), n), schema)
    width = F.expr("aggregate(hit_spans, 0L, (a, x) -> a + x.e - x.s)")
    return df.select(
        *unbundle(cols), "n_words", width.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (width > 0).alias("contaminated"),
        "hit_items", "hit_spans")


def _scanner(block, n: int):
    def scan(batches):
        grams = Grams(block.value, n)
        for batch in batches:
            yield _scan_batch(batch, grams)
    return scan


def _scan_batch(batch: pa.RecordBatch, grams: Grams) -> pa.RecordBatch:
    names = batch.schema.names
    texts = batch.column(names.index("_d_text"))
    before_items = batch.column(names.index("hit_items"))
    before_spans = batch.column(names.index("hit_spans"))
    get = grams.vocab.get
    n_words, items, spans = [], [], []
    for i in range(batch.num_rows):
        words = words_of(texts[i].as_py())
        ids = np.fromiter((get(w, 0) for w in words), dtype=np.int32, count=len(words))
        hit: set = set(before_items[i].as_py() or ())
        step = np.zeros(len(words) + 1, dtype=np.int32)
        for s in before_spans[i].as_py() or ():
            step[s["s"]] += 1
            step[s["e"]] -= 1
        for p, size, found in grams.hits(ids):
            step[p] += 1
            step[p + size] -= 1
            hit.update("" if x is None else str(x) for x in found)
        inside = np.cumsum(step) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside))))
        n_words.append(len(words))
        items.append(sorted(hit))
        spans.append([{"s": int(a), "e": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
    put = {"n_words": n_words, "hit_items": items, "hit_spans": spans}
    return pa.RecordBatch.from_arrays(
        [pa.array(put[f.name], type=f.type) if f.name in put else batch.column(k)
         for k, f in enumerate(batch.schema)], schema=batch.schema)


def digest_of_items(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
