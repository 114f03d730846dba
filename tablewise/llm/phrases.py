"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are brought to one form (A-Z lowered, one space between words) and the
fingerprint of every n-gram is read off numpy prefix polynomials of their bytes.

1. Sketch. Tasks sort the fingerprints of a few million n-grams at a time, count
   equal ones and send blocks of (fingerprint, count), dealt by fingerprint range
   and written as gaps (two to three bytes an n-gram). Ranges add the counts up.
2. Filter. The fingerprints that reach ``min_count`` are marked in a bitmap whose
   size follows their number, up to MAX_FILTER_BITS: that bounds what is broadcast.
3. Exact counts. In a second scan the n-grams whose mark is set are grouped by
   fingerprint, each group keeps a pointer to one occurrence, every other
   occurrence is compared with that text byte by byte, and (language, phrase,
   count) is summed over all tasks. So a collision, or a full bitmap, costs time
   but changes no count, and only phrases that can be frequent become strings.

Scores, cuts and the subsumption of short phrases are joins on the frequent
phrases; parts that very many phrases share are salted.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, shuffle_partitions, small_batches, travels, written

travels(__name__)

MIN_COUNT = 10
MIN_WORDS, MAX_WORDS = 2, 3
TOP = 2000
# A shorter phrase goes when a longer one has this share (in percent) of its occurrences.
COVERED = 50
UNKNOWN = "und"

# Bytes of text hashed at once, and n-grams sorted at once: they bound a worker's memory.
HASH_BYTES = 1 << 20
FLUSH_GRAMS = 2_000_000
# Bytes of text whose n-grams one fingerprint range holds, and ranges that one exchange deals to.
RANGE_BYTES = 2 << 20
RANGE_BITS = 12
# Largest bitmap of frequent fingerprints (128 MB), and bits for each.
MAX_FILTER_BITS = 1 << 30
FILTER_BITS_EACH = 16

_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_SPACE, _BREAK = 32, 10
# byte -> its form: A-Z lowered, white space in a piece -> space, ends of pieces -> line feed
_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91] += 32
_FORM[9] = _SPACE
_FORM[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK
_GAP = np.zeros(256, dtype=bool)
_GAP[[_SPACE, _BREAK]] = True


class _Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self):
        self.n = -1

    @staticmethod
    def _of(base: int, n: int) -> np.ndarray:
        steps = np.full(n + 1, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = n
            self.up, self.down = (self._of(x, n) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up, self.down


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits (the low bits of a polynomial modulo 2**64 know only the low bits of its bytes)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_edges(form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = np.concatenate(([True], _GAP[form], [True]))
    return np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])


def _sections(text: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, int]]:
    """A text in sections of about HASH_BYTES, cut between words; each but the first repeats ``overlap`` words."""
    if len(text) <= HASH_BYTES:
        yield text, 0
        return
    start, end = _word_edges(_FORM[text])
    w = 0
    while w < len(start):
        to = max(w + 1, int(np.searchsorted(end, start[w] + HASH_BYTES, side="right")))
        again = min(overlap, w)
        yield text[start[w - again]:end[to - 1]], again
        w = to


def _batches_of_sections(batches, overlap: int) -> Iterator[list[tuple[np.ndarray, str, int]]]:
    """(section, language, repeated words) in lists of about HASH_BYTES."""
    held, size = [], 0
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        for k, lang in enumerate(langs):
            for section, again in _sections(data[offsets[k]:offsets[k + 1]], overlap):
                held.append((section, lang, again))
                size += len(section) + 1
                if size >= HASH_BYTES:
                    yield held
                    held, size = [], 0
    if held:
        yield held


class _Grams:
    """All n-grams of some sections: fingerprints, places in ``text`` (the sections' form) and languages."""

    def __init__(self, sections: list[tuple[np.ndarray, str, int]], max_words: int, powers: _Powers):
        end_mark = np.array([_BREAK], dtype=np.uint8)
        form = _FORM[np.concatenate([x for s, _, _ in sections for x in (s, end_mark)])]
        first = np.cumsum([0] + [len(s) + 1 for s, _, _ in sections])
        start, end = _word_edges(form)
        self.langs = sorted({lang for _, lang, _ in sections})
        code = {lang: k for k, lang in enumerate(self.langs)}
        section = np.searchsorted(first, start, side="right") - 1
        lang = np.array([code[x] for _, x, _ in sections], dtype=np.int32)[section]
        # words repeated from the section before are counted there
        repeated = np.arange(len(start)) - np.searchsorted(start, first)[section] < \
            np.array([a for _, _, a in sections], dtype=np.int64)[section]
        self.words = np.bincount(lang[~repeated], minlength=len(self.langs))
        piece = np.cumsum(form == _BREAK, dtype=np.int32)[start]
        # one form: each word and a space
        keep = ~_GAP[form]
        keep[end] = True
        self.text = form[keep]
        at = np.concatenate(([0], np.cumsum(end - start + 1)))
        w_start, w_end = at[:-1], at[1:] - 1
        self.text[w_end] = _SPACE
        up, down = powers.upto(len(self.text))
        prefix = np.zeros(len(self.text) + 1, dtype=np.uint64)
        np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * up[:len(self.text)], out=prefix[1:])
        seeds = np.array([_seed(x) for x in self.langs], dtype=np.uint64)
        prints, starts, ends, codes, sizes = [], [], [], [], []
        for k in range(1, max_words + 1):
            n = len(start) - k + 1
            if n <= 0:
                break
            whole = np.flatnonzero((piece[:n] == piece[k - 1:]) & ~repeated[k - 1:])
            s, e = w_start[whole], w_end[whole + k - 1]
            prints.append(_mix((prefix[e] - prefix[s]) * down[s] ^ seeds[lang[whole]]))
            starts.append(s)
            ends.append(e)
            codes.append(lang[whole])
            sizes.append(np.full(len(whole), k, dtype=np.int8))
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, dtype=t)
        self.prints, self.start, self.end = join(prints, np.uint64), join(starts, np.int64), join(ends, np.int64)
        self.lang, self.size = join(codes, np.int32), join(sizes, np.int8)


# ---- pass 1: which fingerprints are frequent

def _pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted ids as gaps and counts, byte planes apart (the shuffle's compression does the rest)."""
    gaps = np.diff(ids, prepend=np.uint64(0))
    width = 4 if not len(gaps) or gaps.max() < 1 << 32 else 8
    planes = gaps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + planes + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = block[0]
    n = (len(block) - 1) // (width + 4)
    planes = np.frombuffer(block, dtype=np.uint8, offset=1)
    gaps = np.ascontiguousarray(planes[:n * width].reshape(width, n).T).view(f"<u{width}").ravel()
    counts = np.ascontiguousarray(planes[n * width:].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(gaps.astype(np.uint64)), counts


def _add_up(ids: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    ids, counts = ids[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, dtype=np.int64)
    total = np.add.reduceat(counts.astype(np.int64), first) if len(ids) else counts
    return ids[first], np.minimum(total, most)


def _blocks(ids: np.ndarray, counts: np.ndarray, bits: int, range_bits: int) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted ids, one for each range that occurs; ids count from the start of the range."""
    shift = np.uint64(bits - range_bits)
    where = ids >> shift
    first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))) if len(ids) else []
    edges = [*first, len(ids)]
    for lo in range(0, len(first), 1024):
        some = range(lo, min(lo + 1024, len(first)))
        yield pa.RecordBatch.from_arrays([
            pa.array([int(where[edges[k]]) for k in some], type=pa.int64()),
            pa.array([_pack(ids[edges[k]:edges[k + 1]] - (where[edges[k]] << shift), counts[edges[k]:edges[k + 1]])
                      for k in some], type=pa.binary())], names=["part", "block"])


def _sketcher(max_words: int, min_count: int, bits: int, range_bits: int):
    def sketch(batches):
        powers, held, n = _Powers(), [], 0

        def flush():
            ids = np.sort(np.concatenate(held) >> np.uint64(64 - bits))
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            counts = np.minimum(np.diff(np.append(first, len(ids))), min_count)
            return _blocks(ids[first], counts, bits, range_bits)

        for sections in _batches_of_sections(batches, max_words - 1):
            prints = _Grams(sections, max_words, powers).prints
            if len(prints):
                held.append(prints)
                n += len(prints)
            if n >= FLUSH_GRAMS:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()
    return sketch


def _splitter(min_count: int, bits: int, coarse: int, fine: int):
    """Deal blocks of coarse ranges on to finer ones; rows arrive sorted by range."""
    def split(batches):
        held, n = [], 0

        def flush():
            ids, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            return _blocks(*_add_up(ids, counts, min_count), bits, fine)

        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, counts = _unpack(block)
                held.append((ids + (np.uint64(part) << np.uint64(bits - coarse)), counts))
                n += len(ids)
                if n >= FLUSH_GRAMS:
                    yield from flush()
                    held, n = [], 0
        if held:
            yield from flush()
    return split


def _adder(min_count: int):
    def add(key, blocks):
        ids, counts = _add_up(*(np.concatenate(x) for x in zip(
            *[_unpack(b) for b in blocks.column("block").to_pylist()], strict=True)), min_count)
        ids = ids[counts >= min_count]
        return pa.table({"part": pa.array([key[0].as_py()], type=pa.int64()),
                         "n": pa.array([len(ids)], type=pa.int64()),
                         "block": pa.array([_pack(ids, np.ones(len(ids)))], type=pa.binary())})
    return add


def _marker(bits: int, range_bits: int, filter_log: int):
    """The stretch of the bitmap that belongs to each range."""
    def mark(batches):
        for batch in batches:
            out = []
            for block in batch.column(1).to_pylist():
                bitmap = np.zeros(1 << (filter_log - range_bits), dtype=np.uint8)
                ids = _unpack(block)[0]
                bitmap[(ids >> np.uint64(bits - filter_log)).astype(np.int64)] = 1
                out.append(np.packbits(bitmap, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.binary())], names=["part", "bitmap"])
    return mark


def _frequent_marks(texts: DataFrame, max_words: int, min_count: int, n_bytes: int) -> tuple[int, bytes]:
    """(log2 of the bits, bitmap) that marks every fingerprint occurring ``min_count`` times; others by chance."""
    spark = texts.sparkSession
    range_bits = max(0, math.ceil(math.log2(max(1, n_bytes / RANGE_BYTES))))
    bits = min(63, max(range_bits + 8, math.ceil(math.log2(n_bytes + 2)) + 10))
    parts = shuffle_partitions(spark, 3 * n_bytes)
    levels = [*range(RANGE_BITS, range_bits, RANGE_BITS), range_bits]
    schema = "part long, block binary"
    blocks = texts.mapInArrow(_sketcher(max_words, min_count, bits, levels[0]), schema)
    for coarse, fine in zip(levels, levels[1:], strict=False):
        dealt = blocks.repartition(parts, "part").sortWithinPartitions("part")
        blocks = dealt.mapInArrow(_splitter(min_count, bits, coarse, fine), schema)
    found = written(blocks.groupBy("part").applyInArrow(_adder(min_count), "part long, n long, block binary"), "phrase-marks")
    total = found.agg(F.sum("n")).first()[0] or 0
    filter_bits = min(MAX_FILTER_BITS, FILTER_BITS_EACH * total)
    filter_log = min(bits, max(range_bits + 3, math.ceil(math.log2(filter_bits + 1))))
    stretch = (1 << (filter_log - range_bits)) // 8
    bitmap = bytearray((1 << filter_log) // 8)
    for r in found.where("n > 0").select("part", "block").mapInArrow(
            _marker(bits, range_bits, filter_log), "part long, bitmap binary").toLocalIterator():
        bitmap[r["part"] * stretch:(r["part"] + 1) * stretch] = r["bitmap"]
    return filter_log, bytes(bitmap)


# ---- pass 2: exact counts

def _same_text(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether ``length`` bytes at ``a`` and at ``b`` are equal; ``text`` has eight bytes to spare at its end."""
    eight = np.ndarray((len(text) - 7,), dtype="<u8", buffer=text.data, strides=(1,))
    same = np.ones(len(a), dtype=bool)
    left = np.arange(len(a))
    for k in range(0, int(length.max(initial=0)), 8):
        left = left[length[left] > k]
        diff = eight[a[left] + k] ^ eight[b[left] + k]
        short = np.minimum(length[left] - k, 8).astype(np.uint64) * np.uint64(8)
        mask = np.where(short == 64, ~np.uint64(0), (np.uint64(1) << (short & np.uint64(63))) - np.uint64(1))
        same[left[(diff & mask) != 0]] = False
        left = left[same[left]]
    return same


def _counted(grams: _Grams, marks: np.ndarray, filter_log: int) -> Iterator[pa.RecordBatch]:
    bit = grams.prints >> np.uint64(64 - filter_log)
    hit = np.flatnonzero((marks[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
    order = hit[np.argsort(grams.prints[hit], kind="stable")]
    prints, start, end = grams.prints[order], grams.start[order], grams.end[order]
    first = np.concatenate(([True], prints[1:] != prints[:-1])) if len(order) else np.zeros(0, dtype=bool)
    group = np.cumsum(first) - 1
    pointer = np.flatnonzero(first)  # one occurrence of each fingerprint
    length = end - start
    text = np.concatenate((grams.text, np.zeros(8, dtype=np.uint8)))
    mine = pointer[group] if len(order) else np.zeros(0, dtype=np.int64)
    alike = (length == length[mine]) & (grams.lang[order] == grams.lang[order][mine]) & (grams.size[order] == grams.size[order][mine])
    same = alike & _same_text(text, start, start[mine], np.where(alike, length, 0))
    counts = np.bincount(group[same], minlength=len(pointer))
    # occurrences of another text under the same fingerprint stand for themselves
    odd = np.flatnonzero(~same)
    pick = np.concatenate((pointer, odd))
    counts = np.concatenate((counts, np.ones(len(odd), dtype=np.int64)))
    s, n = start[pick], length[pick]
    offsets = np.concatenate(([0], np.cumsum(n)))
    data = text[np.repeat(s - offsets[:-1], n) + np.arange(offsets[-1])]
    phrase = pa.LargeStringArray.from_buffers(len(pick), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
    langs = pa.array(grams.langs, type=pa.string())
    yield pa.RecordBatch.from_arrays([
        langs.take(pa.array(grams.lang[order][pick])), pa.array(grams.size[order][pick].astype(np.int32)),
        phrase.cast(pa.string()), pa.array(counts.astype(np.int64))], names=["lang", "size", "phrase", "f"])
    yield pa.RecordBatch.from_arrays([
        langs, pa.array(np.zeros(len(langs), dtype=np.int32)), pa.array([""] * len(langs)),
        pa.array(grams.words.astype(np.int64))], names=["lang", "size", "phrase", "f"])


def _counter(max_words: int, filter_log: int, bitmap):
    def count(batches):
        powers, marks = _Powers(), np.frombuffer(bitmap.value, dtype=np.uint8)
        for sections in _batches_of_sections(batches, max_words - 1):
            yield from _counted(_Grams(sections, max_words, powers), marks, filter_log)
    return count


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                     text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Exact counts ``f`` of all phrases of 1 to ``max_words`` words with ``f >= min_count``, per language.

    Returns lang, size (words), phrase, f. The row of size 0 of a language
    counts all its words, frequent or not.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(col(text_col), F.lit("")).alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0
    filter_log, bitmap = _frequent_marks(texts, max_words, min_count, n_bytes)
    counted = texts.mapInArrow(_counter(max_words, filter_log, spark.sparkContext.broadcast(bitmap)),
                               "lang string, size int, phrase string, f long")
    return (counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
            .where((F.col("f") >= min_count) | (F.col("size") == 0)))


# ---- scores

def _look_up(rows: DataFrame, key: str, table: DataFrame, value: str, share: int) -> DataFrame:
    """Add ``value``, the count of the phrase in ``key``. Phrases that over ``share`` rows ask for are salted."""
    hot = (rows.groupBy("lang", key).count().where(F.col("count") > share)
           .select(F.col("lang").alias("_lang"), F.col(key).alias("_part"),
                   F.ceil(F.col("count") / share).cast("int").alias("_salts")))
    hot = F.broadcast(hot)  # at most (rows / share) rows: a small multiple of the partitions
    is_hot = (F.col("lang") == F.col("_lang")) & (F.col(key) == F.col("_part"))
    salts = F.coalesce("_salts", F.lit(1))
    left = rows.join(hot, is_hot, "left").select(
        *rows.columns, F.pmod(F.xxhash64("phrase"), salts).cast("int").alias("_salt"))
    right = (table.select("lang", F.col("phrase").alias(key), F.col("f").alias(value)).join(hot, is_hot, "left")
             .select("lang", key, value, F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")))
    return left.join(right, ["lang", key, "_salt"]).drop("_salt")


def _words(phrase: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, n), " ")


def collocations(docs: DataFrame, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 top: int = TOP, covered: int = COVERED, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lowered (A-Z only), cut at ``.,;:!?`` and line ends into pieces, and
    those at spaces and tabs into words. ``a`` counts the occurrences of a phrase of
    ``min_words`` to ``max_words`` words within pieces, overlaps included, ``n`` all
    words of the language; a phrase with ``a >= min_count`` is a candidate. A cut
    into first words and rest with counts l and r scores floor(10**6 a a / (l r));
    the lowest cut counts, the shortest first part among equals. Candidates inside a
    longer candidate with at least ``covered`` percent of their occurrences are dropped.
    Ranks go by score, then a (both descending), then phrase (bytes).

    Null or empty text has no words; a null language is 'und'. Rows need no id;
    repeated rows count each time. Texts of any length are read whole. An empty
    table, or one without a frequent phrase, gives no rows. Other input columns are not read.
    """
    spark = docs.sparkSession
    table = written(frequent_phrases(docs, max_words, min_count, text_col, lang_col), "phrases")
    candidate = table.where(F.col("size") >= min_words)
    cuts = candidate.select(
        "lang", "phrase", "size", F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.greatest(F.col("size") - 1, F.lit(1)))).alias("k")).where(F.col("size") > 1)
    cuts = cuts.select("lang", "phrase", "a", "k", _words(F.col("phrase"), F.lit(1), F.col("k")).alias("left"),
                       _words(F.col("phrase"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    parts = shuffle_partitions(spark)
    share = max(256, math.ceil(candidate.count() * max_words / parts / 4))
    cuts = _look_up(_look_up(cuts, "left", table, "l", share), "right", table, "r", share)
    score = F.expr("(cast(a as decimal(15, 0)) * cast(a as decimal(15, 0)) * cast(1000000 as decimal(7, 0)))"
                   " div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0)))")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("c")).select("lang", "phrase", "c.*"))
    spans = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(min_words), F.col("size") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1),
                              lambda s: _words(F.col("phrase"), s, n)))))
    inner = (candidate.where(F.col("size") > min_words).select("lang", spans.alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    words = table.where(F.col("size") == 0).select("lang", F.col("f").alias("n"))
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                           "a", "l", "r", "n", "score")
