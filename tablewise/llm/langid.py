"""Language identification: known words first, character n-grams for the rest.

A word that was seen in training adds its log frequency in each language. An
unseen word is scored by its character 4-grams; where a 4-gram is unknown, by
the 3-gram at that place, and so on down to single characters.
"""
from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bundle, col, others, small_batches, travels, unbundle

travels(__name__)

# Training reads about this many rows of each language at most (a hash of id, text and place picks them).
TRAIN_ROWS = 2500
# Languages that are learned at most: those with the most rows.
MAX_LANGS = 256
# Words and n-grams kept of each language at most: the most frequent.
MAX_WORDS = 60_000
MAX_GRAMS = 30_000
LONGEST = 4
UNKNOWN = "und"
# Words that count fully towards the certainty of a prediction.
CERTAIN_WORDS = 25
# Unseen words remembered by a worker.
CACHE = 200_000

ADDED = ["lang_pred", "score"]
_WORD = re.compile(r"[^\W\d_]+")
# A word longer than this is scored by the n-grams of its pieces of this length.
PIECE = 64


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _pieces(word: str) -> list[str]:
    return [word] if len(word) <= PIECE else [word[i:i + PIECE] for i in range(0, len(word), PIECE)]


def _grams(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _count(batches):
    """(lang, kind, token, count) of each batch; kind 0: words, n: character n-grams."""
    for batch in batches:
        found: dict[tuple[str, int], Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = Counter(words_of(text or ""))
            for word, c in words.items():
                for w in _pieces(word):
                    found.setdefault((lang, 0), Counter())[w] += c
                    for n in range(1, LONGEST + 1):
                        grams = found.setdefault((lang, n), Counter())
                        for g in _grams(w, n):
                            grams[g] += c
        for (lang, kind), counts in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts)), pa.array([kind] * len(counts), pa.int32()),
                 pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())],
                names=["lang", "kind", "token", "n"])


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Token counts by language from a bounded sample of labelled rows.

    Rows without a label or text teach nothing. The model holds at most
    ``MAX_LANGS`` languages and, of each, ``MAX_WORDS`` words and
    ``LONGEST * MAX_GRAMS`` n-grams, so its size does not grow with the input.
    """
    spark = rows.sparkSession
    rows = (rows.where(col(lang_col).isNotNull() & col(text_col).isNotNull())
            .select(col(lang_col).cast("string").alias("lang"), col(text_col).alias("text"), col(id_col).alias("id")))
    sizes = (rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect())
    if not sizes:
        return {"langs": [], "words": {}, "grams": {}, "word_logs": np.zeros((0, 0)), "gram_logs": np.zeros((0, 0))}
    small_batches(spark)
    odds = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, TRAIN_ROWS / r["n"]))])
    # ids may be null or repeat, texts may: the place in the scan tells such rows apart
    at = F.pmod(F.xxhash64("id", "text", F.monotonically_increasing_id(), F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where(at < odds[F.col("lang")]).select("lang", "text")
    counts = (sample.mapInArrow(_count, "lang string, kind int, token string, n long")
              .groupBy("lang", "kind", "token").agg(F.sum("n").alias("n")))
    limit = F.when(F.col("kind") == 0, MAX_WORDS).otherwise(MAX_GRAMS)
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "token"))
    kept = (counts.where((F.col("n") >= 2) | (F.col("kind") == 1)).withColumn("r", rank)
            .where(F.col("r") <= limit).select("lang", "kind", "token", "n").toPandas())
    langs = sorted(kept["lang"].unique().tolist())
    place = {x: i for i, x in enumerate(langs)}

    def logs(part) -> tuple[dict[str, int], np.ndarray]:
        tokens = {t: i for i, t in enumerate(part["token"].unique().tolist())}
        c = np.full((len(tokens), len(langs)), 0.5)
        np.add.at(c, (part["token"].map(tokens).to_numpy(), part["lang"].map(place).to_numpy()), part["n"].to_numpy())
        return tokens, (np.log(c) - np.log(c.sum(axis=0))).astype(np.float32)

    words, word_logs = logs(kept[kept["kind"] == 0])
    grams: dict[str, int] = {}
    parts = []
    for n in range(1, LONGEST + 1):
        t, g = logs(kept[kept["kind"] == n])
        # a padded one-character n-gram never equals a longer one: lengths differ
        grams |= {k: v + len(grams) for k, v in t.items()}
        parts.append(g)
    return {"langs": langs, "words": words, "word_logs": word_logs, "grams": grams, "gram_logs": np.concatenate(parts)}


class Scorer:
    """Scores texts with a fitted model; remembers unseen words."""

    def __init__(self, model: dict):
        self.langs = model["langs"]
        self.grams, self.gram_logs = model["grams"], model["gram_logs"]
        self.known, self.word_logs = model["words"], model["word_logs"]
        self._fresh()

    def _fresh(self) -> None:
        self.index = dict(self.known)
        self.logs = np.empty((len(self.known) + CACHE + 1, max(1, len(self.langs))), dtype=np.float32)
        if len(self.known):
            self.logs[:len(self.known)] = self.word_logs

    def _backoff(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest known n-gram at each place of the word."""
        rows, get = [], self.grams.get
        for piece in _pieces(word):
            w = f"^{piece}$"
            for i in range(len(w) - 1):
                for n in range(min(LONGEST, len(w) - i), 0, -1):
                    k = get(w[i:i + n])
                    if k is not None:
                        rows.append(k)
                        break
        if not rows:
            return np.zeros(len(self.langs), dtype=np.float32)
        return self.gram_logs[rows].mean(axis=0)

    def _learn(self, word: str) -> int:
        if len(self.index) >= len(self.logs):
            self._fresh()
            return -1
        k = len(self.index)
        self.index[word] = k
        self.logs[k] = self._backoff(word)
        return k

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        words = words_of(text)
        total = np.zeros(len(self.langs), dtype=np.float64)
        for a in range(0, len(words), CACHE // 2):  # a very long text goes in pieces; all of them count
            part = words[a:a + CACHE // 2]
            if len(self.index) + len(part) >= len(self.logs):
                self._fresh()
            get, learn = self.index.get, self._learn
            rows = [get(w, -1) for w in part]
            if -1 in rows:
                rows = [r if r >= 0 else get(w, -1) if w in self.index else learn(w)
                        for r, w in zip(rows, part, strict=True)]
            total += self.logs[rows].sum(axis=0, dtype=np.float64)
        x = total * min(1.0, CERTAIN_WORDS / len(words))
        best = int(np.argmax(x))
        return self.langs[best], float(1.0 / np.exp(x - x[best]).sum())


def predict(docs: DataFrame, model: dict, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1), from the text alone.

    Null or empty text and text without a letter give ``und`` with score 0; so
    does every text if nothing was learned. Texts are scored whole. Input
    columns named like the added ones are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cols = others(docs, ADDED) if carry is None else carry
    df = docs.select(bundle(cols), col(text_col).alias("_text"))
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            got = [scorer.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in got], pa.string()),
                 pa.array([x[1] for x in got], pa.float64())], names=["_row", "lang_pred", "score"])

    schema = T.StructType([df.schema["_row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return df.mapInArrow(score, schema).select(*unbundle(cols), "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fold that training never sees. A null id is not in it."""
    return F.pmod(F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
