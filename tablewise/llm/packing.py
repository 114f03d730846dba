"""Packing of documents into token sequences along a space-filling curve.

Each document is tokenised once. A hashed bag of its token ids is projected to
three numbers; their place on a Hilbert curve is the sort key. The documents
are range-sorted by that key and cut, one after another, into sequences, so
neighbours on the curve share sequences. Only the last sequence of a range is
not full; a range holds tens of megabytes of text.
"""
from __future__ import annotations

import bisect
import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, small_batches, travels

travels(__name__)

SEQUENCE = 2048
END_ID = 1
# Text bytes in one sorted range.
RANGE_BYTES = 32 << 20
# Buckets of the hashed bag of tokens; dimensions and bits a dimension of the curve.
BUCKETS, DIMS, BITS = 512, 3, 20
# Ranges at most, and documents a range that are sampled to place the range borders.
MAX_RANGES, SAMPLED = 20_000, 32
# Ids above sequence_id's first 2**33 sequences name the range.
RANGE_SHIFT = 33


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# Fixed value: how a byte-level BPE tokenizer of this family splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts, from a tokenizer file of the tokenizers library.

    If the file describes plain byte-level BPE whose ids follow the merge order, the
    same vocabulary is given to tiktoken, which finds the same ids several
    times faster. Other files, texts that hold a special token and texts that it cannot
    split go through the tokenizers library itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.marks = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.fast = self._fast(path)

    @staticmethod
    def _fast(path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if not (spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex")
                and not before.get("add_prefix_space") and model.get("type") == "BPE"
                and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                   "byte_fallback", "ignore_merges"))):
            return None
        vocab, marks = model["vocab"], {t["content"] for t in spec["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(merges)):
            return None
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): k for token, k in vocab.items() if token not in marks}
        import tiktoken
        return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(m in text for m in self.marks):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except ValueError:  # white space too long for its splitter (millions of characters)
                pass
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of non-negative integers on a Hilbert curve of that many bits a dimension."""
    x = points.astype(np.uint64).copy()
    dims = x.shape[1]
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for d in range(dims):
            high = (x[:, d] & bit) != 0
            # where the bit is set the lower bits of the first axis are mirrored, else swapped with this axis
            swap = np.where(high, np.uint64(0), (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] = np.where(high, x[:, 0] ^ low, x[:, 0] ^ swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), dtype=np.uint64)
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[:, dims - 1] & np.uint64(1 << b)) != 0, flip ^ np.uint64((1 << b) - 1), flip)
    x ^= flip[:, None]
    key = np.zeros(len(x), dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << one) | ((x[:, d] >> np.uint64(b)) & one)
    return key.astype(np.int64)


def _axes() -> np.ndarray:
    return np.random.default_rng(2048).standard_normal((BUCKETS, DIMS))


def curve_keys(docs_ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents given as token ids."""
    bags = np.zeros((len(docs_ids), BUCKETS))
    for k, ids in enumerate(docs_ids):
        spot = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)
        bags[k] = np.bincount(spot.astype(np.int64), minlength=BUCKETS)
    bags = np.sqrt(bags)
    length = np.linalg.norm(bags, axis=1, keepdims=True)
    at = (bags / np.where(length == 0, 1, length)) @ _axes()
    cells = np.clip((at + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert_key(cells.astype(np.uint64), BITS)


def pack(docs: DataFrame, length: int = SEQUENCE, tokenizer: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pack all documents into sequences of at most ``length`` tokens.

    One row per piece: ``doc_id``, ``start`` (its document's ids before it),
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and,
    with ``with_ids``, ``ids`` (little-endian unsigned 32-bit). A document's ids
    end with id 1. Offsets in a sequence are gapless from 0.

    Null and empty text give the end id alone. Long texts are encoded whole and
    cut. Repeated rows and null ids are packed like any other row. An empty
    table gives no rows. Other input columns are not used.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or default_tokenizer()
    text = F.coalesce(col(text_col), F.lit(""))
    src = docs.select(col(id_col).alias("doc_id"), text.alias("text"),
                      F.xxhash64(col(id_col), text).alias("tie"))  # deals copies over ranges
    total = src.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    parts = min(MAX_RANGES, max(1, -(-(total["b"] or 0) // RANGE_BYTES)))
    borders = _borders(src, parts, total["n"], path)
    kind = src.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        enc = Encoder(path)
        for batch in batches:
            ids = _all_ids(enc, batch.column(1).to_pylist())
            keys, ties = curve_keys(ids), batch.column(2).to_pylist()
            part = [bisect.bisect_right(borders, (k, t)) for k, t in zip(keys.tolist(), ties, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(part, pa.int32()), pa.array(keys, pa.int64()),
                 pa.array([_narrow(x) for x in ids], pa.binary())], names=["doc_id", "tie", "part", "key", "ids"])

    tokens = src.mapInArrow(encode, f"doc_id {kind}, tie long, part int, key long, ids binary")
    ranges = (tokens.repartitionById(parts, "part").sortWithinPartitions("part", "key", "tie", "doc_id")
              .select("doc_id", "ids"))

    def cut(batches):
        base, at = TaskContext.get().partitionId() << RANGE_SHIFT, 0
        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = _wide(raw)
                for a, b, seq, off in cuts(at, len(ids), length):
                    piece = ids[a:b].tobytes()
                    rows.append((doc, a, b - a, zlib.crc32(piece), len(ids), base + seq, off,
                                 piece if with_ids else None))
                at += len(ids)
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], batch.schema.field(0).type), *[pa.array(c, pa.int64()) for c in cols[1:7]],
                 pa.array(cols[7], pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    out = ranges.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                 "sequence_id long, offset long, ids binary")
    return out if with_ids else out.drop("ids")


def _all_ids(enc: Encoder, texts: list[str]) -> list[np.ndarray]:
    return [np.append(enc.ids(t), np.array([END_ID], dtype="<u4")) for t in texts]


def _borders(src: DataFrame, parts: int, n: int, path: str) -> list[tuple[int, int]]:
    """Keys between ranges of near equal tokens, from at most MAX_RANGES * SAMPLED documents or so.

    The sample only places borders: every document goes to the range of its own key.
    """
    if parts == 1:
        return []
    odds = min(1.0, parts * SAMPLED / n)
    some = src.where(F.pmod(F.xxhash64("tie", F.lit(3)), F.lit(1 << 30)) < int(odds * (1 << 30)))

    def keys(batches):
        enc = Encoder(path)
        for batch in batches:
            ids = _all_ids(enc, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(curve_keys(ids), pa.int64()), batch.column(2), pa.array([len(x) for x in ids], pa.int64())],
                names=["key", "tie", "n"])

    rows = sorted(tuple(r) for r in some.mapInArrow(keys, "key long, tie long, n long").collect())
    below = np.cumsum([r[2] for r in rows])
    if not len(below):
        return []
    at = np.searchsorted(below, below[-1] * np.arange(1, parts) / parts)
    return [rows[k][:2] for k in at]


def cuts(at: int, n: int, length: int) -> list[tuple[int, int, int, int]]:
    """(from, to, sequence, offset) of the pieces of n ids that begin at place ``at`` of the stream."""
    out, a = [], 0
    while a < n:
        seq, off = divmod(at + a, length)
        b = min(n, a + length - off)
        out.append((a, b, seq, off))
        a = b
    return out


def _narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id where they fit (a leading byte tells), else four."""
    return b"\x02" + ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else b"\x04" + ids.tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u2" if raw[0] == 2 else "<u4", offset=1).astype("<u4")
