"""Dual-tree search against scoring every document for every item."""
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tablewise.llm import lexical

from .conftest import make_docs
from .test_simple_ops import lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, items, k=10):
    docs = [(r[0], TERM.findall(lower(r[1]))) for r in rows]
    n_docs, length = sum(1 for _, w in docs if w), sum(len(w) for _, w in docs)
    counts = [(i, len(w), {t: w.count(t) for t in set(w)}) for i, w in docs]
    df = {}
    for _, _, c in counts:
        for t in c:
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        terms = set(TERM.findall(lower(text)))
        found = []
        for i, n, c in counts:
            m = 100 - 90 + 90 * n * n_docs // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms if t in c)
            if s > 0:
                found.append((-s, i is not None, i or 0, s))
        found.sort(key=lambda x: (x[0], x[1], x[2]))
        out += [(item, r + 1, x[2] if x[1] else None, x[3]) for r, x in enumerate(found[:k])]
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def bench(spark, items, item_type="long"):
    return spark.createDataFrame(items, f"item_id {item_type}, text string").repartition(2)


def check(spark, rows, items, item_type="long", docs=None, **options):
    docs = make_docs(spark, rows, extra=["score", "rank", "key", "item"]) if docs is None else docs
    got = lexical.search(docs, bench(spark, items, item_type), **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute(rows, items, options.get("k", 10))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of", "Été"]
    weights = [1 / (i + 1) for i in range(400)] + [1, 1, .2]
    rows = [(i, " ".join(rng.choices(vocab, weights, k=rng.randint(0, 60)))) for i in range(n)]
    return rows + [(n + i, rows[i % 3][1]) for i in range(n // 4)]  # copies: equal scores


def items_of(rows, n, seed=2):
    rng = random.Random(seed)
    return [(i, " ".join(rng.sample(rng.choice(rows)[1].split() + ["nowhere", "w1"], 2))) for i in range(n)]


ITEMS = [(1, "ABC def"), (2, None), (3, ""), (4, "the one hot text"), (5, "straße été 42"), (5, "alpha alpha beta"),
         (None, "gamma"), (6, "?!"), (7, "x997 the"), (8, "ABC def")]


def test_search_awkward(spark, awkward):
    check(spark, awkward, ITEMS)
    check(spark, awkward, ITEMS, k=1)


def test_search_small_trees(spark, monkeypatch):
    """Several blocks, deep trees, small sections of text and many sets of items."""
    for name, value in (("BLOCK_DOCS", 64), ("LEAF_DOCS", 4), ("FANOUT", 2), ("SECTION", 40)):
        monkeypatch.setattr(lexical, name, value)
    rows = corpus(700)
    check(spark, rows, items_of(rows, 45))
    monkeypatch.setattr(lexical, "MAX_SET_BYTES", 100)
    check(spark, rows, items_of(rows, 10, 5), k=3)


def test_search_string_ids(spark, awkward):
    docs = make_docs(spark, awkward).withColumn("doc_id", F.concat(F.lit("d"), F.format_string("%05d", "doc_id")))
    docs = docs.withColumn("doc_id", F.when(~F.col("doc_id").contains("null"), F.col("doc_id")))
    rows = [(None if i is None else f"d{i:05d}", t) for i, t in awkward]
    got = lexical.search(docs, bench(spark, ITEMS)).collect()
    ids = {(r.item_id, r.rank, r.score) for r in got}
    place = {x: k for k, x in enumerate(sorted({r[0] for r in rows if r[0]}))}
    want = brute([(None if i is None else place[i], t) for i, t in rows], ITEMS)
    assert ids == {(i, r, s) for i, r, _, s in want}
    back = {v: k for k, v in place.items()}
    assert sorted((x.doc_id or "" for x in got)) == sorted(back[d] if d is not None else "" for _, _, d, _ in want)


def test_search_empty(spark, awkward):
    check(spark, [], ITEMS)
    check(spark, awkward, [])
    check(spark, [(1, None), (2, " . ")], ITEMS)


def test_bounds_prune_and_lose_nothing():
    """Few pairs are scored, and the result is that of scoring all."""
    rng = np.random.default_rng(4)
    n, v = 4000, 300
    topic = rng.integers(0, 30, n)
    terms = [np.unique(np.concatenate((t * 10 + rng.integers(0, 10, 6), rng.integers(0, v, 1)))) for t in topic]
    doc = np.repeat(np.arange(n), [len(t) for t in terms])
    term = np.concatenate(terms)
    gain = rng.integers(1, 1000, len(term))
    items = [np.unique(rng.integers(0, 10, 4) + 10 * k) for k in range(30)]
    weight = rng.integers(1, 9000, v)
    tree = lexical.ItemTree(items, weight)
    search = lexical.Search(tree, 5)
    search.add(lexical.DocumentTree(np.arange(n) * 3, doc, term, gain, weight))
    full = np.zeros((n, v), dtype=np.int64)
    full[doc, term] = gain
    want = set()
    for i, t in enumerate(items):
        s = full[:, t] @ weight[t]
        want |= {(i, int(d) * 3, int(s[d])) for d in np.lexsort((np.arange(n), -s))[:5] if s[d] > 0}
    got = search.found()
    assert set(zip(*[c.to_pylist() for c in got.columns], strict=True)) == want
    assert search.scored < 0.2 * n * len(items)


@pytest.mark.parametrize("text", [b"", b"abc", b"a b c " * 50, b"abcdefghij" * 30])
def test_counts_in_sections(text, monkeypatch):
    monkeypatch.setattr(lexical, "SECTION", 7)
    n, found = lexical._counts(text, {b"a": 0, b"abc": 1, b"abcdefghij" * 30: 2}.get)
    words = text.split()
    assert n == len(words) and found.get(0, 0) == words.count(b"a") and found.get(2, 0) == words.count(b"abcdefghij" * 30)
