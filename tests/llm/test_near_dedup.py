"""Near-duplicate groups against all pairs by brute force."""
import random
import re
from collections import defaultdict

import pytest

from tablewise.llm import near_dedup, queries
from tablewise.llm.common import UPPER

from .conftest import make_docs

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    w = WORD.findall((text or "").translate(str.maketrans(UPPER, UPPER.lower())))
    if not w:
        return frozenset()
    size = min(width, len(w))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    lists = defaultdict(list)
    first = {}
    for i, s in enumerate(sets):
        if s and s in first:
            up[top(i)] = top(first[s])
            continue
        if s:
            first[s] = i
        for x in s:
            lists[x].append(i)
    pairs = {(a, b) for v in lists.values() for k, a in enumerate(v) for b in v[k + 1:]}
    for a, b in pairs:
        i = len(sets[a] & sets[b])
        if 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
            up[top(a)] = top(b)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[top(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [x for x in ids[top(i)] if x is not None]
        comp = min(known) if known else None
        out.append((doc, len(sets[i]), comp, comp is None or doc == comp))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=str)


def edited(rng, words, vocabulary, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(vocabulary)
    return " ".join(w)


def test_real(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows, 4, 80)
    assert sum(not r[3] for r in want) > 50
    assert got(queries.QUERIES["op10_near_dedup"](spark, SF)) == want


@pytest.mark.parametrize(("short", "small"), [(6, 128), (2, 8)])
def test_hot_group_and_common_passage(spark, short, small, monkeypatch):
    """A large group of near copies, borderline ones among them, and documents that share a long passage only."""
    monkeypatch.setattr(near_dedup, "SHORT_LIST", short)
    monkeypatch.setattr(near_dedup, "SMALL_GROUP", small)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = [(i, edited(rng, base, vocabulary, rng.choice([1, 2, 3, 4, 6, 9]))) for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows += [(1000 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 150))) + " " + passage)
             for i in range(300)]
    rows += [(2000 + i, edited(rng, base[:8], vocabulary, i % 3)) for i in range(30)]
    rng.shuffle(rows)
    assert got(near_dedup.near_dedup(make_docs(spark, rows), width=4, carry=False)) == brute(rows, 4, 80)


def test_chain_of_small_edits(spark):
    """Links reach over many steps; the ends have little in common."""
    rng = random.Random(9)
    words = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(40):
        rows.append((500 - i, " ".join(words)))
        words[i * 3 % 120] = f"new{i}"
    rng.shuffle(rows)
    assert got(near_dedup.near_dedup(make_docs(spark, rows), width=4, carry=False)) == brute(rows, 4, 80)


def test_awkward(spark, awkward):
    df = make_docs(spark, awkward, extra=["component_id", "node", "_key", "_row", "v"])
    for width in (4, 5):
        assert got(near_dedup.near_dedup(df, width=width, carry=False)) == brute(awkward, width, 80)
    whole = near_dedup.near_dedup(df)
    assert got(whole) == brute(awkward, 5, 80)
    assert {"text", "node", "_row"} <= set(whole.columns)
    assert near_dedup.near_dedup(make_docs(spark, [])).collect() == []
    assert got(near_dedup.near_dedup(make_docs(spark, [(1, None), (2, "a")]))) == [(1, 0, 1, True), (2, 1, 2, True)]
    with pytest.raises(ValueError):
        near_dedup.near_dedup(df, percent=50)


def test_filter_of_texts_reaches_the_driver_as_bytes(spark, monkeypatch):
    """A row came to the driver for every 64 bits of the filter that held a text, 131,072 of a large corpus."""
    import numpy as np
    from pyspark.sql import functions as F
    keys = spark.range(5000).select(F.when(F.col("id") > 0, F.xxhash64("id")).otherwise(-1).alias("tkey"))
    want = np.zeros(near_dedup.FILTER_BITS, dtype=bool)
    want[[r["tkey"] % near_dedup.FILTER_BITS for r in keys.collect()]] = True
    read, collect = [], type(keys).collect
    monkeypatch.setattr(type(keys), "collect", lambda df: read.append(collect(df)) or read[-1])
    assert near_dedup._bit_filter(keys) == np.packbits(want, bitorder="little").tobytes()
    assert 0 < sum(len(rows) for rows in read) <= 8
    assert near_dedup._bit_filter(keys.where("false")) == bytes(near_dedup.FILTER_BITS // 8)
