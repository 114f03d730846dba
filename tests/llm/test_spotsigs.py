"""SpotSigs fingerprints and their search against a word-by-word version."""
import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from tablewise.llm import queries, spotsigs

from .conftest import make_docs

BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def spots(text, chain=2):
    segments, run = [], ["^"]
    for w in [w for w in BETWEEN.split((text or "").lower()) if w] + ["|"]:
        if w in spotsigs.ANCHORS and len(run) < spotsigs.LONGEST_RUN:
            run.append(w)
        else:
            segments.append((run, w))
            run = []
    out = set()
    for k, (run, w) in enumerate(segments):
        if run and w != "|":
            chained = [w for _, w in segments[k:k + chain]]
            out.add(xxhash.xxh64(("".join(x + " " for x in run + chained)).encode(), seed=42).intdigest() >> 32)
    return out


def hexed(s):
    return "".join(f"{x:08x}" for x in sorted(s, key=lambda x: x - (1 << 32) if x >> 31 else x))


def alike(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def h64(text):
    h = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return h - (1 << 64) if h >> 63 else h


def brute(rows, chain=2):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -h64(r[1])))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = spots(text, chain), spots(edited, chain), spots(after, chain)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b), alike(a, b), alike(a, c)))
    return out


def check(rows, got, chain=2):
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted(brute(rows, chain), key=key)
    got = sorted(map(tuple, got.collect()), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5:] for r in got] == [pytest.approx(r[5:]) for r in want]


def test_fingerprints_awkward(spark, awkward):
    rows = awkward + [(500, "the of and " * 3000 + "end"), (501, "The cat of the house sat on a mat"), (502, "word"), (503, "of the")]
    df = make_docs(spark, rows, extra=["fingerprint", "_b", "_h", "own", "key", "NEAR_NEXT"])
    got = spotsigs.fingerprints(df)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    check(rows, got)
    check(rows, spotsigs.fingerprints(df, chain=3), 3)


def test_fingerprints_over_many_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.randint(-10 ** 12, 10 ** 12), " ".join(rng.choices(spotsigs.ANCHORS[:9] + ["cat", "Haus", "été", "x1"], k=rng.randint(0, 25))))
            for _ in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            check(rows, spotsigs.fingerprints(make_docs(spark, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("rows", [[], [(7, "the cat")], [(None, None)], [(1, "a b"), (1, "a b"), (1, "c d")]])
def test_fingerprints_of_few_rows(spark, rows):
    check(rows, spotsigs.fingerprints(make_docs(spark, rows)))


def test_query_on_real_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(rows, queries.QUERIES["op12_spotsigs"](spark, "/root/testdata/sf0.001"))


def test_native_and_one_exchange_of_texts(spark):
    got = queries.QUERIES["op12_spotsigs"](spark, "/root/testdata/sf0.001")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Broadcast|Join", plan) and plan.count("Exchange") == 1


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_search_finds_all_alike(spark, least):
    rng = random.Random(9)
    base = [rng.choices(spotsigs.ANCHORS[:12] + [f"w{i}" for i in range(60)], k=60) for _ in range(25)]
    rows = []
    for k in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"new{rng.randint(0, 9)}"
        rows.append((k, " ".join(words)))
    rows += [(900, None), (901, "of the"), (902, rows[3][1]), (903, rows[3][1].upper())]
    df = make_docs(spark, rows)
    got = spotsigs.search(df.where(F.col("doc_id") % 10 == 0), df, least).collect()
    classes = {}
    for i, t in rows:
        if spots(t):
            classes.setdefault(frozenset(spots(t)), []).append(i)
    want = {(q, min(ids), len(ids), round(alike(spots(t), s), 9)) for q, t in rows if q % 10 == 0
            for s, ids in classes.items() if spots(t) and alike(spots(t), s) >= least}
    assert sorted((r.query_id, r.class_id, r.members, round(r.likeness, 9)) for r in got) == sorted(want) and len(want) > 20
