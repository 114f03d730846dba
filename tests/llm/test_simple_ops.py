"""Exact dedup, sharding, decontamination, language ID and packing against brute force."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tablewise.llm import decontaminate, exact_dedup, langid, packing, queries, sharding
from tablewise.llm.common import UPPER

from .conftest import make_docs

SF = "/root/testdata/sf0.01"


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, UPPER.lower()))


def real_docs(spark, path=SF):
    return spark.read.parquet(f"{path}/documents.parquet")


# ---- exact dedup

def check_dedup(rows, got):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[lower(text)].append(doc)
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, max(known) if known else None, len(ids), sha) for i in ids]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(want, key=key)
    kept = [(r.doc_id, r.keep_id) for r in got if r.kept]
    assert len(kept) == len(groups) and all(a == b for a, b in kept)


@pytest.mark.parametrize("hot_rows", [256, 8])
def test_exact_dedup_awkward(spark, awkward, hot_rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MIN_HOT_ROWS", hot_rows)
    df = make_docs(spark, awkward, extra=["kept", "KEEP_ID", "_x_norm", "_x_salt", "a.b"])
    got = exact_dedup.exact_dedup(df, carry=True)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_x_norm", "_x_salt", "a.b", *exact_dedup.ADDED]
    check_dedup(awkward, got.collect())
    check_dedup(awkward, exact_dedup.exact_dedup(df, carry=False).collect())


def test_exact_dedup_near_heads(spark, monkeypatch):
    """Many different texts with one opening, and copies among them."""
    monkeypatch.setattr(exact_dedup, "MIN_HOT_ROWS", 8)
    rows = [(i, "The same opening " * 8 + str(i % 37)) for i in range(200)]
    check_dedup(rows, exact_dedup.exact_dedup(make_docs(spark, rows), carry=False).collect())


def test_exact_dedup_empty(spark):
    assert exact_dedup.exact_dedup(make_docs(spark, [])).collect() == []


# ---- sharding

def check_shards(rows, got, shards):
    assert len(got) == len(rows)
    assert sorted((r.size, r.text_crc32) for r in got) == sorted(
        (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(0 <= s < shards for s in by)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    return {s: sum(r.size for r in v) for s, v in by.items()}


def test_sharding_real(spark):
    docs = real_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sizes = check_shards(rows, queries.QUERIES["op5_sharding"](spark, SF).collect(), 40)
    largest = max(len(t.encode()) + 16 for _, t in rows)
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and max(abs(x - mean) for x in sizes.values()) <= largest


def test_sharding_hot_group_is_cut(spark):
    rows = [(i, "copied text") for i in range(2000)] + [(5000 + i, f"text {i} " * 3) for i in range(1000)]
    got = sharding.shard_by_bytes(make_docs(spark, rows), carry=False).collect()
    sizes = check_shards(rows, got, 40)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 60
    assert {r.group_cut for r in got} == {True, False}


def shards_of_texts(rows, got):
    crc = {zlib.crc32((t or "").encode()): t for _, t in rows}
    found = defaultdict(set)
    for r in got:
        found[crc[r.text_crc32]].add(r.shard)
    return found


def test_sharding_groups_stay_whole_up_to_the_stated_part(spark):
    """Pairs stay together; groups of half a shard only if the caller asks for it."""
    small = [(i, f"pair {i // 2} " * 4) for i in range(4000)]
    got = sharding.shard_by_bytes(make_docs(spark, small), carry=False, whole_group=0.05).collect()
    check_shards(small, got, 40)
    assert all(len(x) == 1 for x in shards_of_texts(small, got).values())
    large = [(i, f"group {i // 27:04d} " * 4) for i in range(2000)]  # 75 groups, each half a shard
    for part, whole in ((0.6, True), (0.0, False)):
        got = sharding.shard_by_bytes(make_docs(spark, large), carry=False, whole_group=part).collect()
        sizes = check_shards(large, got, 40)
        spread = [len(x) for x in shards_of_texts(large, got).values()]
        assert (max(spread) == 1) == whole and any(r.group_cut for r in got) != whole
        if not whole:
            assert max(sizes.values()) - min(sizes.values()) <= 2 * 70


@pytest.mark.parametrize("carry", [True, False])
def test_sharding_repeated_rows_keep_the_law(spark, carry):
    """Two thirds of all rows repeat one id and text: bytes still come out even."""
    rows = [(7, "the same row")] * 2000 + [(i, f"other {i}") for i in range(998)] + [(None, None)] * 400
    got = sharding.shard_by_bytes(make_docs(spark, rows), carry=carry).collect()
    sizes = check_shards(rows, got, 40)
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 2 * 40


def test_sharding_is_one_exchange_of_rows(spark, tmp_path):
    """Partitions follow the shards in key order, so slots need no further sort."""
    rows = [(i, f"text {i}") for i in range(3000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        got = sharding.shard_by_bytes(make_docs(spark, rows), 5).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    check_shards(rows, got, 5)


def test_sharding_awkward(spark, awkward):
    df = make_docs(spark, awkward, extra=["shard", "size", "_h", "slot"])
    got = sharding.shard_by_bytes(df, 7)
    assert "lang" in got.columns
    check_shards(awkward, got.collect(), 7)
    assert sharding.shard_by_bytes(make_docs(spark, [])).collect() == []
    few = [(1, "a"), (2, "b")]
    check_shards(few, sharding.shard_by_bytes(make_docs(spark, few)).collect(), 40)


# ---- decontamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(rows, items, n=10):
    table = {}
    for item, text in items:
        w = WORDS.findall(lower(text))
        size = min(n, len(w))
        for i in range(len(w) - size + 1) if w else ():
            table.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes = sorted({len(k) for k in table})
    out = []
    for doc, text in rows:
        w = WORDS.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                items_here = table.get(tuple(w[i:i + size]))
                if items_here:
                    hit.update(range(i, i + size))
                    found |= items_here
        names = sorted("" if x is None else str(x) for x in found)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def rows_of(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()],
                  key=str)


def test_decontamination_real(spark):
    docs = [(r.doc_id, r.text) for r in real_docs(spark).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute_contamination(docs, items)
    assert any(r[5] for r in want)
    assert rows_of(queries.QUERIES["op7_decontamination"](spark, SF)) == sorted(want, key=str)


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_decontamination_awkward(spark, awkward, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BLOCK_WORDS", block)
    items = [(1, "Alpha"), (2, "beta gamma"), (3, None), (4, "!!"), (None, "delta 42"), (5, "one hot text one hot text one hot text one hot"),
             (6, "the and the and"), (7, "ÉTÉ"), (8, "été"), (9, " ".join(f"w{i}" for i in range(30)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [*awkward, (900, "x " + " ".join(f"W{i}" for i in range(5, 17)) + " y"), (901, " ".join(f"w{i}" for i in range(9)))]
    df = make_docs(spark, rows, extra=["n_hit", "hit_spans", "_d_text"])
    got = decontaminate.find_contamination(df, bench)
    assert rows_of(got) == sorted(brute_contamination(rows, items), key=str)
    assert "lang" in got.columns


def test_decontamination_empty(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(make_docs(spark, []), bench).collect() == []
    got = decontaminate.find_contamination(make_docs(spark, [(1, "a b")]), bench).collect()
    assert [(r.n_words, r.contaminated) for r in got] == [(2, False)]


# ---- language ID

def test_language_id_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op8_language_id"](spark, SF).collect()}
    docs = real_docs(spark).collect()
    assert len(got) == len(docs)
    right = total = 0
    for d in docs:
        r = got[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.held_out:
            total += 1
            right += r.lang_pred == d.lang
    assert right / total >= 0.97


def test_language_id_awkward(spark, awkward):
    labelled = [(1000 + i, t, la) for i, (t, la) in enumerate(
        [("the house and the garden of the king", "en"), ("das haus und der garten", "de"), ("la maison et le jardin", "fr")] * 6)]
    model = langid.fit(make_docs(spark, labelled + [(1, None, "zz"), (2, "text without label")]))
    assert model["langs"] == ["de", "en", "fr"]
    rows = [*awkward, (1, "1234 !!"), (2, "the gardens"), (3, "der gartenhaus"), (4, "et la maisonette"), (5, "日本語"), (6, "² ½ Ⅷ 3"), (7, "_ 7a")]
    got = langid.predict(make_docs(spark, rows, extra=["score", "lang_pred", "_l_text"]), model)
    out = got.collect()
    assert len(out) == len(rows)
    by = {r.text: r.lang_pred for r in out}
    assert (by["the gardens"], by["der gartenhaus"], by["et la maisonette"]) == ("en", "de", "fr")
    for r in out:
        assert (r.lang_pred == "und") == (not r.text or not any(c.isalpha() for c in r.text))
    none = langid.fit(make_docs(spark, []))
    assert {r.lang_pred for r in langid.predict(make_docs(spark, [(1, "word")]), none).collect()} == {"und"}
    assert langid.predict(make_docs(spark, []), model).collect() == []


def test_language_learns_from_null_and_repeated_ids(spark):
    rows = [(None, f"the words of english number {i}", "en") for i in range(6000)]
    rows += [(9, f"die deutschen wörter hier {i}", "de") for i in range(6000)]
    rows += [(i, f"les mots de la langue {i}", "fr") for i in range(100)]
    model = langid.fit(make_docs(spark, rows))
    assert model["langs"] == ["de", "en", "fr"]
    scorer = langid.Scorer(model)
    assert [scorer.predict(t)[0] for t in ("the words", "die wörter", "les mots")] == ["en", "de", "fr"]


def test_language_backoff_order():
    """A known n-gram of four wins over shorter ones; without it the shorter ones decide."""
    logs = np.array([[-1.0, -9.0], [-9.0, -1.0]], dtype=np.float32)
    model = {"langs": ["aa", "bb"], "words": {}, "word_logs": np.zeros((0, 2), np.float32),
             "grams": {"^xyz": 0, "q": 1}, "gram_logs": logs}
    s = langid.Scorer(model)
    assert s.predict("xyz")[0] == "aa" and s.predict("q")[0] == "bb"


# ---- packing

def check_packing(rows, got, fill):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    texts = defaultdict(list)
    for doc, text in rows:
        texts[doc].append(text)
    for doc, many in texts.items():
        todo = sorted(pieces[doc], key=lambda r: (r.doc_tokens, r.start))
        want = []
        for text in many:
            ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
            raw = np.array(ids, dtype="<u4")
            want.append((len(ids), raw))
        assert sum(n for n, _ in want) == sum(r.length for r in todo)
        if len(many) == 1:
            at = 0
            for r in todo:
                assert r.start == at and r.doc_tokens == want[0][0]
                assert zlib.crc32(want[0][1][at:at + r.length].tobytes()) == r.ids_crc32
                at += r.length
    total = 0
    for v in seqs.values():
        at = 0
        for r in sorted(v, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
    assert total >= fill * 2048 * len(seqs)


def test_packing_real(spark):
    rows = [(r.doc_id, r.text) for r in real_docs(spark).collect()]
    check_packing(rows, queries.QUERIES["op3_packing"](spark, SF).collect(), 0.99)


def test_packing_awkward(spark, awkward):
    rows = [*awkward, (800, "a <|endoftext|> b"), (801, "  two  spaces \n\n and more \t x"), (802, " lead"), (803, "it's we'll 12 34!! ...")]
    df = make_docs(spark, rows, extra=["key", "ids", "sequence_id"])
    got = packing.pack(df)
    check_packing(rows, got.collect(), 0.5)
    assert packing.pack(make_docs(spark, [])).collect() == []


def test_ids_equal_the_tokenizer_library():
    enc = packing.Encoder(packing.default_tokenizer())
    assert enc.fast is not None
    rng = random.Random(2)
    texts = ["", " ", "a  b", "a \n b", "\n\n a", "x  y", "tab\t z", "end  ", "é ñ  1 2", "a\x1c b \x85 c", "''s 's",
             "a" * 20_000, " " * 5000 + "x", " " * 2_000_000 + "x", "日本語 テキスト", "<|endoftext|> x", "\u200b\u3000 \ufeff", "it'S IT'll"]
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'", "s", "ll", "1", "²", "é", "ß", ".", ",", "!!", "\u2028", "\xa0", "\x0b",
                "\x1f", "\x85", "日", "😀", "\u0301", "_", "-"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for text in texts:
        assert enc.ids(text).tolist() == enc.tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_many_ranges(spark, monkeypatch):
    """Ranges of few bytes, a third of the rows copies of one text: each range is a stream of its own."""
    monkeypatch.setattr(packing, "RANGE_BYTES", 20_000)
    rows = [(i, "copy of a text " * 20) for i in range(300)] + [(1000 + i, f"text {i} " * (i % 90)) for i in range(600)]
    got = packing.pack(make_docs(spark, rows)).collect()
    check_packing(rows, got, 0.6)
    by = defaultdict(int)
    for r in got:
        by[r.sequence_id >> packing.RANGE_SHIFT] += r.length
    assert len(by) > 5 and max(by.values()) < 4 * sum(by.values()) / len(by)


def test_hilbert_neighbours():
    """Every step along the curve moves by one in one axis."""
    side, dims, bits = 8, 3, 3
    grid = np.array(np.meshgrid(*[range(side)] * dims)).reshape(dims, -1).T
    key = packing.hilbert_key(grid, bits)
    assert sorted(key) == list(range(side ** dims))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_cuts_fill_sequences():
    assert packing.cuts(2000, 100, 2048) == [(0, 48, 0, 2000), (48, 100, 1, 0)]
    assert packing.cuts(0, 2048, 2048) == [(0, 2048, 0, 0)]
    assert packing.cuts(5, 0, 2048) == []
