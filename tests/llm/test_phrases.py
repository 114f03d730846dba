"""Phrase collocations against counting in plain Python."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tablewise.llm import phrases

from .conftest import make_docs
from .test_simple_ops import lower

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, lo=2, hi=3, least=10, top=2000, covered=50):
    n, f = Counter(), Counter()
    for row in rows:
        lang = row[2] if len(row) > 2 and row[2] is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(row[1])):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, hi + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {key: a for key, a in f.items() if a >= least and len(key[1]) >= lo}
    out = defaultdict(list)
    for (lang, w), a in found.items():
        inside = any(lang == other and len(v) > len(w) and 100 * b >= covered * a
                     and any(v[i:i + len(w)] == w for i in range(len(v))) for (other, v), b in found.items())
        if not inside:
            score, _, l, r = min((10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                 for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, found in out.items() for k, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def check(df, rows, **options):
    got = phrases.collocations(df, **options)
    assert got.columns == COLUMNS
    names = {"min_words": "lo", "max_words": "hi", "min_count": "least", "top": "top", "covered": "covered"}
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, **{names[k]: v for k, v in options.items()})


def prose(n, seed=3):
    rng = random.Random(seed)
    words = "the of Of New york state san ñandú Été city hall a\x00b 42".split(" ")
    gaps = [" "] * 8 + ["  ", "\t", ", ", ". ", "\n", ";", "\x0b", " ? "]
    def text():
        return "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
    return [(i, text(), rng.choice(["en", "en", "es", None, ""])) for i in range(n)]


def test_collocations_prose(spark):
    rows = prose(120)
    df = make_docs(spark, rows, extra=["phrase", "a", "rank", "_part", "size"])
    check(df, rows)
    check(df, rows, min_count=3, max_words=4, top=25, covered=80)
    check(df, rows, min_words=3, max_words=3)
    check(df, rows, min_count=100_000)


def test_collocations_awkward(spark, awkward):
    check(make_docs(spark, awkward), awkward)


def test_collocations_empty(spark):
    for rows in ([], [(1, None), (2, ""), (3, " . , ")], [(1, "one two three")]):
        check(make_docs(spark, rows), rows)


def test_collocations_in_small_sections_and_ranges(spark, monkeypatch):
    """Texts cut into many sections, several exchanges of ranges, salted parts."""
    rows = prose(60, 4) + [(1000, " ".join(t for _, t, _ in prose(80, 5)), "en"), (1001, "x" * 5000 + " the of", "en")]
    monkeypatch.setattr(phrases, "HASH_BYTES", 200)
    monkeypatch.setattr(phrases, "FLUSH_GRAMS", 300)
    monkeypatch.setattr(phrases, "RANGE_BYTES", 500)
    monkeypatch.setattr(phrases, "RANGE_BITS", 3)
    check(make_docs(spark, rows), rows, min_count=4)


@pytest.mark.parametrize("bits", [0, 3])
def test_collisions_are_found_in_the_text(spark, monkeypatch, bits):
    """Almost all fingerprints equal: counts still come from the text."""
    monkeypatch.setattr(phrases, "_mix", lambda x: (x % np.uint64(1 << bits)) << np.uint64(60))
    rows = prose(40, 6)
    check(make_docs(spark, rows), rows)


def test_hot_parts_are_salted(spark, monkeypatch):
    rows = [(i, "the word%d. " % (i % 300) * 2, "en") for i in range(6000)]
    check(make_docs(spark, rows), rows)


def test_same_text_looks_at_every_byte():
    text = np.frombuffer(b"abcdefgh12345678xabcdefgh12345678yabc" + b"\0" * 8, dtype=np.uint8).copy()
    a, b = np.array([0, 0, 0]), np.array([17, 17, 34])
    assert phrases._same_text(text, a, b, np.array([16, 17, 3])).tolist() == [True, False, True]


def test_fingerprints_tell_texts_apart_and_know_equal_ones():
    texts = [t for _, t, _ in prose(50, 8)] * 2
    sections = [(np.frombuffer(t.encode(), dtype=np.uint8), lang, 0) for t in texts for lang in ("en", "es")]
    g = phrases._Grams(sections, 3, phrases._Powers())
    seen = {}
    for p, s, e, lang in zip(g.prints.tolist(), g.start, g.end, g.lang.tolist(), strict=True):
        seen.setdefault(p, set()).add((g.text[s:e].tobytes(), lang))
    assert all(len(x) == 1 for x in seen.values()) and len(seen) == len(set().union(*seen.values())) > 100


def test_blocks_round_trip():
    ids = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000, dtype=np.uint64))
    counts = np.arange(len(ids)) % 11
    parts, back = [], []
    for batch in phrases._blocks(ids, counts, 40, 6):
        for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            got, c = phrases._unpack(block)
            parts += (got + (np.uint64(part) << np.uint64(34))).tolist()
            back += c.tolist()
    assert parts == ids.tolist() and back == counts.tolist()
