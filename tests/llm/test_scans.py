"""PII and secret scans against the plain patterns in Python, and the scores and tests on their own."""
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tablewise.llm import pii, queries, secrets, spans

from .conftest import make_docs

SF = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
]
SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def brute(kinds, text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, pattern, ok) in enumerate(kinds)
             for m in re.finditer(pattern, text or "") if ok(m)]
    counts = tuple(sum(f[1] == k for f in found) for k in range(len(kinds)))
    base = ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(found))
    return counts, hashlib.sha256(base.encode()).hexdigest(), set(base.split(",")) - {""}


def check(kinds, rows, found):
    """Rows and results in any order, matched by id (unique here)."""
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows) == len(by)
    extra = {}
    for doc, text in rows:
        counts, sha, base = brute(kinds, text)
        r = by[doc]
        assert tuple(r[f"n_{k[0]}"] for k in kinds) == counts, (doc, text[:200])
        assert r.base_sha256 == sha, (doc, r.spans)
        spans = r.spans.split(",") if r.spans else []
        assert base <= set(spans)
        starts = [int(x.split(":")[1]) for x in spans]
        assert starts == sorted(starts)
        extra[doc] = [x for x in spans if x not in base]
    return extra


def fuzz(alphabet, n, seed):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120)))) for i in range(n)]


LONG = [
    (-1, "7" * 60_000), (-2, "a." * 30_000 + "@" + "b.c" * 10_000), (-3, "+1 " + "(2) " * 20_000),
    (-4, "1.2.3." * 20_000), (-5, "x@y.z " * 5_000), (-6, "a" * 100_000), (-7, "f" * 100_000), (-8, "token=" * 20_000),
    (-9, "AKIA" * 20_000), (-10, "4111 1111 1111 1111, " * 3_000), (-11, "é😀 me@host.org " * 2_000), (-12, None), (-13, ""),
    (-14, "password" + " " * 50_000), (-15, "1-" * 40_000), (-16, "00000255.0.000.1 256.1.1.1 1.2.3.4.5.6.7.8"),
]


def run_pii(df):
    return pii.digests(pii.find_pii(df, carry=["doc_id"])).collect()


def run_secrets(df):
    return secrets.digests(secrets.find_secrets(df, carry=["doc_id"])).collect()


@pytest.mark.parametrize("alphabet", ["a.@-1 ", "0123456789 -.+()", "ab@.c%_+", "4 1-6.", "1.25", "+19() .-"])
def test_pii_fuzz(spark, alphabet):
    rows = fuzz(alphabet, 400, len(alphabet))
    check(PII, rows, run_pii(make_docs(spark, rows)))


@pytest.mark.parametrize("pieces", [["token", "=", " ", '"', "abc", "12345678", "api_KEY", ":", "SECRET"],
                                    ["AKIA", "ABCD1234", "Z9", "a", " "], ["0123456789abcdef", "dead", "g", " ", "AB"]])
def test_secrets_fuzz(spark, pieces):
    rows = fuzz(pieces, 300, len(pieces))
    check(SECRETS, rows, run_secrets(make_docs(spark, rows)))


def test_long_texts(spark):
    check(PII, LONG, run_pii(make_docs(spark, LONG)))
    check(SECRETS, LONG, run_secrets(make_docs(spark, LONG)))


def test_real(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for kinds, name in ((PII, "op1_pii"), (SECRETS, "op4_secrets")):
        found = queries.QUERIES[name](spark, SF).collect()
        extra = check(kinds, rows, found)
        assert sum(bool(r.spans) for r in found) > 10
        assert not any(extra.values())  # these documents hold base kinds only


def test_awkward_tables(spark, awkward):
    df = make_docs(spark, awkward, extra=["pii", "secrets", "n_ip", "email", "_text", "_m_ip", "random"])
    for f in (pii.find_pii, secrets.find_secrets):
        out = f(df)
        assert out.count() == len(awkward) and {"lang", "_text"} <= set(out.columns)
        assert f(make_docs(spark, [])).collect() == []


def test_checksums_and_context(spark):
    rows = [(1, "my iban is DE89 3704 0044 0532 0130 00, thanks"), (2, "DE88 3704 0044 0532 0130 00"),
            (3, "GB82WEST12345698765432"), (4, "ssn 219-09-9999 here"), (5, "part 219-09-9999 here"),
            (6, "call (939) 555-6242 now"), (7, "lot (939) 555-6242 now"), (8, "phone +1 (939) 555-6242"),
            (9, "visa 4111111111111111"), (10, "4111111111111111"), (11, "iban 0")]
    got = {r.doc_id: r for r in run_pii(make_docs(spark, rows))}
    kinds = {k: [x.split(":")[0] for x in r.spans.split(",") if x] for k, r in got.items()}
    assert kinds == {1: ["iban"], 2: [], 3: ["iban"], 4: ["ssn"], 5: [], 6: ["tel"], 7: [], 8: ["phone"], 9: ["card"],
                     10: ["card"], 11: []}
    assert got[1].spans == "iban:11:38"
    assert float(got[9].scores) > float(got[10].scores)


def battery(token, alphabet):
    k, n = len(alphabet), len(token)
    at = [alphabet.index(c) for c in token]
    chi = sum(at.count(i) ** 2 for i in range(k)) * k / n - n
    z = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    mid, sd = (k - 1) / 2, math.sqrt((k * k - 1) / 12)
    runs = sum((a > mid) != (b > mid) for a, b in zip(at, at[1:], strict=False))
    zr = (runs - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    zs = sum((a - mid) * (b - mid) for a, b in zip(at, at[1:], strict=False)) / sd ** 2 / math.sqrt(n - 1)
    x = z * z + zr * zr + zs * zs
    return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)


def test_battery_matches_the_formulas(spark):
    rng = random.Random(1)
    rows = []
    for alphabet, _ in secrets.ENCODINGS:
        rows += [("".join(rng.choice(alphabet) for _ in range(n)), alphabet) for n in (64, 200)]
    rows.append(("a1" * 20, secrets.DIGITS + secrets.LOWER[:6]))
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string").withColumn("p", secrets.p_value(F.col("t")))
    got = {r.t: r.p for r in df.collect()}
    for token, alphabet in rows:
        assert got[token] == pytest.approx(battery(token, alphabet), abs=1e-5)
    plain = spark.createDataFrame([("teheitenscheinbeheitundso",)], "t string").select(secrets.p_value(F.col("t"))).first()
    assert plain[0] is None


def test_random_tokens_are_found_and_structured_ones_are_not(spark):
    rng = random.Random(4)
    sixtyfour = secrets.ENCODINGS[5][0]
    rows = [(i, "value " + "".join(rng.choice(sixtyfour) for _ in range(40)) + " end") for i in range(100)]
    rows += [(200 + i, f"path /Usr/share/local/lib{i}/modules/Include/headers end") for i in range(100)]
    rows += [(400 + i, "AbAbAbAbAb1AbAbAbAbAb1AbAbAb" + "a" * i) for i in range(50)]
    got = {r.doc_id: r.spans for r in run_secrets(make_docs(spark, rows))}
    assert sum(got[i].startswith("random:6:") for i in range(100)) >= 93
    assert not any("random" in got[i] for i in got if i >= 200)


def test_levels_control_false_shares(spark):
    even = [(5, (i + 0.5) / 1000) for i in range(1000)]
    low = [(5, 0.004)] * 500 + [(6, 0.03)] * 50
    df = spark.createDataFrame(even + low, "size int, p double")
    assert secrets.levels(df) == {5: 0.005, 6: 0.05}


def test_iban_before_another_word(spark):
    good = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "DE89370400440532013000", "NO93 8601 1117 947",
            "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    texts = [f"{before} {x}{after}" for x in good for before in ("IBAN", "konto:") for after in (" BIC", " EUR", ".", " VISA 12", "")]
    texts += ["IBAN ES91 2100 0418 4502 0005 1333 BIC", "IBAN XX91 2100 0418 4502 0005 1332", "IBAN BE68 5390 0754 70345"]
    got = {r.doc_id: r.pii for r in pii.find_pii(make_docs(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        found = [text[x.s:x.e] for x in got[i] if x.kind == "iban"]
        assert found == [x for x in good if x in text and "70345" not in text], text


def test_spans_clear_of_the_base_ones(spark):
    """Blocks of spans give what comparing every pair gives, and do not slow down with the square of the text."""
    import time
    rng = random.Random(4)
    parts = [("%064x" % rng.getrandbits(256)) if rng.random() < .5 else "token=" + "%040x" % rng.getrandbits(160) for _ in range(3000)]
    texts = [" ".join(parts[:n]) for n in (0, 1, 255, 256, 257, 3000)]
    df = spans.find(make_docs(spark, list(enumerate(texts))).select("doc_id", "text"), "text",
                    {"base": (r"[0-9a-f]{24,}", None), "other": (r"[a-f]*[0-9]{2}[a-z =]{1,3}", None)})
    blocked = spans.in_blocks(df, ["base"]).select("doc_id", "base", "other", F.transform("other", lambda x: spans.clear_of(x, ["base"])).alias("ok"))
    for r in blocked.collect():
        assert r.ok == [all(not (b.s < x.e and x.s < b.e) for b in r.base) for x in r.other]
    took = []
    for n in (4000, 16000):
        lines = "\n".join("%064x" % rng.getrandbits(256) for _ in range(n))
        at = time.perf_counter()
        secrets.find_secrets(make_docs(spark, [(1, lines)])).count()
        took.append(time.perf_counter() - at)
    assert took[1] < 6 * took[0] + 10
