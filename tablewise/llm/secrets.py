"""Secrets: fixed shapes, and tokens whose characters pass a battery of randomness tests.

A long token without a fixed shape is measured in its inferred encoding:
chi-squared uniformity over the alphabet, a runs test and the serial
correlation of neighbouring symbols. The three give one p-value (small: not
random). How many of the tokens of about one length are not random is then
estimated from the p-values of all documents, and the level above which tokens of
that length count as secrets is set so that few of them are false.
Built-in expressions only.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans
from .common import bundle, col, others, unbundle, written

BASE = ["assign", "access", "hex"]
EXTRA = ["random"]

# Patterns (the lengths that the contract asks for are in them).
PATTERNS = {
    "assign": r"""(?:(?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"[0-9a-f]{24,}+",
    "random": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+",
}
VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
KEYWORD = r"^(?i)(?:password|passwd|secret|token|api_?key)"
VALUE_CHARS = 6

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings from narrow to wide (the first that holds all symbols), with what a token must show.
ENCODINGS = [
    (DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    (DIGITS + "ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    (UPPER + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$"),
    (DIGITS + LOWER, r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$"),
    (DIGITS + UPPER, r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$"),
    (UPPER + LOWER + DIGITS + "+/", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$"),
    (UPPER + LOWER + DIGITS + "_-", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$"),
]
# Accepted share of false discoveries among the tokens of one length class.
FALSE_SHARE = 0.05
# Levels at which a class may be cut; tokens under the lowest are never random.
LEVELS = [0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5]

ADDED = ["n_assign", "n_access", "n_hex", "secrets"]


def _erfc(x: Column) -> Column:
    """Complementary error function of x >= 0 (rational approximation, error under 2e-7)."""
    t = 1 / (1 + x * 0.3275911)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def p_value(token: Column) -> Column:
    """The battery's p-value of a token, or null if no encoding fits it."""
    body = F.rtrim(token, F.lit("="))
    out = F.lit(None).cast("double")
    for alphabet, shape in reversed(ENCODINGS):
        out = F.when(body.rlike(shape), _battery(body, alphabet)).otherwise(out)
    return out


def _battery(body: Column, alphabet: str) -> Column:
    k = float(len(alphabet))
    n = F.length(body).cast("double")
    # places of the symbols in the alphabet, 0 to k - 1
    at = F.transform(F.split(body, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))
    squares = F.aggregate(F.array(*[F.lit(c) for c in alphabet]), F.lit(0.0), lambda a, c: a + F.pow(
        F.length(body) - F.length(F.replace(body, c, F.lit(""))), F.lit(2.0)))
    chi = squares * k / n - n
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    middle, spread = (k - 1) / 2, math.sqrt((k * k - 1) / 12)
    # one pass over neighbours: changes of half, and products of centred places
    start = F.struct(F.get(at, F.lit(0)).alias("last"), F.lit(1.0).alias("runs"), F.lit(0.0).alias("r"))
    pair = F.aggregate(F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))), start, lambda a, x: F.struct(
        x.alias("last"),
        (a["runs"] + F.when((a["last"] > middle) != (x > middle), 1.0).otherwise(0.0)).alias("runs"),
        (a["r"] + (a["last"] - middle) * (x - middle)).alias("r")))
    z = F.transform(F.array(pair), lambda a: F.struct(
        ((a["runs"] - 1 - (n - 1) / 2) / F.sqrt((n - 1) / 4)).alias("runs"),
        (a["r"] / (spread * spread) / F.sqrt(n - 1)).alias("serial")))[0]
    total = F.transform(F.array(F.struct(z_chi.alias("c"), z.alias("z"))), lambda a: a["c"] * a["c"]
                        + a["z"]["runs"] * a["z"]["runs"] + a["z"]["serial"] * a["z"]["serial"])
    # upper tail of chi-squared with three degrees of freedom
    return F.transform(total, lambda x: F.least(F.lit(1.0), _erfc(F.sqrt(x / 2))
                                                + F.sqrt(x * 2 / math.pi) * F.exp(-x / 2)))[0]


def length_class(token: Column) -> Column:
    return F.floor(F.log2(F.length(token).cast("double"))).cast("int")


def levels(tokens: DataFrame) -> dict[int, float]:
    """For each length class of (token length class, p) the level from which tokens count as random.

    Random tokens have even p-values, so twice the tokens above 0.5 is about
    their number; what is left above a level beyond their share is false. The lowest
    level with a small enough false share is taken; 0.5 if there is none.
    """
    band = F.lit(0)
    for x in LEVELS:
        band = band + (F.col("p") >= x).cast("int")
    rows = tokens.groupBy("size", band.alias("band")).agg(F.count("*").alias("n")).collect()
    out: dict[int, float] = {}
    for size in {r["size"] for r in rows}:
        above = [sum(r["n"] for r in rows if r["size"] == size and r["band"] > k) for k in range(len(LEVELS))]
        even = above[-1] / (1 - LEVELS[-1])
        fits = [x for x, n in zip(LEVELS, above, strict=True) if n - even * (1 - x) <= FALSE_SHARE * n + 0.5]
        out[size] = min(fits, default=LEVELS[-1])
    return out


def find_secrets(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Find secrets in whole texts.

    Adds counts of the base kinds and ``secrets``: all spans by start, then kind, as
    (s, k, e, kind, score, m); positions are code points, the end exclusive.
    Base kinds: assign (keyword, separator, value of 6 characters or more), access
    (AKIA, 20 characters or more), hex (24 or more). The extra kind random holds
    tokens of 20 characters or more that pass the battery and overlap no base span;
    its score is the battery's p-value.

    Null and empty texts have no spans. Repeated rows and null ids give a row
    each; an empty table gives none. Input columns named like the added ones
    are replaced. ``carry`` names the input columns to return (default: all).
    """
    cols = others(docs, ADDED) if carry is None else carry
    text = F.coalesce(col(text_col), F.lit(""))
    df = docs.select(bundle(cols), text.alias("_text"))
    t = F.col("_text")
    needs = {"assign": t.rlike(r"[:=]"), "access": F.contains(t, F.lit("AKIA")), "hex": None, "random": None}
    df = spans.find(df, "_text", {k: (PATTERNS[k], needs[k]) for k in BASE + EXTRA}).drop("_text")
    value = lambda m: F.regexp_extract(F.regexp_replace(m, KEYWORD, ""), "^" + VALUE, 1)
    df = df.withColumn("assign", F.filter("assign", lambda x: F.length(value(x["m"])) >= VALUE_CHARS))
    df = spans.in_blocks(df, BASE)
    df = df.withColumn("random", F.filter("random", lambda x: spans.clear_of(x, BASE))).drop(*[f"_blocks_{k}" for k in BASE])
    df = df.withColumn("random", F.transform("random", lambda x: F.struct(
        *[x[f].alias(f) for f in ("s", "e", "m")], p_value(x["m"]).alias("p"))))
    df = written(df.withColumn("random", F.filter("random", lambda x: x["p"].isNotNull())), "secrets")
    tokens = df.select(F.explode("random").alias("x")).select(length_class(F.col("x.m")).alias("size"), "x.p")
    level = levels(tokens)

    def random(x: Column) -> Column:
        at = F.lit(LEVELS[-1])
        for size, low in level.items():
            at = F.when(length_class(x["m"]) == size, low).otherwise(at)
        return x["p"] >= at

    df = df.withColumn("random", F.filter("random", random))
    score = lambda kind, x: F.round(x["p"], 4) if kind == "random" else F.lit(1.0)
    return df.select(*unbundle(cols), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                     spans.merged(BASE + EXTRA, score).alias("secrets"))


def digests(found: DataFrame) -> DataFrame:
    """``secrets`` as text: base_sha256 (base spans), spans (all)."""
    base = F.filter("secrets", lambda x: x["k"] < len(BASE))
    return found.withColumns({"base_sha256": F.sha2(spans.joined(base), 256),
                              "spans": spans.joined(F.col("secrets"))}).drop("secrets")
