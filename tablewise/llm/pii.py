"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Built-in expressions only; every text is scanned whole, where it lies.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans
from .common import bundle, col, others, unbundle

BASE = ["email", "ip", "card", "phone"]
EXTRA = ["iban", "ssn", "tel"]

# Characters of an account number by country (the word after a number is not part of it).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
_ACCOUNTS = "|".join(
    rf"(?:{'|'.join(c for c, m in IBAN_LENGTHS.items() if m == n)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}"
    for n in sorted(set(IBAN_LENGTHS.values())))

# Patterns. Possessive quantifiers and look-behinds only keep the
# matcher linear; they match what the plain patterns match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?:{_ACCOUNTS})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "tel": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
}
# Score of the pattern alone, gain from a confirmed checksum, words that raise it.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.2, "ssn": 0.3, "tel": 0.3}
CONFIRMED = {"card": 0.4, "iban": 0.5}
WORDS = {
    "email": "mail|e-mail|contact|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse|login",
    "card": "card|visa|mastercard|credit|karte|carte|tarjeta|payment",
    "phone": "phone|tel|mobile|call|fax|telefon|telefono|handy",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social security|taxpayer",
    "tel": "phone|tel|mobile|call|fax|telefon|telefono|handy",
}
CONTEXT_GAIN = 0.2
CONTEXT_CHARS = 40
# Spans of the extra kinds count from this score on; those of the base kinds always do.
THRESHOLD = 0.5

ADDED = ["n_email", "n_ip", "n_card", "n_phone", "pii"]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _mod97(m: Column) -> Column:
    """The account number's check: first four characters last, letters as 10 to 35, remainder 1."""
    s = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substr(s, F.lit(5)), F.left(s, F.lit(4))), "")
    rest = F.aggregate(turned, F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).when(
        c.between("A", "Z"), (a * 100 + F.ascii(c) - 55) % 97).otherwise(a))
    return (F.length(s) >= 15) & (rest == 1)


# checks that a proposed span must pass
VALID = {
    "ip": lambda m: m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?|)(?:\.|$)){4}$"),
    "card": lambda m: F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
    "iban": _mod97,
}


def _near(kind: str, x: Column) -> Column:
    """A word that goes with the kind stands shortly before or after the span."""
    around = F.lower(F.concat(F.right(x["pre"], F.lit(CONTEXT_CHARS)), F.lit(" | "),
                              F.left(x["post"], F.lit(CONTEXT_CHARS))))
    return around.rlike(rf"(?<![a-z])(?:{WORDS[kind]})(?![a-z])")


def score(kind: str, x: Column) -> Column:
    """Between 0 and 1: pattern, checksum (spans that reach this point passed theirs) and context."""
    sure = PRIOR[kind] + CONFIRMED.get(kind, 0.0)
    return F.round(F.lit(sure) + F.when(_near(kind, x), CONTEXT_GAIN).otherwise(0.0), 2)


def find_pii(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Find personal data in whole texts.

    Adds counts of the base kinds and ``pii``: all spans by start, then kind, as
    (s, k, e, kind, score, m); positions are code points, the end exclusive.
    Base kinds: email, ip (parts to 255), card (12 to 19 digits, Luhn), phone (9
    to 15 digits). Extra kinds: iban (length of its country, mod 97), ssn and tel (both need a context
    word); they never overlap a base span.

    Null and empty texts have no spans. Repeated rows and null ids give a row
    each; an empty table gives none. Input columns named like the added ones
    are replaced. ``carry`` names the input columns to return (default: all).
    """
    cols = others(docs, ADDED) if carry is None else carry
    text = F.coalesce(col(text_col), F.lit(""))
    df = docs.select(bundle(cols), text.alias("_text"))
    t = F.col("_text")
    needs = {"email": F.contains(t, F.lit("@")), "phone": F.contains(t, F.lit("+")),
             "ip": t.rlike(r"[0-9]\.[0-9]"), "iban": t.rlike(r"[A-Z]{2}[0-9]{2}"),
             "ssn": t.rlike(r"-[0-9]{2}-"), "tel": t.rlike(r"[0-9]{3}[.-][0-9]{4}"), "card": None}
    df = spans.find(df, "_text", {k: (PATTERNS[k], needs[k]) for k in BASE + EXTRA}).drop("_text")

    def confirmed(kind: str) -> Column:
        return F.filter(kind, lambda x: VALID[kind](x["m"]))

    def likely(kind: str) -> Column:
        return F.filter(kind, lambda x: (score(kind, x) >= THRESHOLD) & spans.clear_of(x, BASE))

    df = spans.in_blocks(df.withColumns({k: confirmed(k) for k in VALID}), BASE).withColumns({k: likely(k) for k in EXTRA})
    return df.select(*unbundle(cols), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                     spans.merged(BASE + EXTRA, score).alias("pii"))


def digests(found: DataFrame) -> DataFrame:
    """``pii`` as text: base_sha256 (base spans), spans (all), scores."""
    base = F.filter("pii", lambda x: x["k"] < len(BASE))
    return found.withColumns({
        "base_sha256": F.sha2(spans.joined(base), 256), "spans": spans.joined(F.col("pii")),
        "scores": F.array_join(F.transform("pii", lambda x: x["score"].cast("string")), ",")}).drop("pii")
