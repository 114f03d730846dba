"""Regular-expression spans with positions, in built-in expressions only.

``regexp_extract_all`` gives the matches and ``split`` the text between them;
their lengths add up to the positions (code points). Sums run in blocks, so a
text with very many matches stays cheap.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK = 256
# Characters of context kept on each side of a match (never across another match of the kind).
CONTEXT = 48

SPAN = "array<struct<s:int,e:int,m:string,pre:string,post:string>>"


def _running(block: Column, start: Column) -> Column:
    """Sums of the elements before each element, counted from ``start``."""
    zero = F.struct(start.alias("p"), F.array().cast("array<int>").alias("o"))
    step = F.aggregate(block, zero, lambda a, v: F.struct(
        (a["p"] + v).alias("p"), F.concat(a["o"], F.array(a["p"])).alias("o")))
    return step["o"]


def _before(lens: Column) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / _BLOCK).cast("int")),
                         lambda k: F.slice(lens, k * _BLOCK + 1, F.lit(_BLOCK)))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, v: a + v))
    return F.flatten(F.zip_with(blocks, _running(totals, F.lit(0)), _running))


def find(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Add, for each kind, a column of its leftmost non-overlapping matches.

    ``patterns`` maps a kind to a Java pattern and a cheap condition without which
    no match is possible (or None). Each match has start ``s``, end ``e``
    (exclusive), the matched text ``m`` and its surroundings ``pre`` and ``post``.
    """
    none = F.array().cast("array<string>")
    t = F.col(text)
    hits = {}
    for kind, (pattern, needs) in patterns.items():
        got = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        hits[f"_m_{kind}"] = got if needs is None else F.when(needs, got).otherwise(none)
    df = df.withColumns(hits)
    df = df.withColumns({f"_g_{kind}": F.when(F.size(f"_m_{kind}") > 0, F.split(t, pattern, -1)).otherwise(none)
                         for kind, (pattern, _) in patterns.items()})

    def width(kind: str) -> Column:
        return F.transform(f"_m_{kind}", lambda m, i: F.length(m) + F.length(F.get(F.col(f"_g_{kind}"), i)))

    df = df.withColumns({f"_n_{kind}": width(kind) for kind in patterns})
    df = df.withColumns({f"_p_{kind}": F.when(F.size(f"_n_{kind}") > 0, _before(F.col(f"_n_{kind}")))
                        .otherwise(F.array().cast("array<int>")) for kind in patterns})

    def span(kind: str) -> Column:
        g, p = F.col(f"_g_{kind}"), F.col(f"_p_{kind}")

        def one(m: Column, i: Column) -> Column:
            start = F.get(p, i) + F.length(F.get(g, i))
            return F.struct(start.alias("s"), (start + F.length(m)).alias("e"), m.alias("m"),
                            F.right(F.get(g, i), F.lit(CONTEXT)).alias("pre"),
                            F.left(F.get(g, i + 1), F.lit(CONTEXT)).alias("post"))
        return F.transform(f"_m_{kind}", one).cast(SPAN)

    return (df.withColumns({kind: span(kind) for kind in patterns})
            .drop(*[f"_{x}_{kind}" for kind in patterns for x in "mgnp"]))


def merged(kinds: list[str], score=None) -> Column:
    """All spans of the kinds by start, then kind as listed: array of (s, k, e, kind, score, m)."""
    def tagged(k: int, kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(
            x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind"),
            (F.lit(1.0) if score is None else score(kind, x)).alias("score"), x["m"].alias("m")))
    return F.array_sort(F.concat(*[tagged(k, kind) for k, kind in enumerate(kinds)]))


def joined(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def in_blocks(df: DataFrame, kinds: list[str]) -> DataFrame:
    """Add, for each kind (sorted spans that do not overlap), its spans in blocks with the positions they cover."""
    def blocks(kind: str) -> Column:
        n = F.size(kind)

        def block(k: Column) -> Column:
            part = F.slice(F.col(kind), k * _BLOCK + 1, F.lit(_BLOCK))
            return F.struct(F.get(F.col(kind), k * _BLOCK)["s"].alias("s"),
                            F.get(F.col(kind), F.least((k + 1) * _BLOCK, n) - 1)["e"].alias("e"),
                            F.transform(part, lambda y: F.struct(y["s"].alias("s"), y["e"].alias("e"))).alias("x"))
        return F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), block)

    none = F.array().cast("array<struct<s:int,e:int,x:array<struct<s:int,e:int>>>>")
    return df.withColumns({f"_blocks_{k}": F.when(F.size(k) > 0, blocks(k)).otherwise(none) for k in kinds})


def clear_of(span: Column, taken: list[str]) -> Column:
    """The span overlaps no span of the given kinds: only blocks that reach it are looked through (see ``in_blocks``)."""
    def meets(y: Column) -> Column:
        return (y["s"] < span["e"]) & (span["s"] < y["e"])

    ok = F.lit(True)
    for kind in taken:
        blocks = F.col(f"_blocks_{kind}")
        # the size is asked first, so that the column counts as used twice and is not computed again for every span
        ok = ok & ((F.size(blocks) == 0) | ~F.exists(blocks, lambda b: meets(b) & F.exists(b["x"], meets)))
    return ok
