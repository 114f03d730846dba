"""Registered queries of the corpus operators: (spark, sf_dir) -> DataFrame, and DuckDB SQL where it can say the same."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate, exact_dedup, langid, lexical, licenses, near_dedup, packing, phrases, pii, secrets, sharding, spotsigs, warc)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return keep

# A-Z lowered and nothing else, in DuckDB
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

@register("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digests(pii.find_pii(table(spark, sf_dir, "documents"), carry=["doc_id"]))


@register("op2_license")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences and licence notices in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), carry=["doc_id"])


@register("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens along a Hilbert curve."""
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)

@register("op4_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents"), carry=["doc_id"]))


@register("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt over 40 shards of near equal bytes."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), carry=False)

# base32 of a SHA-1 in hex: five hex digits make four letters
_BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  (CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS BIGINT) // [32768, 1024, 32, 1][i % 4 + 1]) % 32 + 1, 1) for i in range(0, 32)], '')"""


@register("op6_warc", f"""
WITH t AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first
      FROM t)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM h""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives, normalised and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@register("op7_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, size, list_slice(w, i + 1, i + size) AS gram
       FROM (SELECT item_id, w, size, unnest(range(0, len(w) - size + 1)) AS i
             FROM (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0))),
dw AS (SELECT doc_id, size, i, list_slice(w, i + 1, i + size) AS gram
       FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS i
             FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
m AS (SELECT DISTINCT doc_id, dw.size, i, item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.gram = bw.gram),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(k, ',' ORDER BY k) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words found in every document."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                             carry=False)
    return found.drop("hit_items", "hit_spans")

@register("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.predict(docs, model, carry=["doc_id"]).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")

@register("op9_exact_dedup", f"""
WITH t AS (SELECT doc_id, sha256({_LOWER.format('text')}) AS text_sha256 FROM documents),
     g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical documents by content sort."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), carry=False)

@register("op10_near_dedup", rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(w, i + 1, i + size) AS g
      FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS i
            FROM (SELECT doc_id, w, least(4, len(w)) AS size FROM w WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
      GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * i >= 80 * (na.n + nb.n - i)),
r AS (SELECT doc_id AS a, doc_id AS c FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.c = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id, w.doc_id = min(r.c) AS kept
FROM w JOIN r ON r.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id, n.n""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on sets of four-word shingles."""
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), width=4, carry=False)


_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@register("op11_search", f"""
WITH d AS (SELECT doc_id, {_TERMS.format(_LOWER.format('text'))} AS w FROM documents),
c AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d),
t AS (SELECT doc_id, n, term, count(*) AS tf
      FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
       FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c),
q AS (SELECT DISTINCT item_id, unnest({_TERMS.format(_LOWER.format('text'))}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT)
             AS score
      FROM q JOIN t USING (term) JOIN wt USING (term), c GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_spotsigs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike they are."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


_PIECES = rf"regexp_split_to_array({_LOWER.format('text')}, '[.,;:!?\x0A-\x0D]')"


@register("op13_collocations", rf"""
WITH w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(list_slice(w, i + 1, i + k), ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM w, range(1, 4) t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT cut.lang, cut.phrase, cut.a, cut.j, x.f AS l, y.f AS r,
             CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.lp JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rp
      QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, cut.j) = 1),
o AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE k = 3),
m AS (SELECT lang, phrase, max(a) AS longer FROM o GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank,
       s.phrase, s.a, s.l, s.r, n.n, s.score
FROM s JOIN n ON n.lang = s.lang LEFT JOIN m ON m.lang = s.lang AND m.phrase = s.phrase
WHERE m.longer IS NULL OR 100 * m.longer < 50 * s.a
QUALIFY rank <= 2000""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of two and three words in each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))
