"""Column profiles, histograms, categories, correlations, role detection.

Each profile is ONE wide aggregation over all columns (never a job per
column); results come back in long form, one row per column or pair.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import stats as S
from ..functions.crossprod import correlations
from ..functions.scalars import col_, strength


# --------------------------------------------------------------------------- #
# A10 / A11 role detection
# --------------------------------------------------------------------------- #
def _micros(c: str):
    return F.unix_micros(col_(c).cast("timestamp"))


def detect_date_column(df: DataFrame) -> str | None:
    """Datetime column with the widest span (first on ties)."""
    cols = S.datetime_columns(df)
    if len(cols) <= 1:
        return cols[0] if cols else None
    spans = S.one_row(df, {c: F.max(_micros(c)) - F.min(_micros(c)) for c in cols})
    best, best_span = None, None
    for c in cols:
        sp = spans[c]
        if sp is not None and (best_span is None or sp > best_span):
            best, best_span = c, sp
    return best or cols[0]


def detect_metric_column(df: DataFrame, date_col: str | None, target: str | None) -> str | None:
    """The best-ranked numeric column that is no id: a metric's name first, then the target, then
    the largest spread relative to the mean; position decides ties."""
    def named(c: str, words: tuple[str, ...]) -> bool:
        return any(w in c.lower() for w in words)

    candidates = [c for c in S.numeric_columns(df) if c != date_col and not named(c, K.ID_HINTS)]
    rank = {c: 0 if named(c, K.METRIC_HINTS) else 1 if c == target else 2 for c in candidates}
    best = min(rank.values(), default=None)
    top = [c for c in candidates if rank[c] == best]
    if best != 2:
        return top[0] if top else None
    mean = {c: F.avg(col_(c)) for c in top}
    spread = S.one_row(df, {c: F.when(mean[c] != 0, F.stddev_samp(col_(c)) / F.abs(mean[c])).otherwise(0.0) for c in top})
    return max(top, key=lambda c: (spread[c] is not None, spread[c] or 0.0, -top.index(c)))


# --------------------------------------------------------------------------- #
# A1 / A4 column summary
# --------------------------------------------------------------------------- #
def _kind(dt: T.DataType) -> str:
    if S.is_numeric(dt):
        return "numeric"
    if S.is_datetime(dt):
        return "datetime"
    return "categorical"


def _missing(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    miss = col_(c).isNull()
    if S.is_floating(dt):
        miss = miss | F.isnan(col_(c))
    return F.sum(miss.cast("long"))


def _present(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    if S.is_floating(dt):
        return F.when(~F.isnan(col_(c)), col_(c))
    return col_(c)


def basic_stats(df: DataFrame, approx_distinct: bool = False) -> dict:
    """Column statistics shared by the column summary, describe, histogram and
    quantile steps, so a profile reads the table twice for all of them:

    1. plain aggregates on the input as it is (their last bits then do not
       depend on the core count): missing counts; count, mean, sample std,
       min, max for numbers; min / max (as text) for datetimes;
    2. distinct counts (exact, or HyperLogLog estimates on request).
       Kept apart because Spark expands every row once per distinct aggregate,
       and plain aggregates in the same step would be expanded with them.
    """
    exprs = {("", "rows"): F.count(F.lit(1))}
    for c in df.columns:
        dt = df.schema[c].dataType
        exprs[(c, "missing")] = _missing(df, c)
        if S.is_datetime(dt):
            exprs[(c, "min_text")] = F.min(col_(c)).cast("string")
            exprs[(c, "max_text")] = F.max(col_(c)).cast("string")
        elif S.is_numeric(dt):
            v = _present(df, c).cast("double")
            exprs[(c, "n")] = F.count(v)
            exprs[(c, "mean")] = F.avg(v)
            exprs[(c, "std")] = F.stddev_samp(v)
            exprs[(c, "min")] = F.min(v)
            exprs[(c, "max")] = F.max(v)
    out = S.one_row(df, exprs)
    if approx_distinct:
        out.update(S.one_row(df, {(c, "unique"): F.approx_count_distinct(_present(df, c)) for c in df.columns}))
    else:
        out.update({(c, "unique"): n for c, n in exact_distinct(df, df.columns).items()})
    return out


def exact_distinct(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """Exact distinct values of each column.

    Two 64-bit hashes stand for a value, so long texts are not moved; equal ones of one
    column are combined before the shuffle, and no column is one task's work.
    """
    if not cols:
        return {}
    pairs = F.array(*[F.when(_present(df, c).isNotNull(), F.struct(
        F.lit(i).alias("c"), F.xxhash64(_present(df, c)).alias("h"), F.xxhash64(_present(df, c), F.lit(1)).alias("g")))
        for i, c in enumerate(cols)])
    seen = df.select(F.explode(pairs).alias("p")).where(F.col("p").isNotNull()).select("p.*").distinct()
    n = {r["c"]: r["n"] for r in seen.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: n.get(i, 0) for i, c in enumerate(cols)}


def column_summary(df: DataFrame, approx_distinct: bool = False, stats: dict | None = None) -> DataFrame:
    """Per column: position, dtype, kind, missing, n_unique, min/max text for datetimes."""
    st = stats or basic_stats(df, approx_distinct)
    rows = [(i, c, df.schema[c].dataType.simpleString(), _kind(df.schema[c].dataType),
             int(st[(c, "missing")] or 0), int(st[(c, "unique")] or 0),
             st.get((c, "min_text")), st.get((c, "max_text"))) for i, c in enumerate(df.columns)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, dtype string, kind string, missing bigint, "
              "n_unique bigint, min_value string, max_value string")


# --------------------------------------------------------------------------- #
# A2 numeric describe
# --------------------------------------------------------------------------- #
def numeric_describe(df: DataFrame, cols: list[str] | None = None, stats: dict | None = None) -> DataFrame:
    """count, mean, sample std, min, q25, median, q75, max per numeric column (exact quantiles)."""
    cols = cols if cols is not None else S.numeric_columns(df)
    df = df.select(*[col_(c) for c in cols])
    st = stats or basic_stats(df, approx_distinct=True)
    pre = {c: {"n": st[(c, "n")], "min": st[(c, "min")], "max": st[(c, "max")]} for c in cols}
    qs = S.exact_quantiles(df, cols, [0.25, 0.5, 0.75], stats=pre)
    rows = []
    for i, c in enumerate(cols):
        q = qs.get(c, [None, None, None])
        rows.append((i, c, int(st[(c, "n")]), st[(c, "mean")], st[(c, "std")], st[(c, "min")],
                     *[float(x) if x is not None else None for x in q], st[(c, "max")]))
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, n bigint, mean double, std double, min double, "
              "q25 double, median double, q75 double, max double")


# --------------------------------------------------------------------------- #
# A3 histogram
# --------------------------------------------------------------------------- #
def histogram(df: DataFrame, cols: list[str] | None = None, stats: dict | None = None) -> DataFrame:
    """Equal-width histogram per numeric column, every bin listed (zeros too).

    bins = min(20, max(5, distinct)); the last bin is closed; a constant column
    spans value +- 0.5. One stats aggregation, then one grouped count over
    (column, bin) with map-side combine.
    """
    cols = cols if cols is not None else S.numeric_columns(df)
    spark = df.sparkSession
    schema = "column_name string, bin int, lo double, hi double, cnt bigint"
    if not cols:
        return spark.createDataFrame([], schema)
    df = df.select(*[col_(c) for c in cols])
    st = stats or _hist_stats(df, cols)
    spec_rows = []
    for c in cols:
        lo, hi, nd = st[(c, "min")], st[(c, "max")], st[(c, "unique")] or 0
        if lo is None:
            continue
        bins = min(K.HIST_MAX_BINS, max(K.HIST_MIN_BINS, int(nd)))
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        spec_rows.append((c, float(lo), float(hi), bins))
    if not spec_rows:
        return spark.createDataFrame([], schema)
    # bin edges are literals: values below each inner edge are counted, neighbours subtracted
    edges = {c: [first + i * (last - first) / bins for i in range(bins)] + [last] for c, first, last, bins in spec_rows}
    counts: dict = {}
    for k in range(0, len(spec_rows), HIST_COLUMNS_PER_JOB):
        part = spec_rows[k:k + HIST_COLUMNS_PER_JOB]
        below = {}
        for c, _, _, bins in part:
            v = _present(df, c).cast("double")
            below |= {(c, i): F.count(F.when(v < F.lit(edges[c][i]), 1)) for i in range(1, bins)}
            below[(c, bins)] = F.count(v)
        counts |= S.one_row(df, below)
    rows = [(c, i, edges[c][i], edges[c][i + 1], int(counts[(c, i + 1)] - counts.get((c, i), 0)))
            for c, _, _, bins in spec_rows for i in range(bins)]
    return spark.createDataFrame(rows, schema)


# Columns counted by one job: the aggregate buffer holds at most 20 numbers a column.
HIST_COLUMNS_PER_JOB = 25


def _hist_stats(df: DataFrame, cols: list[str]) -> dict:
    """Stats with an estimated distinct count, made exact where it decides the
    bin count (estimate <= 40: small sets, no row expansion)."""
    st = basic_stats(df, approx_distinct=True)
    low = [c for c in cols if (st[(c, "unique")] or 0) <= 2 * K.HIST_MAX_BINS]
    if low:
        st.update({(c, "unique"): v for (c, _), v in
                   S.one_row(df, {(c, "unique"): F.size(F.collect_set(_present(df, c))) for c in low}).items()})
    return st


# --------------------------------------------------------------------------- #
# A5 top categories
# --------------------------------------------------------------------------- #
def top_categories(df: DataFrame, cols: list[str] | None = None, k: int = K.MAX_CATEGORY_LEVELS) -> DataFrame:
    """The k most frequent values (as text) of each categorical column; ties by value."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if _kind(f.dataType) == "categorical"]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, value string, cnt bigint, rank int")
    vc = S.value_counts(df, cols)
    return S.top_k_per_group(vc, ["column_name"], [F.col("cnt").desc(), F.col("value").asc()], k) \
        .select("column_name", "value", "cnt", F.col("rank").cast("int"))


# --------------------------------------------------------------------------- #
# A12 column stats snapshot
# --------------------------------------------------------------------------- #
def column_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """mean, sample std, min, max, nulls, rows per numeric column (drift snapshot)."""
    cols = cols if cols is not None else S.numeric_columns(df)
    exprs = {("", "rows"): F.count(F.lit(1))}
    for c in cols:
        v = _present(df, c).cast("double")
        exprs[(c, "mean")] = F.avg(v)
        exprs[(c, "std")] = F.stddev_samp(v)
        exprs[(c, "min")] = F.min(v)
        exprs[(c, "max")] = F.max(v)
        exprs[(c, "nulls")] = _missing(df, c)
    st = S.one_row(df, exprs)
    rows = [(c, st[(c, "mean")], st[(c, "std")], st[(c, "min")], st[(c, "max")],
             int(st[(c, "nulls")] or 0), int(st[("", "rows")])) for c in cols]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, mean double, std double, min double, max double, nulls bigint, rows bigint")


# --------------------------------------------------------------------------- #
# A6-A9 correlations
# --------------------------------------------------------------------------- #
def encode_target_for_corr(df: DataFrame, target: str | None, label_map: DataFrame | None) -> DataFrame:
    """Replace a non-numeric target by its label code (text sort order)."""
    if target is None or target not in df.columns or S.is_numeric(df.schema[target].dataType):
        return df
    from .features import apply_label_mapping, label_mapping
    return apply_label_mapping(df, target, label_mapping(df, target) if label_map is None else label_map)


_CORR_EXPRS_PER_JOB = 600


def _pair_corr(df: DataFrame, pairs: list[tuple[str, str]]) -> dict:
    """Pearson r for each pair over rows where both values are present.

    One aggregation of plain sums (count, sum, sum of squares, sum of products)
    instead of one correlation aggregate per pair: sums compile to far smaller
    generated code. Values are shifted by an in-range value per column (taken
    from one row) so the sums do not lose precision to a large mean. Pairs are
    masked to rows where both values exist only for columns that have gaps.
    """
    if not pairs:
        return {}
    cols = sorted({c for p in pairs for c in p})
    if len(pairs) > _CORR_EXPRS_PER_JOB:  # more sums than one aggregation should hold: matrices of sums, one scan
        return _of_matrix(df, cols, pairs)
    x = {c: F.when(~F.isnan(col_(c).cast("double")), col_(c).cast("double")) for c in cols}
    first = S.one_row(df, {"__n__": F.count(F.lit(1)), **{c: F.count(x[c]) for c in cols},
                           **{("f", c): F.first(x[c], ignorenulls=True) for c in cols}})
    counts = {c: first[c] for c in cols}
    n_all = first["__n__"]
    shift = {c: float(first[("f", c)]) if first[("f", c)] is not None else 0.0 for c in cols}
    z = {c: x[c] - F.lit(shift[c]) for c in cols}
    full = {c: counts[c] == n_all for c in cols}
    exprs = {}
    for c in cols:
        if full[c]:
            exprs[("s", c)] = F.sum(z[c])
            exprs[("q", c)] = F.sum(z[c] * z[c])
    for a, b in pairs:
        exprs[("p", a, b)] = F.sum(z[a] * z[b])
        if not (full[a] and full[b]):
            both = z[a].isNotNull() & z[b].isNotNull()
            exprs[("n", a, b)] = F.count(F.when(both, F.lit(1)))
            exprs[("sa", a, b)] = F.sum(F.when(both, z[a]))
            exprs[("sb", a, b)] = F.sum(F.when(both, z[b]))
            exprs[("qa", a, b)] = F.sum(F.when(both, z[a] * z[a]))
            exprs[("qb", a, b)] = F.sum(F.when(both, z[b] * z[b]))
    if len(exprs) > _CORR_EXPRS_PER_JOB:
        return _of_matrix(df, cols, pairs)
    st = S.one_row(df, exprs) if n_all else {}
    out = {}
    for a, b in pairs:
        if not n_all:
            out[(a, b)] = 0.0
            continue
        if full[a] and full[b]:
            n, sa, sb, qa, qb = n_all, st[("s", a)], st[("s", b)], st[("q", a)], st[("q", b)]
        else:
            n, sa, sb, qa, qb = (st[("n", a, b)], st[("sa", a, b)], st[("sb", a, b)],
                                 st[("qa", a, b)], st[("qb", a, b)])
        sp = st[("p", a, b)]
        if not n or n < 2 or sp is None:
            out[(a, b)] = 0.0
            continue
        cov = sp - sa * sb / n
        va, vb = qa - sa * sa / n, qb - sb * sb / n
        out[(a, b)] = float(cov / (va * vb) ** 0.5) if va > 0 and vb > 0 else 0.0
        out[(a, b)] = max(-1.0, min(1.0, out[(a, b)]))
    return out


def _of_matrix(df: DataFrame, cols: list[str], pairs: list[tuple[str, str]]) -> dict:
    r = correlations(df, cols)
    at = {c: k for k, c in enumerate(cols)}
    return {(a, b): float(r[at[a], at[b]]) for a, b in pairs}


def correlation_pairs(df: DataFrame, target: str | None = None, label_map: DataFrame | None = None):
    """(numeric columns, r for every pair i <= j) in one computation, shared by
    the matrix, the interesting pairs and the target correlations."""
    d = encode_target_for_corr(df, target, label_map)
    num = S.numeric_columns(d)
    if len(num) < 2:
        return num, {}
    return num, _pair_corr(d, [(a, b) for i, a in enumerate(num) for b in num[i:]])


def correlation_matrix(df: DataFrame, target: str | None = None, label_map: DataFrame | None = None,
                       pre=None) -> DataFrame:
    """Pearson matrix (long form) over at most 15 numeric columns, target last.

    Pairwise-complete rows, undefined -> 0, rounded to 4 places.
    """
    spark = df.sparkSession
    schema = "i int, j int, col_a string, col_b string, r double"
    if pre is None:
        d = encode_target_for_corr(df, target, label_map)
        num = S.numeric_columns(d)
    else:
        num = pre[0]
    if len(num) < 2:
        return spark.createDataFrame([], schema)
    if target in num:
        cols = [c for c in num if c != target][: K.MAX_CORR_COLS - 1] + [target]
    else:
        cols = num[: K.MAX_CORR_COLS]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    r = pre[1] if pre is not None else _pair_corr(d, pairs)
    if pre is not None:  # precomputed pairs follow the full column order
        pos = {c: k for k, c in enumerate(num)}
        r = {(a, b): (r[(a, b)] if pos[a] <= pos[b] else r[(b, a)]) for a, b in pairs}
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = r[(a, b)] if i <= j else r[(b, a)]
            rows.append((i, j, a, b, round(v, 4)))
    return spark.createDataFrame(rows, schema)


def _all_pairs(df: DataFrame, target: str | None, label_map: DataFrame | None):
    d = encode_target_for_corr(df, target, label_map)
    num = S.numeric_columns(d)
    if len(num) < 2:
        return num, {}
    pairs = [(a, b) for i, a in enumerate(num) for b in num[i + 1:]]
    return num, _pair_corr(d, pairs)


def top_correlations(df: DataFrame, target: str | None = None, label_map: DataFrame | None = None,
                     pre=None) -> DataFrame:
    """Upper-triangle pairs with |r| >= 0.3, strongest six, with a sentence."""
    spark = df.sparkSession
    schema = ("rank int, col_a string, col_b string, r double, strength string, direction string, text string")
    num, r = pre if pre is not None else _all_pairs(df, target, label_map)
    rows = []
    order = 0
    for i, a in enumerate(num):
        for b in num[i + 1:]:
            v = r[(a, b)]
            if abs(v) >= K.CORR_PAIR_MIN_ABS:
                rows.append((order, a, b, v))
            order += 1
    if not rows:
        return spark.createDataFrame([], schema)
    base = spark.createDataFrame(rows, "pair int, col_a string, col_b string, r_raw double")
    rr = F.col("r_raw")
    direction = F.when(rr > 0, "positively").otherwise("negatively")
    ranked = S.top_k_per_group(base.withColumn("_g", F.lit(0)), ["_g"],
                               [F.abs(F.round(rr, 3)).desc(), F.col("pair").asc()], K.CORR_PAIR_TOP)
    return ranked.select(
        F.col("rank").cast("int"), "col_a", "col_b", F.round(rr, 3).alias("r"), strength(rr).alias("strength"),
        direction.alias("direction"),
        F.format_string(K.PAIR_SENTENCE, "col_a", "col_b",
                        strength(rr), direction, rr).alias("text"))


def target_correlations(df: DataFrame, target: str, label_map: DataFrame | None = None, pre=None) -> DataFrame:
    """Columns correlated with the target at |r| >= 0.1, strongest five."""
    spark = df.sparkSession
    schema = "rank int, feature string, r double, text string"
    if pre is None:  # only the target's pairs: as many as there are columns
        d = encode_target_for_corr(df, target, label_map)
        num = S.numeric_columns(d)
        r = _pair_corr(d, [(c, target) for c in num if c != target]) if target in num else {}
    else:
        num, r = pre
    if target not in num:
        return spark.createDataFrame([], schema)
    rows = []
    for pos, c in enumerate(num):
        if c == target:
            continue
        v = r[(c, target)] if (c, target) in r else r[(target, c)]
        if abs(v) >= K.CORR_TARGET_MIN_ABS:
            rows.append((pos, c, v))
    if not rows:
        return spark.createDataFrame([], schema)
    base = spark.createDataFrame(rows, "pos int, feature string, r_raw double").withColumn("_g", F.lit(0))
    rr = F.col("r_raw")
    ranked = S.top_k_per_group(base, ["_g"], [F.abs(rr).desc(), F.col("pos").asc()], K.CORR_TARGET_TOP)
    return ranked.select(
        F.col("rank").cast("int"), "feature", F.round(rr, 3).alias("r"),
        F.format_string(K.TARGET_SENTENCE, F.col("feature"), F.lit(target),
                        F.when(rr > 0, "increase").otherwise("decrease"), rr).alias("text"))
