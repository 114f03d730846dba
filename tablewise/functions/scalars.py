"""Scalar column expressions (JVM-side, codegen friendly)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

# Text that reads as a decimal or scientific number, with optional sign.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER_PATTERN = r"^[+-]?\d+$"
# Infinity spellings accepted as numbers.
INF_PATTERN = r"^[+-]?(inf|infinity)$"

# Date / time layouts tried in order when text is coerced to a timestamp
# (explicit list; time-only text is not accepted). Each layout is guarded by a
# pattern of its shape, so a value costs at most one parse attempt and text
# that looks like no date costs none.
DATETIME_LAYOUTS = (
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{6}$", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}$", "yyyy-MM-dd HH:mm:ss.SSS"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}$", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$", "yyyy-MM-dd HH:mm"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
)


def col_(name: str) -> Column:
    """Column by exact name; back-quoted so dots and spaces are literal."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    """Text without white space (any Unicode white space) at either end."""
    return F.btrim(c, F.lit(K.WHITE_SPACE))


def null_token(c: Column) -> Column:
    """Strip text; stripped values equal (any case) to a null token become NULL."""
    t = strip(c)
    return F.when(F.lower(t).isin(*K.NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


# First characters a number or infinity spelling can start with, and the length
# range of the datetime layouts above: cheap checks that spare free text the
# regular expressions.
NUMBER_FIRST_CHARS = ("0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "+", "-", ".", "i", "I")
DATETIME_MIN_LENGTH = 8
DATETIME_MAX_LENGTH = 26


def parses_as_number(c: Column) -> Column:
    """True where text (already trimmed) is a plain or scientific number or +-inf."""
    t = strip(c)
    return F.substring(t, 1, 1).isin(*NUMBER_FIRST_CHARS) & (t.rlike(NUMBER_PATTERN) | F.lower(t).rlike(INF_PATTERN))


def to_number(c: Column) -> Column:
    """Text to double, NULL where it does not parse."""
    t = strip(c)
    return F.when(parses_as_number(t), t.try_cast("double"))


def parse_datetime(c: Column) -> Column:
    """Text to timestamp (no zone) by the first layout that parses, else NULL.

    Text with a zone or offset becomes UTC. Fractions keep six digits.
    """
    t = strip(c)
    out = None
    for pattern, fmt in DATETIME_LAYOUTS:
        # ISO shapes (year first, dashes): a plain cast parses exactly these and
        # rejects the same invalid dates, at a fraction of a formatted parse's cost
        parsed = t.try_cast("timestamp_ntz") if fmt.startswith("yyyy-") else F.try_to_timestamp(t, F.lit(fmt))
        out = F.when(t.rlike(pattern), parsed) if out is None else out.when(t.rlike(pattern), parsed)
    # every layout starts with a digit and has its first separator as the 2nd, 3rd or 5th character
    sep = F.lit("-"), F.lit("/")
    shaped = (F.length(t).between(DATETIME_MIN_LENGTH, DATETIME_MAX_LENGTH) & F.substring(t, 1, 1).between("0", "9")
              & (F.substring(t, 5, 1).isin(*sep) | F.substring(t, 2, 1).isin(*sep) | F.substring(t, 3, 1).isin(*sep)))
    return F.coalesce(F.when(shaped, out).cast(T.TimestampNTZType()), _other_datetime(t))


# Further shapes: a date (ISO, month first, or with a month's name) and an optional time
# with a fraction, AM / PM, and a zone.
_DATE = r"^(\d{4}|\d{2})-(\d{1,2})-(\d{1,2})"
_CLOCK = (r"(?:[T ]\s*(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*(?:([AaPp])\.?[Mm]\.?)?"
          r"\s*([Zz]|UTC|GMT|[+-]\d{2}:?\d{2})?)?$")
# what each date becomes: year-month-day, the month's name still to be replaced
_TO_YMD = (
    (r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4}|\d{2})(?!\d)", "$3-$1-$2"),
    (r"^(\d{1,2})[ -]([A-Za-z]{3,9})\.?,?[ -](\d{4}|\d{2})(?!\d)", "$3-$2-$1"),
    (r"^([A-Za-z]{3,9})\.? (\d{1,2}),? (\d{4}|\d{2})(?!\d)", "$3-$1-$2"),
)
_NAMED = r"^(?:\d{4}|\d{2})-([A-Za-z]+)-"
OTHER_DATETIME_LENGTH = (6, 45)


def _with(value: Column, use) -> Column:
    """``use(value)``, the value being computed once."""
    return F.transform(F.array(value), use)[0]


def _other_datetime(t: Column) -> Column:
    """Layouts outside the list: offsets, long fractions, AM / PM, two-digit years, month names."""
    def numbered(u: Column) -> Column:
        name = F.lower(F.regexp_extract(u, _NAMED, 1))
        at = F.instr(F.lit(K.MONTH_LETTERS), F.substring(name, 1, 3))
        number = F.concat(F.lit("-"), ((at + 2) / 3).cast("int").cast("string"), F.lit("-"))
        return (F.when(name == "", u)
                .when(name.isin(*K.MONTH_NAMES), F.regexp_replace(u, F.lit("-[A-Za-z]+-"), number)))

    def moment(u: Column) -> Column:
        names = ("y", "m", "d", "hour", "minute", "second", "fraction", "half", "zone")
        parts = F.struct(*[F.regexp_extract(u, _DATE + _CLOCK, k + 1).alias(n) for k, n in enumerate(names)])
        return F.when(u.rlike(_DATE + _CLOCK), _with(parts, assembled))

    def assembled(g: Column) -> Column:
        # two digits: 69 to 99 are the last century
        year = F.when(F.length(g["y"]) == 4, g["y"]).otherwise(
            F.concat(F.when(g["y"].cast("int") >= 69, "19").otherwise("20"), g["y"]))
        hour = g["hour"].cast("int")
        hour = (F.when(g["half"] == "", hour).when(~hour.between(1, 12), F.lit(None))
                .otherwise(hour % 12 + F.when(F.lower(g["half"]) == "p", 12).otherwise(0)))
        offset = F.when(g["zone"].rlike("^[A-Za-z]"), "Z").otherwise(
            F.regexp_replace(g["zone"], "^(.\\d\\d)(\\d\\d)$", "$1:$2"))
        day = F.concat_ws("-", year, F.lpad(g["m"], 2, "0"), F.lpad(g["d"], 2, "0"))
        clock = F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), g["minute"], F.lit(":"),
                         F.rpad(g["second"], 2, "0"), F.lit("."), F.rpad(F.left(g["fraction"], F.lit(6)), 6, "0"))
        text = F.when(g["hour"] == "", day).otherwise(F.concat(day, F.lit(" "), clock))
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                                 F.concat(text, offset).try_cast("timestamp").cast("timestamp_ntz"))
        return F.when((g["hour"] != "") & (g["zone"] != ""), utc).otherwise(text.try_cast("timestamp_ntz"))

    ymd = t
    for pattern, order in _TO_YMD:
        ymd = F.regexp_replace(ymd, pattern, order)
    # an ISO date with a time has two-digit months and days
    likely = (F.length(t).between(*OTHER_DATETIME_LENGTH)
              & t.rlike(r"^(?:\d{1,2}[-/ ]|\d{4}-\d{2}-\d{2}[T ]|[A-Za-z]{3,9}\.? \d)"))
    return F.when(likely, _with(_with(ymd, numbered), moment))


def has_date_hint(c: Column) -> Column:
    return F.coalesce(c.rlike("[-/:]"), F.lit(False))


def is_finite(c: Column) -> Column:
    """Not NULL, not NaN, not +-inf."""
    d = c.cast("double")
    return d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def pct_change(curr: Column, prev: Column) -> Column:
    """(curr / prev - 1) * 100 with a signed previous value; NULL when prev is 0 or NULL."""
    return F.when(prev.isNull() | (prev == 0) | curr.isNull(), F.lit(None).cast("double")) \
        .otherwise((curr / prev - F.lit(1.0)) * F.lit(100.0))


def safe_pct_abs(curr: Column, prev: Column) -> Column:
    """(curr - prev) / |prev| * 100; NULL when prev is 0 or NULL."""
    return F.when(prev.isNull() | (prev == 0) | curr.isNull(), F.lit(None).cast("double")) \
        .otherwise((curr - prev) / F.abs(prev) * F.lit(100.0))


def strength(r: Column) -> Column:
    a = F.abs(r)
    return F.when(a >= K.STRENGTH_STRONG, "strong").when(a >= K.STRENGTH_MODERATE, "moderate").otherwise("weak")


def grade(v: Column) -> Column:
    return F.when(v >= K.GRADE_GOOD, "Good").when(v >= K.GRADE_FAIR, "Fair").otherwise("Poor")


def format_kpi(v: Column) -> Column:
    """Compact number: 1.23M, 4.5K, or 2 decimals; em dash for NULL."""
    a = F.abs(v)
    return (F.when(v.isNull(), F.lit("—"))
            .when(a >= 1_000_000, F.concat(F.format_number(v / 1_000_000, 2), F.lit("M")))
            .when(a >= 1_000, F.concat(F.format_number(v / 1_000, 1), F.lit("K")))
            .otherwise(F.format_number(v, 2)))


def signed_pct(v: Column, decimals: int = 1) -> Column:
    """'+12.3%' style delta; NULL stays NULL."""
    return F.when(v.isNull(), F.lit(None).cast("string")) \
        .otherwise(F.concat(F.format_string(f"%+.{decimals}f", v), F.lit("%")))
