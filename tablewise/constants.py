"""Behaviour constants.

Fixed values: these must equal the values the original pipeline uses, so
results line up. They are stated here plainly and in one place.
"""
from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Dataset file suffixes accepted from an inbox.
SUPPORTED_EXTENSIONS = (".csv", ".json", ".parquet")

# Column names (matched case-insensitively, in this priority) that name the target.
TARGET_NAME_CANDIDATES = ("target", "label", "y", "class", "outcome", "result")

# A numeric target with at most this many distinct whole values is a class label.
MAX_CLASSIFICATION_CLASSES = 20

# Up to this many classes are listed by name in the documents of a run and have a booster each; more
# are kept as a table of labels and are told apart by one booster for each bit of their code.
MAX_LISTED_CLASSES = 100

# Categorical features with at most this many levels are one-hot encoded,
# otherwise frequency encoded.
MAX_ONEHOT_CARDINALITY = 20

# Columns whose null share is strictly above this are dropped.
MAX_MISSING_FRACTION = 0.6

# Share of non-null values that must parse before a text column is converted.
COERCE_MIN_PARSE_SHARE = 0.95

# Holdout share and seed of the split.
TEST_SIZE = 0.2
RANDOM_STATE = 42

# Below this many rows the model trains and scores on every row.
MIN_ROWS_FOR_HOLDOUT = 10

# Trimmed, lower-cased text equal to one of these is a missing value.
NULL_TOKENS = ("", "nan", "none", "null", "na", "n/a", "?", "-")

# A text column is a datetime candidate only if a value holds one of these.
DATE_HINT_CHARS = ("-", "/", ":")

# Gradient-boosted model settings.
GBT_TREES = 300
GBT_MAX_DEPTH = 6
GBT_LEARNING_RATE = 0.1
GBT_ROW_SUBSAMPLE = 0.9
GBT_FEATURE_SUBSAMPLE = 0.9

# Report sizes.
MAX_TOP_FEATURES = 25
MAX_CATEGORY_LEVELS = 12
MAX_CORR_COLS = 15
PREVIEW_ROWS = 50
MAX_WHATIF_FEATURES = 12
RECENT_TAIL_ROWS = 60

# Histogram bin count is min(HIST_MAX_BINS, max(HIST_MIN_BINS, distinct values)).
HIST_MIN_BINS = 5
HIST_MAX_BINS = 20

# Correlation reporting.
CORR_PAIR_MIN_ABS = 0.3
CORR_PAIR_TOP = 6
CORR_TARGET_MIN_ABS = 0.1
CORR_TARGET_TOP = 5
STRENGTH_STRONG = 0.7
STRENGTH_MODERATE = 0.4

# Metric-column detection: name hints, and id-like names that are skipped.
METRIC_HINTS = (
    "sales", "revenue", "amount", "price", "total", "profit", "cost", "gmv",
    "spend", "qty", "quantity", "count", "volume", "value", "income", "units",
)
ID_HINTS = ("id", "index", "code", "zip", "postal", "phone", "year", "month", "day")

# Trend label: slope relative to the mean level.
TREND_REL_THRESHOLD = 0.01

# Quality verdict and grade thresholds.
MIN_ACCURACY = 0.5
MIN_R2 = 0.0
GRADE_GOOD = 0.8
GRADE_FAIR = 0.5

# Rolling window over the holdout: max(ROLLING_MIN_WINDOW, n // ROLLING_DIVISOR).
ROLLING_MIN_WINDOW = 5
ROLLING_DIVISOR = 10

# Residual anomaly band in population standard deviations.
ANOMALY_SIGMAS = 2.0

# Forecast: minimum rows, default horizon, band width in RMSE, spike threshold (%).
FORECAST_MIN_ROWS = 5
FORECAST_HORIZON = 6
FORECAST_BAND_RMSE = 1.5
FORECAST_SPIKE_PCT = 10.0

# Low-confidence cut for classification predictions.
LOW_CONFIDENCE = 0.5

# Drift: mean shift in previous standard deviations that counts as drift.
DRIFT_WARN_THRESHOLD = 2.0

# Run history kept, and recent runs shown.
MAX_HISTORY = 50
RECENT_RUNS = 10

# MAPE ignores targets whose absolute value is below this.
MAPE_EPS = 1e-9

# Pipeline stage names, in run order.
STAGES = ("ingestor", "cleaner", "feature_eng", "trainer", "evaluator", "deployer", "dashboard_gen")

# Outputs a run is expected to leave behind.
EXPECTED_ARTIFACTS = (
    "raw.parquet", "ingest_meta.json", "cleaned.parquet", "clean_report.json",
    "features.parquet", "feature_meta.json", "model", "train_meta.json",
    "metrics.json", "predictions.parquet", "deployment.json",
    "dashboard_data.json", "manifest.json",
)
# Text read as missing when a CSV is loaded (the pandas reader's default list).
CSV_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters stripped from both ends of text: all Unicode white space and the four separators.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
               "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# Month names in dates: the first three letters, and all accepted spellings.
MONTH_LETTERS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH_NAMES = ("jan", "january", "feb", "february", "mar", "march", "apr", "april", "may", "jun", "june", "jul", "july",
               "aug", "august", "sep", "sept", "september", "oct", "october", "nov", "november", "dec", "december")

# Sentences about correlations.
PAIR_SENTENCE = "`%s` and `%s` are %sly %s correlated (r = %+.2f)."
TARGET_SENTENCE = "As `%s` rises, `%s` tends to %s (r = %+.2f)."

# Why time-based KPIs are missing.
REASON_NO_DATE = "No datetime column detected — time-based KPIs need a date field."
REASON_NO_ROWS = "No usable date/metric rows."
REASON_ONE_MONTH = "Data spans less than two months — not enough for trends."

# Column-name prefix (lower case) of index columns left by spreadsheet exports.
UNNAMED_PREFIX = "unnamed:"
# --- end of fixed values ----------------------------------------------------
