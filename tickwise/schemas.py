"""Declared schemas and the fixed values results depend on.

Everything in the "fixed values" block must stay equal to the behaviour
being matched (column names, thresholds, bands, model settings); change
them only together with the tests that pin them.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, LongType, StringType,
                               StructField, StructType)

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Source column names and their snake-case names.
SOURCE_RENAMES = {"Date": "date", "Open": "open", "High": "high", "Low": "low",
                  "Close": "close", "Adj Close": "adj_close", "Volume": "volume"}

# Columns whose NULL/NaN drops a row in cleaning.
CRITICAL_COLUMNS = ["date", "open", "high", "low", "close", "volume"]

# The five model features, in vector order.
FEATURE_COLUMNS = ["daily_return", "moving_avg_7", "moving_avg_30",
                   "volatility_7", "momentum"]

# Columns a feature table must have (also the typed output order).
EXPECTED_FEATURE_TABLE_COLUMNS = [
    "ticker", "date", "open", "high", "low", "close", "volume",
    "daily_return", "moving_avg_7", "moving_avg_30", "volatility_7",
    "momentum", "feature_timestamp"]

LABEL_COLUMN = "next_day_up"

# Rolling frames count rows (trading days), not calendar days.
SHORT_WINDOW_ROWS = 7
LONG_WINDOW_ROWS = 30
MOMENTUM_LAG_INTRADAY = 7        # momentum = close / close 7 rows back
MOMENTUM_LAG_CLOSE_TO_CLOSE = 10  # momentum = (close - close 10 back) / that

# Null-rate bands (percent, strict ">"): fail above 5, warn above 1.
NULL_FAIL_PCT = 5.0
NULL_WARN_PCT = 1.0

# Completeness bands (percent, ">="): good at 95, fair at 80, else poor.
COMPLETENESS_GOOD_PCT = 95.0
COMPLETENESS_FAIR_PCT = 80.0

# Outlier thresholds per feature: (extreme, moderate). daily_return is
# two-sided (|x| > t); the others are upper-bound only (x > t).
OUTLIER_THRESHOLDS = {
    "daily_return": (0.2, 0.1),
    "volatility_7": (0.5, 0.3),
    "momentum": (2.0, 1.5),
}
TWO_SIDED_OUTLIER_FEATURES = ("daily_return",)
# Verdict: share of extreme daily_return outliers must stay below 1 percent.
OUTLIER_VERDICT_MAX_PCT = 1.0
# Rows in the sample of largest outliers.
OUTLIER_SAMPLE_ROWS = 10

# Time split: share of the calendar span that goes to training.
TRAIN_FRACTION = 0.8
RANDOM_SEED = 42

# Random forest and gradient-boosted trees settings.
RF_PARAMS = {"numTrees": 15, "maxDepth": 4, "subsamplingRate": 0.7,
             "maxMemoryInMB": 200}
GBT_PARAMS = {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1,
              "subsamplingRate": 0.8, "maxMemoryInMB": 256}
# Tuning grids.
RF_GRID = {"numTrees": [8, 12, 15], "maxDepth": [3, 4, 5],
           "subsamplingRate": [0.6, 0.7, 0.8]}
GBT_GRID = {"maxIter": [5, 8, 10], "maxDepth": [2, 3, 4],
            "stepSize": [0.1, 0.15, 0.2], "subsamplingRate": [0.6, 0.7, 0.8]}
CV_FOLDS = 3

# Model quality bands: AUC >= 0.8 excellent, >= 0.7 good, >= 0.6 moderate,
# else poor; train/test AUC gap <= 0.05 low, <= 0.1 moderate, else high.
AUC_BANDS = [(0.8, "excellent"), (0.7, "good"), (0.6, "moderate")]
AUC_BAND_ELSE = "poor"
GAP_BANDS = [(0.05, "low"), (0.1, "moderate")]
GAP_BAND_ELSE = "high"

# Length of a download window when only its end is given.
DEFAULT_LOOKBACK_DAYS = 365

# --- Declared schemas (fixed: names, types and nullability) ---

PRICE_SCHEMA = StructType([
    StructField("ticker", StringType(), False),
    StructField("date", DateType(), False),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("adj_close", DoubleType(), True),
    StructField("volume", LongType(), True),
    StructField("ingestion_timestamp", DateType(), False),
])

FEATURE_SCHEMA = StructType([
    StructField("ticker", StringType(), False),
    StructField("date", DateType(), False),
    *[StructField(c, DoubleType(), True) for c in
      ["open", "high", "low", "close", "volume"] + FEATURE_COLUMNS],
    StructField("feature_timestamp", DateType(), False),
])

# ---------------------------------------------------------------------------
# Landing zone
# ---------------------------------------------------------------------------

# File layout of the landing zone (source column names). Batch and stream read
# with it, so a file that lacks a column gives NULL there and never changes the
# type or the presence of a column for the others.
LANDING_SCHEMA = StructType([
    StructField("ticker", StringType()),
    StructField("Date", DateType()),
    StructField("Open", DoubleType()),
    StructField("High", DoubleType()),
    StructField("Low", DoubleType()),
    StructField("Close", DoubleType()),
    StructField("Adj Close", DoubleType()),
    StructField("Volume", LongType()),
])

# The same for text formats: every column as text, parsed by
# ``sources.prices.normalize_source`` (so ``1000.0`` is a volume).
LANDING_TEXT_SCHEMA = StructType([StructField(f.name, StringType()) for f in LANDING_SCHEMA.fields])
