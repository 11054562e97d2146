"""Feature-table quality checks: schema, nulls, completeness, outliers,
per-ticker validation report and recompute checks.

Each check is one grouped aggregation over the feature table that computes
every column/feature at once; the per-column rows come from an unpivot of
that single aggregate row per ticker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.functions.exprs import band, pct_change, safe_div, ticker_window, trailing_rows
from tickwise.schemas import (COMPLETENESS_FAIR_PCT, COMPLETENESS_GOOD_PCT,
                              EXPECTED_FEATURE_TABLE_COLUMNS, FEATURE_COLUMNS,
                              FEATURE_SCHEMA, NULL_FAIL_PCT, NULL_WARN_PCT,
                              OUTLIER_SAMPLE_ROWS, OUTLIER_THRESHOLDS,
                              OUTLIER_VERDICT_MAX_PCT, TWO_SIDED_OUTLIER_FEATURES)


# --- schema -----------------------------------------------------------------

def column_diff(columns: list[str], expected: list[str] | None = None) -> dict:
    """Missing / extra column names (metadata only, no job)."""
    expected = expected or EXPECTED_FEATURE_TABLE_COLUMNS
    return {"missing": sorted(set(expected) - set(columns)),
            "extra": sorted(set(columns) - set(expected))}


def validate_columns(df: DataFrame, expected: list[str] | None = None) -> bool:
    """Required-columns gate: True when no expected column is missing."""
    return validate_columns_of(df.columns, expected)


def validate_columns_of(columns: list[str], expected: list[str] | None = None) -> bool:
    return not column_diff(columns, expected)["missing"]


def schema_check(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Per ticker: column count, missing and extra columns, pass flag."""
    d = column_diff(df.columns, expected)
    return (df.select("ticker").distinct()
              .withColumn("column_count", F.lit(len(df.columns)).cast("bigint"))
              .withColumn("missing_columns", F.lit(",".join(d["missing"])))
              .withColumn("extra_columns", F.lit(",".join(d["extra"])))
              .withColumn("columns_ok", F.lit(not d["missing"])))


# --- nulls and completeness ---------------------------------------------------

def null_report(df: DataFrame, fail_pct: float = NULL_FAIL_PCT, warn_pct: float = NULL_WARN_PCT) -> DataFrame:
    """Per ticker and column: null count, null percent and band
    (fail above ``fail_pct``, warn above ``warn_pct``, else ok). NaN is not NULL here."""
    cols = [c for c in df.columns if c != "ticker"]
    wide = df.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["ticker", "_total"], cols, "column_name", "null_count")
    pct = F.coalesce(safe_div(F.col("null_count") * 100.0, F.col("_total")), F.lit(0.0))
    return (long.withColumn("null_pct", pct)
                .withColumn("band", band(F.col("null_pct"),
                                         [(fail_pct, "fail"), (warn_pct, "warn")],
                                         "ok", inclusive=False))
                .select("ticker", "column_name", F.col("null_count").cast("bigint").alias("null_count"),
                        "null_pct", "band"))


def ticker_checks(df: DataFrame, completeness: float = 1 - NULL_FAIL_PCT / 100,
                  validity: float = 1 - OUTLIER_VERDICT_MAX_PCT / 100) -> DataFrame:
    """Null and outlier verdicts per ticker from ONE aggregation pass:
    rows, extreme daily_return outliers and their percent, outlier_ok,
    the columns whose null percent is above the fail band (comma list,
    sorted) and null_ok.

    ``completeness``: least share of a column's rows that are not null; ``validity``: the share of rows
    without an extreme return has to be above it."""
    cols = sorted(c for c in df.columns if c != "ticker")
    t = OUTLIER_THRESHOLDS["daily_return"][0]
    wide = df.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_outlier("daily_return", t)).alias("extreme_outliers"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in cols])
    return checks_of(wide, cols, lambda c: F.col(f"_n_{c}"), completeness, validity)


def checks_of(wide: DataFrame, cols: list[str], nulls: Callable[[str], Column], completeness: float = 1 - NULL_FAIL_PCT / 100,
              validity: float = 1 - OUTLIER_VERDICT_MAX_PCT / 100) -> DataFrame:
    """The verdicts from counts: ``rows``, ``extreme_outliers`` and the null count of each column."""
    def pct(c: Column) -> Column:
        return F.coalesce(safe_div(c * 100.0, F.col("rows")), F.lit(0.0))
    null_max, extreme_max = round(100 - 100 * completeness, 9), round(100 - 100 * validity, 9)
    high = F.array_compact(F.array(*[F.when(pct(nulls(c)) > null_max, F.lit(c)) for c in cols]))
    extreme = pct(F.col("extreme_outliers"))
    return wide.select(
        "ticker", "rows", "extreme_outliers", extreme.alias("outlier_pct"),
        (extreme < extreme_max).alias("outlier_ok"),
        F.array_join(high, ",").alias("high_null_columns"),
        (F.size(high) == 0).alias("null_ok"))


def completeness(df: DataFrame, features: list[str] | None = None, good_pct: float = COMPLETENESS_GOOD_PCT,
                 fair_pct: float = COMPLETENESS_FAIR_PCT) -> DataFrame:
    """Per ticker and feature: non-null percent, band good from ``good_pct`` on, fair from ``fair_pct`` on, else poor."""
    features = features or FEATURE_COLUMNS
    wide = df.groupBy("ticker").agg(F.count(F.lit(1)).alias("_total"),
                                    *[F.count(c).alias(c) for c in features])
    long = wide.unpivot(["ticker", "_total"], features, "feature", "non_null")
    pct = F.coalesce(safe_div(F.col("non_null") * 100.0, F.col("_total")), F.lit(0.0))
    return (long.withColumn("completeness_pct", pct)
                .withColumn("band", band(F.col("completeness_pct"),
                                         [(good_pct, "good"), (fair_pct, "fair")], "poor"))
                .select("ticker", "feature", F.col("non_null").cast("bigint").alias("non_null"),
                        "completeness_pct", "band"))


# --- outliers -------------------------------------------------------------------

def outlier_thresholds(variant: str = "close_to_close") -> dict[str, tuple[float, float]]:
    """Momentum bounds are ratios; for the close-to-close (return) momentum
    they are shifted by -1 so both variants flag the same price moves."""
    th = dict(OUTLIER_THRESHOLDS)
    if variant == "close_to_close":
        e, m = th["momentum"]
        th["momentum"] = (e - 1.0, m - 1.0)
    return th


def is_outlier(feature: str, threshold: float) -> Column:
    c = F.col(feature)
    if feature in TWO_SIDED_OUTLIER_FEATURES:
        return (c < -threshold) | (c > threshold)
    return c > threshold


def outlier_counts(df: DataFrame, variant: str = "close_to_close") -> DataFrame:
    """Per ticker and feature: extreme / moderate outlier count and percent.
    NULL values are never outliers but count in the denominator."""
    th = outlier_thresholds(variant)
    aggs = [F.count(F.lit(1)).alias("_total")]
    for f, (ext, mod) in th.items():
        aggs += [F.count_if(is_outlier(f, ext)).alias(f"{f}__extreme"),
                 F.count_if(is_outlier(f, mod)).alias(f"{f}__moderate")]
    wide = df.groupBy("ticker").agg(*aggs)
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"{f}__extreme").alias("extreme_count"),
                     F.col(f"{f}__moderate").alias("moderate_count")) for f in th]
    long = wide.select("ticker", "_total", F.explode(F.array(*rows)).alias("_r")).select(
        "ticker", "_total", "_r.*")
    def pct(c):
        return F.coalesce(safe_div(F.col(c) * 100.0, F.col("_total")), F.lit(0.0))
    return long.select("ticker", "feature",
                       F.col("extreme_count").cast("bigint").alias("extreme_count"),
                       pct("extreme_count").alias("extreme_pct"),
                       F.col("moderate_count").cast("bigint").alias("moderate_count"),
                       pct("moderate_count").alias("moderate_pct"),
                       (pct("extreme_count") > OUTLIER_VERDICT_MAX_PCT).alias("high_rate"))


def return_outliers(df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Rows whose daily_return is beyond +-threshold (extreme by default)."""
    t = OUTLIER_THRESHOLDS["daily_return"][0] if threshold is None else threshold
    return df.filter(is_outlier("daily_return", t))


def outlier_verdict(df: DataFrame) -> DataFrame:
    """Per ticker: rows, extreme daily_return outliers, their percent and pass
    (percent below 1). A ticker with no rows passes instead of dividing by 0."""
    t = OUTLIER_THRESHOLDS["daily_return"][0]
    v = df.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"),
                                 F.count_if(is_outlier("daily_return", t)).alias("extreme_outliers"))
    pct = F.coalesce(safe_div(F.col("extreme_outliers") * 100.0, F.col("rows")), F.lit(0.0))
    return (v.withColumn("outlier_pct", pct)
             .withColumn("outlier_ok", F.col("outlier_pct") < OUTLIER_VERDICT_MAX_PCT))


def top_outliers(df: DataFrame, rows: int = OUTLIER_SAMPLE_ROWS) -> DataFrame:
    """Largest extreme daily_return rows of every ticker, at most ``rows`` each, beside
    ``n_extreme``, the ticker's number of extreme rows. A ticker's rows come in order of rank."""
    out = return_outliers(df).select("date", "ticker", "daily_return", "close")
    order = [F.col("daily_return").desc_nulls_last(), F.col("date").desc_nulls_last()]
    rank = Window.partitionBy("ticker").orderBy(*order)
    # ranked first, so each task keeps its best rows and sends no others; counted apart
    top = out.withColumn("_rn", F.row_number().over(rank)).filter(F.col("_rn") <= rows).drop("_rn")
    counts = out.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_extreme"))
    return top.join(counts, "ticker").sortWithinPartitions("ticker", *order)


# --- validation report ----------------------------------------------------------

def validation_report(df: DataFrame, tickers: DataFrame | None = None,
                      expected: list[str] | None = None, completeness: float = 1 - NULL_FAIL_PCT / 100,
                      validity: float = 1 - OUTLIER_VERDICT_MAX_PCT / 100) -> DataFrame:
    """Per ticker: exists, rows, columns, schema/null/outlier checks, passed.

    ``tickers``: optional one-column frame of requested tickers; requested
    tickers without rows get exists = false and fail. ``completeness`` and ``validity``: see ``ticker_checks``.
    """
    return report_of(ticker_checks(df, completeness, validity), df.columns, tickers, expected)


def report_of(rep: DataFrame, columns: list[str], tickers: DataFrame | None = None, expected: list[str] | None = None) -> DataFrame:
    """The report from ``ticker_checks`` and the table's columns."""
    cols_ok = validate_columns_of(columns, expected)
    if tickers is not None:
        rep = tickers.select("ticker").distinct().join(rep, "ticker", "left")
    exists = F.col("rows").isNotNull()
    return rep.select(
        "ticker", exists.alias("table_exists"),
        F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("row_count"),
        F.when(exists, F.lit(len(columns))).otherwise(0).cast("bigint").alias("column_count"),
        (exists & F.lit(cols_ok)).alias("columns_ok"),
        F.coalesce(F.col("null_ok"), F.lit(False)).alias("null_ok"),
        F.coalesce(F.col("outlier_ok"), F.lit(False)).alias("outlier_ok"),
        F.coalesce(F.col("extreme_outliers"), F.lit(0)).cast("bigint").alias("extreme_outliers"),
        F.coalesce(F.col("high_null_columns"), F.lit("")).alias("high_null_columns"),
        (exists & F.lit(cols_ok) & F.coalesce(F.col("null_ok"), F.lit(False))
         & F.coalesce(F.col("outlier_ok"), F.lit(False))).alias("passed"))


def validate_source(spark: SparkSession, table: DataFrame | None, tickers: DataFrame) -> DataFrame:
    """``validation_report`` of a guarded read (``prices.read_table(..., 'skip')``): a table that
    does not exist gives a failed row for every requested ticker."""
    return validation_report(spark.createDataFrame([], FEATURE_SCHEMA) if table is None else table, tickers)


def validation_summary(report: DataFrame) -> DataFrame:
    """One row over the report: tables validated/passed/failed, rows, average
    columns, outliers, all passed (tickers without rows count as failures)."""
    ex = F.col("table_exists")
    return report.agg(
        F.count_if(ex).alias("tables_validated"),
        F.count_if(ex & F.col("passed")).alias("tables_passed"),
        F.count_if(ex & ~F.col("passed")).alias("tables_failed"),
        F.coalesce(F.sum(F.when(ex, F.col("row_count"))), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(safe_div(F.sum(F.when(ex, F.col("column_count"))).cast("double"),
                            F.greatest(F.count_if(ex), F.lit(1)).cast("double")),
                   F.lit(0.0)).alias("avg_columns"),
        F.coalesce(F.sum(F.when(ex, F.col("extreme_outliers"))), F.lit(0)).cast("bigint").alias("total_outliers"),
        F.coalesce(F.bool_and(F.col("passed")), F.lit(True)).alias("all_passed"))


# --- recompute checks ---------------------------------------------------------

def _within_days_of_last(df: DataFrame, days: int) -> DataFrame:
    last = F.max("date").over(Window.partitionBy("ticker"))
    return (df.withColumn("_last", last)
              .filter(F.col("date") >= F.date_sub(F.col("_last"), days)).drop("_last"))


def _recent(df: DataFrame, days: int, newest: int) -> DataFrame:
    last = F.max("date").over(Window.partitionBy("ticker"))
    rn = F.row_number().over(Window.partitionBy("ticker").orderBy(F.col("date").desc_nulls_last()))
    return (df.withColumn("_last", last)
              .filter(F.col("date") >= F.date_sub(F.col("_last"), days))
              .withColumn("_rn", rn).filter(F.col("_rn") <= newest).drop("_rn", "_last"))


def verify_return(features: DataFrame, days: int = 7, newest: int = 5,
                  scope: str = "full") -> DataFrame:
    """Recompute close-to-close daily_return (rounded to 6) next to the stored
    value for the newest rows within ``days`` of each ticker's last date.

    scope='full' computes the lag over the whole series and then restricts;
    scope='filtered' restricts first (edge rows then see a truncated series).
    """
    df = features.select("ticker", "date", "close", "daily_return")
    if scope == "filtered":
        df = _within_days_of_last(df, days)
    prev = F.lag("close", 1).over(ticker_window())
    df = (df.withColumn("prev_close", prev)
            .withColumn("calculated_return", F.round(pct_change(F.col("close"), F.col("prev_close")), 6)))
    return _recent(df, days, newest)


def verify_ma7(features: DataFrame, days: int = 10, newest: int = 5,
               scope: str = "full") -> DataFrame:
    """Recompute the 7-row moving average (rounded to 2) next to the stored
    moving_avg_7/30 for the newest rows within ``days`` of the last date."""
    df = features.select("ticker", "date", "close", "moving_avg_7", "moving_avg_30")
    if scope == "filtered":
        df = _within_days_of_last(df, days)
    df = df.withColumn("calculated_ma7", F.round(F.avg("close").over(trailing_rows(7)), 2))
    return _recent(df, days, newest)


VERIFY_TOLERANCE = 1e-9  # relative, for sums added in another order


def verify_summary(features: DataFrame) -> DataFrame:
    """Per ticker: rows compared and mismatches of the recomputed daily return (close to close)
    and both moving averages over the whole series, and whether all agree.

    A row is compared when the series holds all the rows its value is made of: the first
    price of a ticker is not in the feature table, so its first return is not compared, nor are averages
    with a frame that reaches beyond the first row."""
    w = ticker_window()
    df = features.withColumns({"_rn": F.row_number().over(w), "_prev": F.lag("close", 1).over(w)}).withColumns({
        "_return": pct_change(F.col("close"), F.col("_prev")),
        "_ma7": F.avg("close").over(trailing_rows(7)), "_ma30": F.avg("close").over(trailing_rows(30))})

    def differs(stored: str, again: str) -> Column:
        a, b = F.col(stored), F.col(again)
        near = F.abs(a - b) <= VERIFY_TOLERANCE * F.greatest(F.abs(b), F.lit(1.0))
        return ~F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(near)

    checks = {"return": ("daily_return", "_return", 2), "ma7": ("moving_avg_7", "_ma7", 7), "ma30": ("moving_avg_30", "_ma30", 30)}
    aggs = []
    for name, (stored, again, first) in checks.items():
        compared = F.col("_rn") >= first
        aggs += [F.count_if(compared).alias(f"{name}_compared"),
                 F.count_if(compared & differs(stored, again)).alias(f"{name}_mismatches")]
    wrong = sum((F.col(f"{n}_mismatches") for n in checks), F.lit(0))
    return df.groupBy("ticker").agg(*aggs).withColumn("passed", wrong == 0)
