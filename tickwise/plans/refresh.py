"""Incremental refresh of the feature table, equal to a full recompute.

Every feature of a row is made from that row and a bounded number of rows before it, so
a change at a date touches only that date and later ones of its ticker. From the earliest
changed date on the features are computed anew, with as many rows of look-back as the
longest window needs; earlier stored rows stay as they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.operators import clean as C
from tickwise.operators import features as FE
from tickwise.schemas import LONG_WINDOW_ROWS, MOMENTUM_LAG_CLOSE_TO_CLOSE, SHORT_WINDOW_ROWS
from tickwise.sources import published as PB
from tickwise.sources import sinks as SK

# Rows before a row that any of its features reads: the 30-row average reads 29, the
# 7-row volatility of close-to-close returns 7, the momentum 7 or 10.
LOOKBACK_ROWS = max(LONG_WINDOW_ROWS - 1, SHORT_WINDOW_ROWS, MOMENTUM_LAG_CLOSE_TO_CLOSE)


def features_since(prices: DataFrame, first_dates: DataFrame, variant: str, run_date: dt.date) -> DataFrame:
    """Features of the rows from each ticker's ``first_date`` on.

    ``first_dates``: ticker, first_date. Rows before it count only as look-back: the
    newest ``LOOKBACK_ROWS`` valid ones of each ticker."""
    rows = C.clean(prices.join(first_dates, "ticker")).withColumn("_old", F.col("date") < F.col("first_date"))
    newest_first = Window.partitionBy("ticker", "_old").orderBy(F.col("date").desc())
    used = rows.withColumn("_rn", F.row_number().over(newest_first)).filter(
        ~F.col("_old") | (F.col("_rn") <= LOOKBACK_ROWS)).drop("_rn", "_old", "first_date")
    made = FE.create_features(used, variant, run_date)
    return made.join(first_dates, "ticker").filter(F.col("date") >= F.col("first_date")).drop("first_date")


def merged_features(stored: DataFrame | None, fresh: DataFrame, first_dates: DataFrame) -> DataFrame:
    """Stored rows that the change does not touch, and the fresh ones."""
    if stored is None:
        return fresh
    kept = stored.join(first_dates, "ticker", "left").filter(
        F.col("first_date").isNull() | (F.col("date") < F.col("first_date"))).drop("first_date")
    return kept.unionByName(fresh)


def refresh_features(spark: SparkSession, prices_path: str, features_path: str, first_dates: DataFrame,
                     run_date: dt.date, variant: str = "close_to_close", n_buckets: int | None = None) -> int:
    """Bring the feature table up to date after prices changed; returns the rows written.

    Reads the price and feature partitions of the changed tickers' buckets only (static
    filters of at most as many ids as there are buckets) and rewrites those buckets."""
    n = SK.bucket_count(spark, features_path, n_buckets)
    touched = SK.bucket_ids(first_dates, n)
    if not touched:
        return 0
    prices = SK.read_prices(spark, prices_path, first_dates, by_ticker=True)
    fresh = features_since(prices, first_dates, variant, run_date)
    for _ in range(PB.ATTEMPTS):
        base = PB.current(spark, features_path.rstrip("/"))
        stored = PB.read(spark, features_path.rstrip("/"), base, lambda v: int(v[SK.BUCKET]) in touched)
        if stored is not None:
            stored = stored.filter(F.col(SK.BUCKET).isin(touched)).drop(SK.BUCKET)
        try:
            return SK.overwrite_buckets(merged_features(stored, fresh, first_dates), features_path, n, touched, base)
        except PB.Conflict:  # another writer was there first: merge with its rows
            continue
    raise PB.Conflict(f"{features_path} changed under {PB.ATTEMPTS} attempts to refresh")
