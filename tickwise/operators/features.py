"""Rolling per-ticker features.

All windows are ``partitionBy(ticker).orderBy(date)`` with row frames, so
"7-day" means the last 7 rows. Catalyst plans every feature of one variant
over a single hash exchange on ``ticker`` plus one sort. Input must be clean
(one row per ticker and date, see ``operators.clean``), so a window partition
holds at most one row per calendar day whatever the size of the table.

Two variants exist:

``intraday``        daily_return = (close - open) / open,
                    momentum = close / close 7 rows back; all rows kept.
``close_to_close``  daily_return = (close - prev close) / prev close,
                    momentum = (close - close 10 back) / close 10 back;
                    rows with a NULL daily_return are dropped after the
                    windows are computed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.exprs import pct_change, safe_div, ticker_window, trailing_rows
from tickwise.schemas import (EXPECTED_FEATURE_TABLE_COLUMNS, FEATURE_SCHEMA,
                              LONG_WINDOW_ROWS, MOMENTUM_LAG_CLOSE_TO_CLOSE,
                              MOMENTUM_LAG_INTRADAY, SHORT_WINDOW_ROWS)

Series = str | list[str]  # the columns that make up a series
VARIANTS = ("intraday", "close_to_close")
BASE_COLUMNS = ["ticker", "date", "open", "high", "low", "close", "volume"]


def intraday_return(df: DataFrame) -> Column:
    return safe_div(F.col("close") - F.col("open"), F.col("open"))


def moving_avg(n: int, by: Series = "ticker") -> Column:
    return F.avg("close").over(trailing_rows(n, by))


def volatility(n: int, ret: str = "daily_return", by: Series = "ticker") -> Column:
    return F.stddev_samp(ret).over(trailing_rows(n, by))


def lagged_close(n: int, by: Series = "ticker") -> Column:
    return F.lag("close", n).over(ticker_window(by))


def with_daily_return(df: DataFrame, variant: str = "intraday", by: Series = "ticker") -> DataFrame:
    if variant == "intraday":
        return df.withColumn("daily_return", intraday_return(df))
    # The lag is named once so the window computes it once.
    return (df.withColumn("_prev_close", lagged_close(1, by))
              .withColumn("daily_return", pct_change(F.col("close"), F.col("_prev_close")))
              .drop("_prev_close"))


def with_momentum(df: DataFrame, variant: str = "intraday", by: Series = "ticker") -> DataFrame:
    if variant == "intraday":
        lag = lagged_close(MOMENTUM_LAG_INTRADAY, by)
        return (df.withColumn("_lag", lag)
                  .withColumn("momentum", safe_div(F.col("close"), F.col("_lag")))
                  .drop("_lag"))
    lag = lagged_close(MOMENTUM_LAG_CLOSE_TO_CLOSE, by)
    return (df.withColumn("_lag", lag)
              .withColumn("momentum", pct_change(F.col("close"), F.col("_lag")))
              .drop("_lag"))


def with_features(df: DataFrame, variant: str = "intraday", by: Series = "ticker") -> DataFrame:
    """All rolling features of one variant as further columns; ``by`` names what makes up a series."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")
    df = with_daily_return(df, variant, by)
    df = (df.withColumn("moving_avg_7", moving_avg(SHORT_WINDOW_ROWS, by))
            .withColumn("moving_avg_30", moving_avg(LONG_WINDOW_ROWS, by))
            .withColumn("volatility_7", volatility(SHORT_WINDOW_ROWS, by=by)))
    return with_momentum(df, variant, by)


def create_features(clean_df: DataFrame, variant: str = "intraday",
                    run_date: dt.date | str | None = None,
                    typed: bool | None = None) -> DataFrame:
    """Add daily_return, moving_avg_7, moving_avg_30, volatility_7, momentum
    and feature_timestamp to a clean price table.

    typed: cast to the feature schema (volume as double); default True for
    ``intraday``, False for ``close_to_close`` (volume stays long).
    """
    return finish_features(with_features(clean_df.select(*BASE_COLUMNS), variant), variant, run_date, typed)


def finish_features(df: DataFrame, variant: str, run_date: dt.date | str | None = None, typed: bool | None = None) -> DataFrame:
    """Stamp the run date, drop what the variant drops after the windows, project."""
    df = df.withColumn("feature_timestamp", F.lit(run_date or dt.date.today()).cast("date"))
    if variant == "close_to_close":
        df = df.filter(F.col("daily_return").isNotNull())
    if typed is None:
        typed = variant == "intraday"
    return typed_features(df) if typed else df.select(*EXPECTED_FEATURE_TABLE_COLUMNS)


def typed_features(df: DataFrame) -> DataFrame:
    """Project and cast to the declared feature schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in FEATURE_SCHEMA.fields])
