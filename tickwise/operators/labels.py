"""Next-day labels, label distribution and the time split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.exprs import ticker_window
from tickwise.schemas import FEATURE_COLUMNS, LABEL_COLUMN, TRAIN_FRACTION


def training_read(features: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    """ticker, date, close and the five features; rows with a NULL close or
    daily_return dropped; optional ticker list (pushed to the scan)."""
    missing = [c for c in FEATURE_COLUMNS + ["ticker", "date", "close"] if c not in features.columns]
    if missing:
        raise ValueError(f"feature table lacks columns {missing}")
    df = features
    if tickers is not None:
        df = df.filter(F.col("ticker").isin(list(tickers)))
    return (df.select("ticker", "date", "close", *FEATURE_COLUMNS)
              .filter(F.col("close").isNotNull() & F.col("daily_return").isNotNull()))


def create_labels(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """label = 1 when the next row's close is higher, else 0 (ties are 0);
    the last row of each ticker has no next close and is removed."""
    nxt = F.lead("close", 1).over(ticker_window())
    return (df.withColumn("_next_close", nxt)
              .filter(F.col("_next_close").isNotNull())
              .withColumn(label, F.when(F.col("_next_close") > F.col("close"), 1)
                                   .otherwise(0).cast("int"))
              .drop("_next_close"))


def label_distribution(labeled: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    return labeled.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def split_bounds(df: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """One row: min_date, max_date, split_date = min + floor(span * fraction)."""
    b = df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))
    span = F.datediff("max_date", "min_date")
    return b.withColumn("split_date",
                        F.date_add("min_date", F.floor(span * F.lit(fraction)).cast("int")))


def split_date(df: DataFrame, fraction: float = TRAIN_FRACTION) -> Column:
    """The split date as a scalar subquery (computed once by Spark, no collect)."""
    return split_bounds(df, fraction).select("split_date").scalar()


def with_split(df: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Add split = 'train' (date <= split date) or 'test'. One date for all tickers."""
    sd = split_date(df, fraction)
    return df.withColumn("split", F.when(F.col("date") <= sd, "train").otherwise("test"))


def split_data(df: DataFrame, fraction: float = TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    return split_at(df, split_date(df, fraction))


def split_at(df: DataFrame, day: Column) -> tuple[DataFrame, DataFrame]:
    """Training rows (up to a day) and test rows (after it)."""
    return df.filter(F.col("date") <= day), df.filter(F.col("date") > day)


def with_date_folds(df: DataFrame, k: int = 3, col: str = "fold") -> DataFrame:
    """Assign each row to one of ``k`` consecutive calendar blocks of the
    whole date span (a fold column for time-blocked cross-validation). The
    span comes from a scalar subquery: no global window, no collect."""
    b = df.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    lo = b.select("lo").scalar()
    span = b.select((F.datediff("hi", "lo") + 1).alias("n")).scalar()
    pos = F.datediff(F.col("date"), lo)
    return df.withColumn(col, F.least(F.floor(pos * F.lit(k) / span), F.lit(k - 1)).cast("int"))
