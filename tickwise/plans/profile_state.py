"""Profile of the feature table that is kept up by partitions: mergeable partial states per ticker and month.

Counts, nulls, outliers, minima, maxima and sums of a partition (month and ticker bucket) of the feature table are one row
per ticker in a profile table with the same partitions, published with the version of the feature table that it was made
from. A refresh recomputes the partitions that differ between that version and the newest one, no others. Reading
merges a ticker's rows, one a month: the validation report and the ranges then cost the size of the profile, not of the table.
The price table has a profile of the same kind (``price_partials``): rows, and rows that cleaning keeps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators import clean as C
from tickwise.operators import quality as QA
from tickwise.operators.profile import unpivot_stats
from tickwise.schemas import EXPECTED_FEATURE_TABLE_COLUMNS, OUTLIER_THRESHOLDS
from tickwise.sources import published as PB
from tickwise.sources import sinks as SK

RANGED = ("daily_return", "volatility_7", "momentum")
MADE_FROM = "features_version"
NULL, LOW, HIGH, SUM, COUNT = "null__", "min__", "max__", "sum__", "count__"


def partials(df: DataFrame) -> DataFrame:
    """One row per ticker, month and bucket of a feature table with its partition columns."""
    columns = [c for c in df.columns if c not in ("ticker", SK.MONTH, SK.BUCKET)]
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(QA.is_outlier("daily_return", OUTLIER_THRESHOLDS["daily_return"][0])).alias("extreme")]
    aggs += [F.count_if(F.col(c).isNull()).alias(NULL + c) for c in columns]
    for c in RANGED:
        aggs += [F.min(c).alias(LOW + c), F.max(c).alias(HIGH + c), F.sum(c).alias(SUM + c), F.count(c).alias(COUNT + c)]
    return df.groupBy("ticker", SK.MONTH, SK.BUCKET).agg(*aggs)


def price_partials(df: DataFrame) -> DataFrame:
    """``clean.clean_counts`` per ticker, month and bucket of a merged price table, which has one row a ticker and date."""
    return df.groupBy("ticker", SK.MONTH, SK.BUCKET).agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(C.valid_row(df)).alias("rows_after"))


def refresh_profile(spark: SparkSession, features_path: str, profile_path: str,
                    made_by: Callable[[DataFrame], DataFrame] = partials) -> list[str]:
    """Recompute the partitions of the feature table that have changed since the profile was made; returns them.
    ``made_by`` makes a partition's rows of the profile (``price_partials`` for a price table)."""
    features_path, profile_path = features_path.rstrip("/"), profile_path.rstrip("/")
    now, profile = PB.current(spark, features_path), PB.current(spark, profile_path)
    changed = PB.changed_parts(PB.version(spark, features_path, int(profile.notes.get(MADE_FROM, 0))), now)
    if not changed:
        return []
    wanted = {p for p in changed if p in now.parts}
    table = PB.read(spark, features_path, now, lambda v: f"{SK.MONTH}={v[SK.MONTH]}/{SK.BUCKET}={v[SK.BUCKET]}" in wanted) if wanted else None
    staged = {}
    if table is not None:
        made = made_by(table).hint("rebalance", SK.MONTH, SK.BUCKET)
        staged = PB.stage(made.sortWithinPartitions(SK.MONTH, SK.BUCKET, "ticker"), profile_path, [SK.MONTH, SK.BUCKET])
    PB.publish(spark, profile_path, profile, {**{p: [] for p in changed}, **staged}, {MADE_FROM: str(now.number)})
    return changed


def read_profile(spark: SparkSession, profile_path: str) -> DataFrame:
    """The merged profile: one row per ticker."""
    table = PB.read(spark, profile_path.rstrip("/"))
    if table is None:
        raise FileNotFoundError(f"no profile at {profile_path}")
    how = {LOW: F.min, HIGH: F.max}
    aggs = [how.get(c[:5], F.sum)(c).alias(c) for c in table.columns if c not in ("ticker", SK.MONTH, SK.BUCKET)]
    return table.groupBy("ticker").agg(*aggs)


def ticker_checks(profile: DataFrame) -> DataFrame:
    """``quality.ticker_checks`` from a merged profile."""
    columns = sorted(c[len(NULL):] for c in profile.columns if c.startswith(NULL))
    return QA.checks_of(profile.withColumnRenamed("extreme", "extreme_outliers"), columns, lambda c: F.col(NULL + c))


def validation_report(profile: DataFrame, tickers: DataFrame | None = None) -> DataFrame:
    """``quality.validation_report`` from a merged profile."""
    have = {"ticker", *(c[len(NULL):] for c in profile.columns if c.startswith(NULL))}
    columns = [c for c in EXPECTED_FEATURE_TABLE_COLUMNS if c in have] + sorted(have - set(EXPECTED_FEATURE_TABLE_COLUMNS))
    return QA.report_of(ticker_checks(profile), columns, tickers)


def feature_ranges(profile: DataFrame) -> DataFrame:
    """``profile.feature_ranges`` from a merged profile."""
    wide = profile.select("ticker", *[x for c in RANGED for x in (
        F.col(LOW + c).alias(f"{c}__min_val"), F.col(HIGH + c).alias(f"{c}__max_val"),
        F.try_divide(F.col(SUM + c), F.col(COUNT + c)).alias(f"{c}__avg_val"))])
    return unpivot_stats(wide, list(RANGED), ["min_val", "max_val", "avg_val"])
