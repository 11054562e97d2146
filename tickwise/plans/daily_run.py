"""The daily job as one set-based plan over all tickers.

ingest (scan landing zone, merge) -> clean -> features from the earliest
change on -> write (ticker buckets) -> validate, with a status row per requested
ticker instead of a Python loop that processes one ticker at a time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators import clean as C
from tickwise.operators import features as FE
from tickwise.operators import quality as QA
from tickwise.plans import profile_state as PS
from tickwise.plans.refresh import refresh_features
from tickwise.plans.rolling import refresh_rolling
from tickwise.sources import landing as LA
from tickwise.sources import prices as SP
from tickwise.sources import published as PB
from tickwise.sources import sinks as SK


def run_status(raw: DataFrame, requested: DataFrame, variant: str = "close_to_close",
               run_date: dt.date | None = None, features: DataFrame | None = None) -> DataFrame:
    """Per requested ticker: raw rows, clean rows, feature rows and status
    ('processed' when feature rows exist, else 'failed' with a reason)."""
    feats = features if features is not None else FE.create_features(C.clean(raw), variant, run_date)
    # rows before/after cleaning in one pass over the raw rows
    counts = C.clean_counts(raw).select("ticker", "rows_before", "rows_after")
    made = feats.groupBy("ticker").agg(F.count(F.lit(1)).alias("feature_rows"))
    return status_of(requested, counts, made)


def status_of(requested: DataFrame, counts: DataFrame, made: DataFrame) -> DataFrame:
    """The status rows from counts by ticker: ``rows_before`` and ``rows_after`` cleaning, ``feature_rows``."""
    out = (requested.select("ticker").distinct()
                    .join(counts, "ticker", "left").join(made, "ticker", "left"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    status = F.when(z("feature_rows") > 0, "processed").otherwise("failed")
    reason = (F.when(z("feature_rows") > 0, F.lit(None).cast("string"))
               .when(z("rows_before") == 0, "no_data")
               .when(z("rows_after") == 0, "no_valid_rows")
               .otherwise("no_features"))
    return out.select("ticker", z("rows_before").alias("rows_before"),
                      z("rows_after").alias("rows_after"),
                      z("feature_rows").alias("feature_rows"),
                      status.alias("status"), reason.alias("reason"))


def run_summary(status: DataFrame) -> DataFrame:
    """One row: tickers processed, failed, total feature rows."""
    return status.agg(F.count_if(F.col("status") == "processed").alias("processed"),
                      F.count_if(F.col("status") == "failed").alias("failed"),
                      F.coalesce(F.sum("feature_rows"), F.lit(0)).cast("bigint")
                       .alias("total_feature_rows"))


@dataclass
class RunResult:
    """``changed_rows``: new or corrected prices; ``rejected_rows``: landed rows without a key;
    ``files``: the landed files, which of them were read and why others were not. With a state, ``feature_rows`` is None (rows
    are not counted) and ``refreshed`` says how many tickers were done from the state (``ahead``) and by look-back (``late``)."""

    changed_rows: int
    rejected_rows: int
    feature_rows: int | None
    status: DataFrame
    report: DataFrame
    files: DataFrame
    refreshed: dict[str, int] | None = None


def _requested_frame(spark: SparkSession, tickers) -> DataFrame | None:
    if tickers is None or isinstance(tickers, DataFrame):
        return tickers
    return spark.createDataFrame([(t,) for t in tickers], "ticker string")


def refresh_by_state(spark: SparkSession, prices_path: str, features_path: str, state_path: str, done: SK.Upserted,
                     run_date: dt.date, variant: str = "close_to_close", n_buckets: int | None = None) -> dict[str, int]:
    """Features from the rolling state, then the profiles of the partitions that have changed: all that a day costs.

    ``state_path`` holds ``rows`` (each ticker's newest), ``features`` and ``prices`` (profiles). A feature table that was made
    without a state has other partitions and is refused."""
    stored = PB.current(spark, features_path.rstrip("/")).parts
    if any(SK.MONTH not in PB.values_of(p) for p in stored):
        raise ValueError(f"the features at {features_path} are not partitioned by month: they were made without a state")
    root = state_path.rstrip("/")
    ran = refresh_rolling(spark, prices_path, features_path, f"{root}/rows", done, run_date, variant, n_buckets)
    PS.refresh_profile(spark, features_path, f"{root}/features")
    PS.refresh_profile(spark, prices_path, f"{root}/prices", PS.price_partials)
    return ran


def state_reports(spark: SparkSession, state_path: str, requested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Status and validation report of the requested tickers from the profiles: neither prices nor features are read."""
    def profile(name: str) -> DataFrame | None:
        path = f"{state_path.rstrip('/')}/{name}"
        return PS.read_profile(spark, path) if PB.current(spark, path).parts else None

    prices, features = profile("prices"), profile("features")
    if prices is None:
        prices = spark.createDataFrame([], "ticker string, rows_before long, rows_after long")
    if features is None:
        made = spark.createDataFrame([], "ticker string, feature_rows long")
        report = QA.validate_source(spark, None, requested)
    else:
        made = features.select("ticker", F.col("rows").alias("feature_rows"))
        report = PS.validation_report(features, requested)
    return status_of(requested, prices, made), report


def run_daily(spark: SparkSession, landing_path: str, prices_path: str, features_path: str,
              run_date: dt.date, tickers=None, landing_format: str = "parquet",
              variant: str = "close_to_close", start=None, end=None,
              n_buckets: int | None = None, quarantine_path: str | None = None,
              state_path: str | None = None) -> RunResult:
    """Ingest, clean, compute features, write and validate in one run.

    A file that can't be read is left out and reported (``landing.scan_landing_files``), and recorded in the table at
    ``quarantine_path`` if one is named; the run fails only if no file has rows of a requested ticker.

    tickers: list or one-column frame of requested tickers (None = all in
    the landing zone). All landed dates are loaded unless ``start`` or ``end``
    says otherwise. Prices are merged (one row per ticker and date, the newest ingest wins), and
    features are refreshed from each ticker's earliest changed date on.
    Re-running with the same inputs changes nothing and writes nothing.

    With a ``state_path`` a run costs what has landed and the partitions that it touches, not the history: features come from each
    ticker's newest rows, status and report from profiles by partition (``refresh_by_state``). A feature table keeps to
    one way, with a state or without."""
    requested = _requested_frame(spark, tickers)
    landed = LA.scan_landing_files(spark, landing_path, landing_format, run_date, start, end)
    batch = landed.rows
    if quarantine_path:
        LA.record_quarantine(spark, landed.files, quarantine_path, run_date)
    if requested is not None:
        batch = batch.join(requested.select("ticker").distinct(), "ticker", "left_semi")
    else:
        requested = batch.select("ticker").filter(F.col("ticker").isNotNull()).distinct()
    if batch.isEmpty():  # stops at the first row found
        raise SP.MissingTableError("no source rows for any requested ticker")
    done = SK.upsert_latest(spark, batch, prices_path, n_buckets)
    if state_path:
        ran = refresh_by_state(spark, prices_path, features_path, state_path, done, run_date, variant, n_buckets)
        status, report = state_reports(spark, state_path, requested)
        return RunResult(done.changed, done.rejected, None, status, report, landed.files, ran)
    written = refresh_features(spark, prices_path, features_path, done.first_dates, run_date, variant, n_buckets)

    req = requested.select("ticker").distinct()
    table_req = SK.read_features(spark, features_path, req)
    stored_req = SK.read_prices(spark, prices_path, req)
    status = run_status(stored_req, requested, variant, run_date, features=table_req)
    report = QA.validation_report(table_req, requested)
    return RunResult(done.changed, done.rejected, written, status, report, landed.files)
