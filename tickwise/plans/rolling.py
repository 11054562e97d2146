"""Daily feature refresh whose cost follows the day: rolling state instead of history.

The state table holds each ticker's newest ``LOOKBACK_ROWS`` valid rows, all that the features of a
new row can reach back to, and is published with the version of the price table that it was made from. A run

* takes the state's rows and the changed partitions of the price table for tickers whose changes
  all lie behind the state (a usual day): no earlier month is read;
* falls back to the look-back read of ``plans.refresh`` for tickers with a correction at or before their last row, and
  for new ones;
* after a run that died between the tables finds that the state was not made from the version that the merge began with, and
  takes every ticker of the partitions that differ between the two as corrected.

Features are stored by month and ticker bucket, so a day rewrites the months it touches only. The features are published
before the state: a run that dies in between is made up for by the next one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.operators import clean as C
from tickwise.operators import features as FE
from tickwise.plans.refresh import LOOKBACK_ROWS, features_since, merged_features
from tickwise.session import ensure_checkpoint_dir
from tickwise.sources import published as PB
from tickwise.sources import sinks as SK

MADE_FROM = "prices_version"
STATE_COLUMNS = FE.BASE_COLUMNS


def _places_of(parts: Iterable[str]) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for part in parts:
        v = PB.values_of(part)
        found.setdefault(v[SK.MONTH], []).append(int(v[SK.BUCKET]))
    return found


def newest_rows(rows: DataFrame, n: int = LOOKBACK_ROWS) -> DataFrame:
    """Each ticker's newest ``n`` rows (clean ones: one a day)."""
    w = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def _changes(spark: SparkSession, prices_path: str, since: int, now: PB.Version) -> DataFrame | None:
    """Tickers of the partitions that have changed since a version, with their first date there. None: nothing has changed."""
    places = _places_of(PB.changed_parts(PB.version(spark, prices_path, since), now))
    if not places:
        return None
    return SK.read_prices(spark, prices_path, at=now, places=places).groupBy("ticker").agg(F.min("date").alias("first_date"))


def _replaced(spark: SparkSession, path: str, base: PB.Version, fresh: DataFrame, first_dates: DataFrame, n: int,
              columns: list[str]) -> dict[str, list[str]]:
    """Stage ``fresh`` in place of the stored rows from each ticker's first date on. Stored partitions of the changed tickers'
    buckets from the earliest month on lose rows, whether fresh ones come or not; fresh rows go to these and to new ones, since
    none is before its ticker's first date. So they are made once, by the write."""
    fresh = SK.located(fresh.select(*columns), n)
    begin = dict(tuple(r) for r in first_dates.groupBy(SK.ticker_bucket(F.col("ticker"), n)).agg(
        F.date_format(F.min("first_date"), "yyyy-MM")).collect())
    mine = {k for k in base.parts if (v := PB.values_of(k))[SK.MONTH] >= begin.get(int(v[SK.BUCKET]), "9999")}
    stored = PB.read(spark, path, base, lambda v: f"{SK.MONTH}={v[SK.MONTH]}/{SK.BUCKET}={v[SK.BUCKET]}" in mine)
    if stored is not None:
        stored = stored.select(*fresh.columns)
    out = merged_features(stored, fresh, first_dates)
    staged = PB.stage(out.hint("rebalance", SK.MONTH, SK.BUCKET).sortWithinPartitions(SK.MONTH, SK.BUCKET, "ticker", "date"),
                      path, [SK.MONTH, SK.BUCKET])
    return {**{k: [] for k in mine}, **staged}


def refresh_rolling(spark: SparkSession, prices_path: str, features_path: str, state_path: str, done: SK.Upserted | None,
                    run_date: dt.date, variant: str = "close_to_close", n_buckets: int | None = None) -> dict[str, int]:
    """Bring features and state up to the price table after a merge (``done``; None: after anything); returns the
    tickers done from the state (``ahead``) and by look-back (``late``).

    Equal to a full recompute. One run at a time: of two, the one that publishes second stops with ``published.Conflict``."""
    ensure_checkpoint_dir(spark)
    prices_path, features_path, state_path = (p.rstrip("/") for p in (prices_path, features_path, state_path))
    n = SK.bucket_count(spark, features_path, n_buckets)
    now, state, features = (PB.current(spark, p) for p in (prices_path, state_path, features_path))
    made_from = int(state.notes.get(MADE_FROM, 0))
    if made_from == now.number:
        return {"ahead": 0, "late": 0}
    held = PB.read(spark, state_path, state)
    if done is not None and made_from == done.base.number and now.number == done.made.number:
        last = held and held.groupBy("ticker").agg(F.max("date").alias("last"))
        changed = done.first_dates.withColumn("last", F.lit(None).cast("date")) if held is None else done.first_dates.join(last, "ticker", "left")
        places = done.places
    else:  # not the state of the table that the merge began with
        found = _changes(spark, prices_path, made_from, now)
        if found is None:
            return {"ahead": 0, "late": 0}
        changed, places = found.withColumn("last", F.lit(None).cast("date")), {}
    changed = changed.withColumn("is_ahead", F.coalesce(F.col("first_date") > F.col("last"), F.lit(False))).checkpoint()
    ahead, late = (changed.filter(c).select("ticker", "first_date") for c in ("is_ahead", "not is_ahead"))
    counts = {"ahead": ahead.count(), "late": late.count()}

    fresh, states = [], []
    if counts["ahead"]:
        new = C.clean(SK.read_prices(spark, prices_path, at=now, places=places).join(ahead, "ticker").filter(
            F.col("date") >= F.col("first_date")).drop("first_date")).select(*STATE_COLUMNS)
        rows = held.select(*STATE_COLUMNS).join(ahead.select("ticker"), "ticker", "left_semi").unionByName(new)
        fresh.append(FE.create_features(rows, variant, run_date).join(ahead, "ticker").filter(
            F.col("date") >= F.col("first_date")).drop("first_date"))
        states.append(newest_rows(rows))
    if counts["late"]:
        history = SK.read_prices(spark, prices_path, late, at=now, by_ticker=True)
        fresh.append(features_since(history, late, variant, run_date))
        states.append(newest_rows(C.clean(history).select(*STATE_COLUMNS)))

    first_dates = changed.select("ticker", "first_date")
    rows = reduce(DataFrame.unionByName, fresh)
    staged = _replaced(spark, features_path, features, rows, first_dates, n, rows.columns)
    PB.publish(spark, features_path, features, staged, {MADE_FROM: str(now.number)})

    own = reduce(DataFrame.unionByName, states).withColumn(SK.BUCKET, SK.ticker_bucket(F.col("ticker"), n))
    buckets = SK.bucket_ids(first_dates, n)
    if held is not None:
        own = own.unionByName(held.filter(F.col(SK.BUCKET).isin(buckets)).join(first_dates.select("ticker"), "ticker", "left_anti")
                              .select(*own.columns))
    staged = PB.stage(own.hint("rebalance", SK.BUCKET).sortWithinPartitions(SK.BUCKET, "ticker", "date"), state_path, [SK.BUCKET])
    PB.publish(spark, state_path, state, {**{f"{SK.BUCKET}={b}": [] for b in buckets}, **staged}, {MADE_FROM: str(now.number)})
    return counts
