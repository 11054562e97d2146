"""Daily price bars derived from the driver's tables.

There is no price table in the test data, so bars are derived:

* ``prices``       ticker = supplier, one bar per (supplier, ship date),
                   price = extended price / quantity.
* ``event_prices`` ticker = event type, one bar per (type, day); open != close
                   on every bar, so intraday returns are non-trivial.
* ``prices_dirty`` ``prices`` plus newer duplicate copies, nulls, NaN,
                   negative and zero opens, picked by ticker/date arithmetic.
* ``asof_requests`` (ticker, as_of_date) requests from ``orders``.

Bars are built with one grouped aggregation: the least and the largest full
ordering key pick the open/close prices, so every map task combines
its rows per key before the shuffle and a hot (ticker, day) never lands as
raw rows in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.exprs import safe_div

# Fixed values of the derived fixtures.
FIXTURE_INGEST_DATE = dt.date(2002, 1, 1)
DIRTY_COPY_INGEST_DATE = dt.date(2002, 1, 2)
DIRTY_EPOCH = "1995-01-01"  # day numbers for row picking count from here
DIRTY_MODULUS = 10
EARLY_REQUEST_BEFORE = "1995-02-01"  # orders before this also ask 30 days back
EARLY_REQUEST_SHIFT_DAYS = 30


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bars(grouped_px: DataFrame, key_cols: list[str], opened: Column, closed: Column,
          volume: Column) -> DataFrame:
    return grouped_px.groupBy(*key_cols).agg(
        opened.alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        closed.alias("close"),
        volume.alias("volume"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per supplier from ``lineitem`` (price-table schema)."""
    # The ticker is formed before grouping so the bars come out hash
    # partitioned by (ticker, date): a following dedupe on that key needs no
    # second shuffle.
    li = read_table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice", F.to_date("l_shipdate").alias("date"),
        safe_div(F.col("l_extendedprice"), F.col("l_quantity")).alias("px"))
    order_key = F.struct("l_orderkey", "l_linenumber", "l_partkey",
                         "l_extendedprice", "l_quantity")
    # the key holds what the price is made of, so the price isn't sorted and shuffled beside it
    px_of = lambda first: safe_div(first["l_extendedprice"], first["l_quantity"])
    bars = _bars(li, ["ticker", "date"], px_of(F.min(order_key)), px_of(F.max(order_key)),
                 F.sum("l_quantity").cast("bigint"))
    return bars.select(
        "ticker", "date", "open", "high", "low", "close",
        F.col("close").alias("adj_close"), "volume",
        F.lit(FIXTURE_INGEST_DATE).alias("ingestion_timestamp"))


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per event type from ``events`` (many ticks per day)."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ticker"), F.to_date("ts").alias("date"),
        F.col("value").alias("px"), "ts", "event_id")
    order_key = F.struct("ts", "event_id")
    bars = _bars(ev, ["ticker", "date"], F.min_by("px", order_key), F.max_by("px", order_key),
                 F.count(F.lit(1)).cast("bigint"))
    return bars.select(
        "ticker", "date", "open", "high", "low", "close",
        F.col("close").alias("adj_close"), "volume",
        F.lit(FIXTURE_INGEST_DATE).alias("ingestion_timestamp"))


def dirty_pick(ticker: Column, date: Column) -> Column:
    """Deterministic row picker in 0..9 from ticker number and day number."""
    supp = F.substring(ticker, 2, 64).cast("bigint")
    day = F.datediff(date, F.lit(DIRTY_EPOCH))
    return (supp * 7 + day) % DIRTY_MODULUS


def prices_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prices`` with injected defects (``with_defects``)."""
    return with_defects(prices(spark, sf_dir))


def with_defects(bars: DataFrame) -> DataFrame:
    """Bars with injected defects for the cleaning operators.

    pick 0: a second copy with a newer ingest date and close + 1 (newer wins)
    pick 1: volume NULL            pick 2: open negative
    pick 3: open = 0               pick 4: adj_close NULL
    pick 5 on even day numbers: close NaN
    """
    base = bars.withColumn("_pick", dirty_pick(F.col("ticker"), F.col("date")))
    day_even = F.datediff(F.col("date"), F.lit(DIRTY_EPOCH)) % 2 == 0
    p = F.col("_pick")
    edited = F.struct(
        F.when(p == 2, -F.col("open")).when(p == 3, F.lit(0.0))
         .otherwise(F.col("open")).alias("open"),
        F.when((p == 5) & day_even, F.lit(float("nan")))
         .otherwise(F.col("close")).alias("close"),
        F.when(p == 4, F.lit(None).cast("double"))
         .otherwise(F.col("adj_close")).alias("adj_close"),
        F.when(p == 1, F.lit(None).cast("bigint"))
         .otherwise(F.col("volume")).alias("volume"),
        F.col("ingestion_timestamp"))
    newer = F.struct(
        F.col("open"), (F.col("close") + 1).alias("close"), F.col("adj_close"),
        F.col("volume"), F.lit(DIRTY_COPY_INGEST_DATE).alias("ingestion_timestamp"))
    # One pass over the bars: picked rows also emit their newer copy, so the
    # output keeps the bars' (ticker, date) partitioning for the dedupe.
    versions = F.when(p == 0, F.array(edited, newer)).otherwise(F.array(edited))
    return (base.select("ticker", "date", "high", "low", F.explode(versions).alias("_v"))
                .select("ticker", "date", "_v.open", "high", "low", "_v.close", "_v.adj_close",
                        "_v.volume", "_v.ingestion_timestamp"))


def asof_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, ticker, as_of_date) from ``orders``.

    ticker = 'S' || custkey mod (suppliers + 2), so two tickers have no bars;
    orders before February 1995 also ask 30 days earlier, before any bar.
    """
    n_tickers = read_table(spark, sf_dir, "supplier").select(
        (F.count(F.lit(1)) + 2).alias("n")).scalar()
    d = F.to_date("o_orderdate")
    key = F.col("o_orderkey")
    this = F.struct(key.alias("request_id"), d.alias("as_of_date"))
    back = F.struct((-key).alias("request_id"),
                    F.date_sub(d, EARLY_REQUEST_SHIFT_DAYS).alias("as_of_date"))
    # one scan: early orders emit their second request from the same row
    reqs = F.when(d < F.lit(EARLY_REQUEST_BEFORE), F.array(this, back)).otherwise(F.array(this))
    return (read_table(spark, sf_dir, "orders")
            .select(F.concat(F.lit("S"), (F.col("o_custkey") % n_tickers).cast("string"))
                     .alias("ticker"), F.explode(reqs).alias("_r"))
            .select("_r.request_id", "ticker", "_r.as_of_date"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single trades from ``lineitem``, ordered by ``trade`` and ``px``; the series HOT holds a third of all."""
    hot = F.col("l_orderkey") % 3 == 0
    return read_table(spark, sf_dir, "lineitem").select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("ticker"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("trade"), F.col("l_extendedprice").alias("px"))
