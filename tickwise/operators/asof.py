"""As-of lookup: the newest feature row at or before a requested date.

``asof_join`` answers a whole table of (ticker, as_of_date) requests:

1. Requests are reduced to their distinct (ticker, date) keys (a grouped
   aggregation: a hot request key is combined map-side and becomes one row).
2. Keys and feature rows are unioned and one window per ticker, ordered by
   date with feature rows before keys on the same date, carries the last
   feature row forward (``last(..., ignorenulls)``). Feature rows are one
   per (ticker, date) and keys are distinct, so a window partition is
   bounded by the calendar, never by the request volume.
3. The resolved keys are equi-joined back to the requests. A hot key is
   split by AQE skew-join handling; when the resolved side is small AQE
   turns the join into a broadcast from the measured size.

No range join and no pair explosion: each request matches exactly one
resolved key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATUS_OK = "ok"
STATUS_NO_TICKER = "no_ticker"      # the ticker has no feature rows at all
STATUS_NOT_YET = "no_data_yet"      # rows exist, but none on or before the date


def asof_latest(features: DataFrame, ticker: str, as_of_date) -> DataFrame:
    """Single lookup: newest row of ``ticker`` with date <= as_of_date
    (inclusive). Filters reach the scan; top-1 is TakeOrderedAndProject."""
    return (features.filter((F.col("ticker") == ticker)
                            & (F.col("date") <= F.lit(as_of_date).cast("date")))
                    .orderBy(F.col("date").desc_nulls_last()).limit(1))


def asof_join(requests: DataFrame, features: DataFrame, value_cols: list[str],
              request_date: str = "as_of_date", by: str = "ticker",
              feature_date: str = "date") -> DataFrame:
    """Left as-of join of ``requests`` with ``features`` on ``by`` and
    ``feature_date <= request_date``; adds status, feature_date and value_cols."""
    payload = F.struct(F.col(feature_date).alias("feature_date"),
                       *[F.col(c) for c in value_cols])
    feat = features.select(F.col(by).alias("_by"), F.col(feature_date).alias("_t"),
                           F.lit(0).alias("_side"), payload.alias("_f"))
    keys = (requests.select(F.col(by).alias("_by"), F.col(request_date).alias("_t"))
                    .distinct()
                    .select("_by", "_t", F.lit(1).alias("_side"),
                            F.lit(None).cast(feat.schema["_f"].dataType).alias("_f")))
    w = (Window.partitionBy("_by").orderBy("_t", "_side")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    resolved = (feat.unionByName(keys)
                    .withColumn("_m", F.last("_f", ignorenulls=True).over(w))
                    .withColumn("_known", F.min("_side").over(Window.partitionBy("_by")) == 0)
                    .filter(F.col("_side") == 1)
                    .select("_by", "_t", "_m", "_known"))
    joined = requests.join(resolved, (requests[by] == resolved["_by"])
                           & (requests[request_date] == resolved["_t"]), "left")
    status = (F.when(F.col("_m").isNotNull(), STATUS_OK)
               .when(F.col("_known"), STATUS_NOT_YET).otherwise(STATUS_NO_TICKER))
    return joined.select(*requests.columns, status.alias("status"),
                         F.col("_m.feature_date").alias("feature_date"),
                         *[F.col(f"_m.{c}").alias(c) for c in value_cols])
