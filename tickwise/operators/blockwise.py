"""Windows over series of any length, cut into blocks of rows.

A plain window has a whole series in one task. That is fine for daily bars, which the calendar
bounds, and not for a series of ticks, or one that holds a third of all rows. Here

1. rows are laid out by range of (series, order), so a long series lies in many partitions and short
   ones share one;
2. a row's place in its series is its place in the partition plus a prefix sum over the sizes of the
   partitions before it (one row per series and partition);
3. ``place // block_rows`` names its block. The last ``halo`` rows of a block are copied to the next one,
   so a frame of up to ``halo`` rows before the current one sees the rows that it would see in the whole series, in
   the same order: results are the same to the last bit.

No task holds more of a series than a block with its halo, or a range partition.

The as-of join has no bounded frame; there each partition hands its last feature row on to the ones after it,
by a window over one row per series and partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators import asof
from tickwise.operators import features as FE
from tickwise.schemas import LONG_WINDOW_ROWS
from tickwise.session import ensure_checkpoint_dir

BLOCK_ROWS = 1 << 17
HALO_ROWS = LONG_WINDOW_ROWS - 1  # the longest frame; lags and returns of returns reach less far


def _laid_out(df: DataFrame, series: list[str], order: list[str]) -> DataFrame:
    """Sorted by range, with ``_part``: the partition of a row is part of the result, so it is settled once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(*series, *order).withColumn("_part", F.spark_partition_id()).checkpoint()


def with_places(df: DataFrame, series: list[str], order: list[str], place: str = "_place") -> DataFrame:
    """``df`` with each row's place in its series, from 0. Defined results: rows with a null in ``series`` are a
    series like any other, a null in ``order`` comes first, ties come in any order; no rows in, no rows out."""
    # nulls are told from texts by a flag, so that the join is one of equal keys and keeps the windows' partitioning
    key = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in series], *[F.col(c).isNull() for c in series])
    laid = _laid_out(df, series, order).withColumn("_series", key)
    inside = Window.partitionBy("_series", "_part").orderBy(*order)
    before = Window.partitionBy("_series").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = laid.groupBy("_series", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("_series").alias("_of"), F.col("_part").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_earlier"))
    numbered = laid.withColumn("_row", F.row_number().over(inside) - 1)
    return numbered.join(sizes, (F.col("_series") == F.col("_of")) & (F.col("_part") == F.col("_at"))).select(
        *[F.col(c) for c in df.columns], (F.col("_row") + F.col("_earlier")).alias(place))


def in_blocks(df: DataFrame, series: list[str], order: list[str], halo: int = HALO_ROWS,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``_block``, and ``_own``: false for the copies of rows that the block before it lends to a block.

    Windows over ``series + ["_block"]`` with frames of at most ``halo`` rows before the current row give, for the own
    rows, what the same windows over ``series`` give.
    """
    if not 0 <= halo <= block_rows:
        raise ValueError(f"halo must lie between 0 and block_rows, got {halo} and {block_rows}")
    block = F.floor(F.col("_place") / block_rows)
    lent = F.col("_place") % block_rows >= block_rows - halo
    uses = F.when(lent, F.array(F.struct(block.alias("block"), F.lit(True).alias("own")),
                                F.struct((block + 1).alias("block"), F.lit(False).alias("own")))
                  ).otherwise(F.array(F.struct(block.alias("block"), F.lit(True).alias("own"))))
    return with_places(df, series, order).select(*[F.col(c) for c in df.columns], F.explode(uses).alias("_use")).select(
        *[F.col(c) for c in df.columns], F.col("_use.block").alias("_block"), F.col("_use.own").alias("_own"))


def create_features(clean_df: DataFrame, variant: str = "intraday", run_date: dt.date | str | None = None,
                    typed: bool | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of ``operators.features.create_features`` for tickers of any number of rows."""
    blocks = in_blocks(clean_df.select(*FE.BASE_COLUMNS), ["ticker"], ["date"], HALO_ROWS, block_rows)
    own = FE.with_features(blocks, variant, ["ticker", "_block"]).filter("_own").drop("_block", "_own")
    return FE.finish_features(own, variant, run_date, typed)


def asof_join(requests: DataFrame, features: DataFrame, value_cols: list[str], request_date: str = "as_of_date",
              by: str = "ticker", feature_date: str = "date") -> DataFrame:
    """The rows of ``operators.asof.asof_join`` for tickers of any number of feature rows or different request dates.

    ``features`` has one row per (``by``, ``feature_date``). Defined results: a null ticker has status ``no_ticker``, a null
    request date of a known ticker ``no_data_yet``; repeated requests are answered each.
    """
    payload = F.struct(F.col(feature_date).alias("feature_date"), *[F.col(c) for c in value_cols])
    feat = features.select(F.col(by).alias("_by"), F.col(feature_date).alias("_t"), F.lit(0).alias("_side"), payload.alias("_f"))
    keys = requests.select(F.col(by).alias("_by"), F.col(request_date).alias("_t")).distinct().select(
        "_by", "_t", F.lit(1).alias("_side"), F.lit(None).cast(feat.schema["_f"].dataType).alias("_f"))
    laid = _laid_out(feat.unionByName(keys).filter("_by IS NOT NULL"), ["_by"], ["_t", "_side"])
    known = F.last("_f", ignorenulls=True)
    inside = Window.partitionBy("_by", "_part").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("_by").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # what the partitions before one hand on: one row per series and partition
    handed = laid.groupBy("_by", "_part").agg(
        F.max_by("_f", F.when(F.col("_side") == 0, F.struct("_t"))).alias("_f"), F.min("_side").alias("_side")).select(
        F.col("_by").alias("_of"), F.col("_part").alias("_at"), known.over(earlier).alias("_before"),
        (F.min("_side").over(Window.partitionBy("_by")) == 0).alias("_known"))
    found = laid.withColumn("_here", known.over(inside)).filter("_side = 1")
    resolved = found.join(handed, (found["_by"] == handed["_of"]) & (found["_part"] == handed["_at"])).select(
        "_by", "_t", F.coalesce("_here", "_before").alias("_m"), "_known")
    joined = requests.join(resolved, (requests[by] == resolved["_by"])
                           & requests[request_date].eqNullSafe(resolved["_t"]), "left")
    status = (F.when(F.col("_m").isNotNull(), asof.STATUS_OK)
               .when(F.col("_known"), asof.STATUS_NOT_YET).otherwise(asof.STATUS_NO_TICKER))
    return joined.select(*requests.columns, status.alias("status"), F.col("_m.feature_date").alias("feature_date"),
                         *[F.col(f"_m.{c}").alias(c) for c in value_cols])
