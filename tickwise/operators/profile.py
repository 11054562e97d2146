"""Profiling of price and feature tables: counts, coverage, gaps, nulls,
ranges, summary statistics and newest-rows reports.

Every report is one grouped aggregation (partial + final) over the table;
per-column statistics are computed in the same pass and then unpivoted,
so k columns cost one scan, not k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.exprs import ticker_window
from tickwise.session import ensure_checkpoint_dir


def symbol_counts(df: DataFrame) -> DataFrame:
    """Per ticker: rows, first and last date; largest first."""
    return (df.groupBy("ticker")
              .agg(F.count(F.lit(1)).alias("record_count"),
                   F.min("date").alias("first_date"),
                   F.max("date").alias("last_date"))
              .orderBy(F.desc("record_count"), "ticker"))


def record_counts(df: DataFrame) -> DataFrame:
    """Per ticker: number of rows."""
    return (df.groupBy("ticker").agg(F.count(F.lit(1)).alias("record_count"))
              .orderBy(F.desc("record_count"), "ticker"))


def date_coverage(df: DataFrame) -> DataFrame:
    """Per ticker: start, end, distinct trading days, calendar span in days."""
    return (df.groupBy("ticker")
              .agg(F.min("date").alias("start_date"),
                   F.max("date").alias("end_date"),
                   F.count_distinct("date").alias("trading_days"),
                   F.datediff(F.max("date"), F.min("date")).alias("total_days"))
              .orderBy("ticker"))


def gaps(df: DataFrame, min_gap_days: int = 1) -> DataFrame:
    """Runs of missing calendar days: (ticker, gap_end, gap_start, days_gap)
    for consecutive dates more than ``min_gap_days`` apart.

    Distinct (ticker, date) first: duplicate rows only add zero-day steps, and
    the pre-aggregation keeps a key with many copies from reaching the window.
    """
    dates = df.select("ticker", "date").distinct()
    prev = F.lag("date").over(ticker_window())
    return (dates.withColumn("gap_start", prev)
                 .withColumn("days_gap", F.datediff("date", "gap_start"))
                 .filter(F.col("days_gap") > min_gap_days)
                 .select("ticker", F.col("date").alias("gap_end"), "gap_start", "days_gap"))


def null_counts(df: DataFrame, by_ticker: bool = True) -> DataFrame:
    """NULL count of every column in one pass (wide: one column per column)."""
    cols = [c for c in df.columns if not (by_ticker and c == "ticker")]
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    return (df.groupBy("ticker") if by_ticker else df.groupBy()).agg(*aggs)


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def date_range(df: DataFrame) -> DataFrame:
    """Per ticker: first date, last date, number of dated rows."""
    return df.groupBy("ticker").agg(F.min("date").alias("min_date"),
                                    F.max("date").alias("max_date"),
                                    F.count("date").alias("total_days"))


def unpivot_stats(wide: DataFrame, features: list[str], stats: list[str],
                   key: str = "ticker") -> DataFrame:
    """Turn columns ``{feature}__{stat}`` into rows (key, feature, stats...)."""
    rows = [F.struct(F.lit(f).alias("feature"),
                     *[F.col(f"{f}__{s}").alias(s) for s in stats]) for f in features]
    return (wide.select(key, F.explode(F.array(*rows)).alias("_r"))
                .select(key, "_r.*"))


def feature_ranges(df: DataFrame,
                   features: tuple[str, ...] = ("daily_return", "volatility_7", "momentum")) -> DataFrame:
    """Per ticker and feature: min, max, avg (one aggregation for all)."""
    aggs = []
    for f in features:
        aggs += [F.min(f).alias(f"{f}__min_val"), F.max(f).alias(f"{f}__max_val"),
                 F.avg(f).alias(f"{f}__avg_val")]
    wide = df.groupBy("ticker").agg(*aggs)
    return unpivot_stats(wide, list(features), ["min_val", "max_val", "avg_val"])


SUMMARY_STATS = ["count", "mean", "stddev", "min", "p25", "p50", "p75", "max"]


def summary(df: DataFrame, features: list[str], exact: bool = True) -> DataFrame:
    """Per ticker and feature: count, mean, stddev, min, quartiles, max.

    exact=True uses interpolated ``percentile`` (holds one ticker's values,
    at most one per day); exact=False uses ``percentile_approx`` with
    bounded memory for arbitrary groupings.
    """
    aggs = []
    for f in features:
        c = F.col(f)
        # one aggregate per feature returns all three quartiles
        probs = F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])
        q = F.percentile(c, probs) if exact else F.percentile_approx(c, probs, 10000)
        aggs += [F.count(c).alias(f"{f}__count"), F.avg(c).alias(f"{f}__mean"),
                 F.stddev_samp(c).alias(f"{f}__stddev"), F.min(c).alias(f"{f}__min"),
                 q.alias(f"{f}__q"), F.max(c).alias(f"{f}__max")]
    wide = df.groupBy("ticker").agg(*aggs)
    wide = wide.withColumns({f"{f}__{name}": F.col(f"{f}__q")[i].cast("double")
                             for f in features for i, name in enumerate(("p25", "p50", "p75"))})
    return unpivot_stats(wide, features, SUMMARY_STATS)


# Relative rank error of the sketch that bounds a quartile.
SKETCH_ACCURACY = 10_000
QUARTILES = (0.25, 0.5, 0.75)


def summary_selected(df: DataFrame, features: list[str], groups: list[str] | None = None) -> DataFrame:
    """``summary`` for groups of any size (the whole table if none are named), quartiles exact and interpolated.

    Two passes and no group in one task. The first takes counts, moments and a mergeable sketch of bounded size, which
    gives values that surely lie below and above each quartile. The second counts the values below the lower bound and keeps
    those between the bounds -- about 4 / ``SKETCH_ACCURACY`` of a group's rows, equal values as one row -- of which the
    quartile is picked by its rank. A group of no more rows than the sketch holds is bounded by its minimum and maximum."""
    groups = groups or []
    # once for both passes
    ensure_checkpoint_dir(df.sparkSession)
    df = df.select(*groups, *features).checkpoint()
    gap = 2.0 / SKETCH_ACCURACY
    probs = [max(0.0, min(1.0, p + d)) for p in QUARTILES for d in (-gap, gap)]
    aggs = []
    for f in features:
        c = F.col(f)
        sketch = F.percentile_approx(c, F.array(*[F.lit(p) for p in probs]), SKETCH_ACCURACY)
        aggs += [F.struct(F.lit(f).alias("feature"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
                          F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"), sketch.cast("array<double>").alias("sketch")).alias(f)]
    key = F.struct(F.lit(0).alias("_all"), *[F.col(g) for g in groups])
    first = df.groupBy(key.alias("_key")).agg(*aggs).select("_key", F.explode(F.array(*features)).alias("_s")).select("_key", "_s.*")
    small = F.col("count") <= SKETCH_ACCURACY
    bounds = first.select("_key", "feature", F.explode(F.array(*[F.struct(
        F.lit(i).alias("q"), F.when(small, F.col("min")).otherwise(F.get("sketch", F.lit(2 * i))).alias("lo"),
        F.when(small, F.col("max")).otherwise(F.get("sketch", F.lit(2 * i + 1))).alias("hi"),
        (F.lit(p) * (F.col("count") - 1)).alias("pos")) for i, p in enumerate(QUARTILES)])).alias("_b")).select("_key", "feature", "_b.*")
    # one row a group: its bounds by feature and quartile
    wide = bounds.groupBy(F.col("_key").alias("_of")).agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("#", "feature", F.col("q").cast("string")), F.struct("lo", "hi")))).alias("_bounds"))
    rows = df.select(key.alias("_key"), *[F.col(f).cast("double").alias(f) for f in features])
    # without groups the bounds are one row: a value of its own rather than a join on a constant
    rows = rows.join(wide, F.col("_key") == F.col("_of")) if groups else rows.withColumn("_bounds", wide.select("_bounds").scalar())
    cells, below = [], []
    for f in features:
        for i in range(len(QUARTILES)):
            b, of = F.col("_bounds")[f"{f}#{i}"], (F.lit(f).alias("feature"), F.lit(i).alias("q"))
            between = (F.col(f) >= b["lo"]) & (F.col(f) <= b["hi"])
            cells.append(F.when(between, F.struct(*of, F.col(f).alias("value"))))
            below.append((of, f"_n{len(below)}", F.count_if(F.col(f) < b["lo"])))
    kept = (rows.select("_key", F.explode(F.array_compact(F.array(*cells))).alias("_c")).groupBy("_key", "_c.feature", "_c.q", "_c.value")
            .agg(F.count(F.lit(1)).alias("n")))
    # what lies below is a count in the group's one row, not a row for each
    lower = rows.groupBy("_key").agg(*[n.alias(name) for _, name, n in below]).select("_key", F.explode(F.array(*[
        F.struct(*of, F.lit(None).cast("double").alias("value"), F.col(name).alias("n")) for of, name, _ in below])).alias("_c"))
    counted = kept.unionByName(lower.select("_key", "_c.*").filter("n > 0"))
    # what lies below the bound has no value and comes first; the rest is bounded by the sketch
    w = Window.partitionBy("_key", "feature", "q").orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_before", F.coalesce(F.sum("n").over(w), F.lit(0))).join(
        bounds.select("_key", "feature", "q", "pos"), ["_key", "feature", "q"])
    at = lambda rank: F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("n")), F.col("value")))
    low, high = F.floor("pos"), F.ceil("pos")
    picked = placed.groupBy("_key", "feature", "q").agg(at(low).alias("a"), at(high).alias("b"), F.max("pos").alias("pos"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.floor("pos"))
    names = [f"p{int(p * 100)}" for p in QUARTILES]
    quartiles = picked.groupBy("_key", "feature").agg(*[F.max(F.when(F.col("q") == i, value)).alias(n) for i, n in enumerate(names)])
    return first.join(quartiles, ["_key", "feature"], "left").select(*[F.col("_key")[g].alias(g) for g in groups], "feature", *SUMMARY_STATS)


def sorted_by_key(df: DataFrame) -> DataFrame:
    """Output order (ticker, date); a range-partitioned sort, used only where
    ordered output is wanted (windows never need it)."""
    return df.orderBy(F.col("ticker").asc_nulls_last(), F.col("date").asc_nulls_last())


def head_sample(df: DataFrame, n: int = 3) -> DataFrame:
    """A few rows to look at (any rows: no ordering is paid for)."""
    return df.limit(n)


def newest(df: DataFrame, n: int) -> DataFrame:
    """Newest n rows of the whole table (date desc, ticker as tie-break)."""
    return df.orderBy(F.col("date").desc_nulls_last(), F.col("ticker").asc_nulls_last()).limit(n)


def newest_per_ticker(df: DataFrame, n: int) -> DataFrame:
    """Newest n rows of every ticker (``WindowGroupLimit`` runs before the shuffle)."""
    w = Window.partitionBy("ticker").orderBy(F.col("date").desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
