"""Table writers.

* ``upsert_latest``    one row per key over time: the newest ingest of a
                       (ticker, date) replaces the stored row, also when it is
                       landed again on the same run date. The price table is partitioned by
                       ticker bucket and month; only the partitions that the batch touches
                       are read, only those that change are rewritten, and the change is
                       visible at once (``sources.published``).
* ``append_new``       idempotent append (keep-first): rows whose key is already
                       stored are not written again.
* ``overwrite_buckets`` replaces ticker buckets, all at once: a
                       refresh rewrites only the buckets it recomputed, and clears those
                       that have no rows any more.
* ``write_counted``    any write, with the row count taken by ``observe``
                       during the write instead of a second job.

A bucketed table stores its bucket count beside its data; another count is
refused, since it would spread a ticker over two partitions.

Layout: ``rebalance`` asks AQE to even out output partitions (splitting a
skewed ticker bucket, merging small ones) before files are written.
Published tables are Parquet; ``append_new``, ``overwrite_table`` and ``save_as_table`` take
any file format that Spark has.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwise.operators.clean import KEY, dedupe_latest, keyed_rows, reject_counts
from tickwise.session import ensure_checkpoint_dir, freed_shuffles, stored_once
from tickwise.sources import published as PB

PRICE_KEY = ["ticker", "date", "ingestion_timestamp"]
# Buckets of a new table when the caller names none; a large table should name its own.
DEFAULT_TICKER_BUCKETS = 64
LAYOUT_FILE = "_bucket_count"  # Spark's readers skip names that begin with _
BUCKET, MONTH = "ticker_bucket", "month"


def ticker_bucket(ticker: Column, n_buckets: int = DEFAULT_TICKER_BUCKETS) -> Column:
    """Stable bucket number of a ticker (independent of Spark's hash partitioner)."""
    return F.pmod(F.xxhash64(ticker), F.lit(n_buckets)).cast("int")


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its (shared) file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file on a (shared) file system, None when it is not there."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> str:
    """Write a small file unless it exists; the text that it has then (of two
    writers the first wins)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        try:
            out = fs.create(p, False)
            out.write(bytearray(text.encode()))
            out.close()
        except Exception:  # noqa: BLE001 - another writer was first
            if not fs.exists(p):
                raise
    return read_text(spark, path)


def copy_part(spark: SparkSession, source: str, target: str, share: float) -> None:
    """The first ``share`` of a file's bytes as another file: what an interrupted upload leaves."""
    fs, p = _fs(spark, source)
    to_fs, to = _fs(spark, target)
    given, made = fs.open(p), to_fs.create(to, False)
    try:
        spark.sparkContext._jvm.org.apache.commons.io.IOUtils.copyLarge(given, made, 0, int(fs.getFileStatus(p).getLen() * share))
    finally:
        made.close()
        given.close()


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The bucket count of the table at ``path``."""
    text = read_text(spark, f"{path.rstrip('/')}/{LAYOUT_FILE}")
    return int(text) if text else None


def bucket_count(spark: SparkSession, path: str, n_buckets: int | None) -> int:
    """The table's bucket count: stored when the table is first written, checked after."""
    stored = stored_buckets(spark, path)
    if stored is None:
        stored = int(write_text_once(spark, f"{path.rstrip('/')}/{LAYOUT_FILE}", str(n_buckets or DEFAULT_TICKER_BUCKETS)))
    if n_buckets is not None and n_buckets != stored:
        raise ValueError(f"the table at {path} has {stored} ticker buckets, not {n_buckets}")
    return stored


def bucket_ids(tickers: DataFrame, n_buckets: int) -> list[int]:
    """The buckets of the tickers of a frame: at most ``n_buckets`` integers come back."""
    return sorted(r[0] for r in tickers.select(ticker_bucket(F.col("ticker"), n_buckets)).distinct().collect()
                  if r[0] is not None)


def write_counted(df: DataFrame, writer_fn, name: str = "rows_written") -> int:
    """Run ``writer_fn(observed_df)`` and return the rows it wrote."""
    obs = Observation(name)
    writer_fn(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def append_new(spark: SparkSession, df: DataFrame, path: str, key: list[str] | None = None,
               partition_by: list[str] | None = None, fmt: str = "parquet",
               partition_values: list | None = None) -> int:
    """Append rows of ``df`` whose key is not stored at ``path`` yet (keep-first); returns
    the number of rows appended. Duplicate keys inside ``df`` are reduced to
    one deterministic row first.

    ``partition_values`` (e.g. the run's ingest date) prune the stored side
    statically when there is one partition column; without them the keys of all stored
    partitions are read (key columns only)."""
    key = key or PRICE_KEY
    partition_by = ["ingestion_timestamp"] if partition_by is None else partition_by
    if not set(partition_by) <= set(key):
        raise ValueError("partition columns must be part of the key")
    new = dedupe_latest(df, keys=key)
    if path_exists(spark, path):
        stored = spark.read.format(fmt).load(path)
        if partition_values is not None and len(partition_by) == 1:
            stored = stored.filter(F.col(partition_by[0]).isin(list(partition_values)))
        new = new.join(stored.select(*key), key, "left_anti")
    new = new.hint("rebalance", *partition_by) if partition_by else new
    return write_counted(new, lambda d: d.write.format(fmt).mode("append")
                         .partitionBy(*partition_by).save(path))


@dataclass
class Upserted:
    """``changed``: keys that are new or have a new row; ``rejected``: rows of the batch
    without a key; ``first_dates``: for each ticker that changed its earliest changed date; ``places``: the
    partitions that changed, buckets by month; ``base``, ``made``: the table's versions before and after."""

    changed: int
    rejected: int
    first_dates: DataFrame
    places: dict[str, list[int]]
    base: PB.Version
    made: PB.Version


def located(df: DataFrame, n_buckets: int) -> DataFrame:
    return df.withColumns({BUCKET: ticker_bucket(F.col("ticker"), n_buckets), MONTH: F.date_format("date", "yyyy-MM")})


def _in_partitions(places: dict[str, list[int]]) -> Column:
    """A static filter on the partition columns: buckets by month."""
    return reduce(or_, [(F.col(MONTH) == m) & F.col(BUCKET).isin(ids) for m, ids in sorted(places.items())], F.lit(False))


def _places(df: DataFrame) -> dict[str, list[int]]:
    """The (month, bucket) partitions of a frame: one row a month and bucket at most."""
    found: dict[str, list[int]] = {}
    for m, b in df.select(MONTH, BUCKET).distinct().collect():
        found.setdefault(m, []).append(b)
    return found


def upsert_latest(spark: SparkSession, df: DataFrame, path: str, n_buckets: int | None = None) -> Upserted:
    """Merge a batch into the price table: one row per (ticker, date), the newest ingest wins,
    of equal ingest dates the batch wins over what is stored.

    Running the same batch again changes nothing and writes nothing. Columns that only one side
    has are NULL on the other, so the table's schema grows with its sources (read it with
    ``read_prices``). Rows without a ticker, date or ingest date are rejected and counted. The change is published at
    once; if another writer changed the same partitions meanwhile, the merge is made again with its rows."""
    path = path.rstrip("/")
    rejected = reject_counts(df).first()["rejected"]
    n = bucket_count(spark, path, n_buckets)
    with stored_once(located(dedupe_latest(keyed_rows(df)), n)) as new:  # once for all the steps below
        places = _places(new)
        for _ in range(PB.ATTEMPTS):
            try:
                return _merged_once(spark, new, places, path, rejected)
            except PB.Conflict:
                continue
        raise PB.Conflict(f"{path} changed under {PB.ATTEMPTS} attempts to merge")


def _merged_once(spark: SparkSession, new: DataFrame, places: dict[str, list[int]], path: str, rejected: int) -> Upserted:
    base = PB.current(spark, path)
    old = PB.read(spark, path, base, _within(places), merge_schema=True) if places else None
    if old is None:  # every row of the batch is new
        return _published(spark, new.withColumn("_changed", F.lit(True)), path, rejected, base)
    with stored_once(_rows_of_both(new, old.filter(_in_partitions(places)))) as merged:
        return _published(spark, merged, path, rejected, base)


def _published(spark: SparkSession, merged: DataFrame, path: str, rejected: int, base: PB.Version) -> Upserted:
    changed = merged.filter("_changed")
    places = _places(changed)
    ensure_checkpoint_dir(spark)
    with freed_shuffles(spark):
        first = changed.groupBy("ticker").agg(F.min("date").alias("first_date")).checkpoint()
    if not places:
        return Upserted(0, rejected, first, {}, base, base)
    out = (merged.filter(_in_partitions(places)).hint("rebalance", MONTH, BUCKET)
           .sortWithinPartitions(MONTH, BUCKET, "ticker", "date"))
    obs = Observation("changed")
    out = out.observe(obs, F.count_if("_changed").alias("rows")).drop("_changed")
    staged = PB.stage(out, path, [MONTH, BUCKET])
    made = PB.publish(spark, path, base, staged)
    return Upserted(int(obs.get["rows"]), rejected, first, places, base, made)


def _rows_of_both(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Each key's row of a batch and a stored table, which have one a key: the newest ingest, the batch's of equal ones;
    ``_changed``: it is not the stored one. Rows are matched by a join, so each is shuffled once and as it is."""
    n, o = F.col("n"), F.col("o")
    pairs = new.select(*KEY, F.struct(*new.columns).alias("n")).join(stored.select(*KEY, F.struct(*stored.columns).alias("o")), KEY, "full")
    is_new = o.isNull() | F.coalesce(n["ingestion_timestamp"] >= o["ingestion_timestamp"], F.lit(False))
    side = lambda s, df, c: s[c] if c in df.columns else F.lit(None)
    columns = [*new.columns, *[c for c in stored.columns if c not in new.columns]]
    same = o.isNotNull()
    for c in columns:
        same = same & (~is_new | side(n, new, c).eqNullSafe(side(o, stored, c)))
    return pairs.select(*[F.when(is_new, side(n, new, c)).otherwise(side(o, stored, c)).alias(c) for c in columns],
                        (~same).alias("_changed"))


def _within(places: dict[str, list[int]]):
    """The partitions of ``places``, by their names' values."""
    return lambda v: int(v[BUCKET]) in places.get(v[MONTH], ())


def read_prices(spark: SparkSession, path: str, tickers: DataFrame | list[str] | None = None,
                start=None, at: PB.Version | None = None, places: dict[str, list[int]] | None = None, by_ticker: bool = False) -> DataFrame:
    """The price table, optionally for some tickers, from a date on, or of some partitions (buckets by month): static
    filters on bucket and month. ``at``: a version of the table, the newest one if not given. ``by_ticker``: dealt out by
    ticker before anything else, so joins, grouping and windows by ticker that follow shuffle no rows again."""
    month = f"{start:%Y-%m}" if start is not None else None
    table = _pruned(spark, path, tickers, at, lambda v: (month is None or v[MONTH] >= month) and (
        places is None or _within(places)(v)), True, by_ticker)
    if table is None:
        raise FileNotFoundError(f"no price table at {path}")
    if start is not None:
        table = table.filter((F.col(MONTH) >= month) & (F.col("date") >= F.lit(start)))
    if places is not None:
        table = table.filter(_in_partitions(places))
    return table.drop(BUCKET, MONTH)


def _pruned(spark: SparkSession, path: str, tickers: DataFrame | list[str] | None, at: PB.Version | None, keep, merge_schema: bool,
            by_ticker: bool = False) -> DataFrame | None:
    """Rows of the tickers; their buckets (at most as many integers as the table has) choose the folders that are listed at
    all, and are a static partition filter. An existing table of which nothing is chosen has no rows."""
    path = path.rstrip("/")
    at = at or PB.current(spark, path)
    if not at.parts:
        return None
    ids = names = None
    if tickers is not None:
        names = None if isinstance(tickers, DataFrame) else sorted(set(tickers))
        frame = tickers if names is None else spark.createDataFrame([(t,) for t in names], "ticker string")
        ids = bucket_ids(frame, bucket_count(spark, path, None))
    table = PB.read(spark, path, at, lambda v: keep(v) and (ids is None or int(v[BUCKET]) in ids), merge_schema)
    if table is None:
        one = next(iter(at.parts))
        table = PB.read(spark, path, PB.Version(at.number, {one: at.parts[one]}), None, merge_schema).filter(F.lit(False))
    if ids is not None:
        table = table.filter(F.col(BUCKET).isin(ids))
    if by_ticker:
        table = table.repartition("ticker")
    if ids is None:
        return table
    if names is not None:
        return table.filter(F.col("ticker").isin(names))
    return table.join(tickers.select("ticker").distinct(), "ticker", "left_semi")


def overwrite_buckets(df: DataFrame, path: str, n_buckets: int | None = None, touched: list[int] | None = None,
                      base: PB.Version | None = None) -> int:
    """Write a feature frame partitioned by ticker bucket, replacing only the
    buckets present in ``df``, all at once. Files are sorted
    by (ticker, date) so readers skip row groups by ticker statistics.

    ``touched``: the buckets that ``df`` was made for; one that has no rows left is cleared. ``base``: the version that
    ``df`` was made from; ``published.Conflict`` if one of its buckets has changed since."""
    spark, path = df.sparkSession, path.rstrip("/")
    n = bucket_count(spark, path, n_buckets)
    base = base or PB.current(spark, path)
    out = (df.withColumn(BUCKET, ticker_bucket(F.col("ticker"), n))
             .hint("rebalance", BUCKET)
             .sortWithinPartitions(BUCKET, "ticker", "date"))
    obs = Observation("buckets")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    staged = PB.stage(out, path, [BUCKET])
    PB.publish(spark, path, base, {**{f"{BUCKET}={b}": [] for b in touched or ()}, **staged})
    return int(obs.get["rows"])


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                    fmt: str = "parquet") -> int:
    """Replace the whole table at ``path``."""
    w = lambda d: (d.write.format(fmt).mode("overwrite")
                   .partitionBy(*(partition_by or [])).save(path))
    return write_counted(df, w)


def save_as_table(df: DataFrame, name: str, fmt: str = "parquet") -> int:
    """Create or replace a catalog table from a typed frame (no temp view)."""
    return write_counted(df, lambda d: d.write.format(fmt).mode("overwrite").saveAsTable(name))


def read_features(spark: SparkSession, path: str, tickers: DataFrame | list[str] | None = None,
                  n_buckets: int | None = None, at: PB.Version | None = None) -> DataFrame:
    """Read a ticker-bucket feature table, optionally for some tickers only.

    The bucket ids of a ticker list or frame -- at most as many integers as the table has
    buckets -- are a static partition filter, so only those bucket folders are listed and
    read; the ticker predicate (a semi-join for a frame) then picks the rows inside."""
    bucket_count(spark, path, n_buckets)
    table = _pruned(spark, path, tickers, at, lambda v: True, False)
    if table is None:
        raise FileNotFoundError(f"no feature table at {path}")
    return table.drop(BUCKET, MONTH)
