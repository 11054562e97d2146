"""Landing zone with a fault domain per file: one bad file does not stop the others.

The files of a landing zone are listed by Spark (names and sizes only) and probed in two passes
by its tasks: footers (how many rows a Parquet file says it has; no pages are read), then all declared columns. A
task that can't read on leaves the rest of its file out instead of failing, so what a file gave is compared
with what it holds:

* ``ok``           every row was read, and some row has a ticker and a date;
* ``empty``        a readable file without rows;
* ``quarantined``  with a reason: no footer or a broken page, a foreign type or header, no usable row.

Only the ``ok`` files are read for the result, by name, so a file that lands meanwhile is left to the next run
and no row of a quarantined file is used. The table of files is checkpointed: decision and report are the same. A driver holds one
row per file, as Spark's own listing does.

A compressed text file says nowhere how many rows it has: one that ends early counts as far as it can be read.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwise.session import ensure_checkpoint_dir
from tickwise.sources import prices as SP
from tickwise.sources import sinks as SK

OK, EMPTY, QUARANTINED = "ok", "empty", "quarantined"
# Text of a file's first line that a reason quotes.
QUOTED = 120
# Bytes of a Parquet file without its pages: magic, footer length, magic.
PARQUET_MAGIC, PARQUET_LEAST = "PAR1", 12
# A file without a readable row is looked into up to this size (Spark's limit for a value is 2 GB).
MAX_PROBED = 1 << 30
FILE_KEY = ["path", "length", "modified"]


@dataclass
class Landed:
    """``rows``: price rows of the ``ok`` files; ``files``: path, length, modified, rows, status, reason."""

    rows: DataFrame
    files: DataFrame


def literal(path: str) -> str:
    """A file's name with no character that a path pattern would read."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _file() -> Column:
    """The name of a row's file; Spark gives it as an encoded URL, in which ``+`` stands for itself."""
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(name, "^([A-Za-z0-9]+):///", "$1:/").alias("path")


def _read(spark: SparkSession, names: list[str], fmt: str, extra: StructType | None, options: dict | None) -> DataFrame:
    """The declared columns of the files, and ``path``. Folders may differ from file to file, so Spark does not look for
    partitions; a declared column that a file lacks is taken from a folder ``column=value`` above it."""
    given = {**({"header": "true", "enforceSchema": "false"} if fmt == "csv" else {}), **(options or {})}
    schema = SP.landing_schema(fmt, extra)
    raw = (spark.read.schema(schema).options(**{**given, "ignoreCorruptFiles": "true", "recursiveFileLookup": "true"})
           .format(fmt).load([literal(n) for n in names]).select("*", _file()))
    folders = {k for n in names for k in re.findall(r"/([^/=]+)=[^/]*(?=/)", n)}
    for f in schema.fields:
        if f.name in folders:
            value = F.regexp_extract("path", f"/{re.escape(f.name)}=([^/]*)/", 1)
            value = F.when(~value.isin("", "__HIVE_DEFAULT_PARTITION__"), F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))
            raw = raw.withColumn(f.name, F.coalesce(F.col(f"`{f.name}`"), value.try_cast(f.dataType)))
    return raw


def list_files(spark: SparkSession, paths: str | list[str], name_filter: str | None = None) -> DataFrame:
    """``path, length, modified`` of all files below ``paths``; nothing is read of them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(paths).select(_file(), F.col("_metadata.file_size").alias("length"),
                                     F.col("_metadata.file_modification_time").alias("modified"))


def _broken_parquet(spark: SparkSession, names: list[str]) -> DataFrame:
    """``path, why`` of files without rows that are no whole Parquet file."""
    text = F.col("content").cast("string")
    whole = (F.length("content") >= PARQUET_LEAST) & text.startswith(PARQUET_MAGIC) & text.endswith(PARQUET_MAGIC)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([literal(n) for n in names])
    small = files.filter(F.col("length") <= MAX_PROBED).filter(~whole).select(
        _file(), F.lit("no Parquet footer: truncated, or another format").alias("why"))
    large = files.filter(F.col("length") > MAX_PROBED).select(_file(), F.lit("no row can be read").alias("why"))
    return small.unionByName(large)


def _foreign_csv(spark: SparkSession, names: list[str], extra: StructType | None, options: dict | None) -> DataFrame:
    """``path, why`` of files whose first line is not the declared header. Spark compares it where a file begins
    only, so the other parts of a large file would be read."""
    own = {k.lower(): v for k, v in (options or {}).items()}
    if str(own.get("header", "true")).lower() != "true":
        return spark.createDataFrame([], "path string, why string")
    header = [f.name for f in SP.landing_schema("csv", extra).fields]
    lines = spark.read.option("ignoreCorruptFiles", "true").text([literal(n) for n in names], recursiveFileLookup=True).select(_file(), "value", F.monotonically_increasing_id().alias("at"))
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))
    cells = F.transform(F.split("line", re.escape(own.get("sep", own.get("delimiter", ",")))), lambda c: F.trim(F.btrim(c, F.lit('"'))))
    return first.filter(cells != F.array(*[F.lit(n) for n in header])).select(
        "path", F.concat(F.lit("foreign header: "), F.substring("line", 1, QUOTED)).alias("why"))


def probe_files(spark: SparkSession, paths: str | list[str], fmt: str = "parquet", extra: StructType | None = None,
                options: dict | None = None) -> DataFrame:
    """One row per file: ``path, length, modified, rows`` (read), ``status`` and ``reason``; a checkpointed table."""
    ensure_checkpoint_dir(spark)
    files = list_files(spark, paths).checkpoint()
    names = [r[0] for r in files.select("path").collect()]  # one row a file
    if not names:
        return files.select(*FILE_KEY, F.lit(0).cast("bigint").alias("rows"), F.lit(EMPTY).alias("status"), F.lit(None).cast("string").alias("reason"))
    raw = _read(spark, names, fmt, extra, options)
    # the hash of all columns makes the tasks read them
    columns = [F.col(f"`{c}`") for c in raw.columns if c != "path"]
    read = raw.select("path", F.xxhash64(*columns).alias("h"), (F.col("ticker").isNotNull() & F.col("Date").isNotNull()).alias("keyed"))
    found = read.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.count_if("keyed").alias("keyed"), F.bit_xor("h").alias("digest"))
    if fmt == "parquet":
        said = raw.groupBy("path").agg(F.count(F.lit(1)).alias("said"))
        found = found.join(said, "path", "full")
    else:
        found = found.withColumn("said", F.col("rows"))
    found = files.join(found, "path", "left").fillna(0, ["rows", "keyed", "said"]).checkpoint()
    asked = names
    if fmt == "parquet":
        asked = [r[0] for r in found.filter("said = 0").select("path").collect()]
    why = F.when(F.col("rows") < F.col("said"), F.concat(F.col("rows").cast("string"), F.lit(" of "), F.col("said").cast("string"), F.lit(" rows can be read"))) \
           .when((F.col("rows") > 0) & (F.col("keyed") == 0), "no row has a ticker and a date")
    if asked and fmt in ("parquet", "csv"):
        broken = _broken_parquet(spark, asked) if fmt == "parquet" else _foreign_csv(spark, asked, extra, options)
        found = found.join(broken, "path", "left")
        why = F.coalesce(why, "why")
    status = F.when(F.col("reason").isNotNull(), QUARANTINED).when(F.col("rows") == 0, EMPTY).otherwise(OK)
    return (found.withColumn("reason", why).withColumn("status", status)
            .select(*FILE_KEY, "rows", "status", "reason", "digest").checkpoint())


def scan_landing_files(spark: SparkSession, paths: str | list[str], fmt: str = "parquet", run_date: dt.date | None = None,
                       start=None, end=None, tickers: list[str] | None = None, options: dict | None = None,
                       extra: StructType | None = None) -> Landed:
    """``prices.scan_landing`` over the readable files, and the table of all files.

    Defined results: no file, or none that is ``ok``, gives no rows (``prices.require_any`` and the daily run raise then)."""
    files = probe_files(spark, paths, fmt, extra, options)
    good = [r[0] for r in files.filter(F.col("status") == OK).select("path").collect()]  # one row a file
    raw = _read(spark, good, fmt, extra, options).drop("path") if good else spark.createDataFrame([], SP.landing_schema(fmt, extra))
    rows = SP.normalize_source(raw, run_date or dt.date.today(), extra=[f.name for f in extra.fields] if extra else None)
    return Landed(SP.restrict(rows, start, end, tickers), files)


def quarantined(files: DataFrame, run_date: dt.date) -> DataFrame:
    """The rows of a quarantine table: file, what could be read of it, reason, and when it was found."""
    return files.filter(F.col("status") == QUARANTINED).select(
        *FILE_KEY, "rows", "reason", F.lit(run_date).cast("date").alias("found_on"))


def record_quarantine(spark: SparkSession, files: DataFrame, path: str, run_date: dt.date) -> int:
    """Append what is quarantined to the table at ``path``, once a file as it is; returns the rows added."""
    return SK.append_new(spark, quarantined(files, run_date), path, key=FILE_KEY, partition_by=[])


def file_summary(files: DataFrame) -> DataFrame:
    """One row: files, and how many of them are ok, empty and quarantined; rows read of the ok ones."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    return files.agg(F.count(F.lit(1)).alias("files"), is_(OK).alias("ok_files"), is_(EMPTY).alias("empty_files"),
                     is_(QUARANTINED).alias("quarantined_files"),
                     F.coalesce(F.sum(F.when(F.col("status") == OK, F.col("rows"))), F.lit(0)).cast("bigint").alias("ok_rows"))
