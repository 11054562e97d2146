"""Price-history sources.

The quote download of the original is re-aimed as a scan of a landing zone
(parquet/CSV/JSON files written by whatever fetches quotes): one set-based,
date- and ticker-bounded read for all tickers, no per-ticker loop and no
data through the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwise.operators.clean import parsed
from tickwise.schemas import (DEFAULT_LOOKBACK_DAYS, LANDING_SCHEMA, LANDING_TEXT_SCHEMA,
                              PRICE_SCHEMA, SOURCE_RENAMES)


class MissingTableError(RuntimeError):
    pass


def default_range(run_date: dt.date, start: dt.date | None = None,
                  end: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """A download window [start, end): end defaults to run_date, start to 365
    days before end. What has landed is not cut to it unless the caller asks."""
    end = end or run_date
    start = start or (end - dt.timedelta(days=DEFAULT_LOOKBACK_DAYS))
    return start, end


def restrict(df: DataFrame, start=None, end=None, tickers: list[str] | None = None) -> DataFrame:
    """Rows with start <= date < end and ticker in ``tickers`` (if given);
    the predicates reach the parquet scan."""
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") < F.lit(end).cast("date"))
    if tickers is not None:
        df = df.filter(F.col("ticker").isin(list(tickers)))
    return df


def normalize_source(raw: DataFrame, ingest_date, ticker: str | None = None,
                     extra: list[str] | None = None) -> DataFrame:
    """Source columns to the price schema: snake-case names, timestamps to
    dates (any time zone or offset dropped: the date as written), ticker and ingest-date tags, adj_close
    falling back to close, declared types (unparsable values -> NULL;
    ``clean.unparsed_counts`` counts them). ``extra`` columns are kept as
    they are behind the declared ones."""
    return named_source(raw, ingest_date, ticker).select(
        *[parsed(F.col(f.name), f.dataType).alias(f.name) for f in PRICE_SCHEMA.fields],
        *[F.col(f"`{c}`") for c in extra or []])


def named_source(raw: DataFrame, ingest_date, ticker: str | None = None) -> DataFrame:
    """``normalize_source`` before the values are parsed."""
    df = raw.withColumnsRenamed({k: v for k, v in SOURCE_RENAMES.items() if k in raw.columns})
    if ticker is not None:
        df = df.withColumn("ticker", F.lit(ticker))
    # text is read without a zone: an offset is dropped and the exchange's own date stays
    df = df.withColumn("date", F.col("date").try_cast("timestamp_ntz").cast("date")
                       if dict(df.dtypes)["date"] == "string" else F.to_date("date"))
    return with_adj_close(df).withColumn("ingestion_timestamp", F.lit(ingest_date).cast("date"))


def with_adj_close(df: DataFrame) -> DataFrame:
    """adj_close := close when the column is absent, or per row when NULL."""
    if "adj_close" not in df.columns:
        return df.withColumn("adj_close", F.col("close"))
    return df.withColumn("adj_close", F.coalesce(F.col("adj_close"), F.col("close")))


def landing_schema(fmt: str, extra: StructType | None = None) -> StructType:
    """The declared file layout of a format, with declared additional columns."""
    base = LANDING_TEXT_SCHEMA if fmt in ("csv", "json") else LANDING_SCHEMA
    return StructType([*base.fields, *(extra.fields if extra else [])])


def scan_landing(spark: SparkSession, path: str, fmt: str = "parquet",
                 run_date: dt.date | None = None, start=None, end=None,
                 tickers: list[str] | None = None, options: dict | None = None,
                 extra: StructType | None = None) -> DataFrame:
    """Read quote files from a landing zone with the declared schema and return
    price-schema rows for the requested tickers, all dates unless ``start`` (inclusive) or
    ``end`` (exclusive) says otherwise. Files must carry a ``ticker`` column (or a partition
    directory ``ticker=...``). A column that a file lacks is NULL there;
    ``extra`` declares additional source columns to keep. A CSV header that
    does not follow the declared order is an error, not a shift of columns."""
    reader = spark.read.schema(landing_schema(fmt, extra)).options(**{
        **({"header": "true", "enforceSchema": "false"} if fmt == "csv" else {}), **(options or {})})
    raw = reader.format(fmt).load(path)
    rows = normalize_source(raw, run_date or dt.date.today(), extra=[f.name for f in extra.fields] if extra else None)
    return restrict(rows, start, end, tickers)


def source_status(requested: DataFrame, rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per requested ticker: ok/failed and its row count, plus total_rows,
    the rows of all requested tickers together (a scalar subquery over the
    per-ticker result, not a window that would gather it in one task).

    ``files``: the table of landed files (``landing.scan_landing_files``); bad_files is then the number of
    those that could not be used, in which a failed ticker's rows may be."""
    counts = rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("row_count"))
    out = (requested.select("ticker").distinct().join(counts, "ticker", "left")
                    .select("ticker",
                            F.when(F.col("row_count") > 0, "ok").otherwise("failed").alias("status"),
                            F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint").alias("row_count")))
    total = out.agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint")).scalar()
    out = out.withColumn("total_rows", total)
    if files is None:
        return out
    bad = files.agg(F.count_if(F.col("status") == "quarantined")).scalar()
    return out.withColumn("bad_files", bad)


def require_any(status: DataFrame) -> None:
    """Raise when no requested ticker produced rows (an action on the small
    per-ticker status frame)."""
    if status.filter(F.col("status") == "ok").isEmpty():
        raise MissingTableError("no data for any requested ticker")


def read_table(spark: SparkSession, name: str, on_missing: str = "error") -> DataFrame | None:
    """Catalog scan guarded by ``tableExists``: on_missing = 'error' raises,
    'skip' returns None (``quality.validate_source`` turns that into failed rows)."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    if on_missing == "skip":
        return None
    raise MissingTableError(f"table {name} does not exist")


def read_path(spark: SparkSession, path: str, fmt: str = "parquet",
              on_missing: str = "error") -> DataFrame | None:
    """Path scan with the same policy as ``read_table``."""
    try:
        return spark.read.format(fmt).load(path)
    except Exception as e:  # noqa: BLE001 - Spark raises AnalysisException
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            if on_missing == "skip":
                return None
            raise MissingTableError(f"no table at {path}") from e
        raise


def register_view(df: DataFrame, name: str) -> str:
    """Expose a frame to SQL under ``name`` (session scoped)."""
    df.createOrReplaceTempView(name)
    return name


def ticker_sql(spark: SparkSession, prices: DataFrame, ticker: str) -> DataFrame:
    """Parameterised SQL scan with a ticker predicate."""
    return spark.sql("SELECT * FROM {prices} WHERE ticker = :ticker",
                     args={"ticker": ticker}, prices=prices)
