"""Incremental ingest of a quote landing zone with Structured Streaming.

The daily load job as a file stream: each new file in the landing zone
is read once (the stream checkpoint records which files were processed) with the declared
schema, normalised to the price schema and merged with ``upsert_latest``;
features of the tickers that changed are then refreshed from their earliest changed
date on, or from the rolling state if one is named. A batch that is replayed after a failure changes nothing: it has the
ingest date that was recorded for it the first time.

Run it with ``trigger(availableNow=True)`` for a scheduled job that drains
what has landed and stops, or with a processing-time trigger to keep it
running.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickwise.plans.daily_run import refresh_by_state
from tickwise.plans.refresh import refresh_features
from tickwise.sources import landing as LA
from tickwise.sources import prices as SP
from tickwise.sources import sinks as SK


def epoch_date(spark: SparkSession, checkpoint_path: str, epoch_id: int, today: dt.date) -> dt.date:
    """The ingest date of a micro-batch: ``today`` when it is first seen, the
    recorded date when it is replayed."""
    path = f"{checkpoint_path.rstrip('/')}/ingest_dates/{epoch_id}"
    return dt.date.fromisoformat(SK.write_text_once(spark, path, today.isoformat()))


def start_ingest(spark: SparkSession, landing_path: str, prices_path: str,
                 checkpoint_path: str, run_date: dt.date | None = None, features_path: str | None = None,
                 fmt: str = "parquet", available_now: bool = True,
                 variant: str = "close_to_close",
                 n_buckets: int | None = None, quarantine_path: str | None = None,
                 state_path: str | None = None) -> StreamingQuery:
    """Start the landing-zone stream; returns the running query.

    Each micro-batch gets the date it is first run on, or ``run_date`` for a backfill.

    With ``state_path`` a micro-batch costs what it touches, as in ``daily_run.run_daily``.

    With ``quarantine_path`` the stream is one of file names: each micro-batch probes its files as the batch job does, reads
    those that can be read and records the others there, so a bad file does not stop the stream."""
    if quarantine_path:
        stream = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
                  .option("recursiveFileLookup", "true").load(landing_path).select("path"))
    else:
        reader = spark.readStream.format(fmt).schema(SP.landing_schema(fmt))
        if fmt == "csv":
            reader = reader.option("header", "true").option("enforceSchema", "false")
        stream = reader.load(landing_path)

    def landed_rows(batch: DataFrame, day: dt.date) -> DataFrame:
        if not quarantine_path:
            return SP.normalize_source(batch, day)
        names = [LA.literal(r[0]) for r in batch.collect()]  # one row a file
        landed = LA.scan_landing_files(batch.sparkSession, names, fmt, day)
        LA.record_quarantine(batch.sparkSession, landed.files, quarantine_path, day)
        return landed.rows

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        own = batch.sparkSession
        day = epoch_date(own, checkpoint_path, epoch_id, run_date or dt.date.today())
        done = SK.upsert_latest(own, landed_rows(batch, day), prices_path, n_buckets)
        if features_path and state_path:
            refresh_by_state(own, prices_path, features_path, state_path, done, day, variant, n_buckets)
        elif features_path:
            refresh_features(own, prices_path, features_path, done.first_dates, day, variant, n_buckets)

    writer = (stream.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
