"""Typed projection, invalid-row drop, deterministic dedupe, sanity filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.exprs import is_missing
from tickwise.schemas import CRITICAL_COLUMNS, PRICE_SCHEMA

KEY = ["ticker", "date"]
# Newest ingest first; the value columns make the choice total.
DEDUPE_ORDER = ["ingestion_timestamp", "close", "open", "high", "low",
                "adj_close", "volume"]


def parsed(col, data_type):
    """Cast a column; unparsable values become NULL. Text and floating values
    of an integral column may carry a zero fraction (``1000.0``)."""
    if data_type.typeName() not in ("long", "integer", "short", "byte"):
        return col.try_cast(data_type)
    number = col.try_cast("decimal(38,10)")
    return F.coalesce(F.when(number == F.floor(number), number).try_cast(data_type),
                      col.cast("string").try_cast(data_type))


def typed_projection(df: DataFrame, schema=PRICE_SCHEMA) -> DataFrame:
    """Cast every declared column (``parsed``)."""
    return df.select(*[parsed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def unparsed_counts(df: DataFrame, schema=PRICE_SCHEMA) -> DataFrame:
    """Per declared column: values that are present but can't be parsed, in one pass."""
    found = df.agg(*[F.count_if(F.col(f.name).isNotNull() & parsed(F.col(f.name), f.dataType).isNull()).alias(f.name)
                     for f in schema.fields])
    return found.unpivot([], [f.name for f in schema.fields], "column_name", "unparsed")


def required_columns(schema=PRICE_SCHEMA) -> list[str]:
    """The columns that the schema declares NOT NULL."""
    return [f.name for f in schema.fields if not f.nullable]


def keyed_rows(df: DataFrame, schema=PRICE_SCHEMA) -> DataFrame:
    """Rows whose NOT NULL columns are all there."""
    return df.dropna(subset=[c for c in required_columns(schema) if c in df.columns])


def reject_counts(df: DataFrame, schema=PRICE_SCHEMA) -> DataFrame:
    """One row: rows, and rows rejected for a NULL in a NOT NULL column."""
    missing = F.lit(False)
    for c in required_columns(schema):
        missing = missing | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("rejected"))


def drop_invalid(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with NULL or NaN in any critical column."""
    return df.dropna(subset=subset or CRITICAL_COLUMNS)


def valid_row(df: DataFrame, subset: list[str] | None = None):
    """Boolean column: the row survives ``drop_invalid``."""
    cond = F.lit(True)
    types = dict(df.dtypes)
    for c in subset or CRITICAL_COLUMNS:
        miss = is_missing(F.col(c)) if types[c] in ("double", "float") else F.col(c).isNull()
        cond = cond & ~miss
    return cond


def dedupe_latest(df: DataFrame, keys: list[str] | None = None,
                  order: list[str] | None = None) -> DataFrame:
    """One row per key: the newest ingest, ties broken by the value columns,
    then by every other column that can be ordered, so the choice is total.

    A grouped maximum (not a window): each map task reduces its copies of
    a key to one before the shuffle, so a key with a huge number of copies
    costs one row per task, not one task holding all of them.
    """
    keys = keys or KEY
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in (order or DEDUPE_ORDER) if c in rest]
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    order += [c for c in rest if c not in order and kinds[c] not in ("map", "variant")]
    # what can be ordered is its own order: the row is carried once
    newest = F.max(F.struct(*order)) if len(order) == len(rest) else F.max_by(F.struct(*rest), F.struct(*order))
    picked = df.groupBy(*keys).agg(newest.alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]) \
                 .select(*df.columns)


def clean(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop invalid rows, then keep one row per (ticker, date)."""
    return dedupe_latest(drop_invalid(df, subset))


def clean_counts(df: DataFrame, by_ticker: bool = True) -> DataFrame:
    """Rows before / after cleaning and removed, in one pass over the input.

    rows_after = number of distinct keys among valid rows, which is exactly
    what ``clean`` keeps.
    """
    valid = valid_row(df)
    aggs = [F.count(F.lit(1)).alias("rows_before"),
            F.count_distinct(F.when(valid, F.struct(*KEY))).alias("rows_after")]
    grouped = df.groupBy("ticker") if by_ticker else df.groupBy()
    out = grouped.agg(*aggs)
    return out.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def negative_prices(df: DataFrame) -> DataFrame:
    """Rows with a negative close or open."""
    return df.filter((F.col("close") < 0) | (F.col("open") < 0))


def negative_price_counts(df: DataFrame) -> DataFrame:
    """Per ticker: rows and rows with a negative open/close (one pass)."""
    return df.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((F.col("close") < 0) | (F.col("open") < 0)).alias("negative_rows"))
