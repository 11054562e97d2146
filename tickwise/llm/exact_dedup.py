"""Exact dedup: group by a 128-bit content hash and compare bytes inside groups.

The grouping key of the one wide shuffle is (128-bit hash, SHA-256,
normalised text). Grouping by the text itself is the byte comparison: two
texts share a class only if all their bytes agree, whatever their hashes do.
Map-side aggregation keeps one copy of a text per task, so a text that makes up
a third of all rows costs each reducer one row per map task. The documents (id, hashes and a place, no
text) are checkpointed, the one that stays is picked by map-side aggregation, and they are joined to their class by
the two hashes alone; a hot class is a skewed join key, which AQE splits, and of rows that repeat id and
text the first place stays, so no row has to be regrown.

Two different texts that agree in the 128-bit hash are told apart by their
SHA-256. Should texts ever agree in both, the job stops with an error
instead of merging them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickwise.llm.textblocks import column
from tickwise.session import ensure_checkpoint_dir


def md5_128(text: bytes) -> bytes:
    return hashlib.md5(text, usedforsecurity=False).digest()


def ascii_lower(text: bytes) -> bytes:
    """Lower-case A-Z and nothing else (``bytes.lower`` is ASCII only)."""
    return text.lower()


def _hashed(docs: DataFrame, id_col: str, text_col: str, normalise: Callable[[bytes], bytes],
            content_hash: Callable[[bytes], bytes], with_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            norm = [normalise(t.as_buffer().to_pybytes()) if t.is_valid else b"" for t in texts.cast(pa.large_binary())]
            out = [ids, pa.array([content_hash(t) for t in norm], pa.binary()),
                   pa.array([hashlib.sha256(t).hexdigest() for t in norm], pa.string())]
            names = ["id", "h", "sha"]
            if with_text:
                out.append(pa.array(norm, pa.binary()))
                names.append("norm")
            yield pa.RecordBatch.from_arrays(out, names)

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, h binary, sha string" + ", norm binary" * with_text)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                normalise: Callable[[bytes], bytes] = ascii_lower,
                content_hash: Callable[[bytes], bytes] = md5_128) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    ``keep``: ``smallest`` or ``largest`` id of equal texts stays. Defined
    results: a null text is the empty text; a null id never wins against an
    id, and a group of null ids only has a null ``keep_id``; of repeated rows with
    the same id and text exactly one is kept; no rows in, no rows out. Other
    columns of ``docs`` are not read, so their names can't clash.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is 'smallest' or 'largest', not {keep!r}")
    ensure_checkpoint_dir(docs.sparkSession)
    # one key column: both sides are dealt out anew for the joins, so a hot class can be split
    key = F.concat("h", F.col("sha").cast("binary"))
    texts = (_hashed(docs, id_col, text_col, normalise, content_hash, True).groupBy("h", "sha", "norm").agg(F.count(F.lit(1)).alias("n"))
             # one text per (h, sha): a second one would be a double collision
             .groupBy("h", "sha").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n")).select(
                 key.alias("key"), F.when(F.col("texts") == 1, F.col("n")).otherwise(
                     F.raise_error(F.lit("two texts agree in both content hashes")).cast("long")).alias("group_size")))
    # each row has a place of its own, settled by the checkpoint, which tells repeated rows apart
    rows = _hashed(docs, id_col, text_col, normalise, content_hash, False).select(
        "id", "sha", key.alias("key"), F.monotonically_increasing_id().alias("place")).checkpoint()
    known = F.col("id").isNotNull()
    if keep == "smallest":
        best = F.min(F.struct((~known).alias("none"), F.col("id"), F.col("place")))
    else:
        best = F.max(F.struct(known.alias("none"), F.col("id"), (-F.col("place")).alias("place")))
    stays = rows.groupBy("key").agg(best.alias("best")).select("key", F.col("best.id").alias("keep_id"), F.abs("best.place").alias("keep_place"))
    classes = texts.join(stays, "key").select(F.concat("key", F.lit(b"#")).alias("of"), "group_size", "keep_id", "keep_place")
    out = rows.withColumn("of", F.concat("key", F.lit(b"#"))).join(classes, "of")
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"),
                      F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                      normalise: Callable[[bytes], bytes] = ascii_lower) -> DataFrame:
    """``docs`` with one row per distinct text, all columns as they were."""
    kept = exact_dedup(docs, id_col, text_col, keep, normalise).filter("kept").select(
        F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"))

    # the text's hash tells repeated ids with different texts apart
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = column(b, text_col).cast(pa.large_binary())
            sha = [hashlib.sha256(normalise(t.as_buffer().to_pybytes()) if t.is_valid else b"").hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sha, pa.string())], [*b.schema.names, "__tag"])

    tagged = docs.mapInArrow(tag, StructType([*docs.schema.fields, StructField("__tag", StringType())]))
    out = tagged.join(kept, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tag") == F.col("__sha")), "left_semi")
    return out.dropDuplicates([id_col, "__tag"]).select(*[F.col(f"`{c}`") for c in docs.columns])
