r"""Target-distribution importance resampling on hashed word n-grams.

Texts are scanned as the published scripts do it: A-Z is lower-cased, every run of
separators becomes one space, and ``finditer`` with ``overlapped=True`` and boundary
lookarounds gives the span of every n-gram of one size, which stands in the text as it is
counted: its CRC-32 modulo ``buckets`` is its bucket. Overlapping is what makes n-grams
of two words and more start at every word.

1. Both corpora are counted: a task holds one counter per bucket and sends that on,
   so a shuffle moves at most ``buckets`` rows a task, whatever the words are.
2. The bucket table (at most ``buckets`` rows: the bound of its broadcast) has the log ratio of target and
   source, smoothed by one a bucket, as an integer number of thousandths.
3. The second scan sums the gains over each document. Gumbel noise that depends on
   ``seed`` and the id alone is added; the documents with the highest scores are a sample without replacement.
4. Scores are range-partitioned and sorted; a document's rank is its place in its partition behind the
   sizes of those before, so no task ranks more than its range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textblocks import IS_WORD, LOWER, column
from tickwise.session import ensure_checkpoint_dir

BUCKETS, SEED = 10_000, 2024
MIN_WORDS, SHARE = 20, (10, 100)
_CHUNK = 1 << 16  # spans held at once
_SPACED = bytes(np.where(IS_WORD, LOWER, 32).astype(np.uint8))
_GAP = re.compile(rb" {2,}")


@lru_cache(maxsize=None)
def _pattern(n: int):
    """The next ``n`` words between boundaries; no backtracking inside a word."""
    return regex.compile(rb"(?<![^ ])[^ ]++" + rb"(?: [^ ]++)" * (n - 1) + rb"(?![^ ])")


def collapsed(text: bytes) -> bytes:
    """Lower-cased words with one space between; UTF-8 bytes beyond ASCII belong to words."""
    return _GAP.sub(b" ", text.translate(_SPACED))


def spans(text: bytes, n: int) -> Iterator[bytes]:
    """Every run of ``n`` words of a collapsed text."""
    return map(itemgetter(0), _pattern(n).finditer(text, overlapped=True))


def _buckets(text: bytes, sizes: range, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Size and buckets of all n-grams, a bounded number at a time."""
    text = collapsed(text)
    for n in sizes:
        codes = map(crc32, spans(text, n))
        while len(part := np.fromiter(islice(codes, _CHUNK), np.uint32)):
            yield n, part % np.uint32(buckets)


def _texts(b: pa.RecordBatch) -> Iterator[bytes]:
    for t in column(b, "text").cast(pa.large_binary()):
        yield t.as_buffer().to_pybytes() if t.is_valid else b""


def bucket_counts(docs: DataFrame, text_col: str = "text", sizes: range = range(1, 2), buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all texts, for the buckets that have any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for b in batches:
            for text in _texts(b):
                for _, part in _buckets(text, sizes, buckets):
                    counts += np.bincount(part, minlength=buckets)
        has = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(counts[has], pa.int64())], ["bucket", "n"])

    return (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` for every bucket: floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))."""
    none = F.lit(0).cast("long")
    both = source.select("bucket", F.col("n").alias("s"), none.alias("t")).unionByName(
        target.select("bucket", none.alias("s"), F.col("n").alias("t"))).unionByName(
        source.sparkSession.range(buckets).select(F.col("id").alias("bucket"), none.alias("s"), none.alias("t")))
    ensure_checkpoint_dir(source.sparkSession)
    # ``buckets`` rows, read twice below
    one = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).checkpoint()
    all_s, all_t = (one.agg((F.sum(c) + buckets).cast("double").alias("n")).scalar() for c in ("s", "t"))
    smooth = lambda c: (F.col(c) + 1).cast("double")
    ratio = (smooth("t") * all_s) / (smooth("s") * all_t)
    return one.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain"))


def weights(docs: DataFrame, gains: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: range = range(1, 2),
            buckets: int = BUCKETS) -> DataFrame:
    """``id, n_words, n_features, weight`` of every row."""
    table = np.zeros(buckets, np.int64)
    for bucket, gain in gains.select("bucket", "gain").collect():  # ``buckets`` rows
        table[bucket] = gain
    shared = docs.sparkSession.sparkContext.broadcast(table)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            found = np.zeros((b.num_rows, 3), np.int64)
            for r, text in enumerate(_texts(b)):
                if sizes.start > 1:  # words are counted for the length limit
                    found[r, 0] = sum(len(part) for _, part in _buckets(text, range(1, 2), buckets))
                for n, part in _buckets(text, sizes, buckets):
                    found[r] += (len(part) if n == 1 else 0, len(part), gain[part].sum())
            yield pa.RecordBatch.from_arrays([column(b, "id"), *map(pa.array, np.ascontiguousarray(found.T))],
                                             ["id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate from the first 32 bits of sha256(``seed:id``); a null id is the text ``null``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)


def ranked(scored: DataFrame, order: list[Column], eligible: Column) -> DataFrame:
    """Adds ``rank`` (1, 2, 3 ... in ``order``) to the eligible rows and ``n_eligible``; other rows have no rank.

    ``scored`` has to be read the same way each time (a table or a checkpoint). Ties of ``order`` are
    dealt out by the row's place, so equal rows may be a third of all."""
    ensure_checkpoint_dir(scored.sparkSession)
    place = scored.withColumn("__place", F.monotonically_increasing_id())
    rows = place.filter(eligible).orderBy(*order, "__place").withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__at", 33)
    sizes = rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a partition
    before, start = [], 0
    for p, n in sorted(map(tuple, sizes)):
        before.append((p, start))
        start += n
    # one row a partition, as above
    starts = F.broadcast(scored.sparkSession.createDataFrame(before or [(0, 0)], "__part long, __start long"))
    own = rows.join(starts, part == F.col("__part")).withColumn(
        "rank", F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    out = own.select(*scored.columns, "rank").unionByName(
        scored.filter(~F.coalesce(eligible, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))
    return out.withColumn("n_eligible", F.lit(start).cast("long"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             sizes: range = range(1, 2), buckets: int = BUCKETS, min_words: int = MIN_WORDS, share: tuple[int, int] = SHARE,
             seed: int = SEED) -> DataFrame:
    """One row per input row: ``id_col, n_words, n_features, weight, score, rank``.

    ``sizes``: numbers of words of an n-gram. Of the N rows with at least ``min_words`` words the
    floor(N * share) highest scores are drawn (ties: the smaller id, null last); ``rank`` is null for the others.
    Defined results: a null or empty text has no features and weight 0; a null id draws its
    noise as the text ``null``; repeated rows are rows each; other columns are not read, so their names
    can't clash; no rows in, no rows out; without a target all gains follow from the smoothing alone.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, text_col, sizes, buckets), bucket_counts(target, target_text_col, sizes, buckets), buckets)
    scored = weights(docs, gains, id_col, text_col, sizes, buckets)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed)).checkpoint()
    out = ranked(scored, [F.col("score").desc(), F.col("id").asc_nulls_last()], F.col("n_words") >= min_words)
    drawn = F.col("rank") <= F.floor(F.col("n_eligible") * share[0] / share[1])
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", F.when(drawn, F.col("rank")).alias("rank"))
