r"""Removal of lines that many documents hold, behind two Bloom filters.

A line's key is the line without white space at its ends, A-Z lower-cased; its hash has 128 bits.

1. Each task sets the bits of the keys it sees in a filter of keys seen once and, for a key whose bits
   were set before, in a filter of keys seen twice. The filters are packed, cut into segments and merged by
   segment: twice = twice | twice' | (once & once'). A key in two documents has all
   its bits in the second filter, wherever the documents are.
2. The second filter is broadcast. Its size follows from the number of lines and ends at ``MAX_BITS`` (the
   bound of the broadcast); beyond that more lines are suspected, and the result is the same.
3. Only suspected lines are shuffled: they are counted by hash with map-side aggregation,
   with the smallest and largest key of a hash beside the count, so two keys with one hash stop the job
   instead of being merged. The same pass picks a key's first occurrence.
4. Suspected lines meet the confirmed hashes, and each document gets the hashes it loses.

Joins are on key columns of their own, so a hot line or a much repeated row can be split.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textblocks import column

MIN_DOCS, MIN_CHARS = 10, 1
SPACE = b" \t\n\x0b\x0c\r"
MIN_BITS, MAX_BITS, BITS_PER_LINE = 1 << 16, 1 << 28, 8  # at most 32 MB are broadcast
SEGMENT = 1 << 12   # bytes of a filter that are merged at once
_HELD = 1 << 16     # hashes looked at together


def xxh3_128(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _counts(key: bytes, min_chars: int) -> bool:
    """Whether a key has at least ``min_chars`` code points."""
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _keyed(text: bytes, min_chars: int, line_hash: Callable[[bytes], bytes]) -> dict[bytes, tuple[int, bytes]]:
    """A document's different keys by hash, each with its first line."""
    found: dict[bytes, tuple[int, bytes]] = {}
    for i, line in enumerate(text.split(b"\n")):
        key = line_key(line)
        if _counts(key, min_chars):
            found.setdefault(line_hash(key), (i, key))
    return found


def _texts(b: pa.RecordBatch) -> Iterator[bytes]:
    for t in column(b, "text").cast(pa.large_binary()):
        yield t.as_buffer().to_pybytes()


def _places(hashes: list[bytes], bits: int) -> np.ndarray:
    """The two bits of each hash."""
    return np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2) & np.uint64(bits - 1)


def _has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = (places >> np.uint64(3)).astype(np.int64)
    return ((filter_[at] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _set(filter_: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(filter_, (places >> np.uint64(3)).astype(np.int64).ravel(),
                     (1 << (places & np.uint64(7))).astype(np.uint8).ravel())


def n_bits(n_lines: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_LINE * n_lines - 1).bit_length())) if n_lines else MIN_BITS


def _sketch(bits: int, min_chars: int, line_hash: Callable[[bytes], bytes]):
    """Texts to packed segments of a task's two filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

        def add(hashes: list[bytes]) -> None:
            distinct, count = np.unique(np.array(hashes, "S16").view("V16"), return_counts=True)
            places = np.frombuffer(distinct.tobytes(), np.uint64).reshape(-1, 2) & np.uint64(bits - 1)
            _set(twice, places[(count > 1) | _has(once, places)])
            _set(once, places)

        held: list[bytes] = []
        for b in batches:
            for text in _texts(b):
                held += _keyed(text, min_chars, line_hash)
                if len(held) >= _HELD:
                    add(held)
                    held = []
        if held:
            add(held)
        parts = [f.reshape(-1, min(SEGMENT, bits // 8)) for f in (once, twice)]
        for i in np.flatnonzero(parts[0].any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), *[pa.array([zlib.compress(p[i].tobytes(), 1)], pa.binary()) for p in parts]],
                ["segment", "once", "twice"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of all tasks to one each: at most the two filters are held, however many tasks there were."""
    state: dict[int, list[np.ndarray]] = {}
    unpack = lambda x: np.frombuffer(zlib.decompress(x.as_buffer()), np.uint8)
    for b in batches:
        for i, once, twice in zip(column(b, "segment").to_pylist(), column(b, "once"), column(b, "twice")):
            once, twice = unpack(once), unpack(twice)
            if i in state:
                own = state[i]
                own[1] = own[1] | twice | (own[0] & once)
                own[0] = own[0] | once
            else:
                state[i] = [once, twice]
    for i, (_, twice) in state.items():
        if twice.any():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())],
                                             ["segment", "twice"])


def seen_twice(texts: DataFrame, min_chars: int = MIN_CHARS, line_hash: Callable[[bytes], bytes] = xxh3_128) -> Broadcast:
    """The filter of keys that at least two rows of ``texts`` (a column ``text`` without nulls) hold, sent to all executors."""
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    bits = n_bits(texts.agg(F.sum(lines.cast("long"))).first()[0] or 0)
    merged = (texts.select("text").mapInArrow(_sketch(bits, min_chars, line_hash), "segment int, once binary, twice binary")
              .repartition("segment").mapInArrow(_merge, "segment int, twice binary"))
    twice = np.zeros(bits // 8, np.uint8)
    size = min(SEGMENT, bits // 8)
    for i, part in merged.collect():  # bits / 8 bytes together
        twice[i * size:(i + 1) * size] = np.frombuffer(zlib.decompress(bytes(part)), np.uint8)
    return texts.sparkSession.sparkContext.broadcast(twice)


def _suspected(shared: Broadcast, min_chars: int, line_hash: Callable[[bytes], bytes], with_key: bool):
    """Documents to the keys that may be in two of them: hash, document, first line, and the key itself if asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = shared.value
        for b in batches:
            rows, lines, hashes, keys = [], [], [], []

            def ready() -> pa.RecordBatch:
                cols = [column(b, "id").take(pa.array(rows, pa.int64())), column(b, "rid").take(pa.array(rows, pa.int64())),
                        pa.array(lines, pa.int32()), pa.array(hashes, pa.binary())]
                names = ["id", "rid", "line", "h"]
                if with_key:
                    cols, names = [*cols, pa.array(keys, pa.binary())], [*names, "key"]
                return pa.RecordBatch.from_arrays(cols, names)

            for r, text in enumerate(_texts(b)):
                found = _keyed(text, min_chars, line_hash)
                if not found:
                    continue
                for (h, (line, key)), hit in zip(found.items(), _has(twice, _places(list(found), 8 * len(twice))).tolist()):
                    if hit:
                        rows.append(r)
                        lines.append(line)
                        hashes.append(h)
                        keys.append(key)
                if len(rows) >= _HELD:
                    yield ready()
                    rows, lines, hashes, keys = [], [], [], []
            if rows:
                yield ready()

    return run


def _without(min_chars: int, line_hash: Callable[[bytes], bytes], with_text: bool):
    """Documents with the hashes they lose to what is left of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, dropped, sha, left = [], [], [], []
            for text, gone in zip(_texts(b), column(b, "gone")):
                lines = text.split(b"\n")
                kept = lines
                if gone.is_valid:
                    keeps = {x["h"]: x["keep"] for x in gone.as_py()}
                    kept = []
                    for i, line in enumerate(lines):
                        key = line_key(line)
                        at = keeps.get(line_hash(key)) if _counts(key, min_chars) else None
                        if at is None or at == i:
                            kept.append(line)
                rest = b"\n".join(kept)
                total.append(len(lines))
                dropped.append(len(lines) - len(kept))
                sha.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    left.append(rest.decode())
            cols = [column(b, "id"), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sha, pa.string())]
            names = ["id", "n_lines", "n_dropped", "kept_sha256"]
            if with_text:
                cols, names = [*cols, pa.array(left, pa.string())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def _row_id() -> Column:
    """128 bits of a row's id and text."""
    return F.concat(F.hex(F.xxhash64("id", "text")), F.lit(":"), F.hex(F.xxhash64(F.lit(1), "id", "text")))


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                      min_chars: int = MIN_CHARS, keep: str = "none", with_text: bool = False,
                      line_hash: Callable[[bytes], bytes] = xxh3_128) -> DataFrame:
    r"""One row per input row: ``id_col, n_lines, n_dropped, kept_sha256`` (and ``kept``, the text left).

    Lines end at ``\n``. Keys of at least ``min_chars`` code points that at least ``min_docs`` (two or more)
    rows hold lose all their lines (``keep="none"``), or all but the first one (``keep="first"``: in
    the row with the smallest id, null last, ties by content, its first such line). The other lines stay as they were,
    joined by ``\n``. Defined results: a null or empty text is one empty line; repeated rows are documents each,
    and rows that repeat id and text share their result, so a first occurrence stays in each of them;
    other columns are not read; no rows in, no rows out. ``line_hash`` gives 16 bytes.
    """
    if min_docs < 2:
        raise ValueError("the filter finds keys of two documents or more")
    if keep not in ("none", "first"):
        raise ValueError(f"keep is 'none' or 'first', not {keep!r}")
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("rid", _row_id())
    shared = seen_twice(d, min_chars, line_hash)
    rows = f"id {kind}, rid string, line int, h binary"
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("rid"), F.col("line"))).alias("first")
    counted = d.mapInArrow(_suspected(shared, min_chars, line_hash, True), rows + ", key binary").groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), first)
    common = counted.withColumn("n", F.when(F.col("low") == F.col("high"), F.col("n")).otherwise(
        F.raise_error(F.lit("two lines agree in their hash")).cast("long"))).filter(F.col("n") >= min_docs)
    stays = F.when((F.col("rid") == F.col("first_rid")) & F.lit(keep == "first"), F.col("line")).otherwise(-1)
    gone = (d.mapInArrow(_suspected(shared, min_chars, line_hash, False), rows).withColumn("hash", F.hex("h"))
            .join(common.select(F.hex("h").alias("hash"), F.col("first.rid").alias("first_rid")), "hash")
            .groupBy("rid").agg(F.collect_set(F.struct("h", stays.alias("keep"))).alias("gone"))
            .select(F.concat("rid", F.lit("#")).alias("key"), "gone"))
    out = d.withColumn("key", F.concat("rid", F.lit("#"))).join(gone, "key", "left").select("id", "text", "gone").mapInArrow(
        _without(min_chars, line_hash, with_text),
        f"id {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string" + ", kept string" * with_text)
    return out.withColumnRenamed("id", id_col)
