"""Benchmark decontamination with suffix arrays of the training text.

Each block of training documents is a shard. Its words are mapped to the ids
of the benchmark's vocabulary, and the suffix array of the shard is the sorted
order of its word suffixes; suffixes that leave the benchmark's vocabulary
before the shortest window ends can't match and are left out. Every test
suffix is then looked up in each shard by binary search (both ends of its
range at once), which gives all verbatim occurrences and their locations;
runs of occurrences along an item give the longest verbatim match.

The training side never shuffles: every document is judged where it is read.
The benchmark goes to the tasks in parts of at most ``part_bytes`` of text,
each broadcast by itself, so what is broadcast at once has a fixed bound; a larger
benchmark takes more narrow passes over the same partition, not a larger one. An item
longer than ``PIECE_BYTES`` is cut into pieces that overlap by all but one word of a window,
so each of its windows is in exactly one piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tickwise.llm.textblocks import Words, blocks, column, text_bytes
from tickwise.session import ensure_checkpoint_dir

WINDOW = 13            # words in a window
MIN_SHARE = (1, 20)    # share of a document's words that makes it contaminated
PART_BYTES = 8 << 20   # benchmark text in one broadcast
PIECE_BYTES = 1 << 20  # of an item in one row (or a window's words, if those are longer)


@dataclass
class TestSuffixes:
    """Vocabulary and windows of one part of the benchmark."""

    vocab: np.ndarray    # sorted word hashes; id of a word = place + 1, 0 is any other word
    words: list          # the words by id - 1
    windows: dict        # window length -> (k, length) array of word ids
    owners: dict         # window length -> list of (item number, place) pairs per window
    names: list          # item ids as strings


def test_suffixes(pieces: list[tuple], window: int) -> TestSuffixes:
    """Windows of items given as pieces (item id, item's key, number of the piece's first word, text). An item of fewer words
    is one window, one of none has none."""
    key_of: dict[tuple, int] = {}
    owner = [key_of.setdefault((i, key), len(key_of)) for i, key, _, _ in pieces]
    data, offs = text_bytes(pa.array([t for *_, t in pieces], pa.large_string()))
    w = Words(data, offs)
    h = w.hashes()
    vocab, at, ids = np.unique(h, return_index=True, return_inverse=True)
    ids = ids + 1
    text = [w.low[a:b].tobytes() for a, b in zip(w.start[at], w.end[at])]
    found: dict[int, dict[bytes, list]] = {}
    for p, (_, _, at_word, _) in enumerate(pieces):
        own = ids[w.first[p]:w.first[p + 1]]
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            found.setdefault(n, {}).setdefault(own[i:i + n].astype(">u4").tobytes(), []).append((owner[p], at_word + i))
    return TestSuffixes(
        vocab, text,
        {n: np.frombuffer(b"".join(x), ">u4").reshape(-1, n) for n, x in found.items()},
        {n: list(x.values()) for n, x in found.items()},
        ["null" if i is None else str(i) for i, _ in key_of])


def _padded(windows: np.ndarray, width: int, fill: int) -> np.ndarray:
    out = np.full((len(windows), width), fill, ">u4")
    out[:, :windows.shape[1]] = windows
    return np.ascontiguousarray(out).view(f"S{4 * width}").ravel()


def _spread(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def scan(words: Words, tests: TestSuffixes, window: int) -> tuple[np.ndarray, dict[int, set], np.ndarray]:
    """For a shard: which words are hit, the items by row, the longest match by row."""
    n, rows = len(words), len(words.first) - 1
    hit, items, longest = np.zeros(n, bool), {}, np.zeros(rows, np.int64)
    if not n or not tests.windows:
        return hit, items, longest
    h = words.hashes()
    at = np.minimum(np.searchsorted(tests.vocab, h), len(tests.vocab) - 1)
    ids = np.where(tests.vocab[at] == h, at + 1, 0)
    # words of the benchmark's vocabulary from here on, within the row
    stop = np.flatnonzero(ids == 0)
    nxt = np.minimum(np.append(stop, n)[np.searchsorted(stop, np.arange(n))], words.first[words.row + 1])
    run = nxt - np.arange(n)
    least = min(tests.windows)
    start = np.flatnonzero(run >= least)
    if not len(start):
        return hit, items, longest
    # the shard's suffix array: suffixes by their first `window` words; what
    # lies beyond a row's end or another word sorts as 0
    keys = np.zeros((len(start), window), ">u4")
    for j in range(window):
        live = run[start] > j
        keys[live, j] = ids[start[live] + j]
    keys = np.ascontiguousarray(keys).view(f"S{4 * window}").ravel()
    order = np.argsort(keys, kind="stable")
    keys, start = keys[order], start[order]
    change, found = np.zeros(n + 1, np.int64), []
    for length, wins in tests.windows.items():
        lo = np.searchsorted(keys, _padded(wins, window, 0), "left")
        hi = np.searchsorted(keys, _padded(wins, window, 0xFFFFFFFF), "right")
        count = hi - lo
        which = np.repeat(np.arange(len(wins)), count)
        place = start[np.repeat(lo, count) + _spread(count)]
        same = _verbatim(words, tests, ids, place, length)
        which, place = which[same], place[same]
        np.add.at(change, place, 1)
        np.add.at(change, place + length, -1)
        # a window's items, at its first place in each
        owners = [list({k: i for k, i in reversed(o)}.items()) for o in tests.owners[length]]
        reps = np.array([len(o) for o in owners])
        flat = np.array([p for o in owners for p in o], np.int64).reshape(-1, 2)
        from_ = np.cumsum(reps) - reps
        pick = np.repeat(from_[which], reps[which]) + _spread(reps[which])
        found.append(np.column_stack([np.repeat(place, reps[which]), flat[pick], np.full(len(pick), length)]))
    hit = np.cumsum(change[:-1]) > 0
    occ = np.concatenate(found)
    if len(occ):
        row = words.row[occ[:, 0]]
        for r, k in np.unique(np.column_stack([row, occ[:, 1]]), axis=0).tolist():
            items.setdefault(r, set()).add(k)
        # occurrences of neighbouring windows of an item at neighbouring places are one match
        diagonal = occ[:, 0] - occ[:, 2]
        o = np.lexsort((occ[:, 0], diagonal, occ[:, 1]))
        place, item, diagonal, length = occ[o, 0], occ[o, 1], diagonal[o], occ[o, 3]
        new = np.ones(len(o), bool)
        new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1) | (
            words.row[place[1:]] != words.row[place[:-1]])
        group = np.flatnonzero(new)
        size = np.diff(np.append(group, len(o))) - 1 + length[group]
        np.maximum.at(longest, words.row[place[group]], size)
    return hit, items, longest


def _verbatim(words: Words, tests: TestSuffixes, ids: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Whether the words from each place on are the vocabulary's, byte by byte (ids come from hashes)."""
    at = np.unique((place[:, None] + np.arange(length)).ravel())
    low = words.low
    wrong = [p for p, w, a, b in zip(at.tolist(), ids[at].tolist(), words.start[at].tolist(), words.end[at].tolist())
             if low[a:b].tobytes() != tests.words[w - 1]]
    if not wrong:
        return np.ones(len(place), bool)
    return ~np.isin(place[:, None] + np.arange(length), wrong).any(axis=1)


def cut_text(text: bytes, window: int, piece_bytes: int) -> Iterator[tuple[int, bytes]]:
    """``(first word's number, piece)``: a longer text in pieces of at most ``piece_bytes``, or a window's words if those are
    longer; each piece begins with the last ``window - 1`` words of the one before it."""
    if len(text) <= piece_bytes:
        yield 0, text
        return
    w = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)], np.int64))
    n, at = len(w), 0
    while n:
        fits = int(np.searchsorted(w.end, w.start[at] + piece_bytes, "right"))
        end = min(n, max(fits, at + window))
        yield at, text[w.start[at]:w.end[end - 1]]
        if end == n:
            return
        at = end - window + 1


def _parts(benchmark: DataFrame, item_col: str, text_col: str, part_bytes: int, window: int = WINDOW,
           piece_bytes: int = PIECE_BYTES) -> Iterator[list[tuple]]:
    """The pieces of the benchmark's different rows in parts of at most ``part_bytes`` (or one piece); at least one part.

    Rows leave the cluster one partition at a time, and there are about as many partitions as parts.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = column(b, "t").cast(pa.large_binary())
            for r in range(b.num_rows):
                t = texts[r].as_buffer().to_pybytes() if texts[r].is_valid else b""
                for at, piece in cut_text(t, window, piece_bytes):
                    yield pa.RecordBatch.from_arrays([column(b, "i").slice(r, 1), column(b, "key").slice(r, 1), pa.array([at], pa.int64()),
                                                      pa.array([piece.decode()], pa.string())], ["i", "key", "at", "t"])

    own = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).distinct()
    total = own.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    kind = dict(own.dtypes)["i"]
    pieces = own.withColumn("key", F.xxhash64("i", "t")).mapInArrow(cut, f"i {kind}, key bigint, at bigint, t string")
    dealt = pieces.repartition(max(1, math.ceil(total / part_bytes)), "key", F.floor(F.col("at") / 1_000_000)
                               ).sortWithinPartitions("key", "at")
    part, size, any_part = [], 0, False
    for row in dealt.toLocalIterator():
        n = len(row["t"].encode())
        if part and size + n > part_bytes:
            yield part
            part, size, any_part = [], 0, True
        part.append(tuple(row))
        size += n
    if part or not any_part:
        yield part


FOUND = [StructField("hits", ArrayType(StructType([StructField("first", LongType()), StructField("last", LongType())]))),
         StructField("items", ArrayType(StringType())), StructField("longest_match", LongType()),
         StructField("n_words", LongType())]


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 part_bytes: int = PART_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per document: ``row`` (the document's columns), ``n_words, hits, items, longest_match``.

    ``hits``: maximal runs of hit words (first and last word, from 0);
    ``items``: ids, as strings, of the items with a window in the document, sorted;
    ``longest_match``: words of the longest verbatim match of at least a window; a match that
    runs over the end of a part of the benchmark counts by its longer piece.
    Defined results: a null or empty text has no words and no hits; a null
    item text has no window; a null item id counts as the string ``null``;
    repeated rows are judged one by one; empty tables give no rows, or no
    hits. The document's columns stay in a struct, so no name can clash.

    Of a benchmark of several parts one is matched at a time: what is found goes to
    ``spark.checkpoint.dir`` before the next part is sent out.
    """
    sc = docs.sparkSession.sparkContext
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = StructType([StructField("row", StructType(docs.schema.fields)), *FOUND])
    place = docs.columns.index(text_col)
    shared = None
    for part in _parts(benchmark, item_col, item_text_col, part_bytes, window, piece_bytes):
        if shared is not None:
            ensure_checkpoint_dir(docs.sparkSession)
            out = out.checkpoint()
            shared.unpersist()
        shared = sc.broadcast(test_suffixes(part, window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for b in batches:
                data, offs = text_bytes(column(b, "row").field(place))
                for a, z in blocks(offs):
                    yield _judge(b.slice(a, z - a), Words(data, offs[a:z + 1]), tests, window)

        out = out.mapInArrow(run, schema)
    return out


def _judge(rows: pa.RecordBatch, words: Words, tests: TestSuffixes, window: int) -> pa.RecordBatch:
    hit, items, longest = scan(words, tests, window)
    n = rows.num_rows
    before = rows.schema.get_field_index("hits") >= 0
    if before:  # another part of the benchmark has been matched already
        old_hits, old_items = column(rows, "hits").to_pylist(), column(rows, "items").to_pylist()
        longest = np.maximum(longest, column(rows, "longest_match").to_numpy())
        for r in range(n):
            for s in old_hits[r]:
                hit[words.first[r] + s["first"]:words.first[r] + s["last"] + 1] = True
    edge = np.zeros(len(hit) + 1, bool)
    if len(hit):
        edge[0] = hit[0]
        edge[1:-1] = hit[1:] != hit[:-1]
        edge[-1] = hit[-1]
        cut = words.first[1:-1]
        cut = cut[(cut > 0) & (cut < len(hit))]
        both = np.unique(cut[hit[cut] & hit[cut - 1]])
    else:
        both = np.zeros(0, np.int64)
    bounds = np.sort(np.concatenate([np.flatnonzero(edge), both, both]))
    first, last = bounds[0::2], bounds[1::2] - 1
    owner = words.row[first] if len(first) else np.zeros(0, np.int64)
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(first - words.first[owner], pa.int64()), pa.array(last - words.first[owner], pa.int64())], ["first", "last"])
    names = [sorted({tests.names[k] for k in items.get(r, ())} | (set(old_items[r]) if before else set())) for r in range(n)]
    return pa.RecordBatch.from_arrays(
        [column(rows, "row"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
         pa.array(names, pa.list_(pa.string())), pa.array(longest, pa.int64()), pa.array(np.diff(words.first), pa.int64())],
        ["row", "hits", "items", "longest_match", "n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  min_share: tuple[int, int] = MIN_SHARE, **kw) -> DataFrame:
    """``find_matches`` with ``n_hit`` and the verdict ``contaminated``: hit words
    make up at least ``min_share`` (numerator, denominator) of the document."""
    num, den = min_share
    found = find_matches(docs, benchmark, text_col, **kw)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * den >= F.col("n_words") * num))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        F.col("row")[id_col].alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated", "longest_match")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The documents that ``decontaminate`` finds clean, all columns as they were; no shuffle."""
    clean = decontaminate(docs, benchmark, text_col, **kw).filter(~F.col("contaminated"))
    return clean.select(*[F.col("row")[c].alias(c) for c in docs.columns])
