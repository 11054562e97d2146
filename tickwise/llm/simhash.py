"""SimHash near-dedup with an inverted index on byte positions.

A fingerprint is eight bytes. Two that differ in at most ``d`` bits differ in
at most ``d`` bytes, so they share at least ``8 - d`` bytes at the same
positions: the count filter's guaranteed minimum. At most ``d`` of the four byte pairs at
fixed positions are touched, so two such fingerprints meet in a list keyed by ``4 - d`` whole
pairs (6 keys at d = 2). Inside a list, postings by (position, byte) of the other positions
are tallied per pair; pairs that reach the minimum together with the key's bytes are verified.

A pair of fingerprints is tallied only in lists of at most ``LIST_ROWS`` members, which bounds a task's work. Longer
lists give their members to a second index, keyed by every choice of ``8 - d`` bytes (28 keys at d = 2): there a
pair reaches the minimum exactly if it meets under a key, and a list has at most 256 ** d members,
whose neighbours are looked up instead of forming pairs. Both send on a star per connected part of a list:
fewer links than members.

Equal fingerprints are one row of the index. Components of the links are found
by label propagation with pointer jumping, one reliable checkpoint a round.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textblocks import column
from tickwise.session import ensure_checkpoint_dir

SHINGLE, SEED, MAX_BITS = 3, 42, 2
LIST_ROWS = 256  # members of a list whose pairs are tallied; longer ones go to the second index
_CHUNK = 1 << 15  # shingles counted at once


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the shingles' XXH64 bits; 0 without words. A-Z is lower-cased, words stand between ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:len(words) - k + 1].tolist()
    ends = (ends - 1)[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), _CHUNK):
        hashes = np.array([h(joined[a:b], seed) for a, b in zip(starts[i:i + _CHUNK], ends[i:i + _CHUNK])], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """``id, text_hash, fp`` of every row; ``fp`` is the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = column(b, "text").cast(pa.large_binary())
            fp = [simhash(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle, seed) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.array(fp, np.uint64).view(np.int64))], ["id", "text_hash", "fp"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
                       ).mapInArrow(run, f"id {kind}, text_hash bigint, fp bigint")


def _flips(bits: list[int], d: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for n in range(1, d + 1) for c in combinations(bits, n)], np.uint64)


def _stars(members: np.ndarray, flips: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of the sorted distinct fingerprints the least one that it reaches over verified links."""
    n = len(members)
    if n < 32:  # a small table of distances
        links = np.argwhere(np.bitwise_count(members[:, None] ^ members) <= max_bits)
    else:  # each member's neighbours, looked up
        pairs = []
        for f in flips:
            other = members ^ f
            at = np.minimum(np.searchsorted(members, other), n - 1)
            ok = np.flatnonzero(members[at] == other)
            pairs.append(np.column_stack([ok, at[ok]]))
        links = np.concatenate(pairs)
    return members[_connected(n, links)]


def _connected(n: int, pairs: np.ndarray) -> np.ndarray:
    """The least index reachable over ``pairs`` (rows of two indexes) from each of ``n``."""
    label = np.arange(n)
    both = np.concatenate([pairs, pairs[:, ::-1]])
    while len(both):
        low = label.copy()
        np.minimum.at(low, both[:, 0], label[both[:, 1]])
        low = low[low]
        if (low == label).all():
            break
        label = low
    return label


def _run_pairs(run: np.ndarray) -> np.ndarray:
    """All pairs of places inside runs of equal values of a sorted array."""
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    ends = np.repeat(np.append(first[1:], len(run)), np.diff(np.append(first, len(run))))
    later = ends - np.arange(len(run)) - 1  # partners after each place
    left = np.repeat(np.arange(len(run)), later)
    within = np.arange(len(left)) - np.repeat(np.cumsum(later) - later, later)
    return np.column_stack([left, left + 1 + within])


def _tallied(fp: np.ndarray, lists: np.ndarray, choice: np.ndarray, rest: np.ndarray, max_bits: int) -> np.ndarray:
    """Pairs (rows of two indexes) within ``max_bits`` of each other, of members of the same list.

    ``lists``: the list's number; ``choice``: its kind; ``rest``: the positions outside the key by kind. Those
    positions are gone through one by one: members of a list with the same byte there are a posting, and each pair of a
    posting counts one. A pair reaches the guaranteed minimum if it counts ``max_bits`` of the ``2 * max_bits`` positions.
    """
    data = fp.astype("<u8").view(np.uint8).reshape(-1, 8)
    codes = []
    for k in range(rest.shape[1]):
        posting = lists * 256 + data[np.arange(len(fp)), rest[choice, k]]
        order = np.argsort(posting, kind="stable")
        pairs = order[_run_pairs(posting[order])]
        codes.append(pairs.min(axis=1) * len(fp) + pairs.max(axis=1))
    code, shared = np.unique(np.concatenate(codes), return_counts=True)
    code = code[shared >= max_bits]
    a, b = code // len(fp), code % len(fp)
    near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
    return np.column_stack([a[near], b[near]])


def _starts(cols: list[np.ndarray]) -> np.ndarray:
    """Where the lists of rows sorted by the first two columns begin."""
    if not len(cols[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])))


def _postings(fps: DataFrame, choices: list[tuple[int, ...]]) -> DataFrame:
    """``choice, bytes, fp``: each fingerprint under its bytes at each choice of positions, lists together and in order."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = [sum(0xFF << (8 * p) for p in c) for c in choices]
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bytes"))
        for i, m in enumerate(masks)])).alias("k")).select("k.choice", "k.bytes", "fp")
    return keyed.repartition("choice", "bytes").sortWithinPartitions("choice", "bytes")


def links(fps: DataFrame, max_bits: int = MAX_BITS, list_rows: int = LIST_ROWS) -> DataFrame:
    """``a, b`` (a > b as unsigned): links that connect all fingerprints reachable by at most ``max_bits`` flips a step.

    ``fps``: distinct values of ``fp``. With four bits and more no byte pair need be whole, and the second
    index does all.
    """
    if not 1 <= max_bits <= 3:
        return links_by_minimum(fps, max_bits)
    ensure_checkpoint_dir(fps.sparkSession)
    choices = [tuple(p for unit in c for p in (2 * unit, 2 * unit + 1)) for c in combinations(range(4), 4 - max_bits)]
    rest = np.array([[p for p in range(8) if p not in c] for c in choices])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        long_key = None  # of the list that goes on and has been found to be long
        for b in itertools.chain(batches, [None]):
            if b is None:
                cols, whole = held, len(held[0])
            else:
                cols = [np.concatenate([h, column(b, c).to_numpy()]) for h, c in zip(held, ("choice", "bytes", "fp"))]
                whole = _starts(cols)[-1] if len(cols[0]) else 0  # the last list may go on in the next batch
            new = _starts(cols)
            size = np.diff(np.append(new, len(cols[0])))
            long = size > list_rows
            if len(new) and long_key == (cols[0][0], cols[1][0]):
                long[0] = True
            member = np.repeat(long, size)
            if len(new):
                last = (cols[0][-1], cols[1][-1])
                long_key = last if long[-1] else None
            at = np.arange(len(cols[0]))
            done = ~member & (at < whole)
            yield _closed([c[done] for c in cols], cols[2][member])
            held = [c[~member & (at >= whole)] for c in cols]

    def _closed(cols: list[np.ndarray], of_long: np.ndarray) -> pa.RecordBatch:
        fp = cols[2].view(np.uint64)
        order = np.lexsort((fp, cols[1], cols[0]))  # the least index of a part is its least fingerprint
        choice, key, fp = cols[0][order], cols[1][order], fp[order]
        new = _starts([choice, key])
        lists = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(fp))))
        least = _connected(len(fp), _tallied(fp, lists, choice, rest, max_bits)) if len(fp) else np.zeros(0, np.int64)
        far = np.flatnonzero(least != np.arange(len(fp)))
        a = np.concatenate([fp[far].view(np.int64), of_long])
        b = np.concatenate([fp[least[far]].view(np.int64), of_long])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    # a member of a long list comes as a pair of itself
    found = _postings(fps, choices).mapInArrow(tally, "a bigint, b bigint").distinct().checkpoint()
    near, of_long = found.filter("a <> b"), found.filter("a = b").select(F.col("a").alias("fp"))
    return near if of_long.isEmpty() else near.union(links_by_minimum(of_long, max_bits)).distinct()


def links_by_minimum(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The links of ``links`` from an index keyed by every choice of ``8 - max_bits`` positional bytes."""
    choices = list(combinations(range(8), 8 - max_bits))
    flips = [_flips([8 * p + i for p in range(8) if p not in c for i in range(8)], max_bits) for c in choices]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for b in batches:
            cols = [np.concatenate([r, column(b, c).to_numpy()]) for r, c in zip(rest, ("choice", "bytes", "fp"))]
            new = _starts(cols)
            if not len(new):
                continue
            cut = new[-1]  # the last list may go on in the next batch
            yield _linked([c[:cut] for c in cols], new[:-1])
            rest = [c[cut:] for c in cols]
        if len(rest[0]):
            yield _linked(rest, _starts(rest))

    def _linked(cols, new) -> pa.RecordBatch:
        ends = np.append(new[1:], len(cols[0]))
        a, low = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for i, j in zip(new[ends - new > 1].tolist(), ends[ends - new > 1].tolist()):
            members = np.sort(cols[2][i:j].view(np.uint64))
            least = _stars(members, flips[cols[0][i]], max_bits)
            far = least != members
            a.append(members[far])
            low.append(least[far])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, low)], ["a", "b"])

    return _postings(fps, choices).mapInArrow(verify, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node reachable, for every node of ``edges`` (a, b)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).checkpoint()
    label = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("label")).checkpoint()
    while True:
        # the least label next to a node, then the label of that label
        near = (both.join(label, both.v == label.node).groupBy("u").agg(F.min("label").alias("m"))
                .join(label, F.col("u") == label.node).select("node", F.least("label", "m").alias("next"), "label"))
        jump = label.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = near.join(jump, "next", "left").select(
            "node", F.least("next", F.coalesce("far", "next")).alias("label"), F.col("label").alias("was")).checkpoint()
        label = step.select("node", "label")
        if step.filter("label != was").isEmpty():
            return label


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """One row per document: ``id_col, fingerprint`` (16 hex digits), ``component_id``, and ``text_hash``.

    ``component_id``: the smallest id reachable over links of at most
    ``max_bits`` differing bits, itself included. Defined results: null and empty
    texts have fingerprint zero and link like any other; a null id never is a
    ``component_id`` unless its component has no other; repeated rows are rows
    each; other columns are not read; no rows in, no rows out.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    own = fingerprints(docs, id_col, text_col, shingle, seed).checkpoint()
    nodes = own.groupBy("fp").agg(F.min("id").alias("least")).checkpoint()
    label = components(links(nodes.select("fp"), max_bits))
    # joins on a key of their own: both sides are dealt out anew, so a hot value can be split
    least = label.join(nodes, label.node == nodes.fp).groupBy("label").agg(F.min("least").alias("component_id"))
    linked = label.select("node", F.hex("label").alias("key")).join(
        least.select(F.hex("label").alias("key"), "component_id"), "key").select(F.col("node").alias("fp"), "component_id")
    groups = nodes.join(linked, "fp", "left").select(
        F.hex("fp").alias("key"), F.coalesce("component_id", "least").alias("component_id"))
    own = own.withColumn("key", F.hex("fp"))
    return own.join(groups, "key").select(
        F.col("id").alias(id_col), F.lpad(F.lower("key"), 16, "0").alias("fingerprint"), "component_id", "text_hash")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One document of each component, that with the smallest id; all columns as they were.

    Of rows that repeat that id, the one with the smallest text hash stays.
    """
    groups = simhash_groups(docs, id_col, text_col, **kw)
    stays = groups.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy("component_id", "fingerprint").agg(
        F.min("text_hash").alias("__hash")).groupBy("component_id").agg(F.min("__hash").alias("__hash")).withColumnRenamed(
        "component_id", "__id")
    out = docs.withColumn("__text", F.xxhash64(text_col)).join(
        stays, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")), "left_semi")
    return out.dropDuplicates([id_col, "__text"]).select(*[F.col(f"`{c}`") for c in docs.columns])
