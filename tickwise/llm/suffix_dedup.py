"""Removal of long byte strings that also start earlier, by distributed prefix doubling.

A position's rank at length ``h`` stands for the ``h`` bytes that start there. Ranks
are doubled as in suffix sorting: the rank at ``2h`` is the pair of the ranks at ``p`` and
at ``p + h``, and Spark sorts positions by such pairs, so equal strings become
neighbours, the first of a class is kept as its rank's owner, and what is unique drops out.
Only what is still shared goes on to the next length, until the threshold.

Ranks are 64-bit names computed where the text is (a name of ``2h`` bytes is a mix of two
names of ``h``), so a round needs no global numbering; every decision rests on a pair
of whole names. Strings with the same anchor or first half have the first name in common, and
the 64 bits of the second one tell them apart. At the threshold of 100 the rounds over the cluster go through the lengths 32, 66, 83 and 100:

1. Sampled positions. Of the 32-byte names in a window of 100 bytes the smallest is
   the window's anchor, the same in every copy of the window; a run of windows with
   one anchor is an interval, a few dozen windows long. Sorted by (anchor name, name of all the
   interval's bytes), an interval equal to an earlier one is repeated as a whole; one
   whose anchor occurs nowhere else is unique; the others go on.
2. Halves of those intervals. All windows of a half have 66 bytes around the anchor
   in common; sorted by (name of these, name of all the half's bytes) as before.
3. Quarters of the halves that are left; all windows of a quarter share 83 bytes.
4. Every position of the quarters that are left, sorted by the pair of names at ``p`` and
   ``p + 50``, which is the whole window: all but the first of each class are repeated.

Every map task settles repeats inside its own batch and sends on one position of a
class, and of an anchor with several classes only a mark goes to the anchor's partition (its
classes are dealt out by both names). So a passage that a third of all documents hold costs a
reducer a row or two per map batch. Texts are shuffled once, by id, and all later passes read that shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textblocks import BYTE_CODES, column, mix, text_bytes

THRESHOLD = 100
SEGMENT = 1 << 16   # bytes worked on at once: the arrays stay in the processor's cache
REPEATED, ASKED = 0, 1
# an interval; one whose anchor has others in its batch; a mark for such an anchor; a settled repeat
PLAIN, SHARED, MARK, DONE = 0, 1, 2, 3
_POS = np.uint64((1 << 24) - 1)
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA24BAED4963EE407)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two strings one after another (or overlapping by a fixed length)."""
    x = a * _A
    x += b
    x ^= x >> np.uint64(32)
    x *= _B
    x ^= x >> np.uint64(29)
    return x


def _names(data: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """Names of all strings of the given ascending lengths in ``data``."""
    out, h, name = [], 1, BYTE_CODES[data]
    for n in lengths:
        while 2 * h <= n:
            name = _join(name[:-h], name[h:]) if len(name) > h else name[:0]
            h *= 2
        more = n - h
        out.append(name if not more else (_join(name[:-more], name[more:]) if len(name) > more else name[:0]))
    return out


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    h = 1
    while 2 * h <= w:
        x = np.minimum(x[:-h], x[h:])
        h *= 2
    return np.minimum(x[:-(w - h)], x[w - h:]) if w > h else x


class Lengths:
    def __init__(self, threshold: int):
        if threshold < 8:
            raise ValueError("the threshold has to be at least 8 bytes")
        self.t = threshold
        self.half = threshold - threshold // 2
        self.k = 1 << ((threshold // 3).bit_length() - 1)
        far = threshold - self.k  # a window starts at most so many bytes before its anchor
        # rounds 1 to 3: distances of window starts from the anchor, and bytes that all these windows share
        self.cells = {}
        for step, parts in ((1, 1), (2, 2), (3, 4)):
            size = -(-(far + 1) // parts)
            self.cells[step] = [(a, min(a + size - 1, far), threshold - size + 1) for a in range(0, far + 1, size)]


def _segments(first: np.ndarray, last: np.ndarray, row: np.ndarray, t: int) -> tuple[np.ndarray, ...]:
    """Byte ranges [first, last) cut so that each has ``SEGMENT`` windows at most; neighbours overlap by t - 1 bytes."""
    windows = last - first - t + 1
    keep = windows > 0
    first, row, windows = first[keep], row[keep], windows[keep]
    parts = -(-windows // SEGMENT)
    again = np.repeat(np.arange(len(parts)), parts)
    j = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    a = first[again] + j * SEGMENT
    b = a + np.minimum(windows[again] - j * SEGMENT, SEGMENT) + t - 1
    return a, b, row[again]


def _runs(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of segments of about ``SEGMENT`` bytes together."""
    total = np.cumsum(b - a)
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + SEGMENT, "right")))
        yield i, j
        i = j


def _block(values: np.ndarray, a: np.ndarray, b: np.ndarray, t: int):
    """The bytes of some segments; each window's segment and place in its segment; which windows lie in one segment."""
    data = np.concatenate([values[i:j] for i, j in zip(a.tolist(), b.tolist())])
    size = b - a
    seg = np.repeat(np.arange(len(a)), size)
    place = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    n = max(len(data) - t + 1, 0)
    inside = (place + t <= size[seg])[:n]
    return data, seg, place, inside


def _intervals(values: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: Lengths, step: int):
    """Intervals of windows with one anchor, cut into the cells of a round: segment, first and last
    window in it, name of the bytes that the cell's windows share, name of all bytes."""
    t, half, k = lengths.t, lengths.half, lengths.k
    data, seg, place, inside = _block(values, a, b, t)
    wanted = sorted({k, half, *[c for _, _, c in lengths.cells[step]]})
    names = dict(zip(wanted, _names(data, wanted)))
    key = names[k] & ~_POS
    key |= np.arange(len(key), dtype=np.uint64)
    anchor = (_sliding_min(key, t - k + 1) & _POS).astype(np.int64)
    del key
    change = anchor[1:] != anchor[:-1]
    new, last = inside.copy(), inside.copy()
    new[1:] &= change | ~inside[:-1]
    last[:-1] &= change | ~inside[1:]
    lo, hi = np.flatnonzero(new), np.flatnonzero(last)
    p = anchor[lo]
    found = []
    for i, (near, far, shared) in enumerate(lengths.cells[step]):
        first, end = np.maximum(lo, p - far), np.minimum(hi, p - near)
        has = first <= end
        first, end, at = first[has], end[has], p[has]
        tail = end + t - half
        whole = _join(_join(names[half][first], names[half][first + t - half]),
                      _join(names[half][np.minimum(first + t, tail)], names[half][tail]))
        shape = mix((at - first).astype(np.uint64) * np.uint64(1 << 20) + (end - first).astype(np.uint64))
        found.append((seg[first], place[first], place[end], names[shared][at - near] + np.uint64(i), _join(whole, shape)))
    return tuple(np.concatenate(c) for c in zip(*found))


def _order(b: pa.RecordBatch) -> np.ndarray:
    """Each row's place among the batch's rows by id (null first), then text hash; equal rows share one."""
    rank = pc.rank(column(b, "id"), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
    _, place = np.unique(np.column_stack([rank, column(b, "h").to_numpy(), column(b, "g").to_numpy()]), axis=0, return_inverse=True)
    return place.ravel()


def _first_of_class(x: np.ndarray, y: np.ndarray, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries with names (x, y) at (row, at): which are the first of their class, and which repeat one elsewhere."""
    o = np.lexsort((at, row))
    o = o[np.argsort(mix(x[o]) + y[o], kind="stable")]
    xs, ys = x[o], y[o]
    new = np.ones(len(o), bool)
    new[1:] = (xs[1:] != xs[:-1]) | (ys[1:] != ys[:-1])
    head = o[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(o) else o
    first, repeated = np.zeros(len(o), bool), np.zeros(len(o), bool)
    first[o[new]] = True
    repeated[o] = ~new & ((row[o] != row[head]) | (at[o] != at[head]))
    return first, repeated


def _merged(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of a row that touch or overlap, as one."""
    if not len(row):
        return row, lo, hi
    o = np.lexsort((lo, row))
    row, lo, hi = row[o], lo[o], hi[o]
    base = row * (1 << 40)
    reach = np.maximum.accumulate(base + hi)
    new = np.append(True, base[1:] + lo[1:] > reach[:-1] + 1)
    begin = np.flatnonzero(new)
    return row[begin], lo[begin], reach[np.append(begin[1:] - 1, len(row) - 1)] - base[begin]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


# A position of a round: the name it is grouped by; the second name; length and flag; its id; its
# text's hash (``_document``) and the place. Rows of one class agree in ``x``, ``y`` and ``n`` but for the flag.
DOCUMENT = ["id", "h", "g"]
SPAN = ["x", "y", "n", *DOCUMENT, "at"]
_FLAG, _LENGTH = np.uint32(3), np.uint32((1 << 30) - 1)


def _rows(batch: pa.RecordBatch, x, y, flag, row, lo, hi) -> pa.RecordBatch:
    n = ((hi - lo).astype(np.uint32) << np.uint32(2)) | np.uint32(flag)
    take = pa.array(row, pa.int64())
    return pa.RecordBatch.from_arrays([
        _signed(x), _signed(y), pa.array(n.view(np.int32)), *[column(batch, c).take(take) for c in DOCUMENT],
        pa.array(lo.astype(np.int32))], SPAN)


def _done(batch: pa.RecordBatch, row, lo, hi) -> pa.RecordBatch:
    """Rows of spans that are known to be repeated, dealt out evenly."""
    row, lo, hi = _merged(row, lo, hi)
    while len(hi) and (hi - lo).max() > int(_LENGTH):  # longer than a row can say
        cut = np.minimum(hi, lo + int(_LENGTH))
        more = hi > cut
        row, lo, hi = np.append(row, row[more]), np.append(lo, cut[more] + 1), np.append(cut, hi[more])
    return _rows(batch, mix(_at(row, lo)), np.zeros(len(row), np.uint64), DONE, row, lo, hi)


def _compare_intervals(b: pa.RecordBatch, values, offs, first, last, row, lengths: Lengths, step: int) -> Iterator[pa.RecordBatch]:
    """Rows of rounds 1 to 3 for byte ranges [first, last) of a batch's rows; repeats inside the batch are settled."""
    a, z, row = _segments(first, last, row, lengths.t)
    found = []
    for i, j in _runs(a, z):
        seg, lo, hi, x, y = _intervals(values, a[i:j], z[i:j], lengths, step)
        r = row[i:j][seg]
        base = a[i:j][seg] - offs[r]
        found.append((r, base + lo, base + hi, x, y))
    if not found:
        return
    row, lo, hi, x, y = (np.concatenate(c) for c in zip(*found))
    del found
    order = _order(b)
    first, repeated = _first_of_class(x, y, order[row], lo)
    yield _done(b, row[repeated], lo[repeated], hi[repeated])
    row, lo, hi, x, y = (c[first] for c in (row, lo, hi, x, y))
    _, at, inv, count = np.unique(x, return_index=True, return_inverse=True, return_counts=True)
    shared = count[inv] > 1
    for flag, pick in ((PLAIN, ~shared), (SHARED, shared), (MARK, at[count > 1])):  # one mark an anchor
        yield _rows(b, x[pick], y[pick], flag, row[pick], lo[pick], hi[pick])


def _sample(lengths: Lengths):
    """Batches of texts to rows of round 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, offs = text_bytes(column(b, "text"))
            yield from _compare_intervals(b, values, offs, offs[:-1], offs[1:], np.arange(b.num_rows), lengths, 1)

    return run


def _asked(b: pa.RecordBatch, lengths: Lengths):
    """Bytes of a batch's texts, and of the spans: rows, first and last windows of those repeated and those asked for."""
    values, offs = text_bytes(column(b, "text"))
    row, kind, lo, hi = _spans(b)
    done, ask = kind == REPEATED, kind == ASKED
    return values, offs, (row[done], lo[done], hi[done]), _merged(row[ask], lo[ask], hi[ask])


def _parts(lengths: Lengths, step: int):
    """Texts with their spans to rows of round 2 or 3."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, offs, done, (r, lo, hi) = _asked(b, lengths)
            yield _done(b, *done)
            yield from _compare_intervals(b, values, offs, offs[r] + lo, offs[r] + hi + lengths.t, r, lengths, step)

    return run


def _at(row: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return row.astype(np.uint64) * np.uint64(1 << 32) + lo.astype(np.uint64)


KIND = ["kind", *DOCUMENT, "lo", "hi"]


def _settle(ask: bool):
    """Sorted rows to spans: repeated ones, and (``ask``) those whose anchor has more than one class.

    A group (equal ``x``) has a row or two per map batch; it is carried whole
    to the next Arrow batch if it may go on there.
    """
    def settled(t: pa.Table) -> pa.RecordBatch:
        x, y = (t.column(c).to_numpy().view(np.uint64) for c in ("x", "y"))
        h, g, at = (t.column(c).to_numpy() for c in ("h", "g", "at"))
        n = t.column("n").to_numpy().view(np.uint32)
        flag = (n & _FLAG).astype(np.int64)
        codes = pc.fill_null(pc.dictionary_encode(_one(t.column("id"))).indices, -1).to_numpy(zero_copy_only=False)
        kind = np.where(flag == DONE, REPEATED, -1)
        i = np.flatnonzero((flag != DONE) & (flag != MARK))
        if len(i):
            new = np.append(True, (x[i][1:] != x[i][:-1]) | (y[i][1:] != y[i][:-1]) | (n[i][1:] != n[i][:-1]))
            head = i[np.flatnonzero(new)[np.cumsum(new) - 1]]
            other = (codes[i] != codes[head]) | (at[i] != at[head]) | (h[i] != h[head]) | (g[i] != g[head])
            kind[i[~new & other]] = REPEATED
            if ask:
                heads = i[new]
                asked = flag[heads] == SHARED
                _, inv, count = np.unique(x[heads], return_inverse=True, return_counts=True)
                asked |= (count[inv] > 1) | np.isin(x[heads], x[flag == MARK])
                kind[heads[asked]] = ASKED
        keep = np.flatnonzero(kind >= 0)
        lo = at[keep].astype(np.int64)
        length = (n[keep] >> np.uint32(2)).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(kind[keep].astype(np.int32)), *[_one(t.column(c).take(pa.array(keep))) for c in DOCUMENT],
            pa.array(lo.astype(np.int32)), pa.array((lo + length).astype(np.int32))], KIND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            x = column(b, "x").to_numpy()
            if not len(x):
                continue
            if held and x[0] == x[-1] and x[-1] == column(held[-1], "x")[-1].as_py():
                held.append(b)
                continue
            cut = int(np.flatnonzero(x != x[-1])[-1]) + 1 if x[0] != x[-1] else 0
            ready = pa.Table.from_batches([*held, b.slice(0, cut)])
            if cut == 0 and held:  # the held group has ended
                ready = pa.Table.from_batches(held)
            if ready.num_rows:
                yield settled(ready)
            held = [b.slice(cut)]
        if held:
            yield settled(pa.Table.from_batches(held))

    return run


def _one(c: pa.ChunkedArray) -> pa.Array:
    return c.combine_chunks() if c.num_chunks != 1 else c.chunk(0)


def _spans(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, kind, first and last window of the collected spans."""
    c = column(b, "spans")
    row = np.repeat(np.arange(b.num_rows), pc.fill_null(pc.list_value_length(c), 0).to_numpy().astype(np.int64))
    flat = c.flatten()
    kind, lo, hi = (flat.field(k).to_numpy().astype(np.int64) for k in ("kind", "lo", "hi"))
    return row, kind, lo, hi


def _positions(lengths: Lengths):
    """Texts with their spans to rows of round 4: the pairs of names of all positions asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, half = lengths.t, lengths.half
        for b in batches:
            values, offs, done, (r, lo, hi) = _asked(b, lengths)
            yield _done(b, *done)
            a, z, row = _segments(offs[r] + lo, offs[r] + hi + t, r, t)
            found = []
            for i, j in _runs(a, z):
                data, seg, place, inside = _block(values, a[i:j], z[i:j], t)
                name, = _names(data, [half])
                p = np.flatnonzero(inside)
                r = row[i:j][seg[p]]
                found.append((r, a[i:j][seg[p]] - offs[r] + place[p], name[p], name[p + t - half]))
            if not found:
                continue
            r, p, x, y = (np.concatenate(c) for c in zip(*found))
            del found
            order = _order(b)
            first, repeated = _first_of_class(x, y, order[r], p)
            yield _done(b, r[repeated], p[repeated], p[repeated])
            first = np.flatnonzero(first)
            for i in range(0, len(first), 1 << 18):  # dealt out by both names
                f = first[i:i + (1 << 18)]
                yield _rows(b, x[f], y[f], SHARED, r[f], p[f], p[f])

    return run


def _remove(lengths: Lengths, with_text: bool):
    """Texts with their repeated spans to what is left of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, offs = text_bytes(column(b, "text"))
            row, _, lo, hi = _spans(b)
            # bytes under repeated windows; runs that touch are one
            r, lo, hi = _merged(row, lo, hi + lengths.t - 1)
            at = np.searchsorted(r, np.arange(b.num_rows + 1))
            removed, sha, left = [], [], []
            for k in range(b.num_rows):
                own, start, cut = [], int(offs[k]), 0
                for i in range(at[k], at[k + 1]):
                    end = int(offs[k] + lo[i])
                    own.append(values[start:end])
                    start = int(offs[k] + hi[i] + 1)
                    cut += int(hi[i] - lo[i] + 1)
                own.append(values[start:int(offs[k + 1])])
                kept = own[0].tobytes() if len(own) == 1 else np.concatenate(own).tobytes()
                removed.append(cut)
                sha.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    left.append(kept)
            cols = [column(b, "id"), pa.array(np.diff(offs)), pa.array(removed, pa.int64()),
                    pa.array(np.diff(at).astype(np.int64)), pa.array(sha, pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols.append(pa.array(left, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def _route() -> Column:
    """What a row is dealt out by: its anchor's name, or both names if the anchor may be hot (equal classes still meet)."""
    by_both = F.col("n").bitwiseAND(F.lit(3)) == SHARED
    return F.when(by_both, F.xxhash64("x", "y")).otherwise(F.col("x"))


def _document(d: DataFrame) -> DataFrame:
    """Adds ``h, g``: with its id they name a document. Both are 0 where ids are unique; if any id is shared, 128 bits
    of each text tell the rows that share it apart (and order them)."""
    shared = not d.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    h, g = (F.xxhash64("text"), F.xxhash64(F.lit(1), "text")) if shared else (F.lit(0).cast("long"), F.lit(0).cast("long"))
    return d.withColumns({"h": h, "g": g})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                   with_text: bool = False) -> DataFrame:
    """One row per input row: ``id_col, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the bytes left).

    Removes each byte of the UTF-8 text that is covered by a string of ``threshold``
    bytes that also starts earlier: in a document with a smaller id, or earlier in the same one. Strings
    are judged on the input. What is left may split a character, so it is binary.
    Defined results: a null text is empty; a null id is smaller than any other; rows that share
    an id are documents each, in the order of their text's hash, and rows that repeat both id and text
    are one document, whose result each of them gets; other columns are not read; no rows in, no rows out.
    """
    lengths = Lengths(threshold)
    d = _document(docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")))
    kind = docs.schema[id_col].dataType.simpleString()
    own = f"id {kind}, h bigint, g bigint"
    rows = f"x bigint, y bigint, n int, {own}, at int"
    spans = f"kind int, {own}, lo int, hi int"

    def ranked(df: DataFrame, ask: bool) -> DataFrame:
        """Positions dealt out by name, sorted by their pair of names, reranked."""
        return df.repartition(_route()).sortWithinPartitions(*SPAN).mapInArrow(_settle(ask), spans)

    def with_spans(df: DataFrame, how: str) -> DataFrame:
        own = df.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("kind", "lo", "hi")).alias("spans")).select(
            *[F.col(c).alias(f"of_{c}") for c in DOCUMENT], "spans")
        same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")) & (F.col("g") == F.col("of_g"))
        return d.join(own, same, how).select(*DOCUMENT, "text", "spans")

    found = ranked(d.mapInArrow(_sample(lengths), rows), True)
    for step in (2, 3):
        found = ranked(with_spans(found, "inner").mapInArrow(_parts(lengths, step), rows), True)
    found = ranked(with_spans(found, "inner").mapInArrow(_positions(lengths), rows), False)
    out = with_spans(found, "left").mapInArrow(
        _remove(lengths, with_text),
        f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text)
    return out.withColumnRenamed("id", id_col)
