"""Sum-of-squares online packing of tokenised documents into fixed windows.

A document's ids are cut into full windows and a rest. Every rest is placed
online: among the fill levels it fits on (level 0: a new window) it goes to the
one that makes the sum of the squared counts of partially filled windows
smallest. The counts are kept in a level array of ``window`` entries; a stack for
each level names the open windows.

Each partition is one online stream over the rows where they are read: no
shuffle, and the state is the level array and the open windows. When the stream ends, the
open windows are closed: the pieces of the emptiest ones are cut to fill up the
fullest, and what is left in the last one is cut into windows whose fill
is a power of two, which need no padding. So no partition leaves padding.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of the byte-level BPE in a ``tokenizers`` file, special strings included.

    The same vocabulary as ranks gives the same ids several times faster; the
    ``tokenizers`` encoder does the texts whose white space that one can't split.
    """

    def __init__(self, json_path: str, ranks_path: str | None):
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(json_path)
        self.fast = None
        if ranks_path:
            import tiktoken
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items()}
            self.special = set(special)
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return np.array(self.fast.encode(text, allowed_special=self.special), np.uint32)
            except ValueError:  # its regular expression gave up on the text
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


class Packer:
    """Sum-of-squares placement of pieces into windows; ``take`` then ``finish``."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)  # open windows by fill level
        self.open: list[list[list]] = [[] for _ in range(window)]  # by level: lists of pieces
        self.closed: list[list] = []

    def place(self, piece: tuple, n: int) -> None:
        """Put a piece of ``n`` < window ids on the best level."""
        w = self.window
        levels = np.flatnonzero(self.counts[1:w - n + 1]) + 1  # open windows that have room
        # change of the sum of squares when a window goes from level h to h + n
        up = levels + n
        gain = np.where(up < w, 2 * self.counts[up] + 1, 0) - 2 * self.counts[levels] + 1
        h = 0
        if len(levels):
            best = int(np.argmin(gain))  # of equal ones the lowest level
            if gain[best] <= 2 * self.counts[n] + 1:
                h = int(levels[best])
        pieces = self.open[h].pop() if h else []
        pieces.append(piece)
        self.counts[h] -= h > 0
        if h + n == w:
            self.closed.append(pieces)
        else:
            self.open[h + n].append(pieces)
            self.counts[h + n] += 1

    def finish(self) -> Iterator[list]:
        """Close the open windows: cut the pieces of the emptiest to fill the fullest."""
        left = [(h, p) for h in range(1, self.window) for p in self.open[h]]
        a, b = 0, len(left) - 1
        spare: list = []  # pieces of the emptiest window so far not used up
        while a <= b:
            fill, pieces = left[b]
            b -= 1
            while fill < self.window:
                if not spare:
                    if a > b:
                        break
                    spare = left[a][1]
                    a += 1
                key, start, n = spare.pop()
                m = min(n, self.window - fill)
                pieces.append((key, start, m))
                if m < n:
                    spare.append((key, start + m, n - m))
                fill += m
            if fill == self.window:
                yield pieces
            else:
                spare = pieces + spare
        rest = sum(p[2] for p in spare)
        while rest:  # windows of a power of two need no padding
            room = 1 << (rest.bit_length() - 1)
            rest -= room
            pieces = []
            while room:
                key, start, n = spare.pop()
                m = min(n, room)
                pieces.append((key, start, m))
                if m < n:
                    spare.append((key, start + m, n - m))
                room -= m
            yield pieces


PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", window: int = WINDOW, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    Defined results: a null or empty text is the end id alone; a null id is
    packed like any other; repeated rows are packed each; other columns are
    not read; no rows in, no rows out. Sequence ids hold the partition number
    in their high bits, so a task that runs again gives the same rows.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(tokenizer_path, ranks_path), Packer(window)
        part, number = TaskContext.get().partitionId(), 0

        def out(sequences) -> Iterator[tuple]:
            nonlocal number
            for pieces in sequences:
                seq, at = (part << 40) + number, 0
                number += 1
                for (doc, ids, base, total), start, n in pieces:
                    own = ids[start - base:start - base + n]
                    yield doc, start, n, zlib.crc32(own.tobytes()), total, seq, at, own
                    at += n

        def batch(rows) -> pa.RecordBatch:
            c = list(zip(*rows)) or [[]] * 8
            cols = [pa.array(c[0], id_type), *[pa.array(x, pa.int64()) for x in c[1:7]]]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(pa.array([x.astype(np.int64) for x in c[7]], pa.list_(pa.int64())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(cols, names)

        id_type = None
        for b in batches:
            id_type = b.schema.field(0).type
            rows: list = []
            for doc, text in zip(b.column(0), b.column(1)):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                doc, total = doc.as_py(), len(ids)
                whole = total - total % window
                key = (doc, ids, 0, total)
                rows += out([(key, s, window)] for s in range(0, whole, window))
                if total > whole:
                    packer.place(((doc, ids[whole:].copy(), whole, total), whole, total - whole), total - whole)
                rows += out(packer.closed)
                packer.closed.clear()
                if len(rows) > 20000:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)
        if id_type is not None:
            yield batch(out(packer.finish()))

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, {PIECES}" + ", ids array<bigint>" * with_ids)
    return found.withColumnRenamed("id", id_col)
