"""Quality classifier: ridge regression on random Fourier features, then isotonic calibration.

Statistics of the whole text (``STATS``) are standardised and mapped to
``FEATURES`` random cosines, which approximate a Gaussian kernel. Each
partition sums its share of the normal equations, one fixed-size matrix a
partition; the matrices are added up in a tree on the executors, and the driver
solves one ``FEATURES`` x ``FEATURES`` system. The raw scores of rows that were not
fitted are binned on a fixed grid, and pool-adjacent-violators over the
grid gives the calibrated curve.

All labelled rows of folds 1 to 4 are used, 1 to 3 in the fit and 4 in the
calibration. Texts are read once, where they lie: only their statistics (a
few numbers a row) are written, joined to the labels and scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textblocks import Words, blocks, column, text_bytes
from tickwise.session import ensure_checkpoint_dir

STATS = ["log_bytes", "log_words", "word_length", "word_length_sd", "distinct_words", "top_word", "repeated_next",
         "upper", "digits", "symbols", "spaces", "lines", "non_ascii", "letters_entropy", "one_letter"]
FEATURES, WIDTH, RIDGE, SEED = 256, 3.0, 1e-3, 11
GRID = 4096        # bins of raw scores, over [-1, 2]
TREE = 32          # matrices added up by one task

_KIND = np.zeros(256, np.int64)  # 1 upper, 2 digit, 3 symbol, 4 space, 5 line break, 6 non-ASCII
_KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 6
for _c in b"#$%&*+<=>@[]^_`{|}~\\/":
    _KIND[_c] = 3
_KIND[[32, 9, 11, 12, 13]], _KIND[10] = 4, 5


def statistics(w: Words, raw: np.ndarray) -> np.ndarray:
    """``STATS`` of the rows of a block; zeros for an empty text. ``raw``: the block's bytes as written."""
    rows = len(w.first) - 1
    n, size = np.diff(w.first), np.diff(w.offsets)
    out = np.zeros((rows, len(STATS)))
    row_of = np.repeat(np.arange(rows), size)
    kinds = np.bincount(row_of * 7 + _KIND[raw], minlength=rows * 7).reshape(rows, 7) / np.maximum(size, 1)[:, None]
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(n)
    out[:, [7, 8, 9, 10, 11, 12]] = kinds[:, 1:]
    seen = np.bincount(row_of * 32 + (w.low & 31), minlength=rows * 32).reshape(rows, 32) / np.maximum(size, 1)[:, None]
    out[:, 13] = -(seen * np.log(np.where(seen > 0, seen, 1))).sum(axis=1)
    if len(w):
        length = (w.end - w.start).astype(float)
        some = np.maximum(n, 1)
        mean = np.bincount(w.row, length, rows) / some
        out[:, 2] = mean
        out[:, 3] = np.sqrt(np.maximum(np.bincount(w.row, length ** 2, rows) / some - mean ** 2, 0))
        out[:, 14] = np.bincount(w.row, length == 1, rows) / some
        h = w.hashes()
        same = (h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])
        out[:, 6] = np.bincount(w.row[1:], same, rows) / some
        o = np.lexsort((h, w.row))
        new = np.append(True, (h[o][1:] != h[o][:-1]) | (w.row[o][1:] != w.row[o][:-1]))
        begin = np.flatnonzero(new)
        times, owner = np.diff(np.append(begin, len(h))), w.row[o][begin]
        out[:, 4] = np.bincount(owner, minlength=rows) / some
        np.maximum.at(out[:, 5], owner, times)
        out[:, 5] /= some
    return out


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, x`` of every row: the statistics of its whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(column(b, "text"))
            for a, z in blocks(offs):
                x = statistics(Words(data, offs[a:z + 1]), data[offs[a]:offs[z]])
                flat = pa.array(x.ravel())
                yield pa.RecordBatch.from_arrays([column(b, "id").slice(a, z - a), pa.ListArray.from_arrays(
                    pa.array(np.arange(0, len(flat) + 1, x.shape[1]), pa.int32()), flat)], ["id", "x"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


def _matrix(col: pa.Array) -> np.ndarray:
    if not len(col):
        return np.zeros((0, len(STATS)))
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


@dataclass
class Kernel:
    """Random Fourier features of a Gaussian kernel of width ``width`` on standardised statistics."""

    mean: np.ndarray
    sd: np.ndarray
    w: np.ndarray
    b: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(np.clip((x - self.mean) / self.sd, -8, 8) @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.column_stack([z, np.ones(len(z))])


@dataclass
class Classifier:
    kernel: Kernel
    beta: np.ndarray
    knots: np.ndarray  # raw scores, ascending
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def _tree_sum(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Adds up one ``m`` (float64 bytes) a partition: ``TREE`` to a task, until few are left."""
    n = int(np.prod(shape))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for b in batches:
            for m in b.column(1):
                total += np.frombuffer(m.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "m"])

    groups = parts.rdd.getNumPartitions()
    while groups > TREE:
        groups = -(-groups // TREE)
        parts = parts.repartition(groups, F.pmod("part", F.lit(groups))).mapInArrow(add, "part int, m binary")
    total = np.zeros(n)
    for row in parts.toLocalIterator():
        total += np.frombuffer(row["m"], np.float64)
    return total.reshape(shape)


def isotonic(positives: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing fit to ``positives / counts``."""
    level: list[list[float]] = []
    for p, n in zip(positives, counts):
        level.append([p, n, 1])
        while len(level) > 1 and level[-2][0] * level[-1][1] >= level[-1][0] * level[-2][1]:
            p, n, k = level.pop()
            level[-1] = [level[-1][0] + p, level[-1][1] + n, level[-1][2] + k]
    return np.repeat([p / n for p, n, _ in level], [k for _, _, k in level])


def train(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Classifier | None:
    """Fit on all labelled rows of folds 1 to 4. None when no row is left for the fit or
    the calibration. Null ids, and labels other than 0 and 1, are left out; an id
    labelled both ways counts as 0."""
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % 5
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.min("y").alias("y")).withColumn("fold", fold)
    rows = stats.join(marked.filter("fold > 0"), "id").select("x", "y", "fold").checkpoint()
    fit, rest = rows.filter("fold < 4").drop("fold"), rows.filter("fold = 4").drop("fold")
    n_stats = len(STATS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_stats, 3))
        for b in batches:
            x = _matrix(column(b, "x"))
            total += np.column_stack([np.full(n_stats, len(x)), x.sum(axis=0), (x ** 2).sum(axis=0)])
        yield _part(total)

    n, s, q = _tree_sum(fit.mapInArrow(moments, "part int, m binary"), (n_stats, 3)).T
    if not n[0] or rest.isEmpty():
        return None
    mean = s / n
    rng = np.random.default_rng(SEED)
    kernel = Kernel(mean, np.sqrt(np.maximum(q / n - mean ** 2, 1e-12)), rng.standard_normal((n_stats, FEATURES)) / WIDTH,
                    rng.uniform(0, 2 * np.pi, FEATURES))

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for b in batches:
            z, y = kernel.features(_matrix(column(b, "x"))), column(b, "y").to_numpy()
            total += z.T @ np.column_stack([z, y])
        yield _part(total)

    m = _tree_sum(fit.mapInArrow(normal, "part int, m binary"), (FEATURES + 1, FEATURES + 2))
    beta = np.linalg.solve(m[:, :-1] + RIDGE * n[0] / FEATURES * np.eye(FEATURES + 1), m[:, -1])
    plain = Classifier(kernel, beta, np.zeros(1), np.zeros(1))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((GRID, 3))
        for b in batches:
            raw, y = plain.raw(_matrix(column(b, "x"))), column(b, "y").to_numpy()
            at = np.clip(((raw + 1) / 3 * GRID).astype(int), 0, GRID - 1)
            total += np.column_stack([np.bincount(at, weights, GRID) for weights in (np.ones(len(at)), y, raw)])
        yield _part(total)

    count, ones, raw = _tree_sum(rest.mapInArrow(binned, "part int, m binary"), (GRID, 3)).T
    has = count > 0
    value = isotonic(ones[has], count[has])
    # the curve runs through the middle of each step, so better raw scores stay better
    starts = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    weight = np.add.reduceat(count[has], starts)
    return Classifier(kernel, beta, np.add.reduceat(raw[has], starts) / weight, value[starts])


def _part(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                       pa.array([total.tobytes()], pa.binary())], ["part", "m"])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """``id_col, score`` of every row, score from 0 to 1.

    Defined results: null and empty texts have the statistics of no text and are
    scored by them; without usable labels every score is 0; repeated rows
    are scored each; a null id is scored and never trains; other columns are not
    read; no rows in, no rows out.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    stats = text_statistics(docs, id_col, text_col).checkpoint()
    shared = docs.sparkSession.sparkContext.broadcast(train(stats, labels, id_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for b in batches:
            s = c.score(_matrix(column(b, "x"))) if c else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(s)], ["id", "score"])

    return stats.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, score double").withColumnRenamed("id", id_col)
