"""Toxicity scores from two class-conditional Kneser-Ney models.

Both models are over the bytes of words (a space before and after), to the
order ``ORDER``: the highest order, and what begins a word, counts occurrences; the lower ones
count the different bytes seen before (Kneser-Ney's continuation counts), and each order
backs off to the one below. Expressions seen fewer than ``COMMON`` times in both classes together
are left to the orders below, and the lowest ``SHARED`` orders take the pooled counts of both classes, so what
neither class knows well gets nearly the same likelihood from both, and says nothing.

The log-likelihoods of the two models are compared per byte over the whole text,
and for the words that speak most for the toxic model: a few words in a
long text hardly move its mean. A logistic curve, fitted on labelled rows that
the models have not counted, turns both into a score.

The counted rows are a sample of the labelled ones, at most ``max_train_docs`` of
each class, of ``max_train_chars`` characters together at most (both parameters):
that bounds the model, which is broadcast. All documents are scored
where they are read, over their whole text; nothing is shuffled but ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textblocks import Words, blocks, column, mix, text_bytes
from tickwise.session import ensure_checkpoint_dir

ORDER, SHARED, COMMON, TOP = 9, 2, 6, 3
MAX_TRAIN_DOCS, MAX_TRAIN_CHARS = 1500, 30_000_000
_PAD = 0x20
_CACHE = 1 << 19  # word scores a task remembers


def fold(id_col: str, folds: int = 5) -> Column:
    """crc32 of the id as text, mod ``folds``; 0 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def _padded(low: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with a space on both sides, one after another; their starts; each byte's place in its word."""
    size = length + 2
    begin = np.cumsum(size) - size
    out = np.full(int(size.sum()), _PAD, np.uint8)
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(begin + 1, length) + at] = low[np.repeat(start, length) + at]
    return out, begin, np.arange(len(out)) - np.repeat(begin, size)


def _grams(text: np.ndarray, depth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the n-grams that lie in a word, and their bytes packed in two words (n <= 16)."""
    ends = np.flatnonzero(depth >= max(n - 1, 1))
    lo, hi = np.zeros(len(ends), np.uint64), np.zeros(len(ends), np.uint64)
    for j in range(n):
        part = lo if j < 8 else hi
        part |= text[ends - j].astype(np.uint64) << np.uint64(8 * (j % 8))
    return ends, lo, hi


def _key(lo: np.ndarray, hi: np.ndarray, n) -> np.ndarray:
    return mix(lo ^ mix(hi + np.uint64(0x9E3779B97F4A7C15) * np.asarray(n, np.uint64)))


def _prefix(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (lo >> np.uint64(8)) | (hi << np.uint64(56)), hi >> np.uint64(8)


def _suffix(lo: np.ndarray, hi: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    mask = lambda k: np.uint64((1 << (8 * min(max(k, 0), 8))) - 1)
    return lo & mask(n - 1), hi & mask(n - 9)


def _summed(lo: np.ndarray, hi: np.ndarray, n, counts: np.ndarray):
    """Distinct grams, their lengths and summed counts."""
    n = np.broadcast_to(np.asarray(n), lo.shape)
    _, at, inv = np.unique(_key(lo, hi, n), return_index=True, return_inverse=True)
    return lo[at], hi[at], n[at], np.column_stack([np.bincount(inv, counts[:, c], len(at)) for c in (0, 1)])


@dataclass
class Models:
    """Sorted keys of grams and contexts with, per class, the discounted
    probability of a gram and the weight a context leaves to the order below."""

    first: np.ndarray   # order 1, shared: probability of each byte
    grams: np.ndarray
    p: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray
    order: int

    def word_scores(self, low: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary)."""
        if not len(start):
            return np.zeros(0)
        text, begin, depth = _padded(low, start, length)
        p = np.repeat(self.first[text][:, None], 2, axis=1)
        for n in range(2, self.order + 1):
            ends, lo, hi = _grams(text, depth, n)
            ctx, key = _key(*_prefix(lo, hi), n - 1), _key(lo, hi, n)
            at = np.minimum(np.searchsorted(self.contexts, ctx), len(self.contexts) - 1)
            seen = self.contexts[at] == ctx
            ends, key, at = ends[seen], key[seen], at[seen]
            g = np.minimum(np.searchsorted(self.grams, key), len(self.grams) - 1)
            p[ends] = np.where((self.grams[g] == key)[:, None], self.p[g], 0) + self.rest[at] * p[ends]
        ratio = np.log(p[:, 1]) - np.log(p[:, 0])
        ratio[begin] = 0
        return np.add.reduceat(ratio, begin)


def fit_models(words: list[bytes], counts: np.ndarray, order: int = ORDER, shared: int = SHARED,
               common: int = COMMON) -> Models:
    """``counts``: occurrences of each word in ordinary and in toxic texts."""
    length = np.array([len(w) for w in words], np.int64)
    low = np.frombuffer(b"".join(words), np.uint8)
    text, _, depth = _padded(low, np.cumsum(length) - length, length)
    weight = np.repeat(counts.astype(float), length + 2, axis=0)
    # the highest order, and the shorter grams that begin a word, count occurrences
    levels = []
    for n in range(2, order + 1):
        ends, lo, hi = _grams(text, depth, n)
        own = np.ones(len(ends), bool) if n == order else depth[ends] == n - 1
        levels.append(_summed(lo[own], hi[own], n, weight[ends[own]]))
    top = levels[-1]
    for n in range(order, 1, -1):  # continuation counts: different bytes before
        top = _summed(*_suffix(top[0], top[1], n), n - 1, (top[3] > 0).astype(float))
        if n > 2:
            levels.append(top)
    total = np.zeros(256)
    total[top[0].astype(int)] = top[3].sum(axis=1)
    d = 0.75
    first = (np.maximum(total - d, 0) + d * (total > 0).sum() / 256) / total.sum()
    lo, hi, level, c = (np.concatenate(x) for x in zip(*levels))
    grams = _key(lo, hi, level)
    o = np.argsort(grams)
    grams, lo, hi, level, c = grams[o], lo[o], hi[o], level[o], c[o]
    pooled = c.sum(axis=1, keepdims=True)
    discount = np.full((order + 1, 1), 0.5)
    for n in range(2, order + 1):
        once, twice = (pooled[level == n] == 1).sum(), (pooled[level == n] == 2).sum()
        if once:
            discount[n] = once / (once + 2 * twice)
    contexts, inv = np.unique(_key(*_prefix(lo, hi), level - 1), return_inverse=True)

    def kept(counts: np.ndarray) -> np.ndarray:
        """Discounted probability of each gram after its context."""
        sums = np.column_stack([np.bincount(inv, counts[:, k]) for k in range(counts.shape[1])])
        return np.maximum(counts - discount[level], 0) / np.maximum(sums[inv], 1)

    # a rare gram has no entry of its own: what it would get goes to the order below
    p = np.where((level <= shared)[:, None], kept(pooled), kept(c))
    some = (pooled[:, 0] >= common) | (level <= shared)
    grams, p, inv = grams[some], p[some], inv[some]
    contexts, inv = contexts[np.unique(inv)], np.unique(inv, return_inverse=True)[1]
    rest = np.maximum(1 - np.column_stack([np.bincount(inv, p[:, k], len(contexts)) for k in (0, 1)]), 1e-3)
    return Models(first, grams, p, contexts, rest, order)


class Features:
    """Features of the rows of blocks: mean log-ratio per byte, that of the most toxic word, the mean
    of the ``TOP`` most toxic different words, log of the words.

    Scores of words are remembered from block to block.
    """

    def __init__(self, models: Models):
        self.models = models
        self.known, self.scores = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, w: Words) -> np.ndarray:
        rows = len(w.first) - 1
        out = np.zeros((rows, 4))
        if not len(w):
            return out
        h, at, inv = np.unique(w.hashes(), return_index=True, return_inverse=True)
        score = np.zeros(len(h))
        if len(self.known):
            k = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            old = self.known[k] == h
            score[old] = self.scores[k[old]]
        else:
            old = np.zeros(len(h), bool)
        new = np.flatnonzero(~old)
        score[new] = self.models.word_scores(w.low, w.start[at[new]], (w.end - w.start)[at[new]])
        if len(new) and len(self.known) + len(new) > _CACHE:
            self.known, self.scores = h, score
        elif len(new):
            known, scores = np.append(self.known, h[new]), np.append(self.scores, score[new])
            o = np.argsort(known)
            self.known, self.scores = known[o], scores[o]
        each = score[inv]
        full = np.flatnonzero(np.diff(w.first) > 0)
        first = w.first[full]
        out[full, 0] = np.add.reduceat(each, first) / np.add.reduceat(w.end - w.start + 1, first)
        out[full, 1] = np.maximum.reduceat(each, first)
        for_toxic = np.flatnonzero(each > 0)
        pair = np.unique(w.row[for_toxic] * len(h) + inv[for_toxic])  # a word counts once a text
        row, high = pair // len(h), score[pair % len(h)]
        o = np.lexsort((-high, row))
        row, high = row[o], high[o]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        out[:, 2] = np.bincount(row[place < TOP], high[place < TOP], rows) / TOP
        out[full, 3] = np.log1p(np.diff(w.first)[full])
        return out


def _over_rows(rows: pa.RecordBatch, texts: pa.Array, features: Features) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    data, offs = text_bytes(texts)
    for a, z in blocks(offs):
        yield rows.slice(a, z - a), features.of(Words(data, offs[a:z + 1]))


@dataclass
class Classifier:
    models: Models
    weights: np.ndarray  # intercept, then one for each scaled feature
    mean: np.ndarray
    sd: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + (x - self.mean) / self.sd @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method for a ridge-penalised logistic curve."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - penalty * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fitting(rows: list, max_chars: int) -> list:
    """The rows, in their order, that fit into a number of characters together."""
    out, used = [], 0
    for r in rows:
        if used + r["size"] <= max_chars:
            out.append(r)
            used += r["size"]
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_train_docs: int = MAX_TRAIN_DOCS, max_train_chars: int = MAX_TRAIN_CHARS) -> Classifier | None:
    """Fit on labelled rows of folds 1 to 4: 1 to 3 are counted, 4 fits the curve.

    Of each class and purpose the ``max_train_docs`` rows that come first by a hash
    of the id, as far as they have at most ``max_train_chars`` characters together (a row that
    does not fit any more is passed over). Texts of every length are used. None when a class has no row. Labels other
    than 0 and 1 and null ids are left out; an id labelled both ways counts as toxic; of rows that share an id
    one is used, chosen by a hash of the text.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y"))
    text_hash = F.xxhash64("text")
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    one = given.filter(F.col("id").isNotNull()).groupBy("id").agg(
        F.min(text_hash).alias("hash"), F.max(F.length("text")).alias("size"))
    marked = marked.withColumn("fold", fold("id")).filter("fold > 0").join(one, "id").select(
        "id", "y", (F.col("fold") < 4).alias("counted"), "hash", "size").checkpoint()
    n = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    picks = [marked.filter((F.col("y") == y) & (F.col("counted") == c)).orderBy(F.xxhash64("id"), "id").limit(max_train_docs)
             for y in (0, 1) for c in (True, False)]
    ids = [r for p in picks for r in _fitting(p.collect(), max_train_chars)]  # 4 * max_train_docs at most
    if len({(r["y"], r["counted"]) for r in ids}) < 4:
        return None
    sample = spark.createDataFrame([tuple(r) for r in ids], marked.schema)
    rows = (given.withColumn("hash", text_hash).join(F.broadcast(sample), ["id", "hash"])
            .dropDuplicates(["id"]).select("text", "y", "counted"))  # an id's rows may repeat

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_bytes(column(b, "text"))
            for a, z in blocks(offs):
                y = column(b, "y").to_numpy()[a:z]
                w = Words(data, offs[a:z + 1])
                h = w.hashes()
                if not len(h):
                    continue
                _, at, inv = np.unique(h, return_index=True, return_inverse=True)
                toxic = y[w.row] == 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([w.low[w.start[i]:w.end[i]].tobytes() for i in at.tolist()], pa.binary()),
                    pa.array(np.bincount(inv, ~toxic, len(at)).astype(np.int64)), pa.array(np.bincount(inv, toxic, len(at)).astype(np.int64))],
                    ["word", "ordinary", "toxic"])

    counted = rows.filter("counted").select("text", "y").mapInArrow(count, "word binary, ordinary bigint, toxic bigint").groupBy(
        "word").agg(F.sum("ordinary").alias("o"), F.sum("toxic").alias("t")).toArrow()
    if not counted.num_rows:
        return None
    words = counted["word"].to_pylist()
    models = fit_models(words, np.column_stack([counted["o"].to_numpy(), counted["t"].to_numpy()]))
    fitted = rows.filter(~F.col("counted")).select("text", "y").mapInArrow(
        _features(spark, models), "y int, x array<double>").toArrow()
    x, y = np.array(fitted["x"].to_pylist()).reshape(-1, 4), fitted["y"].to_numpy().astype(float)
    share = n[1] / (n[0] + n[1])
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    mean, sd = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    return Classifier(models, _logistic((x - mean) / sd, y, weight), mean, sd)


def _features(spark, models: Models):
    shared = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value)
        for b in batches:
            for rows, x in _over_rows(b, column(b, "text"), features):
                yield pa.RecordBatch.from_arrays([column(rows, "y"), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    return run


def _run(classifier: Classifier | None, spark, out, text_col: str = "text"):
    """Batches through the classifier; ``out(rows, scores)`` makes what is sent on."""
    shared = spark.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        features = c and Features(c.models)
        for b in batches:
            if c is None:
                yield out(b, np.zeros(b.num_rows))
                continue
            for rows, x in _over_rows(b, column(b, text_col), features):
                yield out(rows, c.score(x))

    return run


def score(docs: DataFrame, classifier: Classifier | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` of every row. Defined results: a null text is empty, and
    an empty text has the score of one without words; without a classifier all scores
    are 0; repeated rows are scored each; other columns are not read."""
    kind = dict(docs.dtypes)[id_col]

    def out(rows: pa.RecordBatch, s: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([column(rows, "id"), pa.array(s)], ["id", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _run(classifier, docs.sparkSession, out), f"id {kind}, score double").withColumnRenamed("id", id_col)


def reject_toxic(docs: DataFrame, classifier: Classifier | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, all columns as they were."""
    def out(rows: pa.RecordBatch, s: np.ndarray) -> pa.RecordBatch:
        return rows.filter(pa.array(s < threshold))

    return docs.mapInArrow(_run(classifier, docs.sparkSession, out, text_col), docs.schema)
