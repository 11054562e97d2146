"""The quality query against a plain version: statistics text by text, one system over all rows, isotonic fit by its definition."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from .rows import SMALL, awkward_rows

from tickwise.llm import quality, registry
from tickwise.llm.textblocks import Words, text_bytes

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_statistics(text):
    raw = (text or "").encode()
    low = raw.lower()
    words = WORD.findall(low)
    n, size = max(len(words), 1), max(len(raw), 1)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    times = Counter(words)
    letters = Counter(b & 31 for b in low)
    share = lambda test: sum(map(test, raw)) / size
    return [math.log1p(len(raw)), math.log1p(len(words)), mean, math.sqrt(max(sum(x * x for x in lengths) / n - mean ** 2, 0)),
            len(times) / n, max(times.values(), default=0) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
            share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in b"#$%&*+<=>@[]^_`{|}~\\/"),
            share(lambda b: b in b" \t\x0b\x0c\r"), share(lambda b: b == 10), share(lambda b: b >= 128),
            -sum(c / size * math.log(c / size) for c in letters.values()), sum(x == 1 for x in lengths) / n]


def slow_isotonic(positives, counts):
    """At each place the largest, over starts before it, of the smallest mean up to an end after it."""
    p, n = np.append(0, np.cumsum(positives)), np.append(0, np.cumsum(counts))
    k = len(counts)
    mean = np.full((k, k), np.nan)
    for a in range(k):
        mean[a, a:] = (p[a + 1:] - p[a]) / (n[a + 1:] - n[a])
    return np.array([max(mean[a, i:].min() for a in range(i + 1)) for i in range(k)])


def slow_scores(docs, labels):
    """``{doc_id: score}`` of documents with different ids."""
    marks = {}
    for i, y in labels:
        marks[i] = min(y, marks.get(i, 1))
    x = np.array([slow_statistics(t) for _, t in docs])
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i, _ in docs])
    y = np.array([marks.get(i, -1) for i, _ in docs])
    fit, rest = (y >= 0) & (fold > 0) & (fold < 4), (y >= 0) & (fold == 4)
    rng = np.random.default_rng(quality.SEED)
    w = rng.standard_normal((x.shape[1], quality.FEATURES)) / quality.WIDTH
    b = rng.uniform(0, 2 * np.pi, quality.FEATURES)
    z = np.clip((x - x[fit].mean(axis=0)) / np.sqrt(np.maximum(x[fit].var(axis=0), 1e-12)), -8, 8)
    z = np.column_stack([np.cos(z @ w + b) * math.sqrt(2 / quality.FEATURES), np.ones(len(x))])
    # ridge as least squares with further rows
    pull = math.sqrt(quality.RIDGE * fit.sum() / quality.FEATURES) * np.eye(quality.FEATURES + 1)
    beta = np.linalg.lstsq(np.vstack([z[fit], pull]), np.append(y[fit], np.zeros(len(pull))), rcond=None)[0]
    raw = z @ beta
    bins = {}
    for r, label in zip(raw[rest], y[rest]):
        bins.setdefault(min(max(int((r + 1) / 3 * quality.GRID), 0), quality.GRID - 1), []).append((r, label))
    bins = [np.array(bins[k]) for k in sorted(bins)]
    value = slow_isotonic([g[:, 1].sum() for g in bins], [len(g) for g in bins])
    steps = {}
    for v, g in zip(value, bins):
        steps.setdefault(round(v, 12), []).append(g[:, 0])
    knots = [np.concatenate(g).mean() for g in steps.values()]
    return dict(zip((i for i, _ in docs), np.clip(np.interp(raw, knots, list(steps)), 0, 1)))


def test_statistics_text_by_text():
    import pyarrow as pa
    texts = [t for _, t in awkward_rows()] + ["", None, "a", "A a\tb\n\nB", "é É 12 é", "x" * 5000, "#$ / \\ ~"]
    data, offs = text_bytes(pa.array(texts, pa.string()))
    got = quality.statistics(Words(data, offs), data)
    assert np.allclose(got, [slow_statistics(t) for t in texts], rtol=0, atol=1e-9)


@pytest.mark.parametrize("seed", range(5))
def test_isotonic_by_its_definition(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 6, 60)
    positives = rng.binomial(counts, np.linspace(0.1, 0.9, 60))
    assert np.allclose(quality.isotonic(positives, counts), slow_isotonic(positives, counts))


def test_query_equals_the_plain_version(spark):
    docs = [tuple(r) for r in registry.table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in registry.table(spark, SMALL, "labels").selectExpr("doc_id", "int(quality)").collect()]
    want = slow_scores(docs, [(i, y) for i, y in labels if y in (0, 1)])
    got = {r.doc_id: r for r in registry.op5_quality(spark, SMALL).collect()}
    assert len(got) == len(docs) == len(want)
    worst = max(abs(got[i].score - s) for i, s in want.items())
    assert worst < 1e-9, worst
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
