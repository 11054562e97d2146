r"""Grouping of spelling variants with a permuterm index.

A word w is marked at its end, ``w$``; its rotations are ``w[j:]$w[:j]``. Two words are near if one inserted,
deleted or replaced code point makes one of the other, and a rotation brings that place to the end:

* replaced: both have a rotation that starts behind the place, and these agree in all but the last code point;
* deleted: the longer word's rotation without its last code point is a whole rotation of the shorter word.

So each rotation is entered under itself and under its prefix without the last code point. Spark sorts
all entries, and the entries of a range share a prefix that skips the edited place: the words of the range are
near each other, and near the one word whose whole rotation the prefix is. A range has
at most one word per code point that can stand there, and a whole one, so no range grows with the
input. Of a run of equal code points only the first counts as deleted; so a pair is met in one range only and
neighbours can be counted by adding up.

Each member of a range emits its number of neighbours there and the most frequent of them, not the pairs. A word's form is
its most frequent neighbour overall if that is frequent enough; its root is found by pointer jumping along forms,
with a checkpoint a round.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textblocks import column
from tickwise.session import ensure_checkpoint_dir

MARK = "$"
LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
_CHUNK = 1 << 20     # code points of a text looked at together
_HELD = 1 << 18      # words a task counts before it sends the counts on


def _pieces(text: str, outside: re.Pattern) -> Iterator[str]:
    """A text in pieces of about ``_CHUNK`` code points that end beside a run."""
    a = 0
    while a < len(text):
        m = outside.search(text, a + _CHUNK) if len(text) - a > _CHUNK else None
        b = m.start() if m else len(text)
        yield text[a:b]
        a = b


def typo(run: str, h: int, every: int) -> str:
    """A run without its code point ``h % length`` if ``every`` divides ``h``."""
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = LETTERS,
                min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, typo_every: int | None = None) -> DataFrame:
    """``word, n``: runs of ``letters`` (a character class), A-Z lower-cased, with at least ``min_chars`` code points
    and ``min_count`` occurrences.

    With ``typo_every`` a run loses a code point where that number divides crc32 of ``id:run``, the same wherever the run
    stands in the document: typing errors for measuring."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = re.compile(f"[{letters}]+"), re.compile(f"[^{letters}]")
        counts: Counter = Counter()

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                              ["word", "n"])

        for b in batches:
            for key, text in zip(column(b, "id").to_pylist(), column(b, "text").cast(pa.large_binary())):
                if not text.is_valid:
                    continue
                begin = crc32(f"{'null' if key is None else key}:".encode())
                for piece in _pieces(text.as_buffer().to_pybytes().lower().decode(), outside):
                    for word, n in Counter(inside.findall(piece)).items():
                        if typo_every:
                            word = typo(word, crc32(word.encode(), begin), typo_every)
                        if len(word) >= min_chars:
                            counts[word] += n
                    if len(counts) >= _HELD:
                        yield ready()
                        counts.clear()
        if counts:
            yield ready()

    return (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, last, n, first``: each rotation under itself (``last`` is empty), and under all but its last code point
    unless that is the mark; ``first``: the skipped code point begins a run of equal ones."""
    w, size = F.col("word"), F.length("word")
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("j"))
    before, last = F.substring(w, F.lit(1), F.col("j") - 1), F.substring(w, F.col("j"), F.lit(1))
    behind = F.concat(F.substring(w, F.col("j") + 1, size), F.lit(MARK))
    whole = F.struct(F.concat(behind, F.substring(w, F.lit(1), F.col("j"))).alias("prefix"), F.lit("").alias("last"),
                     F.lit(False).alias("first"))
    skip = F.struct(F.concat(behind, before).alias("prefix"), last.alias("last"),
                    ((F.col("j") == 1) | (F.substring(w, F.col("j") - 1, F.lit(1)) != last)).alias("first"))
    both = F.when(F.col("j") == 0, F.array(whole)).otherwise(F.array(whole, skip))
    return turned.select("n", F.explode(both).alias("e")).select("e.prefix", "e.last", "n", "e.first")


def _range(prefix: str, members: list[tuple[str, int, bool]]) -> Iterator[tuple[str, int, int, str]]:
    """What the members of one range emit: word, neighbours in the range, the count and name of the most frequent."""
    tail, head = prefix.split(MARK)
    named = [(-n, head + last + tail, first, last) for last, n, first in members]
    whole = [m for m in named if not m[3]]
    skips = sorted(m for m in named if m[3])
    for v in whole:
        longer = [m for m in skips if m[2]]
        if longer:
            yield v[1], len(longer), -longer[0][0], longer[0][1]
    for m in skips:
        near = [s for s in skips[:2] if s is not m][:1] + (whole if m[2] else [])
        if near:
            best = min(near)
            yield m[1], len(skips) - 1 + (len(whole) if m[2] else 0), -best[0], best[1]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries to what each range emits; a range may go on in the next batch."""
    held: list[tuple[str, str, int, bool]] = []

    def emitted(rows: list[tuple[str, str, int, bool]]) -> pa.RecordBatch:
        out, a = [], 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][0] != rows[a][0]:
                if i - a > 1:
                    out += _range(rows[a][0], [r[1:] for r in rows[a:i]])
                a = i
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
            ["word", "n_near", "best_n", "best"])

    for b in batches:
        prefix = column(b, "prefix")
        n = len(prefix)
        if not n:
            continue
        same = pc.equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False) if n > 1 else []
        # entries beside an equal one, and those at the batch's ends
        use = [i for i in range(n) if i == 0 or i == n - 1 or same[i - 1] or same[i]]
        pick = pa.array(use, pa.int64())
        rows = held + list(zip(*(column(b, c).take(pick).to_pylist() for c in ("prefix", "last", "n", "first"))))
        a = len(rows) - 1
        while a and rows[a - 1][0] == rows[-1][0]:
            a -= 1
        held = rows[a:]
        yield emitted(rows[:a])
    yield emitted(held)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: of each word that has a near word their number and the most frequent one (ties: the
    smallest in code-point order)."""
    met = (rotations(words).repartition("prefix").sortWithinPartitions("prefix", "last")
           .mapInArrow(_scan, "word string, n_near bigint, best_n bigint, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of a checkpointed ``word, form``: the end of each chain, which doubles its reach each round."""
    cur = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = cur.select(F.col("word").alias("at"), F.col("root").alias("far"))
        step = cur.join(ahead, cur.root == ahead.at, "left").select(
            "word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")).checkpoint()
        cur = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return cur


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = LETTERS,
                   min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                   typo_every: int | None = None) -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``.

    ``form``: the near word of largest n (ties: the smallest in code-point order) if its n is at least ``ratio`` (two or more) times
    the word's; else null. ``root``: the last word along the forms, the word itself if it has none. ``letters`` must not
    hold ``$``. Defined results: null and empty texts have no words; a null id counts as the text ``null`` where typing errors
    are drawn; repeated rows are counted each; other columns are not read; no words, no rows.
    """
    if ratio < 2:
        raise ValueError("counts have to grow along the forms")
    ensure_checkpoint_dir(docs.sparkSession)
    words = word_counts(docs, id_col, text_col, letters, min_chars, min_count, typo_every).checkpoint()
    near = near_words(words)
    formed = F.col("best_n") >= ratio * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best")).alias("form"),
        F.when(formed, F.col("best_n")).alias("form_n")).checkpoint()
    ends = roots(out.filter(F.col("form").isNotNull()).select("word", "form"))
    return out.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
