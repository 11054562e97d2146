"""Spelling variants, line dedup and importance resampling against slow versions."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickwise.llm import importance, line_dedup, spelling

from .rows import awkward_rows, prose, with_clashes

DOCS = "doc_id long, text string"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# --- spelling variants ---

def near(a, b):
    """Exactly one insertion, deletion or replacement."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_variants(docs, typo_every=None, min_chars=5, min_count=3):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = low(run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if typo_every and h % typo_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    found = {w: [v for v in n if near(v, w)] for w in n}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return [(w, n[w], len(found[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n]


VARIANT = ["word", "n", "n_near", "form", "form_n", "root"]


def variant_docs():
    """Words at one edit of each other in chains, doubled letters, letters beyond ASCII, ties."""
    rng = random.Random(8)
    base = ["aabbcc", "abcabc", "letter", "balloon", "ÀÉîõü", "straße", "x" * 12, "mississippi"]
    made = []
    for w in base:
        for _ in range(25):
            v = w
            for _ in range(rng.randint(0, 2)):
                i = rng.randrange(len(v))
                c = rng.choice("abcslxéß")
                v = rng.choice([v[:i] + v[i + 1:], v[:i] + c + v[i:], v[:i] + c + v[i + 1:]])
            made += [v] * rng.choice([1, 3, 3, 4, 6, 8, 16, 40])
    rng.shuffle(made)
    return awkward_rows() + [(5000 + k, rng.choice([" ", "-", "1", "ł"]).join(made[k::40])) for k in range(40)]


@pytest.mark.parametrize("every", [None, 3, 97])
def test_variants_brute_force(spark, every):
    docs = variant_docs()
    df = with_clashes(spark.createDataFrame(docs, DOCS)).repartition(5)
    got = rows(spelling.group_variants(df, typo_every=every), *VARIANT)
    want = slow_variants(docs, every)
    assert got == sorted(want, key=str)
    assert any(w[3] for w in want) and any(w[2] > 3 for w in want)
    assert any(w[5] not in (w[0], w[3]) for w in want)  # chains of two forms


def test_variants_of_a_frequent_word(spark):
    """A third of all words is one word; it moves as one row a task and its range stays small."""
    docs = [(k, "market " * 400 + "marken market maret " * 2 + f"word{'abcdefghij'[k % 10] * 5}") for k in range(60)]
    got = {r["word"]: r for r in spelling.group_variants(spark.createDataFrame(docs, DOCS).repartition(6)).collect()}
    assert got["market"]["n"] == 60 * 402 and got["market"]["n_near"] == 2
    assert got["marken"]["root"] == got["maret"]["root"] == "market"


def test_variants_cut_only_beside_a_run(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_CHUNK", 7)
    text = "abcdefghijklmnop qrstuv abcdefghijklmnop-abcdefghijklmnop"
    outside = re.compile("[^a-z]")
    assert [w for p in spelling._pieces(text, outside) for w in re.findall("[a-z]+", p)] == re.findall("[a-z]+", text)


def test_each_pair_meets_once(spark):
    words = spark.createDataFrame([("aaabb", 9), ("aabb", 5), ("aaabbb", 3), ("aaabc", 2)], "word string, n long")
    got = rows(spelling.near_words(words), "word", "n_near", "best_n", "best")
    assert got == sorted([("aaabb", 3, 5, "aabb"), ("aabb", 1, 9, "aaabb"), ("aaabbb", 1, 9, "aaabb"),
                          ("aaabc", 1, 9, "aaabb")], key=str)


def test_variants_empty(spark, nothing, awkward):
    assert spelling.group_variants(nothing).collect() == []
    assert spelling.group_variants(awkward.filter("doc_id = 9")).collect() == []


# --- line dedup ---

def slow_lines(docs, min_docs=10, min_chars=1, keep="none"):
    key = lambda s: low(s.strip(" \t\n\x0b\x0c\r"))
    split = [(t or "").split("\n") for _, t in docs]
    seen = Counter(k for ls in split for k in {key(s) for s in ls})
    common = {k for k, n in seen.items() if n >= min_docs and len(k) >= min_chars}
    first = {}
    if keep == "first":
        for (i, _), ls in sorted(zip(docs, split), key=lambda x: (x[0][0] is None, x[0][0])):
            for at, s in enumerate(ls):
                first.setdefault(key(s), (i, at))
    out = []
    for (i, t), ls in zip(docs, split):
        kept = [s for at, s in enumerate(ls) if key(s) not in common or first.get(key(s)) == (i, at)]
        text = "\n".join(kept)
        out.append((i, len(ls), len(ls) - len(kept), hashlib.sha256(text.encode()).hexdigest(), text))
    return out


def line_docs():
    rng = random.Random(3)
    often = [prose(rng, 6) for _ in range(30)]
    docs = awkward_rows() + [(None, "Foot\nfoot"), (30, "\n\n"), (31, "\n"), (32, "\x00\n\x85 foot"), (33, "  FOOT\t\r\n foot \x0b")]
    for k in range(120):
        own = [prose(rng, 5) for _ in range(rng.randint(0, 4))]
        own += [rng.choice([" ", "", "\t"]) + rng.choice([s, s.upper()]) + rng.choice(["", " \r"]) for s in rng.sample(often, rng.randint(0, 9))]
        own += ["footer"] * (k % 3) + [""] * (k % 2) + ["é"] * (k % 4 == 0)
        rng.shuffle(own)
        docs.append((100 + k, "\n".join(own)))
    return docs


LINES = ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"]


@pytest.mark.parametrize("min_docs, min_chars", [(10, 1), (2, 1), (28, 2), (3, 7)])
def test_lines_brute_force(spark, min_docs, min_chars):
    docs = line_docs()
    df = with_clashes(spark.createDataFrame(docs, DOCS)).repartition(7)
    got = rows(line_dedup.drop_common_lines(df, min_docs=min_docs, min_chars=min_chars, with_text=True), *LINES)
    want = slow_lines(docs, min_docs, min_chars)
    assert got == sorted(want, key=str)
    assert any(w[2] for w in want)


def test_lines_keep_first(spark):
    rng = random.Random(1)
    docs = [(i, t) for i, t in line_docs() if i is not None]
    docs = list({i: (i, t) for i, t in docs}.values())  # one row an id, so the slow version knows the first
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    got = rows(line_dedup.drop_common_lines(df, min_docs=2, keep="first", with_text=True), *LINES)
    assert got == sorted(slow_lines(docs, 2, keep="first"), key=str)


def test_lines_with_a_full_filter(spark, monkeypatch):
    """Beyond its bound the filter suspects more lines; the rows are the same."""
    monkeypatch.setattr(line_dedup, "MIN_BITS", 64)
    monkeypatch.setattr(line_dedup, "MAX_BITS", 64)
    docs = line_docs()
    df = spark.createDataFrame(docs, DOCS).repartition(7)
    shared = line_dedup.seen_twice(df.select(F.coalesce("text", F.lit("")).alias("text")))
    assert len(shared.value) == 8 and (shared.value == 255).all()
    got = rows(line_dedup.drop_common_lines(df, with_text=True), *LINES)
    assert got == sorted(slow_lines(docs), key=str)


def test_filter_finds_all_repeats_and_few_others(spark):
    rng = random.Random(2)
    own = [f"line {k} {rng.random()}" for k in range(6000)]
    docs = [(k, "\n".join(own[k * 30:(k + 1) * 30] + [f"shared {k // 2}"])) for k in range(200)]
    twice = line_dedup.seen_twice(spark.createDataFrame(docs, DOCS).select("text").repartition(9)).value
    def hit(lines):
        h = [line_dedup.xxh3_128(line_dedup.line_key(s.encode())) for s in lines]
        return line_dedup._has(twice, line_dedup._places(h, 8 * len(twice))).mean()
    assert hit([f"shared {k}" for k in range(100)]) == 1.0
    assert hit(own) < (1 - math.exp(-2 * 6200 / (8 * len(twice)))) ** 2 + 0.005  # both bits set by others


def test_lines_colliding_hashes_stop(spark):
    """Two keys with one hash are an error, not one key."""
    docs = spark.createDataFrame([(k, f"one\nside {k % 2}\nline {k}") for k in range(40)], DOCS)
    assert line_dedup.drop_common_lines(docs).filter("n_dropped = 2").count() == 40
    weak = lambda key: bytes([len(key)]) * 16
    with pytest.raises(Exception, match="two lines agree"):
        line_dedup.drop_common_lines(docs, line_hash=weak).collect()


def test_lines_hot_row_is_not_one_task(spark):
    """A third of all rows are one row, and one line is in every document: joins are on keys of their own."""
    docs = [(None, "same\nrow")] * 200 + [(k, f"own {k}\nsame") for k in range(400)]
    out = line_dedup.drop_common_lines(spark.createDataFrame(docs, DOCS).repartition(8), with_text=True)
    got = Counter((r["doc_id"] is None, r["n_dropped"], r["kept"] if r["doc_id"] is None else "") for r in out.collect())
    assert got == Counter({(True, 2, ""): 200, (False, 1, ""): 400})


def test_lines_empty(spark, nothing):
    assert line_dedup.drop_common_lines(nothing).collect() == []
    with pytest.raises(ValueError):
        line_dedup.drop_common_lines(nothing, min_docs=1)


# --- importance resampling ---

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, sizes):
    w = WORD.findall(low(text))
    return len(w), [" ".join(w[i:i + n]) for n in sizes for i in range(len(w) - n + 1)]


def slow_resample(docs, target, sizes, buckets, min_words, share):
    code = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(code(g) for _, t in docs for g in grams(t, sizes)[1])
    t = Counter(code(g) for _, x in target for g in grams(x, sizes)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (S + buckets) / ((s[k] + 1) * (T + buckets)))) for k in range(buckets)]
    out = []
    for i, x in docs:
        n, g = grams(x, sizes)
        weight = sum(gain[code(v)] for v in g)
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    k = len(order) * share[0] // share[1]
    return out, [(r[4], r[0]) for r in order[:k]]


@pytest.mark.parametrize("sizes, buckets", [(range(1, 2), 10_000), (range(1, 4), 500), (range(2, 3), 77)])
def test_resample_brute_force(spark, sizes, buckets):
    rng = random.Random(6)
    docs = awkward_rows() + [(100 + k, rng.choice([" ", ", ", "\n\x00"]).join(prose(rng, rng.randint(0, 60)).split())) for k in range(150)]
    target = [(k, prose(rng, 40)) for k in range(20)] + [(90, None), (91, "")]
    df = with_clashes(spark.createDataFrame(docs, DOCS)).repartition(6)
    got = importance.resample(df, spark.createDataFrame(target, DOCS), sizes=sizes, buckets=buckets, min_words=12, share=(30, 100)).collect()
    want, drawn = slow_resample(docs, target, sizes, buckets, 12, (30, 100))
    cols = ["doc_id", "n_words", "n_features", "weight", "score"]
    assert sorted(str([r[c] for c in cols]) for r in got) == sorted(map(str, want))
    ranks = sorted((r["rank"], r["score"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranks] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranks] == drawn


def test_spans_overlap():
    text = importance.collapsed("A,b  C\x7fdé e".encode())
    assert text == "a b c dé e".encode()
    assert [s.decode() for s in importance.spans(text, 2)] == ["a b", "b c", "c dé", "dé e"]
    assert [s.decode() for s in importance.spans(text, 6)] == []
    assert list(importance.spans(importance.collapsed(b" .. "), 1)) == []


def test_ranks_with_a_third_equal(spark):
    """Equal rows share a range with no other bound than the salt: every rank is given once."""
    scored = spark.range(0, 900, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("score"), F.lit(1).alias("ok")).checkpoint()
    got = importance.ranked(scored, [F.col("score").desc()], F.col("ok") == 1).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 901))
    by_rank = [r["score"] for r in sorted(got, key=lambda r: r["rank"])]
    assert by_rank == sorted(by_rank, reverse=True) and {r["n_eligible"] for r in got} == {900}


def test_resample_empty(spark, nothing, awkward):
    assert importance.resample(nothing, awkward).collect() == []
    got = importance.resample(awkward, nothing.select("doc_id", "text")).collect()
    assert len(got) == awkward.count()
