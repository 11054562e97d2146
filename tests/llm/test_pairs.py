"""Exact dedup, SimHash and suffix dedup against brute force."""
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from .rows import CLASHING, awkward_rows, prose, with_clashes

from tickwise.llm import exact_dedup, simhash, suffix_dedup


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- exact dedup ---

def groups_of(given):
    texts = defaultdict(list)
    for i, t in given:
        texts[(t or "").encode().lower()].append(i)
    return texts


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_awkward(awkward, keep):
    got = rows(exact_dedup.exact_dedup(with_clashes(awkward), keep=keep))
    want = groups_of(awkward_rows())
    assert len(got) == len(awkward_rows())
    by_sha = defaultdict(list)
    for i, k, n, kept, sha in got:
        by_sha[sha].append((i, k, n, kept))
    assert set(by_sha) == {hashlib.sha256(t).hexdigest() for t in want}
    for t, ids in want.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        own = by_sha[hashlib.sha256(t).hexdigest()]
        assert sorted(map(str, ids)) == sorted(str(i) for i, *_ in own)
        assert {(k, n) for _, k, n, _ in own} == {(best, len(ids))}
        assert [i for i, _, _, kept in own if kept] == [best]


def test_exact_dedup_tells_colliding_hashes_apart(awkward):
    """A one-byte content hash: only the bytes keep the groups apart."""
    weak = exact_dedup.exact_dedup(awkward, content_hash=lambda t: bytes([len(t) % 2]))
    assert sorted(map(str, rows(weak))) == sorted(map(str, rows(exact_dedup.exact_dedup(awkward))))


def test_exact_dedup_lower_cases_ascii_only(spark):
    df = spark.createDataFrame([(1, "É"), (2, "é"), (3, "E"), (4, "e"), (5, "İ"), (6, "i̇")], "doc_id long, text string")
    assert {i for i, _, n, _, _ in rows(exact_dedup.exact_dedup(df)) if n == 2} == {3, 4}


def test_drop_exact_copies_keeps_columns(awkward):
    df = with_clashes(awkward)
    out = exact_dedup.drop_exact_copies(df, keep="largest")
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(groups_of(awkward_rows()))
    assert {r["doc_id"] for r in got if r["text"] and r["text"].lower() == awkward_rows()[0][1].lower()} == {3}
    assert all(r[c] == f"own {c}" for r in got for c in CLASHING)


def test_exact_dedup_empty(nothing):
    assert rows(exact_dedup.exact_dedup(nothing)) == []
    assert rows(exact_dedup.drop_exact_copies(nothing)) == []


# --- SimHash ---

def slow_simhash(text: str | None) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {i: 32 for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(given):
    fps = [slow_simhash(t) for _, t in given]
    parent = list(range(len(given)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(given)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(given):
        r = find(k)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return sorted(((str(i), f"{fps[k]:016x}", str(least[find(k)])) for k, (i, _) in enumerate(given)))


def test_simhash_awkward(awkward):
    got = rows(simhash.simhash_groups(with_clashes(awkward)).select("doc_id", "fingerprint", "component_id"))
    assert sorted((str(i), f, str(c)) for i, f, c in got) == slow_groups(awkward_rows())


def test_simhash_documents(spark, documents):
    given = rows(documents.select("doc_id", "text"))
    got = rows(simhash.simhash_groups(documents).select("doc_id", "fingerprint", "component_id"))
    assert sorted((str(i), f, str(c)) for i, f, c in got) == slow_groups(given)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bits", [1, 2, 3])
def test_tally_finds_every_pair_of_a_list_within_the_limit(seed, bits):
    rng = np.random.default_rng(seed)
    keyed = 2 * (4 - bits)
    rest = np.array([list(range(keyed, 8)), list(range(8 - keyed))])
    fp, lists, choice = [], [], []
    for n in range(12):
        kind, base = n % 2, int(rng.integers(0, 2**64, dtype=np.uint64))
        members = {base}
        for _ in range(30):
            x = base
            for b in rng.choice(8 * (8 - keyed), int(rng.integers(0, 4)), replace=False):
                x ^= 1 << int(b + 8 * rest[kind, 0])
            members.add(x)
        fp += sorted(members)
        lists += [n] * len(members)
        choice += [kind] * len(members)
    got = simhash._tallied(np.array(fp, np.uint64), np.array(lists), np.array(choice), rest, bits)
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp))
            if lists[i] == lists[j] and (fp[i] ^ fp[j]).bit_count() <= bits}
    assert set(map(tuple, got.tolist())) == want and len(got) == len(want)


@pytest.mark.parametrize("max_bits, list_rows", [(2, simhash.LIST_ROWS), (2, 3), (2, 0), (1, 4), (3, 16), (4, 16)])
def test_links_find_every_pair_and_no_other(spark, max_bits, list_rows):
    """Random fingerprints with planted neighbours at 0 to 4 bits, a dense ball and a long chain; lists short and too long."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    fps = set(base.tolist())
    for d in (1, 2, 3, 4):
        for x in base[:20].tolist():
            for b in rng.choice(64, d, replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    centre = int(base[0])
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(16)}   # one large posting list
    x = int(base[1])
    for b in range(0, 62, 2):
        x ^= (1 << b) | (1 << (b + 1))
        fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits, list_rows)
    label = {n % (1 << 64): x for n, x in rows(simhash.components(edges))}
    parent = {f: f for f in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= max_bits:
                parent[find(a)] = find(b)
    want, got = defaultdict(set), defaultdict(set)
    for f in fps:
        want[find(f)].add(f)
        got[label.get(f, ("alone", f))].add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_drop_near_copies(awkward, nothing):
    df = with_clashes(awkward)
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    want = {c for _, _, c in slow_groups(awkward_rows())}
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(want)
    assert rows(simhash.drop_near_copies(nothing)) == [] and rows(simhash.simhash_groups(nothing)) == []


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_many_repeats_of_a_row(spark, keep):
    """A third of all rows are one row, with an id and without: exactly one of a class is kept, and no row is regrown."""
    docs = [(None, None)] * 300 + [(5, "Same")] * 200 + [(9, "same")] * 3 + [(k, f"own {k}") for k in range(100, 400)]
    out = exact_dedup.exact_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), keep=keep)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.collect()
    assert len(got) == len(docs)
    kept = sorted(str(r["doc_id"]) for r in got if r["kept"])
    assert kept == sorted(["None", "5" if keep == "smallest" else "9", *map(str, range(100, 400))])
    sizes = {r["doc_id"]: r["group_size"] for r in got}
    assert sizes[None] == 300 and sizes[5] == sizes[9] == 203 and sizes[100] == 1


# --- suffix dedup ---

def slow_repeats(given, t, rank=str):
    """(n_bytes, n_removed, n_spans, sha) by row; rows repeating id and text are one document; ``rank`` orders texts of one id."""
    docs = {}
    order = sorted({(i is not None, i or 0, x or "") for i, x in given}, key=lambda d: (d[0], d[1], rank(d[2])))
    seen = set()
    for known, i, text in order:
        b = text.encode()
        cover = np.zeros(len(b) + 1, int)
        for s in range(len(b) - t + 1):
            k = b[s:s + t]
            if k in seen:
                cover[s] += 1
                cover[s + t] -= 1
            seen.add(k)
        gone = np.cumsum(cover[:-1]) > 0
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        docs[(i if known else None, text)] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted((str(i), *docs[(i, x or "")]) for i, x in given)


def check(spark, given, t, rank=str):
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    got = sorted((str(i), *r) for i, *r in rows(suffix_dedup.remove_repeats(df, threshold=t)))
    assert got == slow_repeats(given, t, rank)


@pytest.mark.parametrize("t", [8, 13, 100])
def test_suffix_dedup_random(spark, t):
    rng = random.Random(t)
    shared = [prose(rng, 40) for _ in range(4)]
    given = []
    for i in range(60):
        parts = [prose(rng, rng.randint(1, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            parts += [s[a:a + rng.randint(t // 2, 3 * t)], prose(rng, rng.randint(0, 20))]
        given.append((i, "".join(parts)))
    given += [(100 + i, given[i][1]) for i in range(0, 20, 3)] + [(200, "ab" * 300), (201, "abc" * 200), (202, "a" * 500), (203, None), (204, "")]
    rng.shuffle(given)
    check(spark, given, t)


def test_suffix_dedup_few_letters(spark):
    """Two letters: nearly every anchor occurs often, so much goes on to the last round."""
    rng = random.Random(1)
    given = [(i, "".join(rng.choices("ab", k=rng.randint(0, 400)))) for i in range(40)]
    check(spark, given, 12)


def test_suffix_dedup_awkward(spark, awkward):
    given = [(i, t) for i, t in awkward_rows() if t is None or len(t) < 100000]
    df = with_clashes(awkward).filter("text is null or length(text) < 100000")
    got = sorted((str(i), *r) for i, *r in rows(suffix_dedup.remove_repeats(df)))
    assert [g[:2] for g in got] == [w[:2] for w in slow_repeats(given, 100)]
    both = [w for w in slow_repeats(given, 100)]
    assert got == both


def test_suffix_dedup_long_text_is_cut_into_segments(spark):
    """A text of several segments, and its copy: all of the copy but nothing of the first goes."""
    rng = random.Random(9)
    text = prose(rng, 60000)
    n = len(text.encode())
    assert n > 3 * suffix_dedup.SEGMENT
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(df, with_text=True).collect()}
    assert got[2]["n_removed"] == n and got[2]["kept"] == b"" and got[2]["n_spans"] == 1
    assert got[1]["n_removed"] == 0 and got[1]["kept"] == text.encode()


def test_suffix_dedup_compares_whole_names(spark):
    """Windows that differ in their last ten bytes only, and whose second names agree in the high 32 bits,
    in batches of their own: nothing is repeated."""
    rng = np.random.default_rng(3)
    lengths = suffix_dedup.Lengths(100)
    while True:  # a start that holds the anchor, and all that the rounds before the last compare by
        start = rng.integers(97, 123, 90).astype(np.uint8)
        name = suffix_dedup._names(start, [lengths.k])[0] >> np.uint64(24)
        if name.argmin() < 4 and name.min() < np.uint64(1 << 33):
            break
    ends = rng.integers(97, 123, (10, 200_000)).astype(np.uint8)
    last, = suffix_dedup._names(np.concatenate([np.repeat(start[50:, None], ends.shape[1], axis=1), ends]), [50])
    high = last[0] >> np.uint64(32)
    o = np.argsort(high, kind="stable")
    twins = np.flatnonzero(high[o[1:]] == high[o[:-1]])[:20]
    pairs = [(o[i], o[i + 1]) for i in twins if (ends[:, o[i]] != ends[:, o[i + 1]]).any()]
    assert pairs
    given = [(n, (start.tobytes() + ends[:, c].tobytes()).decode()) for n, c in enumerate(c for p in pairs for c in p)]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "1")
    try:
        check(spark, given, 100)
    finally:
        spark.conf.set(size, before)


def test_suffix_dedup_rows_that_share_an_id(spark):
    """Texts whose 32-bit hashes agree, under one id or none, are documents each: what they share goes once."""
    rng = random.Random(21)
    base = prose(rng, 60)
    made = spark.range(300_000).select(F.concat(F.lit(base), F.lit(" "), F.hex(F.xxhash64("id"))).alias("t"))
    twins = [r["ts"] for r in made.groupBy(F.hash("t")).agg(F.collect_list("t").alias("ts")).filter("size(ts) = 2").limit(4).collect()]
    assert len(twins) == 4 and len(base) > 150
    by_hash = {r["text"]: (r["h"], r["g"]) for r in suffix_dedup._document(spark.createDataFrame(
        [(1, t) for pair in twins for t in pair], "id long, text string")).collect()}
    assert len(set(by_hash.values())) == 8
    for key in (7, None):
        check(spark, [(key, t) for t in twins[0]], 100, by_hash.get)
    check(spark, [(k % 2 or None, t) for k, pair in enumerate(twins) for t in pair] + [(1, twins[0][0])] * 3, 100, by_hash.get)


def test_suffix_dedup_deals_out_by_both_names(spark):
    """Round 4's rows before a common passage: one second name, many first ones; they do not go to one reducer."""
    flag = suffix_dedup.SHARED
    df = spark.createDataFrame([(i, 7 << 32, flag) for i in range(1000)] * 2, "x long, y long, n int")
    where = rows(df.repartition(8, suffix_dedup._route()).select("x", F.spark_partition_id().alias("p")).distinct())
    assert len(where) == 1000  # equal classes meet
    assert len({p for _, p in where}) == 8


def test_suffix_dedup_empty(nothing):
    assert rows(suffix_dedup.remove_repeats(nothing)) == []
