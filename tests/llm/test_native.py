"""Chat formatting and URL filters: built-in functions only, exact round trip, brute force."""
import hashlib
import random

import pytest
from .rows import with_clashes
from pyspark.sql import functions as F

from tickwise.llm import chat_format, registry, url_filter


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_native_plans(spark):
    for name in ("op1_chat_format", "op6_url_filter"):
        p = plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert not any(x in p for x in ("Python", "Arrow", "Pandas", "ExistingRDD")), p


# --- chat formatting ---

ODD = ["", None, "</turn>", "### user: x</turn>\n", "\\", "\\\\/turn>", "<|image|>", "<\\|", "\\### a", "a\nb</turn>\n### assistant: c",
       "%3A:%25", "###", "####", "<</turn>>", "é🙂 \\n", "\\### Assistant: </turn> ok", "$1 \\1", "x" * 200000]


def test_round_trip(spark):
    rng = random.Random(3)
    given = []
    for c in range(60):
        for t in range(rng.randint(1, 6)):
            given.append((c if c else None, None if c == 7 else t, rng.choice(["user", "assistant", "system", None, "a:b%3A\\</turn>"]),
                          rng.choice(ODD) if rng.random() < .7 else "".join(rng.choices("\\<|>/turn#: \n", k=30))))
    given += [(5, 0, "user", "twice"), (5, 0, "user", "twice")]  # a tie of repeated rows: two turns
    df = with_clashes(spark.createDataFrame(given, "conv_id long, turn long, role string, text string").withColumn(
        "parts", chat_format.text_part(F.col("text"))).drop("text"))
    out = chat_format.read_back(chat_format.format_messages(df)).collect()
    convs = {}
    for c, t, r, x in given:
        convs.setdefault(c, []).append((t, r or "", x or ""))
    assert len(out) == len(convs)
    for r in out:
        own = convs[r.conv_id]
        got = [(x.role, x.text) for x in r.turns]
        assert sorted(got) == sorted(x[1:] for x in own) and r.n_turns == len(own)
        if all(x[0] is not None for x in own) and len({x[0] for x in own}) == len(own):
            assert got == [x[1:] for x in sorted(own)]
        assert r.loss_texts == [t for a, t in got if a == "assistant"]
        for s in r.loss_spans:
            block = r.blocks[s.turn]
            assert block[s.start:s.start + s.length] == block[len("### assistant: "):]
        assert not any(x in b[len("### "):] for b in r.blocks for x in ("</turn>", "<|", "###"))
        assert "</turn>" not in "".join(r.blocks) and r.formatted.count("</turn>\n") == len(own)


def test_control_strings_across_parts(spark):
    """Texts cut into two to four parts at every place of the template's strings, some with an attachment between."""
    rng = random.Random(12)
    cut = []
    for whole in ("a</turn>\n### user: b", "<|image|>", "####", "x### y", "\\</turn>", "<<|audio|>|>"):
        for i in range(len(whole) + 1):
            cut.append([whole[:i], whole[i:]])
            j, k = sorted((rng.randint(i, len(whole)), rng.randint(i, len(whole))))
            cut += [[whole[:i], whole[i:j], whole[j:]], [whole[:i], whole[i:j], whole[j:k], whole[k:]], [whole[:i], None, whole[i:j], "", whole[j:]]]
    given = []
    for c, texts in enumerate(cut):
        parts = [("text" if rng.random() < .8 else None, t, None) for t in texts]
        if c % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), ("image", None, f"ref{c}"))
        given += [(c, 0, "user", parts), (c, 1, "assistant", [("text", "ok", None)] + parts[::-1])]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, parts array<struct<kind:string,text:string,ref:string>>")
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.format_messages(df)).collect()}
    for c, texts in enumerate(cut):
        r = out[c]
        turns = [parts for conv, _, _, parts in given if conv == c]
        want = ["".join("<|image|>" if k == "image" else t or "" for k, t, _ in parts) for parts in turns]
        assert [t.text for t in r.turns] == want and [t.role for t in r.turns] == ["user", "assistant"]
        assert r.formatted.count("</turn>") == 2 and r.formatted.count("### ") == 2
        assert r.formatted.count("<|") == r.formatted.count("<|image|>") == len(r.attachments) == (2 if c % 3 == 0 else 0)
        assert "".join(r.loss_texts) == "".join(t or "" for k, t, _ in turns[1] if k != "image")


def test_turns_as_rows(spark):
    """Without putting conversations together: a row per message, no shuffle, the same blocks."""
    df = spark.createDataFrame([(1, t, "user" if t % 2 == 0 else "assistant", f"### {t}") for t in range(50)], "conv_id long, turn long, role string, text string")
    df = df.withColumn("parts", chat_format.text_part(F.col("text")))
    turns = chat_format.format_turns(df)
    assert "Exchange" not in plan(turns)
    whole = chat_format.format_messages(df).first()
    assert "".join(r.block + chat_format.END for r in turns.orderBy("turn").collect()) == whole.formatted


def test_contract_conversation(spark):
    got = {r.conv_id: r for r in registry.op1_chat_format(spark, "/root/testdata/sf0.001").collect()}[-7]
    text = "\\### Assistant: </turn> ok"
    assert got.n_turns == 2 and got.loss_chars == len(text) and got.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_typed_parts(spark):
    part = chat_format.PART
    p = lambda kind, **kw: {"kind": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None, **kw}
    given = [
        (1, 0, "user", [p("text", text="see "), p("image", ref="a.png", width=57, height=28), p(None, text=" and "), p("audio", ref="b", seconds=1.01)]),
        (1, 1, "assistant", [p("text", text="first "), p("document", ref="d", pages=3), p("text", text="<|image|> last")]),
        (2, 0, "assistant", []), (2, 1, "assistant", None), (2, 2, "user", [p("video", ref="v"), p("image", ref=None)])]
    df = spark.createDataFrame(given, f"conv_id long, turn long, role string, parts array<{part}>")
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.format_messages(df)).collect()}
    one = out[1]
    assert one.formatted == "### user: see <|image|> and <|audio|></turn>\n### assistant: first <|document|><\\|image|> last</turn>\n"
    assert [(a.kind, a.ref, a.tokens) for a in one.attachments] == [("image", "a.png", 3), ("audio", "b", 26), ("document", "d", 1536)]
    assert one.attachment_tokens == 1565 and one.loss_texts == ["first ", "<|image|> last"]
    assert [(a.kind, a.ref, a.tokens) for a in out[2].attachments] == [("video", "v", 1), ("image", None, 1)]
    assert out[2].formatted == "### assistant: </turn>\n### assistant: </turn>\n### user: <|video|><|image|></turn>\n"


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, parts array<struct<kind:string,text:string>>")
    assert chat_format.digest(chat_format.format_messages(df)).collect() == []


# --- URL filters ---

def slow_judge(url, rules, default="allow"):
    url = url or ""
    if "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), len(p), a, h + p) for h, p, a in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


URLS = ["http://a.example.net/en/x", "http://example.net/en", "https://EXAMPLE.net/en/?q#f", "ftp://x.y.example.com/de/1", "http://example.com",
        "http://net", "http://net/", "net/", None, "", "://", "http:///en/", "http://notexample.net/en/", "http://org/fr/x://y.net/",
        "http://u@h.org:80/fr/", "http://a..net/x", "http://.net/", "http://é.org/fr/é", "HTTP://A.ORG?x=/fr/", "a://b\nc.net/x\ny?z", "http://x.net#/", "http://net./"]


def judged(spark, urls, rules, **kw):
    pages = with_clashes(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    r = with_clashes_rules(spark.createDataFrame(rules, "host string, path string, action string"))
    return [tuple(x)[1:] for x in sorted(url_filter.judge_urls(pages, r, **kw).collect())]


def with_clashes_rules(df):
    return df.withColumns({"page_id": F.lit(1), "url": F.lit("x"), "rule": F.lit("y")})


def test_urls_brute_force(spark):
    assert judged(spark, URLS * 2, registry.URL_RULES) == [slow_judge(u, registry.URL_RULES) for u in URLS * 2]


@pytest.mark.parametrize("max_blocks", [1, 1 << 17])
def test_long_list(spark, max_blocks):
    """A list much too long for the filter's bound passes more, and gives the same verdicts."""
    rng = random.Random(6)
    hosts = ["net", "com", "a.net", "b.net", "a.b.net", "x.com", "y.x.com"]
    paths = ["/", "/a", "/a/", "/a/b", "/b/c/", ""]
    rules = list({(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)}) + [
        (f"h{i}.org", "/", "block") for i in range(3000)] + [("", "/", "block"), (None, "/", "block"), ("q.net", None, "block")]
    urls = [f"http://{rng.choice(['', 'w.', 'a.', 'z.z.'])}{rng.choice([*hosts, 'q.net', 'h7.org', 'h99999.org'])}{rng.choice([*paths, '/a/bc', '/c?x'])}"
            for _ in range(400)]
    given = [(h, p or "", a) for h, p, a in rules if h]
    assert judged(spark, urls, rules, max_blocks=max_blocks) == [slow_judge(u, given) for u in urls]


def test_urls_empty(spark):
    none = spark.createDataFrame([], "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge_urls(pages, none).collect()] == [(1, "a.net", "/", None, "allow")]
    assert url_filter.judge_urls(pages.filter("false"), none).collect() == []


def test_bloom_filter_has_no_false_negatives(spark):
    rules = spark.range(2000).select(F.concat(F.lit("h"), F.col("id"), F.lit(".net")).alias("host"), F.lit("/").alias("path"))
    bits = url_filter.bloom_filter(rules, 16)
    asked = url_filter._hashed(rules, "host", "path", 16).join(bits, "block")
    assert bits.count() <= 16
    assert asked.filter(" AND ".join(f"(w{i} & m{i}) = m{i}" for i in range(8))).count() == 2000


def test_urls_without_a_host_are_spread(spark):
    """Two thirds of the pages have no host and one URL is hot: the last join has a key of its own on both sides."""
    urls = [None] * 200 + ["no scheme"] * 200 + ["http://a.net/x"] * 150 + [f"http://h{k}.org/fr/{k}" for k in range(50)]
    rules = spark.createDataFrame([("net", "/", "block"), ("org", "/fr/", "allow")], "host string, path string, action string")
    out = url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4), rules)
    p = plan(out)
    assert p.count("Exchange hashpartitioning(key") >= 2 and "monotonically_increasing_id" in p
    got = [r["rule"] for r in out.collect()]
    assert len(got) == 600 and got.count(None) == 400 and got.count("net/") == 150 and got.count("org/fr/") == 50
