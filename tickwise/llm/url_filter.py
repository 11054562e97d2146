"""URL filters: a blocked Bloom filter in front of an exact hash join.

Rules are (host, path, action). A rule fits its host and all subdomains of it
if the URL's path starts with the rule's path; the longest rule wins. The
listed canonical URLs are the rules' ``host + path``; a page asks for each
host suffix and path prefix that a rule could have.

The filter is a table of 512-bit blocks (eight 64-bit words, one bit set in
each word per listed URL), built by ``bit_or`` per block. It has at most
``max_blocks`` rows of 72 bytes whatever the list's length is; that bound is what
allows its broadcast. Possible hits go on to an exact join with the rules, which
removes the false positives; a list too long for the bound makes the filter
pass more, not the result wrong.

Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8
MAX_BLOCKS = 1 << 17   # 9 MB
KEYS_PER_BLOCK = 32    # 16 bits a key


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hashed(df: DataFrame, host: str, path: str, n_blocks: int) -> DataFrame:
    """Adds the block of a canonical URL and its mask in each word."""
    h = F.xxhash64(F.col(host), F.col(path), F.lit("bits"))
    df = df.withColumns({"block": F.pmod(F.xxhash64(F.col(host), F.col(path)), F.lit(n_blocks)), "h": h})
    masks = {f"m{i}": F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {6 * i}) & 63 as int))") for i in range(WORDS)}
    return df.withColumns(masks).drop("h")


def bloom_filter(rules: DataFrame, n_blocks: int) -> DataFrame:
    """At most ``n_blocks`` rows: ``block, w0 .. w7``."""
    return _hashed(rules, "host", "path", n_blocks).groupBy("block").agg(
        *[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict``.

    ``rules``: ``host, path, action``. ``rule`` is the winning rule's host + path
    (of equally long ones that with the longer path, then the larger action),
    or null, and then the verdict is ``default``. Defined results: a null URL, or
    one without ``://``, has empty host and path and fits no rule; rules with a null
    or an empty host fit nothing, a null path counts as empty; repeated rows are
    judged each; other columns are not read; empty tables give no rows, or the default.
    """
    own = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                       F.col("action")).filter(F.length("host") > 0)
    # bounded by the longest rule: how many labels a host has, how long paths are
    n, labels, lengths = own.agg(F.count(F.lit(1)), F.max(F.size(F.split("host", r"\."))),
                                 F.sort_array(F.collect_set(F.length("path")))).first()
    n_blocks = max(1, min(max_blocks, -(-n // KEYS_PER_BLOCK)))
    pages = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))

    asked = pages.select("host", "path").distinct().filter(F.length("host") > 0)
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels or 1))),
                           lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    prefixes = F.transform(F.filter(F.array(*[F.lit(x) for x in lengths] or [F.lit(0)]), lambda x: x <= F.length("path")),
                           lambda x: F.substring(F.col("path"), F.lit(1), x))
    asked = (asked.withColumn("rule_host", F.explode(suffixes)).withColumn("rule_path", F.explode(prefixes)))

    bits = F.broadcast(bloom_filter(own, n_blocks))
    possible = _hashed(asked, "rule_host", "rule_path", n_blocks).join(bits, "block").filter(
        F.expr(" AND ".join(f"(w{i} & m{i}) = m{i}" for i in range(WORDS)))).select("host", "path", "rule_host", "rule_path")
    exact = possible.join(own.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action"),
                          ["rule_host", "rule_path"])
    rule = F.concat("rule_host", "rule_path")
    best = exact.groupBy(F.concat("host", "path").alias("url")).agg(F.max(F.struct(
        F.length(rule).alias("size"), F.length("rule_path").alias("path_size"), F.col("action"), rule.alias("rule"))).alias("best"))
    # A key of its own on both sides, so a hot URL can be split (a host has no slash and a path begins with one, so host + path
    # says both); what has no host meets nothing and is dealt out by its place.
    key = F.when(F.length("host") > 0, F.concat(F.lit("u"), "host", "path")).otherwise(
        F.concat(F.lit("n"), F.monotonically_increasing_id().cast("string")))
    best = best.select(F.concat(F.lit("u"), "url").alias("key"), "best")
    return pages.withColumn("key", key).join(best, "key", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"))
