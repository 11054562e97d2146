"""Query keys of this package: one ``opN_<name>`` per operator, and ``pipeline``.

Each applies its operator, with production parameters, to the whole table it is
meant for. ``/opt/tokenizers`` is only the default place of the vocabulary files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import (chat_format, decontaminate, exact_dedup, importance, license_scan, line_dedup, packing, quality,
                          simhash, spelling, suffix_dedup, toxicity, url_filter)

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"  # the same vocabulary as ranks
TOKENIZER_PATH, RANKS_PATH = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, whose texts hold the template's own strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(0, 2, 1, 1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    messages = given.unionByName(own).select("conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts"))
    return chat_format.digest(chat_format.format_messages(messages))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classifier = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _verdicts(toxicity.score(docs, classifier), 0.5)


def _verdicts(scored: DataFrame, threshold: float) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan_licenses(table(spark, sf_dir, "documents")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), 0.3)


# Fixed rules of the contract: host, path, action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(0, 1, 1, 1).select(F.explode(F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for h, p, a in URL_RULES]))
        .alias("r")).select("r.*")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER_PATH, RANKS_PATH)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), typo_every=97)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_common_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), sizes=range(1, 2),
                                buckets=10_000, min_words=20, share=(10, 100), seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_chat_format, op2_toxicity, op3_suffix_dedup, op4_license_scan, op5_quality, op6_url_filter, op7_decontaminate, op8_simhash,
    op9_packing, op10_exact_dedup, op11_spelling, op12_line_dedup, op13_importance)}
