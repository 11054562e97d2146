"""Corpus cleaning: documents to packed token sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickwise.llm import decontaminate, exact_dedup, packing, registry, simhash, toxicity
from tickwise.session import ensure_checkpoint_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models find toxic go."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, registry.table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go."""
    return decontaminate.remove_contaminated(docs, registry.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs, registry.TOKENIZER_PATH, registry.RANKS_PATH)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Models, fingerprints and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each stage but the last keeps is written under ``spark.checkpoint.dir`` as Parquet, and read by the next."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = registry.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        if k:
            path = f"{folder}/{STAGES[k - 1][0]}"
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
        docs = stage(spark, docs, sf_dir)
    return docs
