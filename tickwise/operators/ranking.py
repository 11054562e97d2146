"""Exact area under the ROC curve of many groups in one pass.

AUC is the share of (positive, negative) pairs in the right order, ties counting half. Rows
are first counted by group and score, so tied rows, however many, are one. The counts are sorted by
range over all groups together: a large group is spread over many partitions, small ones share one. What the
partitions before hold of a group is a prefix sum over one row per group and partition, and inside
its partition a score adds the counts before it. Nothing is collected, and no group has to fit into a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.schemas import LABEL_COLUMN
from tickwise.session import ensure_checkpoint_dir


def grouped_auc(scored: DataFrame, groups: list[str], score: str, label: str = LABEL_COLUMN) -> DataFrame:
    """Per group: ``rows, positives, auc``. Defined results: rows with a null score or label are left out, NaN is the
    largest score, a label above 0 is positive; the AUC of a group with one class only is null; null groups are one group."""
    ensure_checkpoint_dir(scored.sparkSession)
    given = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = given.groupBy(*groups, F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) > 0).alias("_pos"), F.count_if(F.col(label) <= 0).alias("_neg"))
    # the partition of a score is part of the result, so it is settled once
    laid = counts.repartitionByRange(*groups, "_score").withColumn("_part", F.spark_partition_id()).checkpoint()
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("")) for g in groups] + [F.col(g).isNull() for g in groups]
    laid = laid.withColumn("_group", F.struct(*keys))
    # one row a group and partition; a group has at most as many as there are partitions
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("_group", "_part").agg(F.sum("_neg").alias("_n")).select(
        F.col("_group").alias("_of"), F.col("_part").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy("_group", "_part").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    ranked = laid.withColumn("_below", below).join(parts, (F.col("_group") == F.col("_of")) & (F.col("_part") == F.col("_at")))
    # twice the pairs in order, exact
    pairs = (F.col("_pos") * (2 * (F.col("_below") + F.col("_earlier")) + F.col("_neg"))).cast("decimal(38,0)")
    out = ranked.groupBy(*groups).agg(F.sum(F.col("_pos") + F.col("_neg")).alias("rows"), F.sum("_pos").alias("positives"), F.sum(pairs).alias("_pairs"))
    all_pairs = F.col("positives") * (F.col("rows") - F.col("positives"))
    return out.select(*groups, "rows", "positives", F.when(all_pairs > 0, F.col("_pairs").cast("double") / (2.0 * all_pairs)).alias("auc"))
