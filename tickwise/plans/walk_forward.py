"""Walk-forward validation: expanding training windows, an embargo, and the block of days that follows.

The calendar span is cut into ``k + 1`` blocks. Fold i trains on everything up to the end of block i less
``embargo`` days and is validated on block i + 1, so a row is trained on in many folds and no label or rolling feature of a training
row reaches into the block it is judged on. (A fold column can't express that: it puts a row into one fold.)
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators.ranking import grouped_auc
from tickwise.plans.model import assembler, classifier, persist_input, scaler, vector_to_array, without_summary
from tickwise.schemas import LABEL_COLUMN, LONG_WINDOW_ROWS

FOLDS, EMBARGO_DAYS = 5, LONG_WINDOW_ROWS

Fit = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]


def fold_bounds(df: DataFrame, k: int = FOLDS, embargo: int = EMBARGO_DAYS) -> DataFrame:
    """``fold, train_end, valid_start, valid_end`` (days, inclusive), one row per fold."""
    b = df.agg(F.min("date").alias("lo"), (F.datediff(F.max("date"), F.min("date")) + 1).alias("n")).filter(F.col("lo").isNotNull())
    at = lambda i: F.date_add("lo", F.floor(F.col("n") * i / (k + 1)).cast("int"))
    folds = b.select("lo", "n", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    return folds.select("fold", at(F.col("fold") + 1).alias("valid_start"), F.date_sub(at(F.col("fold") + 2), 1).alias("valid_end")).select(
        "fold", F.date_sub("valid_start", embargo + 1).alias("train_end"), "valid_start", "valid_end")


def walk_forward(labeled: DataFrame, fit: Fit, k: int = FOLDS, embargo: int = EMBARGO_DAYS, parallelism: int = 4,
                 checkpoint_input: bool = True) -> DataFrame:
    """Validation rows of all folds, with ``fold``, ``train_rows`` and what the fold's model adds (``prediction``, ``score``).

    ``fit`` takes the training rows of a fold and returns the function that adds the columns to its validation rows. Folds are
    fitted ``parallelism`` at a time over one copy of the input. A fold without training rows is left out."""
    held = persist_input(labeled, checkpoint_input)
    try:
        bounds = fold_bounds(held, k, embargo).collect()  # k rows

        def one(b) -> DataFrame | None:
            train = held.filter(F.col("date") <= F.lit(b["train_end"]))
            n = train.count()
            if not n:
                return None
            valid = held.filter(F.col("date").between(F.lit(b["valid_start"]), F.lit(b["valid_end"])))
            return fit(train)(valid).withColumns({"fold": F.lit(b["fold"]), "train_rows": F.lit(n).cast("bigint")}).checkpoint()

        with ThreadPoolExecutor(max(1, min(parallelism, k))) as pool:
            made = [m for m in pool.map(one, bounds) if m is not None]
    finally:
        held.unpersist()
    if not made:
        raise ValueError("no fold has training rows")
    return reduce(DataFrame.unionByName, made)


def fit_classifier(model_type: str = "gbt", **params) -> Fit:
    """A fold's pipeline of assembler, scaler and classifier; ``score`` is the probability of a rise."""
    def fit(train: DataFrame):
        model = without_summary(Pipeline(stages=[assembler(), scaler(), classifier(model_type, **params)]).fit(train))

        def apply(valid: DataFrame) -> DataFrame:
            scored = model.transform(valid).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
            return scored.select(*valid.columns, "prediction", "score")

        return apply

    return fit


def fold_metrics(scored: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """Per fold: rows trained on and validated, accuracy and AUC."""
    base = scored.groupBy("fold").agg(F.max("train_rows").alias("train_rows"), F.count(F.lit(1)).alias("valid_rows"),
                                      F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))
    return base.join(grouped_auc(scored, ["fold"], "score", label).select("fold", "auc"), "fold", "left")
