"""Session helpers for tests, the bench and the driver contract.

Library operators never build a session; they take DataFrames (or a
``SparkSession`` where they have to read) from the caller.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session we create gets. On a cluster these come from the
# job's own configuration; ``local_session`` only sets them for tests/bench.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tickwise", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset key raises on some versions
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder. Only a local session (tests, the
    bench) gets a scratch folder when it is unset: on a cluster each executor
    would write to its own disk, so there the setting is required."""
    existing = checkpoint_dir(spark)
    if existing:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(existing)
        return existing
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set and {master} is no local master: "
                           "set it to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="tickwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What the actions of frames made in the block have shuffled goes from the executors' disks as each ends, not
    when the driver next collects garbage. Whoever still wants it computes it again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_checkpoint(df: DataFrame) -> None:
    """Remove the files of a checkpointed frame (of another one: nothing); neither it nor what is made of it can be read after."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.nodeName() == "LogicalRDD" or plan.getClass().getSimpleName() == "LogicalRDD":
        at = plan.rdd().getCheckpointFile()
        if at.isDefined():
            remove_folder(df.sparkSession, at.get())


@contextmanager
def stored_once(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that several steps read, computed once: Parquet under the checkpoint folder, which takes less room than a
    cache on disk beside the shuffles that it keeps alive. The folder goes with the block, so no frame made of it may be read after."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    try:
        with freed_shuffles(spark):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)
