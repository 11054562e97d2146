"""Tables whose writes become visible at once.

A write goes to a folder of its own, ``data/write=<id>/<partition folders>``, which no reader looks at. It is published by
creating the next pointer file, ``_versions/<number>``: a text that says for each partition which folders or
files below ``data`` make it up. The text is written beside it first and renamed onto the number, which fails if the number
is there (an atomic create on HDFS and the stores that offer it). So

* a reader resolves the newest pointer once and sees that version whole, whatever is written meanwhile;
* of two writers one gets the number. The other looks at the newer version: if none of the partitions that it replaces
  has changed since it read them, it publishes on top of that, else ``Conflict`` tells it to start again;
* a writer that dies leaves a folder that nothing points to.

The pointer has a line per partition, its driver holds the same. ``compact`` packs small files of a partition into bins of about
a size and rewrites those only; ``vacuum`` removes what only older versions point to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.session import freed_shuffles

VERSIONS, DATA, WRITE = "_versions", "data", "write"
ATTEMPTS = 20
SMALL_BYTES, TARGET_BYTES = 32 << 20, 128 << 20


class Conflict(RuntimeError):
    """A partition that was to be replaced has changed since it was read."""


@dataclass(frozen=True)
class Version:
    """``parts``: names below ``data`` by partition (``month=1996-01/ticker_bucket=0``); ``notes``: what the writer says of it."""

    number: int = 0
    parts: dict[str, list[str]] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, f"{path}/{VERSIONS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Version:
    fs, p = _fs(spark, f"{path}/{VERSIONS}/{number:012d}")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(number, **json.loads(text))


def current(spark: SparkSession, path: str) -> Version:
    """The newest version; number 0 without parts if nothing has been published."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else Version()


def version(spark: SparkSession, path: str, number: int) -> Version:
    return _load(spark, path, number) if number else Version()


def _created(spark: SparkSession, path: str, made: Version) -> bool:
    """Whether this writer got the number: the text is renamed onto it unless it is there."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, folder = _fs(spark, f"{path}/{VERSIONS}")
    fs.mkdirs(folder)
    draft, name = (jvm.org.apache.hadoop.fs.Path(folder, n) for n in (f".new-{uuid.uuid4().hex}", f"{made.number:012d}"))
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"parts": made.parts, "notes": made.notes}).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(name), never)
        return True
    except Exception:  # noqa: BLE001 - the number is taken, or the store failed
        fs.delete(draft, False)
        if not fs.exists(name):
            raise
        return False


def publish(spark: SparkSession, path: str, base: Version, replaced: dict[str, list[str]],
            notes: dict[str, str] | None = None) -> Version:
    """Make the next version: ``base`` with some partitions replaced (by nothing: removed).

    On top of versions published meanwhile if they left these partitions as they were in ``base``; else ``Conflict``."""
    newest = base
    for _ in range(ATTEMPTS):
        parts = {k: v for k, v in {**newest.parts, **replaced}.items() if v}
        made = Version(newest.number + 1, parts, {**newest.notes, **(notes or {})})
        if _created(spark, path, made):
            return made
        newest = current(spark, path)
        changed = [k for k in replaced if newest.parts.get(k) != base.parts.get(k)]
        if changed:
            raise Conflict(f"{len(changed)} partitions of {path} have changed, {changed[0]} among them")
    raise Conflict(f"{path} was published {ATTEMPTS} times meanwhile")


def _leaves(fs, folder, depth: int, below: str) -> list[str]:
    if not depth:
        return [below]
    return [x for s in fs.listStatus(folder) if s.isDirectory()
            for x in _leaves(fs, s.getPath(), depth - 1, f"{below}/{s.getPath().getName()}")]


def stage(df: DataFrame, path: str, partition_by: list[str]) -> dict[str, list[str]]:
    """Write a frame to a new folder; its partitions as ``publish`` takes them. Nothing is visible yet."""
    spark, name = df.sparkSession, f"{WRITE}=w{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(f"{path}/{DATA}/{name}")
    fs, p = _fs(spark, f"{path}/{DATA}/{name}")
    return {leaf[len(name) + 1:]: [leaf] for leaf in _leaves(fs, p, len(partition_by), name)}


def values_of(part: str) -> dict[str, str]:
    """Column values of a partition name."""
    return dict(x.split("=", 1) for x in part.split("/") if x)


def read(spark: SparkSession, path: str, at: Version | None = None, keep: Callable[[dict[str, str]], bool] | None = None,
         merge_schema: bool = False) -> DataFrame | None:
    """The rows of a version (the newest), of the partitions that ``keep`` says yes to; None if there are none."""
    at = at or current(spark, path)
    names = [n for part, own in sorted(at.parts.items()) if keep is None or keep(values_of(part)) for n in own]
    if not names:
        return None
    reader = spark.read.option("basePath", f"{path}/{DATA}").option("mergeSchema", str(merge_schema).lower())
    return reader.parquet(*[f"{path}/{DATA}/{n}" for n in names]).drop(WRITE)


def changed_parts(old: Version, new: Version) -> list[str]:
    """Partitions that differ between two versions."""
    return sorted(k for k in {*old.parts, *new.parts} if old.parts.get(k) != new.parts.get(k))


def append(df: DataFrame, path: str, partition_by: list[str], notes: dict[str, str] | None = None) -> Version:
    """Add rows: partitions get one more folder, what they have stays. Never conflicts with another append."""
    spark, staged = df.sparkSession, stage(df, path, partition_by)
    for _ in range(ATTEMPTS):
        base = current(spark, path)
        try:
            return publish(spark, path, base, {k: base.parts.get(k, []) + v for k, v in staged.items()}, notes)
        except Conflict:
            continue
    raise Conflict(f"{path} was published {ATTEMPTS} times meanwhile")


# --- upkeep ---

def files(spark: SparkSession, path: str, at: Version | None = None) -> DataFrame:
    """``part, name, length`` of a version's files; names below ``data``. Listed by tasks, nothing is read."""
    at = at or current(spark, path)
    names = [n for own in at.parts.values() for n in own]
    if not names:
        return spark.createDataFrame([], "part string, name string, length bigint")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load([f"{path}/{DATA}/{n}" for n in names]).select("path", "length"))
    name = F.regexp_extract("path", f"/{DATA}/({WRITE}=w[0-9a-f]+/.*)$", 1)
    return listed.select(name.alias("name"), "length").select(
        F.regexp_extract("name", f"^{WRITE}=[^/]*/?(.*?)/?[^/]*$", 1).alias("part"), "name", "length")


def bins(listed: DataFrame, small: int = SMALL_BYTES, target: int = TARGET_BYTES) -> DataFrame:
    """``part, name, length, bin`` of the small files that share a bin: within a partition the files are laid end to
    end from the smallest on, and a bin holds those that begin in the same ``target`` bytes."""
    w = Window.partitionBy("part").orderBy("length", "name").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    packed = listed.filter(F.col("length") < small).withColumn("slot", F.floor((F.sum("length").over(w) - F.col("length")) / target))
    shared = packed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("part", "slot"))).filter("n > 1")
    return shared.withColumn("bin", F.concat_ws("#", "part", F.col("slot").cast("string"))).select("part", "name", "length", "bin")


def compact(spark: SparkSession, path: str, small: int = SMALL_BYTES, target: int = TARGET_BYTES,
            sort_by: list[str] | None = None) -> dict[str, int]:
    """Rewrite the small files of each partition, a bin by a task, and publish; larger files stay where they are.

    Returns files before and after, and files rewritten. A partition that another writer changes meanwhile makes
    the attempt start again."""
    for _ in range(ATTEMPTS):
        base = current(spark, path)
        listed = files(spark, path, base)
        # one row a file, as the pointer has one a folder
        rows = [r.asDict() for r in listed.join(bins(listed, small, target).select("name", "bin"), "name", "left").collect()]
        chosen = [r for r in rows if r["bin"] is not None]
        if not chosen:
            return {"before": len(rows), "after": len(rows), "rewritten": 0}
        columns = list(values_of(chosen[0]["part"]))
        number = {b: i for i, b in enumerate(sorted({r["bin"] for r in chosen}))}
        own = spark.createDataFrame([(r["name"], number[r["bin"]]) for r in chosen], "_name string, _bin int")
        name = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))),
                                f"/{DATA}/({WRITE}=w[0-9a-f]+/.*)$", 1)
        reader = spark.read.option("basePath", f"{path}/{DATA}").option("mergeSchema", "true")
        data = reader.parquet(*[f"{path}/{DATA}/{r['name']}" for r in chosen])
        data = data.select(*[F.col(f"`{c}`") for c in data.columns if c != WRITE], name.alias("_name")).join(own, "_name").drop("_name")
        data = data.repartitionById(len(number), F.col("_bin")).sortWithinPartitions(*columns, *(sort_by or [])).drop("_bin")
        staged = stage(data, path, columns)
        gone = {r["name"] for r in chosen}
        replaced = {part: [r["name"] for r in rows if r["part"] == part and r["name"] not in gone] + staged[part]
                    for part in {r["part"] for r in chosen}}
        try:
            publish(spark, path, base, replaced)
        except Conflict:
            continue
        return {"before": len(rows), "after": len(rows) - len(gone) + len(number), "rewritten": len(gone)}
    raise Conflict(f"{path} was published {ATTEMPTS} times meanwhile")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove pointers older than the newest ``keep`` and the folders and files that only those named; readers of an
    older version must have ended. What was never published (a write under way) is not touched. Returns names removed."""
    numbers = _numbers(spark, path)
    old, new = numbers[:-keep], numbers[-keep:]
    names = lambda ns: {n for k in ns for own in _load(spark, path, k).parts.values() for n in own}
    used = names(new)
    gone = [n for n in names(old) - used if not any(u.startswith(n + "/") for u in used)]
    for n in gone:
        fs, p = _fs(spark, f"{path}/{DATA}/{n}")
        fs.delete(p, True)
    for k in old:
        fs, p = _fs(spark, f"{path}/{VERSIONS}/{k:012d}")
        fs.delete(p, False)
    return len(gone)
