"""Change log: the sink of the keyed streams (ST2, ST3).

A micro-batch is written whole to a folder of its own, ``changes/batch=<id>``,
and then committed by a marker file that appears at once; nothing is ever
overwritten that a reader may use. A batch that comes again after a failure
replaces its uncommitted folder, or is skipped if its marker is there. Readers
take the committed batches and resolve the latest row of each key.

:func:`compact` resolves what is committed into a new base and names it in a
manifest marker; readers then start from that base. Rows that are closed and
old enough leave the base for an archive part that is written once, so a base
holds what is open or recent, however long the stream has run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def deliver(spark: SparkSession, folder: str, to: str) -> None:
    """A written folder takes its place among those that a stream reads."""
    source, fs = _fs(spark, folder)
    target, _ = _fs(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise RuntimeError(f"cannot move {folder} to {to}")


def _mark(spark: SparkSession, folder: str, name: str, content: dict) -> None:
    """A small file that appears whole: written beside its place, then renamed."""
    draft, fs = _fs(spark, f"{folder}/_draft-{uuid.uuid4().hex}")
    fs.mkdirs(draft.getParent())
    out = fs.create(draft)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if not fs.rename(draft, _fs(spark, f"{folder}/{name}")[0]):
        fs.delete(draft, False)
        raise RuntimeError(f"cannot commit {name}")


def _marks(spark: SparkSession, folder: str) -> dict[int, dict]:
    """Content of the markers in ``folder`` by number."""
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return {}
    out = {}
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("n="):
            stream = fs.open(status.getPath())
            out[int(name[2:])] = json.loads(bytes(stream.readAllBytes()).decode())
            stream.close()
    return out


def committed(spark: SparkSession, root: str) -> dict[int, dict]:
    """Committed batches: id -> what their marker says."""
    return _marks(spark, f"{root}/commits")


def commit_sink(root: str, prepare: Callable[[DataFrame, int], dict[str, DataFrame]] | None = None,
                note: Callable[[SparkSession, int], dict] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function. ``prepare`` turns a batch into the tables to
    append (default: the batch as ``changes``); ``note`` makes the marker's content."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in committed(spark, root):
            return
        for name, df in (prepare(batch, batch_id) if prepare else {"changes": batch}).items():
            df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id:012d}")
        _mark(spark, f"{root}/commits", f"n={batch_id:012d}", note(spark, batch_id) if note else {})
    return sink


def appended(spark: SparkSession, root: str, schema: str, name: str = "changes", after: int = -1) -> DataFrame:
    """Rows of the committed batches after ``after``, with their ``batch``."""
    paths = [f"{root}/{name}/batch={b:012d}" for b in sorted(committed(spark, root)) if b > after]
    if not paths:
        return spark.createDataFrame([], f"{schema}, batch bigint")
    return spark.read.schema(f"{schema}, batch bigint").option("basePath", f"{root}/{name}").parquet(*paths)


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the largest ``order``; of equal ones the latest batch's."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, "batch")).alias("_r")).select(*keys, "_r.*")


def _base(spark: SparkSession, root: str) -> tuple[int, list[str], list[str]]:
    """(last batch of the base, its paths, the archive's paths) by the latest manifest."""
    manifests = _marks(spark, f"{root}/manifests")
    if not manifests:
        return -1, [], []
    m = manifests[max(manifests)]
    return m["upto"], [m["open"]], m["archive"]


def _read(spark: SparkSession, schema: str, paths: list[str]) -> DataFrame:
    kind = f"{schema}, batch bigint"
    return spark.read.schema(kind).parquet(*paths) if paths else spark.createDataFrame([], kind)


def current(spark: SparkSession, root: str, schema: str, keys: list[str], order: list[str], archived: bool = True) -> DataFrame:
    """Latest row of every key; without the archive only those still in the base or newer."""
    upto, base, archive = _base(spark, root)
    rows = _read(spark, schema, base + (archive if archived else [])).unionByName(appended(spark, root, schema, after=upto))
    return latest(rows, keys, order).drop("batch")


def compact(spark: SparkSession, root: str, schema: str, keys: list[str], order: list[str], closed: Column | None = None) -> int:
    """A new base from the latest one and the batches committed since; rows for
    which ``closed`` holds go to a new archive part instead. Returns the last
    batch in it. Folders of a compaction that did not reach its manifest are
    named nowhere, and those of earlier bases stay for readers that have begun."""
    upto, base, archive = _base(spark, root)
    done = committed(spark, root)
    if not done or max(done) <= upto:
        return upto
    last, name = max(done), uuid.uuid4().hex[:8]
    rows = latest(_read(spark, schema, base).unionByName(appended(spark, root, schema, after=upto)), keys, order)
    whole = f"{root}/bases/{last:012d}-{name}"
    rows.withColumn("part", F.when(closed, "archive").otherwise("open") if closed is not None else F.lit("open")) \
        .write.partitionBy("part").parquet(whole)
    for part in ("open", "archive"):  # a part without rows is an empty folder
        p, fs = _fs(spark, f"{whole}/part={part}")
        fs.mkdirs(p)
    _mark(spark, f"{root}/manifests", f"n={last:012d}", {"upto": last, "open": f"{whole}/part=open", "archive": [*archive, f"{whole}/part=archive"]})
    return last


def drop_compacted(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Delete change folders that the base holds, but for the last ``keep`` of them; returns their batches."""
    upto, _, _ = _base(spark, root)
    gone = sorted(b for b in committed(spark, root) if b <= upto)[:-keep or None]
    deleted = []
    for b in gone:
        p, fs = _fs(spark, f"{root}/changes/batch={b:012d}")
        if fs.exists(p):
            fs.delete(p, True)
            deleted.append(b)
    return deleted
