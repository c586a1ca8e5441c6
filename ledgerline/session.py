"""Session settings the engine relies on, and the shared work folder.

Every public entry point calls :func:`configure` so that a session built by
someone else (the driver, a notebook) still has the semantics we need:
UTC session time zone (timestamps are published as UTC wall clock), last-wins
map key de-duplication (config overlay), AQE with skew-join handling.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime (session-level) settings; safe to set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # rows that are sorted by the grouping keys are grouped as they come (nest_split)
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}

_WORK_DIR: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's own builder and call configure()."""
    master = master or os.environ.get("LEDGERLINE_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEM", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    Uses ``spark.checkpoint.dir`` when the cluster names one. A temporary
    folder stands in only for a ``local`` master (tests, one machine); it is
    removed when the process ends. Any other master without a shared folder is
    an error: executors could not read each other's files.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _WORK_DIR:
        return _WORK_DIR[key]
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        base = base.rstrip("/") + "/ledgerline"
    elif re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        base = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(base + "/checkpoints")
    _WORK_DIR[key] = base
    return base


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused sub-path of the work dir (each run writes a new folder)."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting that holds inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_go_with_writes(spark: SparkSession):
    """Inside the block the shuffle files of a write are deleted when it ends,
    not when the driver happens to collect its garbage: several large writes of
    one query then need the disk one after the other."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a new folder of the work dir as Parquet and read it
    back: cuts the lineage with files that outlive any executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
