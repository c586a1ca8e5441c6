"""Readers for the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# dimensions whose size is fixed by definition (5 regions, 25 nations)
FIXED_SIZE = {"region", "nation"}
# split count per (session, table path): the driver's input tables are immutable
_SPLITS: dict[tuple, tuple[int, int]] = {}
#: Bytes of a table's files for which a shuffle gets one partition to begin with
#: (about 250,000 order lines); the adaptive plan merges what turns out small.
SHUFFLE_BYTES = 4 << 20
MOST_PARTITIONS = 20_000  # to begin with; with more, the blocks of a map task get too small
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _size_shuffles(spark: SparkSession, size: int) -> None:
    """Shuffles of the session begin with as many partitions as a table of
    ``size`` bytes wants, if that is more than they have: a fixed number would
    have tasks grow with the table, and their sorts spill."""
    wanted = min(size // SHUFFLE_BYTES, MOST_PARTITIONS)
    if wanted > int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL, str(wanted))


def slices_of(spark: SparkSession, sf_dir: str, name: str, slice_bytes: int, most: int) -> int:
    """In how many slices a table is to be read so that each holds about ``slice_bytes`` of its files; ``most`` at most."""
    jdf = getattr(spark.read.parquet(table_path(sf_dir, name)), "_jdf", None)
    size = 0 if jdf is None else int(str(jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max(1, -(-size // slice_bytes)), most)


def read(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Parquet scan; projections and filters applied later are pushed into it
    (Catalyst pushes them below the repartition).

    A table stored as a few large row groups scans as a few tasks, and every
    expression up to the first shuffle then runs on those few cores. When the
    scan has fewer input partitions than the cluster's default parallelism,
    rows are spread round-robin first; a large table (many splits) is left
    as it is, so at scale this adds no shuffle.
    """
    configure(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    if name in FIXED_SIZE:
        return df
    jdf = getattr(df, "_jdf", None)  # a Spark Connect session has no JVM view: its own setting holds
    if jdf is not None:
        _size_shuffles(spark, int(str(jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))
    if not spread:           # e.g. counts gain nothing from spreading
        return df
    key = (id(spark), table_path(sf_dir, name))
    if key not in _SPLITS:
        try:
            _SPLITS[key] = (df.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
        except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no RDD view: keep the scan
            _SPLITS[key] = (1 << 30, 0)
    splits, target = _SPLITS[key]
    return df.repartition(target) if splits < target else df


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    for n in names or TABLES:
        read(spark, sf_dir, n).createOrReplaceTempView(n)
