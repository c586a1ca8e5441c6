"""Loads that move their rows a part at a time.

A load deals its rows to the partitions that it writes. In one shuffle, all rows
lie on disk as shuffle files, several times as large as the table itself, beside
the shuffles that made them and the table. Here the rows are written first as
they come (compressed Parquet, in folders by a hash of the partition columns),
and then moved and written a few folders at a time; all rows of a partition are
in one folder, so its files are the same as from one shuffle. A pass's shuffle
files go when it ends, and its folders with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path, setting, shuffles_go_with_writes

FOLDERS = 16
#: Bytes of written rows that one pass moves (their shuffle takes about four times that), if a folder doesn't hold more.
PASS_BYTES = 256 << 20
SLICE = "ledgerline_slice"


def in_passes(df: DataFrame, keys: list[Column], write: Callable[[DataFrame, bool], None]) -> None:
    """Call ``write(rows, first)`` for parts of ``df`` that together are all its
    rows; rows of equal ``keys`` come in one part. Without rows it is called
    once, with none. ``df`` is computed once."""
    spark = df.sparkSession
    root = fresh_path(spark, "passes")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        with shuffles_go_with_writes(spark):
            with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(FOLDERS)):  # rows are not sorted by folder
                df.withColumn(SLICE, F.pmod(F.xxhash64(*keys), F.lit(FOLDERS)).cast("int")) \
                    .write.option("compression", "zstd").partitionBy(SLICE).parquet(root)
            folders = sorted((s.getPath() for s in fs.listStatus(path) if s.isDirectory()), key=lambda p: p.toString())
            parts, held = [[]], 0
            for folder in folders:
                size = fs.getContentSummary(folder).getLength()
                if parts[-1] and held + size > PASS_BYTES:
                    parts, held = [*parts, []], 0
                parts[-1].append(folder)
                held += size
            for i, part in enumerate(parts):
                rows = spark.read.schema(df.schema).parquet(*[p.toString() for p in part]) if part else spark.createDataFrame([], df.schema)
                write(rows, i == 0)
                for p in part:
                    fs.delete(p, True)
    finally:
        fs.delete(path, True)
