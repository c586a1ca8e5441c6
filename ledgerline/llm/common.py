"""Helpers shared by the training-text operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Bytes of text that an Arrow task works on at once.
PIECE_BYTES = 4 << 20
#: The six ASCII white-space characters (0x20, 0x09-0x0D) that part words.
SPACES = " \t\n\x0b\x0c\r"


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it is not installed but
    lies in a folder that they see; rows go to them in batches of about
    PIECE_BYTES, not of a fixed number however long they are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(PIECE_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text falls on ``fold``; a null id never does."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` has a fast path for ASCII
    and agrees there; other texts take the slower character map."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)) \
        .otherwise(F.translate(text, upper, upper.lower()))


def text_pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with about ``limit`` bytes of text (one row at
    least), so that a task's arrays stay bounded however long texts are."""
    if batch.num_rows == 0:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    first = 0
    while first < batch.num_rows:
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and the length of each value (null: 0)."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    column = pa.concat_arrays([column])  # offsets from 0
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], np.diff(offsets)


def small_side(df: DataFrame, name: str, most: int = 64 << 20) -> DataFrame:
    """``df``, written once, with a broadcast hint if its text and rows take at
    most ``most`` bytes; a larger one is left to the planner's shuffle joins."""
    kept = materialize(df, name)
    size = F.lit(16)
    for f in kept.schema.fields:
        kind = f.dataType.typeName()
        size = size + (F.coalesce(F.octet_length(f.name), F.lit(0)) if kind in ("string", "binary")
                       else 16 * F.greatest(F.size(f.name), F.lit(1)) if kind == "array" else F.lit(16))
    held = kept.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(kept) if held <= most else kept


def global_prefix(df: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """Exclusive prefix sums over all rows in ``order``, which must be total.

    Rows are dealt into ranges of the order once and written, so that a retried
    task sees the same ranges. Each range has a total; the totals (one row a
    range, so as many as shuffle partitions) are summed up and sent to every
    task, which adds its own running sum. Adds ``_before`` (sum of ``size`` of
    earlier rows), ``_rank`` (number of earlier rows) and ``_total``.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    totals = ranged.groupBy("_range").agg(F.sum(size).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum0"),
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
                            F.sum("_sum").over(every).alias("_total"))
    inside = Window.partitionBy("_range").orderBy(*order)
    local = ranged.withColumn("_upto", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_nth", F.row_number().over(inside))
    return local.join(F.broadcast(offsets), "_range") \
        .withColumn("_before", F.col("_sum0") + F.col("_upto") - F.col(size)) \
        .withColumn("_rank", F.col("_n0") + F.col("_nth") - 1) \
        .drop("_range", "_sum0", "_n0", "_upto", "_nth")
