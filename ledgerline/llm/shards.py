"""Sharding by global byte-size prefix sums.

Documents are ordered by id, the bytes before each one are found from
per-range totals (:func:`~.common.global_prefix`), and the order is cut at
equal byte targets. Shards are contiguous in the order and differ from the
target by less than one document at either end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_prefix


def assign_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every document.

    Size is the UTF-8 bytes of the text (null: 0) plus 1. A document goes to
    the shard in whose byte range its middle lies. Only id, size and checksum
    are shuffled, never the text.

    Null ids come first. Repeated rows are ordered by id, checksum and size,
    and rows equal in all three by an arbitrary fixed number; each has its own
    slot. Null and empty texts have size 1. A table with no rows gives no rows.
    Other columns of ``docs`` are not read.

    Columns: doc_id, size, text_crc32 (null text: of no bytes), law ('bytes'),
    shard, slot (gapless from 0 in each shard), grown_shard (null).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32")).withColumn("_row", F.monotonically_increasing_id())
    placed = global_prefix(rows, ["doc_id", "text_crc32", "size", "_row"], "size", "shards")
    placed = placed.withColumn("shard", F.expr(f"(_before * 2 + size) * {int(shards)} div (_total * 2)").cast("int"))
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_rank") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as Parquet with one folder a shard. The id must be unique here."""
    where = assign_shards(docs.select(id_col, text_col), shards, id_col, text_col).select(
        F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    docs.join(where, docs[id_col].eqNullSafe(where["_id"])).drop("_id") \
        .repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot") \
        .write.partitionBy("_shard").parquet(path)
