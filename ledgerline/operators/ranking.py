"""Row numbers per key that stay balanced when one key holds a third of the rows.

``row_number() over (partition by k order by o)`` puts every row of a key in
one task. :func:`split_row_number` computes the same numbers with the work
spread by range: rows are range partitioned and sorted on (k, o), so a hot key
spans many partitions, and are written once with an id that counts up inside
each partition (compressed Parquet in the shared work folder, so every use sees
the same ids even if executors are lost). A row's number is its id's distance
from the first id of its (partition, key) slice, plus the number of rows of the
key in earlier partitions. The rows are moved once; only the table of slices,
partitions plus keys at most, is grouped and summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Slices (partitions plus keys at most) that are sent to every task; more are joined by a shuffle.
MOST_BROADCAST = 100_000


def split_row_number(df: DataFrame, keys: list[str], order: list[str], out: str = "row_number",
                     partitions: int | None = None) -> DataFrame:
    """``order`` must be a total order within each key (add a unique tie-breaker)."""
    from ..session import materialize
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
                       .withColumn("_id", F.monotonically_increasing_id()), "numbered", "zstd") \
        .withColumn("_slice", F.shiftright("_id", 33))
    sizes = rows.groupBy("_slice", *keys).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sizes.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0))).drop("_cnt"), "slices")
    side = F.broadcast(offsets) if offsets.count() <= MOST_BROADCAST else offsets
    return (rows.join(side, ["_slice", *keys])
            .withColumn(out, (F.col("_id") - F.col("_first") + 1 + F.col("_off")).cast("bigint"))          # may exceed int at scale
            .drop("_slice", "_id", "_first", "_off"))
