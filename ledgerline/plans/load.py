"""Sinks and the load runner (SNK1-SNK7, DQ5, A10).

Layout: tables are Parquet, partitioned by (store_name, month of the store-local
date) and sorted by (day, clustering columns) inside each partition. Day-level
Hive partitions would mean stores x days directories (millions at scale, and
tiny files at small scale); month partitions plus sorted days give the same
pruning through partition filters and row-group min/max statistics. Rows are
rebalanced on the partition columns before the write; AQE splits a hot
store-month over several tasks instead of one task writing the whole partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from .passes import in_passes

ORDER_ITEMS_LAYOUT = (["store_name", "processed_month"], ["processed_at_store_date", "name", "line_item_sku"])
ORDERS_LAYOUT = (["store_name", "processed_month"], ["processed_at_store_date", "customer_id", "display_financial_status"])
MAX_ROWS_PER_FILE = 5_000_000


def with_month(df: DataFrame, date_col: str = "processed_at_store_date") -> DataFrame:
    """Partition column: 'yyyy-MM' of the store-local date."""
    return df.withColumn("processed_month", F.date_format(date_col, "yyyy-MM"))


def _layout(df: DataFrame, partition_cols: list[str], cluster_cols: list[str], files: int | None) -> DataFrame:
    """Rebalance on the partition columns (AQE splits a skewed store-month over
    several tasks and merges small ones from runtime shuffle statistics, with
    no sampling pass), then sort each task's rows by partition + cluster keys."""
    keys = partition_cols + cluster_cols
    if not keys:
        return df
    d = df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")
    if files:
        d = d.repartition(files, *partition_cols)
    return d.sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, partition_cols: list[str] = (), cluster_cols: list[str] = (),
                mode: str = "overwrite", files: int | None = None,
                max_records_per_file: int | None = MAX_ROWS_PER_FILE) -> int:
    """SNK1/SNK4/SNK5: write with layout; returns the written row count
    (DQ5, collected with an observation in the same job: no second pass)."""
    obs = Observation("load")
    w = _layout(df, list(partition_cols), list(cluster_cols), files).observe(obs, F.count(F.lit(1)).alias("rows")).write
    w = w.mode(mode).option("partitionOverwriteMode", "static").option("compression", "zstd")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return int(obs.get.get("rows", 0))


def load_full_refresh(df: DataFrame, table_root: str, layout=ORDER_ITEMS_LAYOUT) -> tuple[int, str | None]:
    """SNK1 + SNK3: full refresh as a new table version.

    The rows are laid out in passes (:func:`~.passes.in_passes`), so that their
    shuffle needs the disk for a part of them at a time, each written once into a
    fresh version folder under table_root and counted by an observation of that
    same write (no separate emptiness probe, which would run the whole upstream
    plan a second time). A version
    with rows becomes current (its path is returned and a record of it added
    to ``_PUBLISHED``); empty input leaves the current version untouched (SNK3).
    """
    import time
    import uuid
    spark = df.sparkSession
    root = table_root.rstrip("/")
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{root}/version={version}"
    counts = []
    in_passes(with_month(df), [F.col(c) for c in layout[0]],
              lambda part, first: counts.append(write_table(part, path, *layout, mode="overwrite" if first else "append")))
    rows = sum(counts)
    if rows == 0:
        return 0, None
    spark.createDataFrame([(version, path)], "version string, path string").coalesce(1).write.mode("append").parquet(f"{root}/_PUBLISHED")
    return rows, path


def current_version(spark: SparkSession, table_root: str) -> str:
    """Path of the latest version that load_full_refresh has published. Each
    version adds a record and none is rewritten, so a reader always finds one."""
    return spark.read.parquet(f"{table_root.rstrip('/')}/_PUBLISHED").agg(F.max_by("path", "version")).first()[0]


def load_store(df: DataFrame, table_path: str, store: str, layout=ORDER_ITEMS_LAYOUT) -> int:
    """SNK1 for one store: static overwrite of the store's whole sub-tree, so
    days that vanished from the source disappear too."""
    part, cluster = layout
    d = with_month(df.where(F.col(part[0]) == store).drop(part[0]))
    staged = d.checkpoint(eager=True)          # one computation; emptiness probe reads the checkpoint
    if staged.isEmpty():
        return 0
    return write_table(staged, f"{table_path.rstrip('/')}/{part[0]}={store}", part[1:], cluster)


def load_chunked(df: DataFrame, path: str, max_rows_per_file: int = K.PRODUCTS_CHUNK_ROWS) -> int:
    """SNK2: the chunked upload becomes one overwrite with files of at most
    ``max_rows_per_file`` rows, the same rule at every size (pass more for large tables)."""
    return write_table(df, path, ["store_name"], ["id", "variant_id"], max_records_per_file=max_rows_per_file)


def append(df: DataFrame, path: str) -> int:
    """SNK4: append rows (job events, log lines, configs)."""
    return write_table(df, path, mode="append")


def table_contracts(spark: SparkSession) -> dict:
    """Schemas that the flatten operators produce (each applied to an empty
    DataFrame with its page node schema), to be held against the declared
    ones (:func:`ledgerline.schemas.drift`)."""
    from .. import schemas
    from ..operators import flatten
    empty = lambda node, top=True: spark.createDataFrame(
        [], (node if top else f"node struct<{schemas._fields(node)}>") + ", store_name string")
    return {
        "order_items_insights": flatten.order_items(empty(schemas.ORDER_ITEMS_NODE)).schema,
        "order_insights": flatten.orders(empty(schemas.ORDER_NODE)).schema,
        "customer_insights": flatten.customers(empty(schemas.CUSTOMER_NODE)).schema,
        "products_insights": flatten.products(empty(schemas.PRODUCT_NODE, top=False)).schema,
    }


def write_config_json(df: DataFrame, path: str) -> str:
    """SNK7: config records to JSON (file fallback)."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


# --------------------------------------------------------------------------- A10 result of a run (its components: plans/components.py)
@dataclass
class ComponentResult:
    component: str
    status: str
    records: int
    error: str | None


def run_status(results: list[ComponentResult]) -> tuple[str, str | None, int]:
    """A10 for one run: final status, message with the first three errors,
    records. A run without a failure but with a cancelled component is cancelled."""
    failed = [r for r in results if r.status == "failed"]
    total = sum(r.records for r in results)
    if not failed:
        return "cancelled" if any(r.status == "cancelled" for r in results) else "completed", None, total
    msg = f"Failed components: {', '.join(r.component for r in failed)}. " + " | ".join(r.error for r in failed[:3])
    return "failed", msg, total
