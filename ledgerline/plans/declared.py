"""Declared tables that show what was loaded (SNK1, SNK3, SNK5, SNK6).

Each store has a database of its own with the four published tables. A load
writes one new version of a table for all its stores in one job, under
``<root>/<table>/version=<id>/store_name=<store>/``, and then publishes it: each
store's table is pointed at its folder by ``ALTER TABLE ... SET LOCATION``, one
change in the catalog. Files of a published version are never touched again, so
a reader sees one whole version, before, during and after the change. A store
without rows in a load keeps the version it has.

Tables by day are partitioned by year and bucketed by their clustering columns;
rows are dealt to (store, year, bucket) before the write, and the adaptive plan
cuts those that are large, so each of these is one file, or several of bounded
size, sorted by day (row groups are found by their least and largest day), and no
task sorts more than it holds however large a store's year is. The rows are moved
in passes (:mod:`.passes`), so their shuffle needs the disk for a part at a time. Partitions
are found by their folders, not listed in the catalog one by one, as a version's
years change with it.
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import constants as K
from ..session import setting as _setting
from .passes import in_passes

STAGING = "ledgerline_staging"
BUCKETS = 2  # raise with the rows of a store and year
YEAR = "processed_year"
#: Table -> its day column and clustering columns (none: a plain table).
LAYOUTS = {"order_items_insights": ("processed_at_store_date", ["name", "line_item_sku"]),
           "order_insights": ("processed_at_store_date", ["customer_id", "display_financial_status"]),
           "customer_insights": (None, []), "products_insights": (None, [])}


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _subfolders(spark: SparkSession, path: str, key: str) -> dict[str, str]:
    """Value -> path of the ``key=value`` folders under ``path``."""
    p, fs = _files(spark, path)
    if not fs.exists(p):
        return {}
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith(f"{key}=")]
    return {unquote(x.getName().split("=", 1)[1]): x.toString() for x in found}


def database_of(store: str) -> str:
    """Database of a store: its name without the suffix, as the data set naming rule has it."""
    name = store.removesuffix(K.STORE_SUFFIX).lower()
    return K.DATASET_PREFIX + "".join(c if c.isalnum() else "_" for c in name)


def _table_sql(name: str, table: str, location: str, legacy: bool, buckets: int) -> str:
    day, cluster = LAYOUTS[table]
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.contract(table, legacy) if f.name != "store_name"]
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols + ([f'{YEAR} string'] if day else []))}) USING parquet"
    if day:
        sql += f" PARTITIONED BY ({YEAR})"
    names = [c for c in cluster if not legacy or c in schemas.contract(table, True).names]
    if names:
        sql += f" CLUSTERED BY ({', '.join(names)}) SORTED BY ({', '.join([day, *names])}) INTO {buckets} BUCKETS"
    return f"{sql} LOCATION '{location}'"


def declare(spark: SparkSession, root: str, store: str, legacy: bool = False, buckets: int = BUCKETS) -> str:
    """SNK5 / SNK6: the store's database and its four tables, if absent; of the
    older schema set if ``legacy``. A new table lies in an empty folder."""
    database = database_of(store) + ("_legacy" if legacy else "")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/{database}.db'")
    with _setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
        for table in LAYOUTS:
            location = f"{root.rstrip('/')}/{database}.db/{table}"
            p, fs = _files(spark, location)
            fs.mkdirs(p)
            spark.sql(_table_sql(f"{database}.{table}", table, location, legacy, buckets))
    return database


def write_version(df: DataFrame, root: str, table: str, buckets: int = BUCKETS) -> str:
    """A new version of ``table`` (``df``: its columns and store_name); returns its folder."""
    spark = df.sparkSession
    day, cluster = LAYOUTS[table]
    version = f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{table}/version={version}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGING} LOCATION '{root.rstrip('/')}/{STAGING}.db'")
    keys = ["store_name"]
    if day:
        df = df.withColumn(YEAR, F.date_format(day, "yyyy"))
        keys.append(YEAR)
    bucket = F.pmod(F.hash(*cluster), F.lit(buckets)) if cluster else F.lit(0)
    name = f"{STAGING}.{table}_{version.replace('-', '_')}"

    def write(part: DataFrame, first: bool) -> None:
        rows = part.withColumn("_bucket", bucket).hint("rebalance", *keys, "_bucket").drop("_bucket")
        writer = rows.write.format("parquet").option("path", path).option("compression", "zstd").partitionBy(*keys)
        if cluster:
            writer = writer.bucketBy(buckets, *cluster).sortBy(day, *cluster)
        writer.mode("errorifexists" if first else "append").saveAsTable(name)
    with _setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
        in_passes(df, [*map(F.col, keys), bucket], write)
    spark.sql(f"DROP TABLE {name}")  # the entry alone: the files are the version
    return path


def publish(spark: SparkSession, root: str, table: str, path: str, stores: list[str], buckets: int = BUCKETS) -> dict[str, str]:
    """Point the table of each store at its folder of the version; a store
    without one keeps what it has. Returns ``published`` or ``kept`` by store."""
    folders, out = _subfolders(spark, path, "store_name"), {}
    for store in stores:
        name = f"{declare(spark, root, store, buckets=buckets)}.{table}"
        if store in folders:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folders[store]}'")
            spark.catalog.refreshTable(name)
        out[store] = "published" if store in folders else "kept"
    return out


def load_table(df: DataFrame, root: str, table: str, stores: list[str] | None = None, buckets: int = BUCKETS) -> dict[str, str]:
    """Full refresh of ``table`` for ``stores`` (default: those with rows), written once and published store by store."""
    spark = df.sparkSession
    if stores is not None:
        df = df.where(F.col("store_name").isin(stores))
    path = write_version(df, root, table, buckets)
    return publish(spark, root, table, path, sorted(_subfolders(spark, path, "store_name")) if stores is None else stores, buckets)


def location_of(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0].data_type


def read_declared(spark: SparkSession, table: str, stores: list[str]) -> DataFrame:
    """The declared tables of several stores as one, with their store_name."""
    out = None
    for store in stores:
        df = spark.table(f"{database_of(store)}.{table}").select(F.lit(store).alias("store_name"), "*")
        out = df if out is None else out.unionByName(df)
    return out


def expire_versions(spark: SparkSession, root: str, table: str, stores: list[str], keep: int = 1) -> list[str]:
    """Delete versions to which no store's table points any more, but for the
    latest ``keep`` of those (for readers that began before a change); returns
    the deleted ones."""
    used = {location_of(spark, f"{database_of(s)}.{table}") for s in stores}
    versions = _subfolders(spark, f"{root.rstrip('/')}/{table}", "version")
    unused = [v for v in sorted(versions) if not any(f"version={v}/" in u for u in used)]
    gone = unused[:max(0, len(unused) - keep)]
    for v in gone:
        p, fs = _files(spark, versions[v])
        fs.delete(p, True)
    return gone
