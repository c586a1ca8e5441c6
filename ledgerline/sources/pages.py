"""Landed API pages: read with an explicit schema, triage, unnest, quarantine and
replay (SRC1-SRC4, SRC12, UNN1, SET1, FLT1, FLT2).

Pages are landed as JSON lines under ``<root>/store_name=<s>/month=<m>/``
(one record per page). Reading with an explicit schema avoids inference (a
full extra pass) and makes absent fields (e.g. personal fields when access
was denied) read as null. The landing path partitions prune by store/month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import constants as K
from ..session import materialize, setting

PAGE_CLASSES = ["malformed", "rate_limited", "access_denied", "error", "missing_data", "good"]
CORRUPT = "_corrupt_record"
UNDATED = "undated"
PAGE_KEY = ["store_name", "month", "page"]


def read_pages(spark: SparkSession, paths: str | list[str], entity: str) -> DataFrame:
    """SRC1-SRC4 + SET1: one or many landing paths (bag union) with the entity's
    page schema. A line that is no JSON of that schema keeps its text in
    ``_corrupt_record``; ``page_file`` is the file that a page came from."""
    paths = [paths] if isinstance(paths, str) else paths
    ddl = schemas.page_schema(entity).replace(", store_name string", "")
    return spark.read.schema(f"page bigint, {ddl}, {CORRUPT} string, store_name string, month string") \
        .option("columnNameOfCorruptRecord", CORRUPT).json(paths).withColumn("page_file", F.col("_metadata.file_path"))


def in_months(pages: DataFrame, start: str, end: str) -> DataFrame:
    """FLT1: pages whose months can hold days from ``start`` to ``end``: a
    condition on the partition column, so other months are not read. The rows'
    own dates are still to be compared."""
    return pages.where((F.col("month") >= start[:7]) & (F.col("month") <= end[:7]))


def from_store_start(pages: DataFrame, starts: DataFrame, until: Column) -> DataFrame:
    """FLT2: pages of each store from the month of its own start date on.
    ``starts`` (store_name, start) is turned into (store, month) rows, whose join
    on both partition columns prunes the scan at run time (dynamic partition
    pruning). Undated pages and stores without a start are left out."""
    months = F.sequence(F.trunc("start", "month"), F.trunc(until, "month"), F.expr("INTERVAL 1 MONTH"))
    wanted = starts.where(F.col("start") <= until).select("store_name", F.explode(months).alias("_m")) \
        .select("store_name", F.date_format("_m", "yyyy-MM").alias("month")).distinct()
    return pages.join(F.broadcast(wanted), ["store_name", "month"], "left_semi")  # one row a store and month of its windows


def _has_error(text: str) -> Column:
    return F.coalesce(F.exists(F.coalesce(F.col("errors"), F.array()), lambda e: e["message"].contains(text)),
                      F.lit(False))


def triage(pages: DataFrame, entity: str) -> DataFrame:
    """SRC12: malformed, rate-limited, access-denied, other error, missing data, good."""
    field = schemas.ENTITY_FIELD[entity]
    has_errors = F.coalesce(F.size("errors"), F.lit(0)) > 0
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in pages.columns else F.lit(False)
    cls = (F.when(broken, "malformed").when(_has_error(K.THROTTLED_TEXT), "rate_limited")
           .when(_has_error(K.ACCESS_DENIED_TEXT), "access_denied")
           .when(has_errors, "error")
           .when(F.col(f"data.{field}").isNull(), "missing_data")
           .otherwise("good"))
    return pages.withColumn("page_class", cls)


def nodes(pages: DataFrame, entity: str) -> DataFrame:
    """UNN1: one row per node of every page that has data (edges concatenated
    over pages). A page that reports errors beside its data loads its data and is
    quarantined as well; of a malformed page nothing is loaded, whatever could be
    read of it. Null nodes are skipped (FLT5). Products keep the node as one
    column, as their flatten reads it; the other entities spread its fields."""
    field = schemas.ENTITY_FIELD[entity]
    if CORRUPT in pages.columns:
        pages = pages.where(F.col(CORRUPT).isNull())
    edges = pages.select("store_name", F.explode(f"data.{field}.edges").alias("_e")).where(F.col("_e.node").isNotNull())
    return edges.select("store_name", F.col("_e.node").alias("node") if entity == "products" else F.col("_e.node.*"))


def quarantine(pages: DataFrame, entity: str) -> DataFrame:
    """Pages that reported an error, lack data or could not be read, kept for
    replay (instead of silently ending a month): the page's key and class, its
    file, its text as landed (or written anew from what was read), and whether
    its data was loaded all the same."""
    t = triage(pages, entity).where(F.col("page_class") != "good")
    field = schemas.ENTITY_FIELD[entity]
    number = F.coalesce("page", F.regexp_extract(CORRUPT, r'"page"\s*:\s*(\d+)', 1).try_cast("bigint"))
    return t.select("store_name", "month", number.alias("page"), "page_class", "page_file",
                    F.coalesce(CORRUPT, F.to_json(F.struct("page", "data", "errors"))).alias("page_text"),
                    (F.col(CORRUPT).isNull() & F.col(f"data.{field}.edges").isNotNull()).alias("loaded"))


def write_quarantine(pages: DataFrame, entity: str, path: str) -> DataFrame:
    """Append the pages to the quarantine at ``path``; returns it as written."""
    with setting(pages.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "16"):  # page texts are not sorted by class
        quarantine(pages, entity).write.mode("append").option("compression", "zstd").partitionBy("page_class").parquet(path)
    return pages.sparkSession.read.parquet(path)


def replay(quarantined: DataFrame, fetched: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """Pages fetched again against the quarantine: (the pages to load now, the
    quarantine that is left). A page is settled by a good page of its key; of
    those, the ones whose data was loaded at first are not loaded again. Several
    fetches of one page count once, as do several quarantine records of it."""
    keys = materialize(quarantined.groupBy(*PAGE_KEY).agg(F.max("loaded").alias("_loaded")), "quarantine-keys")
    good = triage(fetched, entity).where(F.col("page_class") == "good")
    # the keys first, a small table: only pages that are to be loaded go through the shuffle, of the others no more than the key
    settled = good.join(keys.where(~F.col("_loaded")).select(*PAGE_KEY), PAGE_KEY, "left_semi").dropDuplicates(PAGE_KEY)
    return (settled.select(*fetched.columns),
            quarantined.join(good.select(*PAGE_KEY), PAGE_KEY, "left_anti"))


def nodes_with_fallback(pages: DataFrame, reduced: DataFrame, entity: str, reduced_entity: str) -> DataFrame:
    """Nodes of ``pages``, and for the pages to which access was denied those
    of ``reduced``, the same pages asked for again without the personal fields."""
    denied = triage(pages, entity).where(F.col("page_class") == "access_denied").select(*PAGE_KEY).distinct()
    again = reduced.join(denied, PAGE_KEY, "left_semi")
    return nodes(pages, entity).unionByName(nodes(again, reduced_entity), allowMissingColumns=True)
