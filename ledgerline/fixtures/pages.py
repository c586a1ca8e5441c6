"""API-shaped pages made of documents, and their landing as text lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import constants as K
from ..session import setting

#: Pages of a store and month that are dealt to one task and written to one file.
PAGES_A_FILE = 16
#: Folders that a task writes side by side, instead of sorting its pages' text by folder.
OPEN_FILES = 256


def envelope(docs: DataFrame, entity: str, page_key: Column, node_cols: list[str] | Column | Callable, error_for: Column,
             pages_a_file: int = PAGES_A_FILE) -> DataFrame:
    """Group documents into API-shaped pages (page_key bounds the page size).

    The node of a document is given as columns, or as a function that builds it
    from ``get(column name)``: then documents are grouped in their plain columns
    and nested page by page.

    ``error_for`` yields a page class to inject ('malformed', 'rate_limited',
    'access_denied', 'error', 'missing_data') or null for a good page.
    """
    field = schemas.ENTITY_FIELD[entity]
    if callable(node_cols) and not isinstance(node_cols, Column):
        row = F.struct(*[c for c in docs.columns if c not in ("store_name", "month")])
        items = F.sort_array(F.transform("_rows", lambda x: F.struct(x["k"].alias("k"), node_cols(x["n"].getField).alias("n"))))
    else:
        row = node_cols if isinstance(node_cols, Column) else F.struct(*[F.col(c) for c in node_cols])
        items = F.sort_array("_rows")
    g = (docs.withColumn("page", page_key.cast("bigint")).withColumn("_file", F.floor(F.col("page") / pages_a_file))
         .repartition("store_name", "month", "_file").groupBy("store_name", "month", "_file", "page")
         .agg(F.collect_list(F.struct(F.col("order_key").alias("k"), row.alias("n"))).alias("_rows"))
         .withColumn("_items", items))
    cls = error_for(F.col("page"))
    edges = F.transform("_items", lambda x: F.struct(F.concat(F.lit("c"), x["k"].cast("string")).alias("cursor"),
                                                     x["n"].alias("node")))
    data = F.struct(F.struct(edges.alias("edges"), F.struct(F.lit(False).alias("hasNextPage"),
                                                            F.lit(None).cast("string").alias("endCursor")).alias("pageInfo"))
                    .alias(field))
    msg = (F.when(cls == "rate_limited", F.lit(K.THROTTLED_TEXT))
           .when(cls == "access_denied", F.concat(F.lit("This app is "), F.lit(K.ACCESS_DENIED_TEXT)))
           .when(cls == "error", F.lit("Internal error")))
    return g.select(
        "store_name", "month", "page",
        F.when(cls.isin("rate_limited", "access_denied", "missing_data"), F.lit(None)).otherwise(data).alias("data"),
        F.when(msg.isNotNull(), F.array(F.struct(msg.alias("message")))).alias("errors"),
        F.coalesce(cls == "malformed", F.lit(False)).alias("broken"))


def land(pages: DataFrame, path: str) -> str:
    """Write pages as gzip-compressed JSON lines partitioned by store and month
    (the landing zone); a broken one as a line that ends too early."""
    text = F.to_json(F.struct("page", "data", "errors"))
    rows = pages.select("store_name", "month", "broken", text.alias("_t"))
    value = F.when(F.col("broken"), F.expr("substring(_t, 1, length(_t) - 2)")).otherwise(F.col("_t"))
    with setting(pages.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        rows.select("store_name", "month", value.alias("value")).write.mode("overwrite").partitionBy("store_name", "month") \
            .option("compression", "gzip").text(path)
    return path
