"""Queries over declared tables and older schema sets (SNK1, SNK3, SNK5, SNK6, P10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import flatten
from ..session import fresh_path, materialize, shuffles_go_with_writes
from ..fixtures import control, landing
from . import declared as D
from . import entities
from .registry import query


def _stores_of(result: dict[str, str]) -> list[str]:
    return sorted(result)


@query("load_declared_table")
def load_declared_table(spark, sf_dir):
    """SNK1 SNK5 DQ5: order items of all stores written as one version, each
    store's declared table pointed at its part, read back through the tables."""
    root = fresh_path(spark, "declared")
    stores = _stores_of(D.load_table(entities.order_items_flat(spark, sf_dir, kept=True), root, "order_items_insights"))
    return D.read_declared(spark, "order_items_insights", stores).groupBy("store_name", "processed_at_store_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("line_item_quantity").alias("quantity"))


ONE_STORE, FROM_DAY = "store-1.myshopify.com", "1997-01-01"


@query("load_one_store")
def load_one_store(spark, sf_dir):
    """SNK1 SNK5: orders of all stores loaded, then one store alone from a later
    day on: its earlier days are gone, the other stores' tables are as before."""
    root = fresh_path(spark, "declared")
    orders = materialize(entities.orders_flat(spark, sf_dir), "orders-flat", "zstd")  # made once for both loads
    stores = _stores_of(D.load_table(orders, root, "order_insights"))
    D.load_table(orders.where(F.col("processed_at_store_date") >= F.lit(FROM_DAY).cast("date")), root, "order_insights", [ONE_STORE])
    return D.read_declared(spark, "order_insights", stores).groupBy("store_name", "customer_country").agg(
        F.count(F.lit(1)).alias("orders"), F.min("processed_at_store_date").alias("first_day"),
        F.max("processed_at_store_date").alias("last_day"), F.max("total_price").alias("largest"))


@query("load_empty_keeps_target")
def load_empty_keeps_target(spark, sf_dir):
    """SNK3 SNK5: variants of all stores loaded, then a load that has rows for
    none but one of them: the others' tables keep what they have."""
    root = fresh_path(spark, "declared")
    products = entities.products_flat(spark, sf_dir)
    stores = _stores_of(D.load_table(products, root, "products_insights"))
    D.load_table(products.where((F.col("store_name") == ONE_STORE) & (F.col("status") == "ACTIVE")), root, "products_insights", stores)
    return D.read_declared(spark, "products_insights", stores).groupBy("store_name", "id").agg(
        F.count(F.lit(1)).alias("variants"), F.count_if(F.col("status") == "DRAFT").alias("drafts"))


def _legacy(spark, df: DataFrame, table: str) -> DataFrame:
    """A table as the older schema set declares it, written and read back with that schema."""
    path = fresh_path(spark, f"legacy-{table}")
    schemas.reconcile(df, schemas.contract(table, legacy=True), schemas.renames(table, False)).write.parquet(path)
    return spark.read.schema(schemas.contract(table, legacy=True)).parquet(path)


@query("legacy_orders")
def legacy_orders(spark, sf_dir):
    """SNK6 P10: the orders table under the older schema set."""
    return _legacy(spark, entities.orders_flat(spark, sf_dir), "order_insights")


@query("legacy_customers")
def legacy_customers(spark, sf_dir):
    """SNK6 P10: the customers table under the older schema set: tags as text, one more column."""
    return _legacy(spark, entities.customers_flat(spark, sf_dir), "customer_insights")


@query("legacy_products")
def legacy_products(spark, sf_dir):
    """SNK6 P10: the products table under the older schema set: inventory quantity as text."""
    return _legacy(spark, entities.products_flat(spark, sf_dir), "products_insights")


@query("mixed_order_items")
def mixed_order_items(spark, sf_dir):
    """P10 SNK6: order items of some stores in files of the older schema set, of
    the others in files of the current one, read together as the current table."""
    table, root = "order_items_insights", fresh_path(spark, "mixed")
    # made once for both sets; each flattens its own stores' documents alone
    items = flatten.order_items(landing.order_item_docs(spark, sf_dir, kept=True), control.store_config(spark, sf_dir))
    old = F.col("store_name").isin(MIXED_OLD)
    write = lambda df, path: df.write.option("compression", "zstd").partitionBy("store_name").parquet(path)
    with shuffles_go_with_writes(spark):
        write(schemas.reconcile(items.where(old), schemas.contract(table, legacy=True), schemas.renames(table, False), ("store_name",)), f"{root}/old")
        write(items.where(~old | F.col("store_name").isNull()), f"{root}/new")
    both = schemas.read_mixed(spark, table, [(f"{root}/old", True), (f"{root}/new", False)], keep=("store_name",))
    return both.groupBy("store_name", "currency_code", "refund_restock_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("line_item_quantity").alias("quantity"),
        F.min("processed_at_store_date").alias("first_day"), F.max("line_item_price").alias("largest_price"))


MIXED_OLD = ["store-0.myshopify.com", "store-2.myshopify.com"]


@query("contract_drift")
def contract_drift(spark, sf_dir):
    """P10 SNK5 SNK6: differences of the produced tables from the declared ones
    (current and older set), with the number of rows that have a value there."""
    made = {"order_items_insights": entities.order_items_flat, "order_insights": entities.orders_flat,
            "customer_insights": entities.customers_flat, "products_insights": entities.products_flat}
    parts = []
    for table, build in made.items():
        df = build(spark, sf_dir)
        found = [(legacy, *d) for legacy in (False, True) for d in schemas.drift(
            df.drop("store_name").schema if "store_name" not in schemas.contract(table, legacy).names else df.schema,
            schemas.contract(table, legacy), schemas.renames(table, False) if legacy else None)]
        if not found:
            continue
        source = [p.split(" ")[0] if change == "renamed" else name if change in ("type", "extra") else None for _, name, change, p, _ in found]
        counts = df.agg(*[(F.count(F.col(f"`{s}`")) if s else F.lit(0).cast("bigint")).alias(f"c{i}") for i, s in enumerate(source)])
        parts.append(counts.select(F.inline(F.array(*[F.struct(
            F.lit(table).alias("table_name"), F.lit("older" if legacy else "current").alias("schema_set"), F.lit(name).alias("column_name"),
            F.lit(change).alias("change"), F.lit(p).cast("string").alias("produced"), F.lit(want).cast("string").alias("declared"),
            F.col(f"c{i}").alias("rows_with_value")) for i, (legacy, name, change, p, want) in enumerate(found)]))))
    return reduce(DataFrame.unionByName, parts)
