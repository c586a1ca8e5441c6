"""Entity ELT queries: landed documents -> flat tables (P1-P10, UNN1-3, SRC1-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import flatten
from ..fixtures import control, landing
from ..fixtures import pages as FP
from ..sources import pages as PG
from .registry import query


@query("order_items_flat")
def order_items_flat(spark, sf_dir, kept=False):
    """SRC2 UNN2 P2 J5 A2 FN1 FN4 FN7 FN10 FN11: order documents -> one row per line item."""
    docs = landing.order_item_docs(spark, sf_dir, kept)
    return flatten.order_items(docs, control.store_config(spark, sf_dir))


@query("orders_flat")
def orders_flat(spark, sf_dir):
    """SRC1 P1 P5 P6 P8 P11 A2 FN6-FN8 FN13: order documents -> one row per order."""
    docs = landing.order_docs(spark, sf_dir)
    return flatten.orders(docs, control.store_config(spark, sf_dir))


@query("customers_flat")
def customers_flat(spark, sf_dir):
    """SRC3 P3 FN2 FN5 FN12."""
    return flatten.customers(landing.customer_docs(spark, sf_dir))


@query("customers_flat_no_pii")
def customers_flat_no_pii(spark, sf_dir):
    """The same documents read without personal fields."""
    return flatten.customers(flatten.without_pii(landing.customer_docs(spark, sf_dir)))


@query("products_flat")
def products_flat(spark, sf_dir):
    """SRC4 UNN3 P4 P7 FLT5 FN3 FN10: product documents -> one row per variant."""
    return flatten.products(landing.product_docs(spark, sf_dir))


# ---------------------------------------------------------------------------
# P10 / SRC12 / FLT1 / FLT2 / J9 / V13 / FN9 / SNK1-SNK7
# ---------------------------------------------------------------------------
RANGE_START, RANGE_END = "1997-01-01", "1997-12-31"


@query("order_items_legacy_names")
def order_items_legacy_names(spark, sf_dir):
    """P10: the order-items table conformed to the older schema set's names."""
    from .. import schemas
    return schemas.conform(order_items_flat(spark, sf_dir), schemas.ORDER_ITEMS_LEGACY)


PAGE_NODES = 250
_LANDED: dict[tuple, str] = {}


def _error_for(page):
    """Stand-in input: which pages come with an error, by store, month and page."""
    month = F.coalesce(F.replace("month", F.lit("-"), F.lit("")).try_cast("bigint"), F.lit(0))
    store = F.regexp_extract("store_name", "store-([0-9]+)", 1).try_cast("bigint")
    r = F.pmod(month * 7 + F.coalesce(store, F.lit(0)) * 3 + page, F.lit(17))
    return (F.when(r == 3, "rate_limited").when(r == 5, "access_denied").when(r == 7, "error")
            .when(r == 11, "missing_data").when(r == 13, "malformed"))


def _denied_again(page):
    """Stand-in input of a second fetch: only what access was denied to fails again."""
    return F.when(_error_for(page) == "access_denied", "access_denied")


def _numbered(docs, order):
    """Documents with the page of their store and month: PAGE_NODES a page, in ``order``."""
    from ..operators.ranking import split_row_number
    return split_row_number(docs, ["store_name", "month"], order, "_nth").withColumn("_page", F.floor((F.col("_nth") - 1) / PAGE_NODES)).drop("_nth")


def _entity_docs(spark, sf_dir, entity):
    """(documents with their month, order_key and page, node): what the API would
    deliver. Orders are numbered before their lines are joined, and both kinds of
    orders stay in plain columns until their page is made."""
    dated = lambda c: F.coalesce(F.substring(c, 1, 7), F.lit(PG.UNDATED))
    if entity == "orders":
        heads = landing.order_heads(spark, sf_dir).withColumn("month", dated(landing.processed_at()))
        return landing.orders_plain(spark, sf_dir, _numbered(heads, ["order_key"])), lambda get: F.struct(*landing.order_node(get))
    if entity == "order_items":
        docs = landing.order_items_plain(spark, sf_dir).withColumn("month", dated(landing.processed_at()))
        return _numbered(docs, ["order_key", "doc_part"]), lambda get: F.struct(*landing.order_item_node(get))
    if entity.startswith("customers"):
        month = F.when(X.parse_ts("createdAt").isNull(), F.lit(PG.UNDATED)).otherwise(F.substring("createdAt", 1, 7))
        docs = landing.customer_docs(spark, sf_dir, include_pii=entity == "customers").withColumn("month", month).withColumn("order_key", X.last_segment(F.col("id")).cast("bigint"))
        order = ["order_key"]
    else:
        docs = landing.product_docs(spark, sf_dir).withColumn("month", F.lit("all")).withColumn("order_key", F.col("product_key").cast("bigint"))
        return _numbered(docs, ["order_key", "doc_part"]), F.col("node")
    own = [c for c in docs.columns if c not in ("store_name", "order_key", "doc_part", "month")]
    return _numbered(docs, order), F.struct(*own)


def _landed(spark, sf_dir, entity, error_for=_error_for):
    """Landed pages of an entity: at most PAGE_NODES documents each, some with
    errors; landed once a session and table folder, read with the page schema."""
    from ..session import fresh_path
    from . import declared
    key = (spark.sparkContext.applicationId, sf_dir, entity, error_for.__name__)
    if key in _LANDED:
        path, fs = declared._files(spark, _LANDED[key])
        if fs.exists(path):
            return PG.read_pages(spark, _LANDED[key], entity)
    docs, node = _entity_docs(spark, sf_dir, entity)
    env = FP.envelope(docs, entity, F.col("_page"), node, error_for, pages_a_file=1 if entity == "products" else FP.PAGES_A_FILE)
    _LANDED[key] = FP.land(env, fresh_path(spark, f"landing-{entity}"))
    return PG.read_pages(spark, _LANDED[key], entity)


@query("orders_from_pages")
def orders_from_pages(spark, sf_dir):
    """SRC1 SRC12 UNN1 P1 end to end: landed pages of up to 250 orders -> nodes of
    all pages with data -> order flatten, all columns (pages without data stay in quarantine)."""
    return flatten.orders(PG.nodes(_landed(spark, sf_dir, "orders"), "orders"), control.store_config(spark, sf_dir))


@query("order_items_from_pages")
def order_items_from_pages(spark, sf_dir):
    """SRC2 UNN1 UNN2 P2 end to end: landed order pages with their line items -> one row per line item."""
    return flatten.order_items(PG.nodes(_landed(spark, sf_dir, "order_items"), "order_items"), control.store_config(spark, sf_dir))


@query("customers_from_pages")
def customers_from_pages(spark, sf_dir):
    """SRC3 UNN1 P3 end to end: landed customer pages -> customer flatten."""
    return flatten.customers(PG.nodes(_landed(spark, sf_dir, "customers"), "customers"))


def _no_error(page):
    return F.lit(None).cast("string")


@query("customers_access_denied")
def customers_access_denied(spark, sf_dir):
    """P9 SRC3 SRC12: customer pages; those to which access was denied come from
    a second fetch without personal fields."""
    reduced = _landed(spark, sf_dir, "customers_no_pii", _no_error)
    return flatten.customers(PG.nodes_with_fallback(_landed(spark, sf_dir, "customers"), reduced, "customers", "customers_no_pii"))


def _product_error(page):
    return F.when(page == 3, "error")


@query("products_from_pages")
def products_from_pages(spark, sf_dir):
    """SRC4 UNN1 UNN3 P4 end to end: product documents landed as API pages of a
    bounded number of documents (some with an error beside their data), read back, unnested and flattened."""
    return flatten.products(PG.nodes(_landed(spark, sf_dir, "products", _product_error), "products"))


@query("page_triage")
def page_triage(spark, sf_dir):
    """SRC1 SRC12 UNN1 SET1: orders landed as API pages (JSON, by store/month),
    read back with the page schema, triaged; page and edge counts per class."""
    t = PG.triage(_landed(spark, sf_dir, "orders"), "orders")
    return t.groupBy("store_name", "page_class").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.when(F.col(PG.CORRUPT).isNull(), F.coalesce(F.size("data.orders.edges"), F.lit(0))).otherwise(0)).cast("bigint").alias("edges"))


@query("pages_quarantined")
def pages_quarantined(spark, sf_dir):
    """SRC12: pages with errors, without data or unreadable, written to the
    quarantine with their key, text and file; counted there per store and class."""
    from ..session import fresh_path
    q = PG.write_quarantine(_landed(spark, sf_dir, "orders"), "orders", fresh_path(spark, "quarantine"))
    return q.groupBy("store_name", "page_class").agg(
        F.count_distinct("month", "page").alias("pages"), F.count_distinct("month").alias("months"),
        F.count_if(F.length("page_text") > 0).alias("with_text"), F.count_if(F.col("page_file").contains(".txt")).alias("with_file"),
        F.count_if("loaded").alias("loaded"))


@query("pages_replayed")
def pages_replayed(spark, sf_dir):
    """SRC12: the quarantine replayed against a second fetch of the pages: orders
    of the first load, orders recovered, pages settled without loading twice, pages left."""
    from ..session import fresh_path
    first = _landed(spark, sf_dir, "orders")
    q = PG.write_quarantine(first, "orders", fresh_path(spark, "quarantine"))
    again, left = PG.replay(q, _landed(spark, sf_dir, "orders", _denied_again), "orders")
    per = lambda df, what: df.groupBy("store_name").agg(F.count(F.lit(1)).alias("n")).select("store_name", F.lit(what).alias("part"), "n")
    stores = control.store_config(spark, sf_dir)
    return per(flatten.orders(PG.nodes(first, "orders"), stores), "first load") \
        .unionByName(per(flatten.orders(PG.nodes(again, "orders"), stores), "recovered")).unionByName(per(left, "pages left"))


@query("orders_in_range")
def orders_in_range(spark, sf_dir):
    """FLT1: orders processed in a closed date range (half-open by day), from the
    landed months that can hold them."""
    pages = PG.in_months(_landed(spark, sf_dir, "orders"), RANGE_START, RANGE_END)
    docs, ts = PG.nodes(pages, "orders"), X.parse_ts("processedAt")
    docs = docs.where((ts >= F.to_timestamp(F.lit(RANGE_START)))
                      & (ts < F.to_timestamp(F.lit(RANGE_END)) + F.expr("INTERVAL 1 DAY")))
    return flatten.orders(docs, control.store_config(spark, sf_dir)) \
        .select("store_name", "name", "processed_at", "processed_at_store_date")


def _starts(spark, sf_dir):
    """Each active store's own start date, from its config with the overlay."""
    from ..operators import stores as S
    cfg = S.config_records(control.store_config(spark, sf_dir))
    return cfg.select(F.col("merchant").alias("store_name"), F.to_date(F.col("config")["BACKFILL_START_DATE"]).alias("start"))


def _backfill(spark, sf_dir, entity, flat, day):
    """FLT2: rows of an entity from each store's start on; months before it are not read."""
    starts = _starts(spark, sf_dir)
    pages = PG.from_store_start(_landed(spark, sf_dir, entity), starts, F.to_date(control.as_of_col()))
    rows = flat(PG.nodes(pages, entity)).join(F.broadcast(starts), "store_name")  # one row a store
    return rows.where(F.col(day) >= F.col("start").cast("timestamp_ntz"))


@query("backfill_by_store")
def backfill_by_store(spark, sf_dir):
    """FLT2 J9 SRC7 P12: each store's orders from its own backfill start date."""
    stores = control.store_config(spark, sf_dir)
    rows = _backfill(spark, sf_dir, "orders", lambda d: flatten.orders(d, stores), "processed_at")
    return rows.groupBy("store_name").agg(F.count(F.lit(1)).alias("orders"),
                                          F.min("processed_at").alias("first_processed"),
                                          F.max("processed_at").alias("last_processed"))


@query("items_backfill")
def items_backfill(spark, sf_dir):
    """FLT2: each store's order items from its own start on (orders processed on that day or later)."""
    stores, starts = control.store_config(spark, sf_dir), _starts(spark, sf_dir)
    pages = PG.from_store_start(_landed(spark, sf_dir, "order_items"), starts, F.to_date(control.as_of_col()))
    docs = PG.nodes(pages, "order_items").join(F.broadcast(starts), "store_name") \
        .where(X.utc_naive(X.parse_ts("processedAt")) >= F.col("start").cast("timestamp_ntz"))
    return flatten.order_items(docs, stores).groupBy("store_name").agg(
        F.count(F.lit(1)).alias("items"), F.count_distinct("name").alias("orders"), F.sum("line_item_quantity").alias("quantity"))


@query("customers_backfill")
def customers_backfill(spark, sf_dir):
    """FLT2: each store's customers created on its own start date or later."""
    rows = _backfill(spark, sf_dir, "customers", flatten.customers, "created_at")
    return rows.groupBy("store_name").agg(F.count(F.lit(1)).alias("customers"), F.min("created_at").alias("first_created"),
                                          F.max("created_at").alias("last_created"))


@query("orders_on_date")
def orders_on_date(spark, sf_dir):
    """V13 FLT11 FN17 A1: orders created on the latest day ("today") per store."""
    flat = flatten.orders(landing.order_docs(spark, sf_dir), control.store_config(spark, sf_dir))
    # counts per (store, day); the latest day is a one-row aggregate of them that
    # reuses their shuffle, joined on the day
    per_day = flat.groupBy("store_name", F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return per_day.join(per_day.agg(F.max("day").alias("day")), "day").select("store_name", "orders")


@query("month_windows")
def month_windows(spark, sf_dir):
    """FN9 J9: per store, one-month load windows from its own start date to
    today with the number of orders processed in each; orders before the first
    window and orders without a date are counted apart. An order meets the
    windows that touch its calendar month (two at most) in an equi-join."""
    flat = flatten.orders(landing.order_docs(spark, sf_dir), control.store_config(spark, sf_dir))
    day = F.col("processed_at_store_date")
    per_day = flat.groupBy("store_name", day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    starts = _starts(spark, sf_dir)
    windows = starts.select("store_name", F.explode(X.window_starts("start", F.to_date(control.as_of_col()))).alias("window_start")) \
        .withColumn("window_end", X.window_end("window_start"))
    touched = windows.withColumn("month", F.explode(F.array_distinct(F.array(F.trunc("window_start", "month"), F.trunc("window_end", "month")))))
    met = touched.join(per_day.withColumn("month", F.trunc("day", "month")), ["store_name", "month"]) \
        .where(F.col("day").between(F.col("window_start"), F.col("window_end"))) \
        .groupBy("store_name", "window_start").agg(F.sum("n").alias("orders"))
    inside = windows.join(met, ["store_name", "window_start"], "left").select(
        "store_name", F.lit("window").alias("part"), "window_start", "window_end", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"))
    apart = per_day.join(F.broadcast(starts), "store_name").withColumn(
        "part", F.when(F.col("day").isNull(), "undated").when(F.col("day") < F.col("start"), "before the start")) \
        .where(F.col("part").isNotNull()).groupBy("store_name", "part").agg(F.sum("n").alias("orders"))
    return inside.unionByName(apart, allowMissingColumns=True)


@query("load_roundtrip")
def load_roundtrip(spark, sf_dir):
    """SNK1 SNK3 SNK5 DQ5: order items written as a (store, day)-partitioned,
    clustered Parquet table, read back with partition discovery."""
    from ..session import fresh_path
    from .load import load_full_refresh
    root = fresh_path(spark, "order_items_insights")
    _, path = load_full_refresh(order_items_flat(spark, sf_dir, kept=True), root)
    back = spark.read.parquet(path)
    return back.groupBy("store_name", "processed_at_store_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("line_item_quantity").alias("quantity"))


@query("products_chunked_load")
def products_chunked_load(spark, sf_dir):
    """SNK2: variants written with bounded files (chunked upload as one
    atomic write), read back and counted per store."""
    from ..session import fresh_path
    from .load import load_chunked
    path = fresh_path(spark, "products_insights")
    load_chunked(products_flat(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("store_name").agg(
        F.count(F.lit(1)).alias("variants"), F.count_distinct("id").alias("products"))
