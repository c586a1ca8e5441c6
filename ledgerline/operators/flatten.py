"""Flatten jobs: nested entity documents -> typed analytic tables.

All four are narrow (no shuffle) apart from the join to the stores dimension
(broadcast while it is small) that supplies each store's time zone (SRC7/J9). Nested
lists are handled with explode (inner: a parent with no children vanishes, as
in the source) and higher-order functions (refund match, tax sums).

Input: a DataFrame of documents with a ``store_name`` column and the entity
node's fields either at top level (orders, customers) or under ``node``
(products), as :func:`ledgerline.sources.pages.nodes` yields them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

STR = "string"


def _s(c: Column) -> Column:
    """FN11: string columns are filled with ''."""
    return F.coalesce(c.cast(STR), F.lit(""))


def _d(c: Column) -> Column:
    """FN11: money / float columns are filled with 0.0."""
    return F.coalesce(c.cast("double"), F.lit(0.0))


def with_timezone(docs: DataFrame, stores: DataFrame | None) -> DataFrame:
    """SRC7: store time zone from the stores dimension, default UTC. The planner
    broadcasts the dimension by its size in bytes, and shuffles beyond that."""
    if stores is None:
        return docs.withColumn("_tz", F.lit("UTC"))
    tz = stores.select(F.col("merchant").alias("store_name"), F.col("iana_timezone").alias("_tz")).dropDuplicates(["store_name"])
    return (docs.join(tz, "store_name", "left")
            .withColumn("_tz", F.coalesce(F.col("_tz"), F.lit("UTC"))))


# ---------------------------------------------------------------------------
# Order items (UNN2 + J5 + A2)
# ---------------------------------------------------------------------------
def refund_match(refunds: Column, item_id: Column) -> Column:
    """Per refund, the first refund line item for this item sets
    (restock, subtotal); stop at the first refund whose restock is non-empty,
    otherwise a later matching refund overwrites."""
    init = F.lit(None).cast("struct<rt:string,s:decimal(18,4)>")

    def step(acc, r):
        hit = F.get(F.filter(r["refundLineItems"]["edges"], lambda e: e["node"]["lineItem"]["id"] == item_id), 0)
        found = F.when(hit.isNotNull(), F.struct(
            hit["node"]["restockType"].alias("rt"),
            F.coalesce(X.money(hit["node"]["subtotalSet"], default0=False), F.lit(0).cast("decimal(18,4)")).alias("s")))
        return F.when(F.coalesce(acc["rt"], F.lit("")) != "", acc).otherwise(F.coalesce(found, acc))
    return F.aggregate(F.coalesce(refunds, F.array()), init, step)


def order_items(docs: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    d = with_timezone(docs, stores)
    d = d.select("*", X.parse_ts("processedAt").alias("_processed"),
                 X.first(F.col("shippingLines.edges")).getField("node").alias("_ship"),
                 F.explode(F.col("lineItems.edges")).alias("_e"))
    i = F.col("_e.node")
    tax0 = X.first(i["taxLines"])
    ref = refund_match(F.col("refunds"), i["id"])
    return d.select(
        F.col("store_name"),
        X.local_date("_processed", "_tz").alias("processed_at_store_date"),
        X.utc_naive(X.parse_ts("createdAt")).alias("created_at"),
        X.utc_naive(X.parse_ts("updatedAt")).alias("updated_at"),
        _s(F.col("currencyCode")).alias("currency_code"),
        _s(F.col("email")).alias("email"),
        _s(F.col("displayFinancialStatus")).alias("display_financial_status"),
        _s(F.col("name")).alias("name"),
        _s(X.join_list(F.col("paymentGatewayNames"))).alias("payment_gateway_names"),
        _d(X.money("totalDiscountsSet")).alias("total_discounts"),
        _d(X.money("totalPriceSet")).alias("total_price"),
        _s(X.gid_digits(i["id"])).alias("line_item_id"),
        F.coalesce(i["currentQuantity"].cast("bigint"), F.lit(0).cast("bigint")).alias("line_item_current_quantity"),
        _d(X.money(i["originalUnitPriceSet"])).alias("line_item_pre_tax_price"),
        _d(X.money(i["discountedUnitPriceSet"])).alias("line_item_price"),
        _d(X.sum_money(i["discountAllocations"], lambda a: a["allocatedAmountSet"]["shopMoney"]["amount"])).alias("line_item_discount"),
        _s(X.gid_digits(i["product"]["id"])).alias("line_item_product_id"),
        F.coalesce(i["quantity"].cast("bigint"), F.lit(0).cast("bigint")).alias("line_item_quantity"),
        _s(i["sku"]).alias("line_item_sku"),
        _s(i["title"]).alias("line_item_title"),
        _s(X.gid_digits(i["variant"]["id"])).alias("line_item_variant_id"),
        _s(i["variantTitle"]).alias("line_item_variant_title"),
        tax0["rate"].cast("double").alias("line_item_tax_rate"),
        _s(i["vendor"]).alias("line_item_vendor"),
        _d(X.money(tax0["priceSet"], default0=False)).alias("line_item_tax_price"),
        _s(F.col("_ship.code")).alias("shipping_line_code"),
        _d(X.money(F.col("_ship.discountedPriceSet"))).alias("shipping_line_discounted_price"),
        _s(F.col("discountCode")).alias("discount_code"),
        _s(ref["rt"]).alias("refund_restock_type"),
        _d(ref["s"]).alias("refund_subtotal"),
    )


# ---------------------------------------------------------------------------
# Orders (P5, P6, P8, A2, FN6-FN8, FN13)
# ---------------------------------------------------------------------------
def orders(docs: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    d = with_timezone(docs, stores)
    d = d.select("*", X.parse_ts("processedAt").alias("_processed"),
                 X.first(F.col("shippingLine.taxLines")).alias("_stax"))
    named = F.coalesce(F.col("lineItems.edges"), F.array())  # all that the page delivers
    j = lambda c: _s(X.json_list_text(c))
    return d.select(
        F.col("store_name"),
        X.utc_naive(X.parse_ts("createdAt")).alias("created_at"),
        X.utc_naive(X.parse_ts("updatedAt")).alias("updated_at"),
        X.utc_naive("_processed").alias("processed_at"),
        # the store-zone value converted back to UTC equals processed_at
        X.utc_naive("_processed").alias("processed_at_shopify_timezone"),
        X.local_date("_processed", "_tz").alias("processed_at_store_date"),
        _s(F.col("currencyCode")).alias("currency_code"),
        j(F.col("discountCodes")).alias("discount_codes"),
        _s(F.col("email")).alias("email"),
        _s(F.col("displayFinancialStatus")).alias("display_financial_status"),
        _s(F.col("name")).alias("name"),
        j(F.col("paymentGatewayNames")).alias("payment_gateway_names"),
        _d(X.money("totalRefundedSet")).alias("total_refunded"),
        _s(F.col("shippingLine.title")).alias("shipping_line_title"),
        _d(X.amount(F.col("shippingLine.price"))).alias("shipping_line_price"),
        F.col("_stax.rate").cast("double").alias("shipping_line_tax_rate"),
        _d(X.money(F.col("_stax.priceSet"))).alias("shipping_line_tax_amount"),
        _d(X.money("totalDiscountsSet")).alias("total_discounts"),
        _d(X.money("totalPriceSet")).alias("total_price"),
        _s(F.col("cancelledAt")).alias("cancelled_at"),
        _s(F.col("confirmationNumber")).alias("confirmation_number"),
        _s(F.col("displayFulfillmentStatus")).alias("display_fulfillment_status"),
        _s(F.col("landingPageUrl")).alias("landing_page_url"),
        _s(F.col("note")).alias("note"),
        j(F.col("tags")).alias("tags"),
        _d(X.amount(F.col("totalTipReceived.amount"))).alias("total_tip_received"),
        _s(X.gid_digits(F.col("customer.id"))).alias("customer_id"),
        _s(F.col("customer.defaultAddress.country")).alias("customer_country"),
        j(F.transform(named, lambda e: e["node"]["name"])).alias("line_items"),
        j(F.transform(named, lambda e: e["node"]["vendor"])).alias("vendor"),
        _d(X.sum_money(F.col("taxLines"), lambda t: t["priceSet"]["shopMoney"]["amount"])).alias("order_level_tax_amount"),
        _d(X.money("currentTotalDutiesSet")).alias("duties"),
        _d(X.money("currentTotalAdditionalFeesSet")).alias("additional_fees"),
    )


# ---------------------------------------------------------------------------
# Customers (FN2, FN5, FN12)
# ---------------------------------------------------------------------------
PII_FIELDS = ["email", "firstName", "displayName", "phone", "note", "tags", "defaultAddress"]
ADDRESS_FIELDS = [("id", "id"), ("first_name", "firstName"), ("last_name", "lastName"),
                  ("company", "company"), ("address1", "address1"), ("address2", "address2"),
                  ("city", "city"), ("province", "province"), ("country", "country"),
                  ("zip", "zip"), ("phone", "phone"), ("name", "name")]


def customers(docs: DataFrame) -> DataFrame:
    """Customer flatten. Personal fields absent from the documents (access
    denied, or read without them) come out as '' / [] (P9)."""
    have = set(docs.columns)
    f = lambda name: F.col(name) if name in have else F.lit(None)
    addr = lambda sub: F.col("defaultAddress").getField(sub) if "defaultAddress" in have else F.lit(None)
    return docs.select(
        F.col("store_name"),
        X.utc_naive(X.parse_ts("createdAt")).alias("created_at"),
        X.utc_naive(X.parse_ts("updatedAt")).alias("updated_at"),
        _s(X.last_segment(F.col("id"))).alias("id"),
        _s(f("email")).alias("email"),
        _s(f("firstName")).alias("first_name"),
        _s(f("displayName")).alias("display_name"),
        _d(X.amount(F.col("amountSpent.amount"))).alias("total_spent"),
        _s(X.last_segment(F.col("lastOrder.id"))).alias("last_order_id"),
        _s(F.col("lastOrder.name")).alias("last_order_name"),
        F.coalesce(F.col("numberOfOrders").try_cast("bigint"), F.lit(0).cast("bigint")).alias("orders_count"),
        _s(F.col("amountSpent.currencyCode")).alias("currency_code"),
        _s(f("phone")).alias("phone"),
        _s(f("note")).alias("note"),
        X.tags_array(f("tags").cast("array<string>")).alias("tags"),
        *[_s(addr(src)).alias(f"default_address_{dst}") for dst, src in ADDRESS_FIELDS],
    )


def without_pii(docs: DataFrame) -> DataFrame:
    """Privacy projection of customer documents."""
    return docs.drop(*[c for c in PII_FIELDS if c in docs.columns])


# ---------------------------------------------------------------------------
# Products -> one row per variant (UNN3, P7, FLT5, FN3, FN10)
# ---------------------------------------------------------------------------
def products(docs: DataFrame) -> DataFrame:
    """Variant flatten. A product's own columns are made before its variants are
    exploded: a row of a variant then carries those, not the whole product with
    all its variants, which would grow with the square of their number."""
    d = docs.where(F.col("node").isNotNull())                          # FLT5 (product)
    p = F.col("node")
    media_url = F.get(F.filter(F.transform(F.coalesce(p["media"]["nodes"], F.array()),
                                           lambda x: x["image"]["url"]),
                               lambda u: F.coalesce(u, F.lit("")) != ""), 0)
    own = d.select(
        F.col("store_name"),
        X.utc_naive(X.parse_ts(p["createdAt"])).alias("created_at"),
        X.utc_naive(X.parse_ts(p["updatedAt"])).alias("updated_at"),
        _s(X.gid_tail(p["id"])).alias("id"),
        _s(p["title"]).alias("title"),
        _s(p["productType"]).alias("product_type"),
        _s(p["handle"]).alias("handle"),
        _s(p["status"]).alias("status"),
        X.utc_naive(X.parse_ts(p["publishedAt"])).alias("published_at"),
        F.array_join(F.coalesce(p["tags"], F.array()), ", ").alias("tags"),
        _s(p["vendor"]).alias("vendor"),
        F.coalesce(media_url, F.lit("")).alias("_img"),
        F.coalesce(p["variants"]["edges"], F.array()).alias("_edges"))
    kept = [c for c in own.columns if c not in ("_img", "_edges")]
    d = own.select(*kept, "_img", F.explode("_edges").alias("_v"))
    d = d.where(F.col("_v.node").isNotNull())                          # FLT5 (variant)
    v = F.col("_v.node")
    return d.select(
        *kept,
        _s(X.gid_tail(v["id"])).alias("variant_id"),
        _s(v["sku"]).alias("variant_sku"),
        _s(v["title"]).alias("variant_title"),
        _s(v["price"]).alias("variant_price"),
        _s(v["compareAtPrice"]).alias("variant_compareAtPrice"),
        F.when(v["inventoryItem"].isNull(), F.lit("")).otherwise(_s(X.gid_tail(v["inventoryItem"]["id"])))
        .alias("variant_inventoryItem_id"),
        F.coalesce(v["inventoryQuantity"].cast("bigint"), F.lit(0).cast("bigint")).alias("variant_inventoryQuantity"),
        F.coalesce(F.nullif(v["image"]["url"], F.lit("")), F.col("_img")).alias("variant_image_url"),
    )
