"""Schemas: landed page envelopes (read schemas) and the published table
contracts, plus ``conform`` (P10: cast, order, fill, rename)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

MONEY = "struct<shopMoney:struct<amount:string>>"

# --------------------------------------------------------------------------- node read schemas
ORDER_NODE = (
    "createdAt string, updatedAt string, processedAt string, currencyCode string, discountCodes array<string>, "
    "email string, displayFinancialStatus string, name string, paymentGatewayNames array<string>, "
    f"shippingLine struct<title:string, price:string, taxLines:array<struct<rate:double, priceSet:{MONEY}>>>, "
    f"totalDiscountsSet {MONEY}, totalPriceSet {MONEY}, cancelledAt string, confirmationNumber string, "
    "displayFulfillmentStatus string, landingPageUrl string, note string, tags array<string>, "
    f"totalRefundedSet {MONEY}, currentTotalDutiesSet {MONEY}, currentTotalAdditionalFeesSet {MONEY}, "
    f"taxLines array<struct<priceSet:{MONEY}, rate:double>>, totalTipReceived struct<amount:string>, "
    "customer struct<id:string, defaultAddress:struct<country:string>>, "
    "lineItems struct<edges:array<struct<node:struct<name:string, vendor:string>>>>")

ORDER_ITEMS_NODE = (
    "createdAt string, processedAt string, updatedAt string, email string, displayFinancialStatus string, "
    "name string, paymentGatewayNames array<string>, currencyCode string, "
    f"totalDiscountsSet {MONEY}, totalPriceSet {MONEY}, discountCode string, "
    f"shippingLines struct<edges:array<struct<node:struct<code:string, discountedPriceSet:{MONEY}>>>>, "
    "refunds array<struct<id:string, refundLineItems:struct<edges:array<struct<node:struct<"
    f"restockType:string, subtotalSet:{MONEY}, lineItem:struct<id:string>>>>>>>, "
    "lineItems struct<edges:array<struct<node:struct<id:string, currentQuantity:bigint, quantity:bigint, "
    "title:string, sku:string, vendor:string, product:struct<id:string>, variant:struct<id:string>, "
    f"originalTotalSet:{MONEY}, discountedTotalSet:{MONEY}, originalUnitPriceSet:{MONEY}, "
    f"discountedUnitPriceSet:{MONEY}, discountAllocations:array<struct<allocatedAmountSet:{MONEY}>>, "
    f"taxLines:array<struct<priceSet:{MONEY}, rate:double>>, variantTitle:string>>>>")

CUSTOMER_NODE_BASE = ("id string, lastOrder struct<id:string, name:string>, numberOfOrders string, "
                      "amountSpent struct<amount:string, currencyCode:string>, createdAt string, updatedAt string")
CUSTOMER_NODE_PII = (
    "email string, firstName string, displayName string, phone string, note string, tags array<string>, "
    "defaultAddress struct<id:string, firstName:string, lastName:string, company:string, address1:string, "
    "address2:string, city:string, province:string, country:string, zip:string, phone:string, name:string>")
CUSTOMER_NODE = f"{CUSTOMER_NODE_BASE}, {CUSTOMER_NODE_PII}"

PRODUCT_NODE = (
    "createdAt string, updatedAt string, id string, title string, productType string, handle string, "
    "status string, publishedAt string, tags array<string>, vendor string, "
    "media struct<nodes:array<struct<mediaContentType:string, image:struct<url:string, altText:string>>>>, "
    "variants struct<edges:array<struct<node:struct<id:string, sku:string, title:string, price:string, "
    "compareAtPrice:string, createdAt:string, inventoryItem:struct<id:string>, inventoryQuantity:bigint, "
    "image:struct<url:string>>>>>")

NODES = {"orders": ORDER_NODE, "order_items": ORDER_ITEMS_NODE, "customers": CUSTOMER_NODE,
         "customers_no_pii": CUSTOMER_NODE_BASE, "products": PRODUCT_NODE}
ENTITY_FIELD = {"orders": "orders", "order_items": "orders", "customers": "customers",
                "customers_no_pii": "customers", "products": "products"}


def page_schema(entity: str) -> str:
    """DM1: ``{data:{<entity>:{edges:[{cursor,node}],pageInfo}}, errors}`` + store_name."""
    node = NODES[entity]
    field = ENTITY_FIELD[entity]
    return (f"data struct<{field}:struct<edges:array<struct<cursor:string, node:struct<{_fields(node)}>>>, "
            f"pageInfo:struct<hasNextPage:boolean, endCursor:string>>>, "
            f"errors array<struct<message:string>>, store_name string")


def _fields(ddl: str) -> str:
    """'a string, b int' -> 'a:string, b:int' (top-level commas only)."""
    out, depth, cur = [], 0, ""
    for ch in ddl:
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
    out.append(cur.strip())
    return ", ".join(f"{p.split(' ', 1)[0]}:{p.split(' ', 1)[1]}" for p in out)


# --------------------------------------------------------------------------- published contracts
# Columns and types of the four published tables, as their owner
# declares them. They are stated here, apart from the code that produces the
# tables, so that a difference between the two can show (:func:`drift`).
CONTRACTS = {
    "order_items_insights": (
        "processed_at_store_date date, created_at timestamp_ntz, updated_at timestamp_ntz, currency_code string, email string, "
        "display_financial_status string, name string, payment_gateway_names string, total_discounts double, total_price double, "
        "line_item_id string, line_item_current_quantity bigint, line_item_pre_tax_price double, line_item_price double, "
        "line_item_discount double, line_item_product_id string, line_item_quantity bigint, line_item_sku string, "
        "line_item_title string, line_item_variant_id string, line_item_variant_title string, line_item_tax_rate double, "
        "line_item_vendor string, line_item_tax_price double, shipping_line_code string, shipping_line_discounted_price double, "
        "discount_code string, refund_restock_type string, refund_subtotal double"),
    "order_insights": (
        "store_name string, created_at timestamp_ntz, updated_at timestamp_ntz, processed_at timestamp_ntz, "
        "processed_at_shopify_timezone timestamp_ntz, processed_at_store_date date, currency_code string, discount_codes string, "
        "email string, display_financial_status string, name string, payment_gateway_names string, total_refunded double, "
        "shipping_line_title string, shipping_line_price double, shipping_line_tax_rate double, shipping_line_tax_amount double, "
        "total_discounts double, total_price double, cancelled_at string, confirmation_number string, "
        "display_fulfillment_status string, landing_page_url string, note string, tags string, total_tip_received double, "
        "customer_id string, customer_country string, line_items string, vendor string, order_level_tax_amount double, "
        "duties double, additional_fees double"),
    "customer_insights": (
        "store_name string, created_at timestamp_ntz, updated_at timestamp_ntz, id string, email string, first_name string, "
        "display_name string, total_spent double, last_order_id string, last_order_name string, orders_count bigint, "
        "currency_code string, phone string, note string, tags array<string>, default_address_id string, "
        "default_address_first_name string, default_address_last_name string, default_address_company string, "
        "default_address_address1 string, default_address_address2 string, default_address_city string, "
        "default_address_province string, default_address_country string, default_address_zip string, "
        "default_address_phone string, default_address_name string"),
    "products_insights": (
        "store_name string, created_at timestamp_ntz, updated_at timestamp_ntz, id string, title string, product_type string, "
        "handle string, status string, published_at timestamp_ntz, tags string, vendor string, variant_id string, "
        "variant_sku string, variant_title string, variant_price string, variant_compareAtPrice string, "
        "variant_inventoryItem_id string, variant_inventoryQuantity bigint, variant_image_url string"),
}

# Older schema set of the same table: fixed column names of the legacy contract,
# with the current column each one is filled from (None: not produced, null).
ORDER_ITEMS_LEGACY = [
    ("date", "date", None), ("created_at", "timestamp_ntz", "created_at"),
    ("updated_at", "timestamp_ntz", "updated_at"), ("processed_at", "timestamp_ntz", None),
    ("processed_at_store_date", "date", "processed_at_store_date"),
    ("orders_currency", "string", "currency_code"), ("orders_email", "string", "email"),
    ("orders_financial_status", "string", "display_financial_status"), ("orders_name", "string", "name"),
    ("orders_payment_gateway_names", "string", "payment_gateway_names"),
    ("orders_total_discounts", "double", "total_discounts"), ("orders_total_price", "double", "total_price"),
    ("orders_line_items_id", "string", "line_item_id"),
    ("orders_line_items_current_quantity", "bigint", "line_item_current_quantity"),
    ("orders_line_items_pre_tax_price", "double", "line_item_pre_tax_price"),
    ("orders_line_items_price", "double", "line_item_price"),
    ("orders_line_items_product_id", "string", "line_item_product_id"),
    ("orders_line_items_quantity", "bigint", "line_item_quantity"),
    ("orders_line_items_sku", "string", "line_item_sku"), ("orders_line_items_title", "string", "line_item_title"),
    ("orders_line_items_variant_id", "string", "line_item_variant_id"),
    ("orders_line_items_variant_title", "string", "line_item_variant_title"),
    ("orders_line_items_tax_lines_rate", "double", "line_item_tax_rate"),
    ("orders_line_items_vendor", "string", "line_item_vendor"),
    ("orders_line_items_tax_lines_price", "double", "line_item_tax_price"),
    ("orders_shipping_lines_code", "string", "shipping_line_code"),
    ("orders_shipping_lines_discounted_price", "double", "shipping_line_discounted_price"),
    ("orders_discount_codes_code", "string", "discount_code"),
    ("orders_refunds_refund_line_items_restock_type", "string", "refund_restock_type"),
    ("orders_refunds_refund_line_items_subtotal", "double", "refund_subtotal")]


def conform(df: DataFrame, contract: list[tuple]) -> DataFrame:
    """P10: select the contract's columns in order, cast to its types, fill
    absent columns with typed nulls, renaming from the source column given as
    the optional third element."""
    have = set(df.columns)
    cols = []
    for item in contract:
        name, typ = item[0], item[1]
        src = item[2] if len(item) > 2 else name
        c = F.col(src).cast(typ) if src is not None and src in have else F.lit(None).cast(typ)
        cols.append(c.alias(name))
    return df.select(*cols)


# The older schema set of the other tables, as differences from
# the current one (column, type; the older set has each of them so).
LEGACY_CHANGES = {"order_insights": [],
                  "customer_insights": [("tags", "string"), ("default_address_country_name", "string")],
                  "products_insights": [("variant_inventoryQuantity", "string")]}


def contract(table: str, legacy: bool = False) -> StructType:
    """Declared columns of a published table, of the older schema set if ``legacy``."""
    if legacy and table == "order_items_insights":
        return StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t, _ in ORDER_ITEMS_LEGACY))
    current = StructType.fromDDL(CONTRACTS[table])
    if not legacy:
        return current
    changes = dict(LEGACY_CHANGES[table])
    kept = [(f.name, changes.pop(f.name, f.dataType.simpleString())) for f in current]
    return StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in [*kept, *changes.items()]))


def renames(table: str, legacy_to_current: bool) -> dict[str, str]:
    """Target column -> the source column that it is renamed from."""
    if table != "order_items_insights":
        return {}
    pairs = [(old, new) for old, _, new in ORDER_ITEMS_LEGACY if new is not None and new != old]
    return {new: old for old, new in pairs} if legacy_to_current else dict(pairs)


def _convert(value: Column, have: DataType, want: DataType) -> Column:
    """A value as another type of the same column: lists become joined text and
    text a list of one (none if empty); everything else is a cast, null where
    the text is no such value."""
    if have == want:
        return value
    if isinstance(have, ArrayType) and isinstance(want, StringType):
        return F.array_join(F.coalesce(value, F.array()), ", ")
    if isinstance(have, StringType) and isinstance(want, ArrayType):
        return F.when(F.coalesce(value, F.lit("")) == "", F.array().cast(want)).otherwise(F.array(value))
    return value.try_cast(want)


def reconcile(df: DataFrame, target: StructType, renamed: dict[str, str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as ``target``: its columns in order, each from the column of that
    name or the one it is renamed from, converted where the types differ, null
    where there is none. ``keep`` names further columns to pass on."""
    renamed, have = renamed or {}, {f.name: f.dataType for f in df.schema}
    out = []
    for f in target:
        source = f.name if f.name in have else renamed.get(f.name)
        out.append((_convert(F.col(f"`{source}`"), have[source], f.dataType) if source in have else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*out, *(F.col(f"`{c}`") for c in keep if c not in target.names))


def drift(produced: StructType, declared: StructType, renamed: dict[str, str] | None = None) -> list[tuple]:
    """(column, change, produced type, declared type) of every difference:
    ``missing`` (declared only), ``extra`` (produced only), ``type``, ``renamed``."""
    renamed, have, out = renamed or {}, {f.name: f.dataType.simpleString() for f in produced}, []
    for f in declared:
        want = f.dataType.simpleString()
        source = f.name if f.name in have else renamed.get(f.name)
        if source not in have:
            out.append((f.name, "missing", None, want))
        elif source != f.name:
            out.append((f.name, "renamed", f"{source} {have[source]}", want))
        elif have[source] != want:
            out.append((f.name, "type", have[source], want))
    used = {renamed.get(n, n) for n in declared.names} | set(declared.names)
    return out + [(n, "extra", t, None) for n, t in have.items() if n not in used]


def read_mixed(spark: SparkSession, table: str, parts: list[tuple[str, bool]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Files of both schema sets as one current table. ``parts`` are (path,
    legacy); each is read with the schema that it was declared with (no
    inference, absent columns null) and reconciled; ``keep`` are partition columns."""
    target = contract(table)
    out = None
    for path, legacy in parts:
        own = contract(table, legacy)
        for c in keep:
            if c not in own.names:
                own = own.add(c, "string")
        df = reconcile(spark.read.schema(own).parquet(path), target, renames(table, True) if legacy else None, keep)
        out = df if out is None else out.unionByName(df)
    return out
