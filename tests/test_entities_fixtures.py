"""Hand-written documents, one case each (FIXTURES.md section 4)."""
import datetime as dt
import json

from pyspark.sql import functions as F

from helpers import docs_from_json, money, stores
from ledgerline import schemas
from ledgerline.functions import exprs as X
from ledgerline.operators import flatten


def _order(**kw):
    base = {"createdAt": "2024-03-01T02:00:00Z", "updatedAt": "2024-03-02T00:00:00Z",
            "processedAt": "2024-03-01T02:00:00Z", "currencyCode": "USD", "name": "#1001",
            "totalPriceSet": money("10.50"), "totalDiscountsSet": money("1.00"),
            "lineItems": {"edges": []}}
    base.update(kw)
    return base


def _item(i, **kw):
    base = {"id": f"gid://shop/LineItem/{i}", "quantity": 2, "currentQuantity": 2, "title": f"t{i}",
            "sku": f"S{i}", "vendor": "v", "product": {"id": "gid://shop/Product/7"},
            "variant": {"id": "gid://shop/ProductVariant/8"}, "originalUnitPriceSet": money("5.00"),
            "discountedUnitPriceSet": money("4.50"), "discountAllocations": [], "taxLines": []}
    base.update(kw)
    return {"node": base}


def test_order_defaults_without_shipping_customer_tax(spark):
    d = docs_from_json(spark, schemas.ORDER_NODE, [_order()])
    r = flatten.orders(d, stores(spark)).first()
    assert r.shipping_line_title == "" and r.shipping_line_price == 0.0
    assert r.shipping_line_tax_rate is None and r.shipping_line_tax_amount == 0.0
    assert r.customer_id == "" and r.customer_country == ""
    assert r.order_level_tax_amount == 0.0 and r.total_tip_received == 0.0
    assert r.line_items == "[]" and r.tags == "" and r.discount_codes == ""


def test_new_york_store_date_shifts_back_a_day(spark):
    d = docs_from_json(spark, schemas.ORDER_NODE, [_order()])
    r = flatten.orders(d, stores(spark, "America/New_York")).first()
    assert r.processed_at_store_date == dt.date(2024, 2, 29)
    assert r.processed_at == dt.datetime(2024, 3, 1, 2, 0)       # published as UTC wall clock
    assert r.processed_at_shopify_timezone == r.processed_at
    r2 = flatten.orders(d, None).first()                          # no stores dimension -> UTC
    assert r2.processed_at_store_date == dt.date(2024, 3, 1)


def test_all_order_names_of_a_page_are_kept(spark):
    items = [{"node": {"name": f"n{i}", "vendor": f"v{i}"}} for i in range(12)]
    d = docs_from_json(spark, schemas.ORDER_NODE, [_order(lineItems={"edges": items})])
    r = flatten.orders(d).first()
    assert json.loads(r.line_items) == [f"n{i}" for i in range(12)]
    assert r.vendor == json.dumps([f"v{i}" for i in range(12)])


def test_order_without_items_vanishes_from_items_table(spark):
    d = docs_from_json(spark, schemas.ORDER_ITEMS_NODE, [_order(), _order(name="#2", lineItems={"edges": [_item(1)]})])
    rows = flatten.order_items(d).collect()
    assert [r.name for r in rows] == ["#2"]


def test_discount_sum_and_first_tax_line(spark):
    it = _item(5, discountAllocations=[{"allocatedAmountSet": money(a)} for a in ("1.10", "2.20", None)],
               taxLines=[{"priceSet": money("0.70"), "rate": 0.07}, {"priceSet": money("0.30"), "rate": 0.03}])
    d = docs_from_json(spark, schemas.ORDER_ITEMS_NODE, [_order(lineItems={"edges": [it]})])
    r = flatten.order_items(d).first()
    assert r.line_item_discount == 3.3
    assert r.line_item_tax_price == 0.7 and r.line_item_tax_rate == 0.07
    assert r.line_item_id == "5" and r.line_item_product_id == "7" and r.line_item_variant_id == "8"


def _refund(rid, *entries):
    return {"id": rid, "refundLineItems": {"edges": [
        {"node": {"restockType": rt, "subtotalSet": money(s), "lineItem": {"id": f"gid://shop/LineItem/{li}"}}}
        for li, rt, s in entries]}}


def test_refund_first_match_rules(spark):
    items = [_item(1), _item(2), _item(3)]
    refunds = [
        _refund("r1", (1, None, "1.00"), (2, "RETURN", "2.00"), (2, "NO_RESTOCK", "9.00")),
        _refund("r2", (1, "RETURN", "3.00"), (2, "CANCEL", "4.00")),
    ]
    d = docs_from_json(spark, schemas.ORDER_ITEMS_NODE, [_order(lineItems={"edges": items}, refunds=refunds)])
    got = {r.line_item_id: (r.refund_restock_type, r.refund_subtotal) for r in flatten.order_items(d).collect()}
    assert got["1"] == ("RETURN", 3.0)      # null restock first, a later refund overwrites
    assert got["2"] == ("RETURN", 2.0)      # first match in the first refund wins and stops
    assert got["3"] == ("", 0.0)            # no match


def test_gid_digits_edge_cases(spark):
    df = spark.createDataFrame([("gid://shop/Order/123",), ("gid://shop/Order/abc",), (None,)], "x string")
    assert [r[0] for r in df.select(X.gid_digits("x")).collect()] == ["123", None, None]
    assert [r[0] for r in df.select(X.gid_tail("x")).collect()] == ["123", "abc", None]


def test_tags_normaliser(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(X.tags_from_text("t")).collect()] == [["a"], [], []]
    df2 = spark.createDataFrame([(["x", "y"],), (None,)], "t array<string>")
    assert [r[0] for r in df2.select(X.tags_array("t")).collect()] == [["x", "y"], []]


def test_customer_without_personal_fields(spark):
    doc = {"id": "gid://shop/Customer/9", "numberOfOrders": "3", "amountSpent": {"amount": "12.5", "currencyCode": "EUR"},
           "createdAt": "bad", "updatedAt": "2024-01-01T00:00:00Z", "lastOrder": None}
    d = docs_from_json(spark, schemas.CUSTOMER_NODE_BASE, [doc])
    r = flatten.customers(d).first()
    assert r.id == "9" and r.orders_count == 3 and r.total_spent == 12.5
    assert r.email == "" and r.tags == [] and r.default_address_city == "" and r.last_order_id == ""
    assert r.created_at is None


def _product(pid, variants, media=None, **kw):
    p = {"id": f"gid://shop/Product/{pid}", "title": "P", "tags": ["a", "b"],
         "media": {"nodes": media or []}, "variants": {"edges": [{"node": v} for v in variants]}}
    p.update(kw)
    return {"node": p}


def test_products_null_nodes_and_images(spark):
    docs = [
        {"node": None},
        _product(1, [None, {"id": "gid://shop/ProductVariant/11", "price": "1.00", "compareAtPrice": None,
                            "inventoryItem": None, "inventoryQuantity": None, "image": None}],
                 media=[{"image": {"url": ""}}, {"image": {"url": "http://img/p1.jpg"}}]),
        _product(2, []),
        _product(3, [{"id": "plain-id", "image": {"url": "http://img/v3.png"}, "inventoryItem": {"id": "gid://x/Inv/5"}}]),
    ]
    d = docs_from_json(spark, "node struct<" + schemas._fields(schemas.PRODUCT_NODE) + ">", docs)
    rows = sorted(flatten.products(d).collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == ["1", "3"]
    a, b = rows
    assert a.variant_image_url == "http://img/p1.jpg" and a.variant_compareAtPrice == ""
    assert a.variant_inventoryItem_id == "" and a.variant_inventoryQuantity == 0 and a.tags == "a, b"
    assert b.variant_id == "plain-id" and b.variant_image_url == "http://img/v3.png"
    assert b.variant_inventoryItem_id == "5"


def test_json_text_matches_python_dumps(spark):
    vals = ["é", 'say "hi"', None, "a\\b"]
    df = spark.createDataFrame([(vals,)], "a array<string>")
    got = df.select(X.json_list_text("a")).first()[0]
    assert got == json.dumps(vals, ensure_ascii=False)


def test_legacy_conform_renames_and_fills(spark):
    d = docs_from_json(spark, schemas.ORDER_ITEMS_NODE, [_order(lineItems={"edges": [_item(1)]})])
    out = schemas.conform(flatten.order_items(d), schemas.ORDER_ITEMS_LEGACY)
    assert out.columns == [c[0] for c in schemas.ORDER_ITEMS_LEGACY]
    r = out.first()
    assert r.orders_line_items_id == "1" and r.date is None and r.orders_name == "#1001"
