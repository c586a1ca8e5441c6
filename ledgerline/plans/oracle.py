"""Independent DuckDB SQL for each registry query, written directly over the
flat tables (region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations).

These are the correctness oracles: the Spark side builds nested documents and
control tables and runs the engine's operators over them; the SQL here derives
the expected rows straight from the flat tables.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,4)) AS DOUBLE)"


STORES_CTE = """
st AS (
  SELECT 'store-' || CAST(n_nationkey AS VARCHAR) || '.myshopify.com' AS merchant,
         CASE n_nationkey % 5 WHEN 0 THEN 'UTC' WHEN 1 THEN 'America/New_York'
              WHEN 2 THEN 'Europe/Paris' WHEN 3 THEN 'Asia/Tokyo' END AS tz
  FROM nation
)"""

ORDERS_CTE = """
o AS (
  SELECT o.*, c.c_name, c.c_nationkey,
         'store-' || CAST(c.c_nationkey % 5 AS VARCHAR) || '.myshopify.com' AS store_name,
         CASE WHEN o.o_orderkey % 101 = 50 THEN NULL
              ELSE o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) END AS processed,
         CASE c.c_nationkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR'
              WHEN 3 THEN 'JPY' WHEN 4 THEN 'AUD' END AS currency
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

LINE_KEY = ("CAST(l_orderkey AS VARCHAR) || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') || "
            "lpad(CAST(l_partkey AS VARCHAR), 10, '0') || lpad(CAST(l_suppkey AS VARCHAR), 10, '0') || "
            "strftime(l_shipdate, '%Y%m%d')")

LOCAL_DATE = "CAST(timezone(coalesce(st.tz, 'UTC'), o.processed AT TIME ZONE 'UTC') AS DATE)"

ORDER_HEADER = f"""
  o.o_orderdate AS created_at,
  CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderdate + INTERVAL 2 DAY END AS updated_at,
  coalesce(o.currency, '') AS currency_code,
  coalesce(CASE WHEN o.o_orderkey % 17 = 0 THEN NULL
                ELSE lower(replace(o.c_name, '#', '')) || '@example.com' END, '') AS email,
  CASE o.o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'PENDING' ELSE 'PARTIALLY_REFUNDED' END
    AS display_financial_status,
  '#' || CAST(o.o_orderkey + 1000 AS VARCHAR) AS name,
  {money('o.o_totalprice * 0.05')} AS total_discounts,
  {money('o.o_totalprice')} AS total_price"""

ORACLE["order_items_flat"] = f"""
WITH {STORES_CTE}, {ORDERS_CTE},
l AS (
  SELECT l.*, p.p_name, p.p_brand, p.p_type, p.p_retailprice, {LINE_KEY} AS line_key
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
)
SELECT
  o.store_name,
  {LOCAL_DATE} AS processed_at_store_date,
  {ORDER_HEADER},
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'card_payments, gift_card'
       WHEN '2-HIGH' THEN 'card_payments' WHEN '3-MEDIUM' THEN 'manual' ELSE '' END
    AS payment_gateway_names,
  l.line_key AS line_item_id,
  CASE WHEN l.l_returnflag = 'R' THEN 0 ELSE CAST(l.l_quantity AS BIGINT) END AS line_item_current_quantity,
  {money('l.p_retailprice')} AS line_item_pre_tax_price,
  {money('l.p_retailprice * (1 - l.l_discount)')} AS line_item_price,
  CASE WHEN l.l_discount = 0 THEN 0.0 ELSE CAST(
    CAST(l.l_extendedprice * l.l_discount AS DECIMAL(18,4))
    + CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_quantity AS DECIMAL(18,4)) ELSE 0 END AS DOUBLE) END
    AS line_item_discount,
  CASE WHEN l.l_partkey % 11 = 0 THEN '' ELSE coalesce(regexp_extract(l.p_brand, '([0-9]+)$', 1), '') END
    AS line_item_product_id,
  CAST(l.l_quantity AS BIGINT) AS line_item_quantity,
  CASE WHEN l.l_partkey % 13 = 0 THEN '' ELSE 'SKU-' || CAST(l.l_partkey AS VARCHAR) END AS line_item_sku,
  coalesce(l.p_name, '') AS line_item_title,
  CAST(l.l_partkey AS VARCHAR) AS line_item_variant_id,
  coalesce(l.p_type, '') AS line_item_variant_title,
  CASE WHEN l.l_tax = 0 THEN NULL ELSE l.l_tax END AS line_item_tax_rate,
  coalesce(l.p_brand, '') AS line_item_vendor,
  CASE WHEN l.l_tax = 0 THEN 0.0 ELSE {money('l.l_extendedprice * l.l_tax')} END AS line_item_tax_price,
  CASE WHEN o.o_orderkey % 7 = 0 THEN '' WHEN o.o_orderstatus = 'O' THEN 'STANDARD' ELSE 'EXPRESS' END
    AS shipping_line_code,
  CASE WHEN o.o_orderkey % 7 = 0 THEN 0.0 ELSE {money('o.o_totalprice * 0.01')} END
    AS shipping_line_discounted_price,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'URGENT10' WHEN '2-HIGH' THEN 'HIGH5' ELSE '' END AS discount_code,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'RETURN'
       WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'NO_RESTOCK' ELSE '' END AS refund_restock_type,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN {money('l.l_extendedprice * (1 - l.l_discount)')}
       WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN {money('l.l_extendedprice * l.l_tax')}
       ELSE 0.0 END AS refund_subtotal
FROM l JOIN o ON l.l_orderkey = o.o_orderkey
LEFT JOIN st ON st.merchant = o.store_name
"""

FIRST10 = f"""
f10 AS (
  SELECT l_orderkey,
         string_agg(CASE WHEN p_name IS NULL THEN 'null' ELSE '"' || p_name || '"' END, ', ' ORDER BY line_key) AS names,
         string_agg(CASE WHEN p_brand IS NULL THEN 'null' ELSE '"' || p_brand || '"' END, ', ' ORDER BY line_key) AS vendors
  FROM (SELECT l.l_orderkey, p.p_name, p.p_brand, {LINE_KEY} AS line_key,
               row_number() OVER (PARTITION BY l.l_orderkey ORDER BY {LINE_KEY}) AS rn
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey)
  WHERE rn <= 10
  GROUP BY l_orderkey
)"""

ORACLE["orders_flat"] = f"""
WITH {STORES_CTE}, {ORDERS_CTE}, {FIRST10}
SELECT
  o.store_name,
  {ORDER_HEADER},
  o.processed AS processed_at,
  o.processed AS processed_at_shopify_timezone,
  {LOCAL_DATE} AS processed_at_store_date,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN '["URGENT10"]' WHEN '2-HIGH' THEN '["HIGH5", "VIP"]'
       WHEN '5-LOW' THEN '' ELSE '[]' END AS discount_codes,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN '["card_payments", "gift_card"]'
       WHEN '2-HIGH' THEN '["card_payments"]' WHEN '3-MEDIUM' THEN '["manual"]'
       WHEN '4-NOT SPECIFIED' THEN '[]' ELSE '' END AS payment_gateway_names,
  CASE WHEN o.o_orderstatus = 'F' THEN {money('o.o_totalprice * 0.1')} ELSE 0.0 END AS total_refunded,
  CASE WHEN o.o_orderkey % 7 = 0 THEN '' WHEN o.o_orderstatus = 'O' THEN 'Standard' ELSE 'Express' END
    AS shipping_line_title,
  CASE WHEN o.o_orderkey % 7 = 0 THEN 0.0 ELSE {money('o.o_totalprice * 0.01')} END AS shipping_line_price,
  CASE WHEN o.o_orderkey % 7 = 0 OR o.o_orderkey % 3 = 0 THEN NULL ELSE CAST(0.05 AS DOUBLE) END AS shipping_line_tax_rate,
  CASE WHEN o.o_orderkey % 7 = 0 OR o.o_orderkey % 3 = 0 THEN 0.0 ELSE {money('o.o_totalprice * 0.02')} END
    AS shipping_line_tax_amount,
  CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 5 = 0
       THEN strftime(o.o_orderdate + INTERVAL 3 DAY, '%Y-%m-%dT%H:%M:%SZ') ELSE '' END AS cancelled_at,
  'C' || CAST(o.o_orderkey AS VARCHAR) AS confirmation_number,
  CASE o.o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'O' THEN 'UNFULFILLED' ELSE 'PARTIALLY_FULFILLED' END
    AS display_fulfillment_status,
  CASE WHEN o.o_orderkey % 4 = 0 THEN '' ELSE '/products/p' || CAST(o.o_orderkey % 50 AS VARCHAR) END
    AS landing_page_url,
  CASE WHEN o.o_orderkey % 9 = 0 THEN 'gift wrap' ELSE '' END AS note,
  CASE WHEN o.o_orderstatus = 'P'
       THEN '["status-P", "' || o.o_orderpriority || '", "réduit"]'
       ELSE '["status-' || o.o_orderstatus || '", "' || o.o_orderpriority || '"]' END AS tags,
  CASE WHEN o.o_orderkey % 10 = 0 THEN 0.0 ELSE {money('o.o_totalprice * 0.01')} END AS total_tip_received,
  CASE WHEN o.o_custkey % 19 = 0 THEN '' ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN o.o_custkey % 19 = 0 THEN '' ELSE coalesce(n.n_name, '') END AS customer_country,
  coalesce('[' || f10.names || ']', '[]') AS line_items,
  coalesce('[' || f10.vendors || ']', '[]') AS vendor,
  CAST(CAST(o.o_totalprice * 0.05 AS DECIMAL(18,4))
       + CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice * 0.01 AS DECIMAL(18,4)) ELSE 0 END AS DOUBLE)
    AS order_level_tax_amount,
  CASE WHEN o.o_orderkey % 6 = 0 THEN {money('o.o_totalprice * 0.02')} ELSE 0.0 END AS duties,
  CAST(CASE WHEN o.o_orderkey % 8 = 0 THEN 1.5 ELSE 0.0 END AS DOUBLE) AS additional_fees
FROM o
LEFT JOIN st ON st.merchant = o.store_name
LEFT JOIN nation n ON n.n_nationkey = o.c_nationkey
LEFT JOIN f10 ON f10.l_orderkey = o.o_orderkey
"""

CUSTOMER_CTE = """
agg AS (
  SELECT o_custkey, count(*) AS n_orders, SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS spent,
         max(CASE WHEN rn = 1 THEN o_orderkey END) AS last_key
  FROM (SELECT o_custkey, o_orderkey, o_totalprice,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders)
  GROUP BY o_custkey
),
cu AS (
  SELECT c.*, n.n_name, agg.n_orders, agg.spent, agg.last_key,
         TIMESTAMP '2015-01-01 00:00:00' + to_days(CAST(c.c_custkey % 2000 AS INTEGER)) AS created
  FROM customer c LEFT JOIN agg ON agg.o_custkey = c.c_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""

CUSTOMER_BASE = """
  'store-' || CAST(c_nationkey % 5 AS VARCHAR) || '.myshopify.com' AS store_name,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE created END AS created_at,
  created + INTERVAL 1 DAY AS updated_at,
  CAST(c_custkey AS VARCHAR) AS id,
  CAST(coalesce(spent, 0) AS DOUBLE) AS total_spent,
  coalesce(CAST(last_key AS VARCHAR), '') AS last_order_id,
  coalesce('#' || CAST(last_key + 1000 AS VARCHAR), '') AS last_order_name,
  coalesce(n_orders, 0) AS orders_count,
  CASE c_nationkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR'
       WHEN 3 THEN 'JPY' WHEN 4 THEN 'AUD' END AS currency_code"""

ADDRESS_COLS = ["id", "first_name", "last_name", "company", "address1", "address2", "city",
                "province", "country", "zip", "phone", "name"]

ORACLE["customers_flat"] = f"""
WITH {CUSTOMER_CTE}
SELECT {CUSTOMER_BASE},
  lower(replace(c_name, '#', '')) || '@example.com' AS email,
  'First' || CAST(c_custkey AS VARCHAR) AS first_name,
  c_name AS display_name,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '+1-555-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') END AS phone,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS note,
  CASE WHEN c_custkey % 5 IN (0, 1) THEN CAST([] AS VARCHAR[])
       ELSE [c_mktsegment, 'n' || CAST(c_nationkey AS VARCHAR)] END AS tags,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'gid://shop/MailingAddress/' || CAST(c_custkey AS VARCHAR) END AS default_address_id,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'First' || CAST(c_custkey AS VARCHAR) END AS default_address_first_name,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Last' || CAST(c_custkey AS VARCHAR) END AS default_address_last_name,
  CASE WHEN c_custkey % 7 = 0 OR c_custkey % 2 <> 0 THEN '' ELSE c_mktsegment END AS default_address_company,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey % 997 AS VARCHAR) || ' Main St' END AS default_address_address1,
  '' AS default_address_address2,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'City' || CAST(c_custkey % 50 AS VARCHAR) END AS default_address_city,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'Province' || CAST(c_custkey % 10 AS VARCHAR) END AS default_address_province,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE coalesce(n_name, '') END AS default_address_country,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS default_address_zip,
  '' AS default_address_phone,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS default_address_name
FROM cu
"""

ORACLE["customers_flat_no_pii"] = f"""
WITH {CUSTOMER_CTE}
SELECT {CUSTOMER_BASE},
  '' AS email, '' AS first_name, '' AS display_name, '' AS phone, '' AS note,
  CAST([] AS VARCHAR[]) AS tags,
  {", ".join(f"'' AS default_address_{c}" for c in ADDRESS_COLS)}
FROM cu
"""

ORACLE["products_flat"] = """
WITH pb AS (
  SELECT p.*, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS b,
         TIMESTAMP '2019-01-01 00:00:00'
           + to_days(CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER)) AS created
  FROM part p
)
SELECT
  'store-' || CAST(b % 5 AS VARCHAR) || '.myshopify.com' AS store_name,
  created AS created_at,
  created + INTERVAL 30 DAY AS updated_at,
  CAST(b AS VARCHAR) AS id,
  p_brand AS title,
  CASE WHEN b % 2 = 0 THEN 'Hardware' ELSE 'Apparel' END AS product_type,
  lower(replace(p_brand, '#', '-')) AS handle,
  CASE WHEN b % 7 = 0 THEN 'DRAFT' ELSE 'ACTIVE' END AS status,
  CASE WHEN b % 7 = 0 THEN NULL ELSE created + INTERVAL 1 DAY END AS published_at,
  CASE WHEN b % 3 = 0 THEN '' ELSE 'brand, b' || CAST(b AS VARCHAR) END AS tags,
  'Vendor ' || CAST(b AS VARCHAR) AS vendor,
  CAST(p_partkey AS VARCHAR) AS variant_id,
  'SKU-' || CAST(p_partkey AS VARCHAR) AS variant_sku,
  p_name AS variant_title,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS variant_price,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(CAST(p_retailprice * 2 AS DECIMAL(18,2)) AS VARCHAR) END
    AS "variant_compareAtPrice",
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS "variant_inventoryItem_id",
  CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE CAST(p_size AS BIGINT) END AS "variant_inventoryQuantity",
  CASE WHEN p_partkey % 2 = 0 THEN 'https://cdn.example.com/v/' || CAST(p_partkey AS VARCHAR) || '.png'
       WHEN b % 4 = 0 THEN '' ELSE 'https://cdn.example.com/p/' || CAST(b AS VARCHAR) || '.jpg' END
    AS variant_image_url
FROM pb
WHERE b <> 13 AND p_partkey % 29 <> 0
"""


def _merge():
    from . import oracle_jobs, oracle_quality, oracle_stores
    ORACLE.update(oracle_quality.ORACLE)
    ORACLE.update(oracle_jobs.ORACLE)
    ORACLE.update(oracle_stores.ORACLE)


_merge()

_LEGACY = [("date", "CAST(NULL AS DATE)"), ("created_at", "created_at"), ("updated_at", "updated_at"),
           ("processed_at", "CAST(NULL AS TIMESTAMP)"), ("processed_at_store_date", "processed_at_store_date")]


def _legacy_select() -> str:
    from ..schemas import ORDER_ITEMS_LEGACY
    cols = []
    for name, _typ, src in ORDER_ITEMS_LEGACY:
        if name in dict(_LEGACY):
            cols.append(f"{dict(_LEGACY)[name]} AS {name}")
        else:
            cols.append(f"{src} AS {name}")
    return ", ".join(cols)


ORACLE["order_items_legacy_names"] = f"SELECT {_legacy_select()} FROM ({ORACLE['order_items_flat']}) t"

def page_cte(rows: str, month: str, key: str) -> str:
    """Pages of the stand-in landing: 250 documents of a store and month, and the class of each page."""
    return f"""
pg AS (SELECT *, {month} AS month, (row_number() OVER (PARTITION BY store_name, {month} ORDER BY {key}) - 1) // 250 AS page FROM {rows}),
pc AS (SELECT *, CASE (coalesce(TRY_CAST(replace(month, '-', '') AS BIGINT), 0) * 7
                       + CAST(regexp_extract(store_name, 'store-([0-9]+)', 1) AS BIGINT) * 3 + page) % 17
         WHEN 3 THEN 'rate_limited' WHEN 5 THEN 'access_denied' WHEN 7 THEN 'error'
         WHEN 11 THEN 'missing_data' WHEN 13 THEN 'malformed' ELSE 'good' END AS page_class FROM pg)"""


ORDER_PAGES = f"{ORDERS_CTE}, {page_cte('o', "coalesce(strftime(processed, '%Y-%m'), 'undated')", 'o_orderkey')}"
CUSTOMER_PAGES = f"""{CUSTOMER_CTE},
cs AS (SELECT *, 'store-' || CAST(c_nationkey % 5 AS VARCHAR) || '.myshopify.com' AS store_name,
              CASE WHEN c_custkey % 23 <> 0 THEN created END AS dated FROM cu),
{page_cte('cs', "coalesce(strftime(dated, '%Y-%m'), 'undated')", 'c_custkey')}"""
LOADED = "page_class IN ('good', 'error')"
STARTS_CTE = """
cfg AS (
  SELECT 'store-' || CAST(n_nationkey AS VARCHAR) || '.myshopify.com' AS merchant,
         CASE WHEN n_nationkey % 4 = 0 THEN DATE '2020-01-01'
              ELSE DATE '1995-01-01' + CAST(n_nationkey * 30 AS INTEGER) END AS start
  FROM nation WHERE n_nationkey % 6 <> 5
)"""

ORACLE["orders_from_pages"] = f"""
WITH {ORDER_PAGES}
SELECT t.* FROM ({ORACLE['orders_flat']}) t JOIN pc ON t.name = '#' || CAST(pc.o_orderkey + 1000 AS VARCHAR) WHERE {LOADED}
"""

ORACLE["order_items_from_pages"] = f"""
WITH {ORDER_PAGES}
SELECT t.* FROM ({ORACLE['order_items_flat']}) t JOIN pc ON t.name = '#' || CAST(pc.o_orderkey + 1000 AS VARCHAR) WHERE {LOADED}
"""

ORACLE["customers_from_pages"] = f"""
WITH {CUSTOMER_PAGES}
SELECT t.* FROM ({ORACLE['customers_flat']}) t JOIN pc ON t.id = CAST(pc.c_custkey AS VARCHAR) WHERE {LOADED}
"""

ORACLE["page_triage"] = f"""
WITH {ORDER_PAGES},
p AS (SELECT store_name, month, page, page_class, COUNT(*) AS n FROM pc GROUP BY ALL)
SELECT store_name, page_class, COUNT(*) AS pages, CAST(SUM(CASE WHEN {LOADED} THEN n ELSE 0 END) AS BIGINT) AS edges
FROM p GROUP BY 1, 2
"""

ORACLE["pages_quarantined"] = f"""
WITH {ORDER_PAGES},
p AS (SELECT DISTINCT store_name, month, page, page_class FROM pc WHERE page_class <> 'good')
SELECT store_name, page_class, COUNT(*) AS pages, COUNT(DISTINCT month) AS months, COUNT(*) AS with_text, COUNT(*) AS with_file,
       COUNT(*) FILTER (page_class = 'error') AS loaded
FROM p GROUP BY 1, 2
"""

ORACLE["pages_replayed"] = f"""
WITH {ORDER_PAGES}
SELECT store_name, CASE WHEN {LOADED} THEN 'first load' ELSE 'recovered' END AS part, COUNT(*) AS n
FROM pc WHERE page_class <> 'access_denied' GROUP BY 1, 2
UNION ALL SELECT store_name, 'pages left', COUNT(DISTINCT month || ' ' || CAST(page AS VARCHAR)) FROM pc WHERE page_class = 'access_denied' GROUP BY 1
"""

ORACLE["orders_in_range"] = f"""
WITH {STORES_CTE}, {ORDER_PAGES}
SELECT o.store_name, '#' || CAST(o.o_orderkey + 1000 AS VARCHAR) AS name, o.processed AS processed_at,
       {LOCAL_DATE} AS processed_at_store_date
FROM pc o LEFT JOIN st ON st.merchant = o.store_name
WHERE {LOADED} AND o.processed >= TIMESTAMP '1997-01-01 00:00:00' AND o.processed < TIMESTAMP '1998-01-01 00:00:00'
"""

ORACLE["backfill_by_store"] = f"""
WITH {ORDER_PAGES}, {STARTS_CTE}
SELECT o.store_name, COUNT(*) AS orders, MIN(o.processed) AS first_processed, MAX(o.processed) AS last_processed
FROM pc o JOIN cfg ON cfg.merchant = o.store_name
WHERE {LOADED} AND o.processed >= CAST(cfg.start AS TIMESTAMP)
GROUP BY o.store_name
"""

ORACLE["items_backfill"] = f"""
WITH {ORDER_PAGES}, {STARTS_CTE}
SELECT o.store_name, COUNT(*) AS items, COUNT(DISTINCT o.o_orderkey) AS orders, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM pc o JOIN cfg ON cfg.merchant = o.store_name JOIN lineitem ON l_orderkey = o.o_orderkey
WHERE {LOADED} AND o.processed >= CAST(cfg.start AS TIMESTAMP)
GROUP BY o.store_name
"""

ORACLE["customers_backfill"] = f"""
WITH {CUSTOMER_PAGES}, {STARTS_CTE}
SELECT store_name, COUNT(*) AS customers, MIN(dated) AS first_created, MAX(dated) AS last_created
FROM pc JOIN cfg ON cfg.merchant = store_name
WHERE {LOADED} AND dated >= CAST(start AS TIMESTAMP)
GROUP BY store_name
"""

ORACLE["orders_on_date"] = f"""
WITH {ORDERS_CTE}
SELECT store_name, COUNT(*) AS orders FROM o
WHERE CAST(o_orderdate AS DATE) = (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)
GROUP BY store_name
"""

ORACLE["month_windows"] = f"""
WITH RECURSIVE {STORES_CTE}, {ORDERS_CTE}, {STARTS_CTE},
w AS (
  SELECT merchant AS store_name, start AS window_start FROM cfg
  UNION ALL SELECT store_name, CAST(window_start + INTERVAL 1 MONTH AS DATE) FROM w
  WHERE window_start + INTERVAL 1 MONTH <= DATE '2024-01-31'),
f AS (SELECT o.store_name, {LOCAL_DATE} AS d FROM o LEFT JOIN st ON st.merchant = o.store_name)
SELECT w.store_name, 'window' AS part, window_start, CAST(window_start + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS window_end, COUNT(f.d) AS orders
FROM w LEFT JOIN f ON f.store_name = w.store_name AND f.d >= window_start AND f.d < window_start + INTERVAL 1 MONTH GROUP BY 1, 2, 3, 4
UNION ALL SELECT f.store_name, CASE WHEN d IS NULL THEN 'undated' ELSE 'before the start' END, NULL, NULL, COUNT(*)
FROM f JOIN cfg ON merchant = f.store_name WHERE d IS NULL OR d < start GROUP BY 1, 2
"""

ORACLE["load_roundtrip"] = f"""
SELECT store_name, processed_at_store_date, COUNT(*) AS rows, CAST(SUM(line_item_quantity) AS BIGINT) AS quantity
FROM ({ORACLE['order_items_flat']}) t GROUP BY 1, 2
"""

_J = __import__("ledgerline.plans.oracle_jobs", fromlist=["BASE", "LEVEL", "COMPONENT"])

ORACLE["stream_log_classify"] = f"""
WITH {_J.BASE}
SELECT log_id, job_id, "timestamp", {_J.LEVEL} AS level, {_J.COMPONENT} AS component,
       CASE WHEN contains(msg, '[PROCESSING]') THEN 25 WHEN contains(msg, '[FETCHING]') THEN 50
            WHEN contains(msg, '[SUCCESS]') THEN 75 WHEN contains(msg, '[COMPLETED]') THEN 100 END AS stage
FROM (SELECT *, message AS msg FROM logs)
"""

# Deliveries of the stand-in stream: number, watermark before each (newest event
# of earlier ones, in milliseconds, less two days), and which arrivals are taken.
DELIVERED_CTE = """
arr AS (
  SELECT *, unnest(CASE WHEN event_id % 101 = 5 THEN [least(own + 2, 3)] WHEN event_id % 97 = 0 THEN [own, own, least(own + 1, 3)] ELSE [own] END) AS d
  FROM (SELECT *, least((dayofyear(ts) - 1) // 8, 3) AS own FROM events)),
newest AS (SELECT d, max(ts) AS newest FROM arr GROUP BY d),
wm AS (SELECT d, date_trunc('milliseconds', max(newest) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - INTERVAL 2 DAY AS wm FROM newest),
seen AS (SELECT arr.*, wm IS NULL OR ts > wm AS in_time, row_number() OVER (PARTITION BY event_id, (wm IS NULL OR ts > wm) ORDER BY arr.d) AS nth
         FROM arr JOIN wm USING (d))"""

ORACLE["stream_job_status"] = f"""
WITH {_J.BASE}, {DELIVERED_CTE}
SELECT job_id, status, started_at AS status_at, event_seq
FROM (SELECT j.*, row_number() OVER (PARTITION BY job_id ORDER BY started_at DESC, event_seq DESC) AS last_first
      FROM jobs j WHERE event_seq IN (SELECT event_id FROM seen WHERE in_time)) WHERE last_first = 1
"""

ORACLE["stream_late_events"] = f"""
WITH {_J.BASE}, {DELIVERED_CTE}
SELECT job_id, event_seq, CASE WHEN in_time THEN 'repeated' ELSE 'late' END AS reason, count(*) AS times
FROM seen JOIN jobs ON event_seq = event_id WHERE NOT in_time OR nth > 1 GROUP BY 1, 2, 3
"""

ORACLE["stream_incremental_sync"] = """
SELECT 'store-' || CAST(c.c_nationkey % 5 AS VARCHAR) || '.myshopify.com' AS store_name, o.o_orderkey AS order_id,
       CASE WHEN o.o_orderstatus = 'O' THEN 'pending' ELSE o.o_orderstatus END AS status,
       CASE WHEN o.o_orderstatus = 'O' THEN o.o_orderdate ELSE o.o_orderdate + INTERVAL 5 DAY END AS updated_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

ORACLE["products_chunked_load"] = """
SELECT 'store-' || CAST(b % 5 AS VARCHAR) || '.myshopify.com' AS store_name, COUNT(*) AS variants,
       COUNT(DISTINCT b) AS products
FROM (SELECT p_partkey, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS b FROM part)
WHERE b <> 13 AND p_partkey % 29 <> 0
GROUP BY 1
"""

ORACLE["config_json_roundtrip"] = """
SELECT 'store-' || CAST(n_nationkey AS VARCHAR) || '.myshopify.com' AS merchant,
       'shopify_store_' || CAST(n_nationkey AS VARCHAR) AS bigquery_dataset,
       DATE '1995-01-01' + CAST(n_nationkey * 30 AS INTEGER) AS backfill_start_date,
       n_nationkey % 6 <> 5 AS is_active
FROM nation
"""

ORACLE["error_lines"] = f"""
WITH {_J.BASE}
SELECT log_id, job_id, log_level FROM logs WHERE contains(message, '[ERROR]')
"""

ORACLE["jobs_after_sweep"] = f"""
WITH {_J.BASE},
swept AS (SELECT *, cur.status = 'pending' AND cur.started_at < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 HOUR AS stuck FROM state)
SELECT job_id, CASE WHEN stuck THEN 'failed' ELSE cur.status END AS status,
       CASE WHEN stuck THEN TIMESTAMP '2024-01-31 00:00:00' ELSE cur.started_at END AS status_at
FROM swept
"""

ORACLE["products_from_pages"] = ORACLE["products_flat"]



def _derived() -> None:
    from . import oracle_declared
    ORACLE.update(oracle_declared.build(ORACLE))


_derived()
