"""DuckDB SQL of the queries over declared tables and older schema sets."""

from __future__ import annotations

from ..schemas import ORDER_ITEMS_LEGACY
from .oracle_jobs import BASE


def build(oracle: dict[str, str]) -> dict[str, str]:
    """From the SQL of the four flat tables."""
    from .oracle import CUSTOMER_PAGES, LOADED
    orders, items, customers, products = (oracle[n] for n in ("orders_flat", "order_items_flat", "customers_flat", "products_flat"))
    renamed = ", ".join(f"('{old}', '{new}', '{typ}')" for old, typ, new in ORDER_ITEMS_LEGACY if new is not None and new != old)
    counts = ", ".join(f"count({new}) AS {new}" for old, _, new in ORDER_ITEMS_LEGACY if new is not None and new != old)
    return {
        "load_declared_table": f"""
SELECT store_name, processed_at_store_date, count(*) AS "rows", CAST(sum(line_item_quantity) AS BIGINT) AS quantity
FROM ({items}) t GROUP BY 1, 2""",
        "load_one_store": f"""
SELECT store_name, customer_country, count(*) AS orders, min(processed_at_store_date) AS first_day, max(processed_at_store_date) AS last_day,
       max(total_price) AS largest
FROM ({orders}) t WHERE store_name <> 'store-1.myshopify.com' OR processed_at_store_date >= DATE '1997-01-01' GROUP BY 1, 2""",
        "load_empty_keeps_target": f"""
SELECT store_name, id, count(*) AS variants, count(*) FILTER (status = 'DRAFT') AS drafts
FROM ({products}) t WHERE store_name <> 'store-1.myshopify.com' OR status = 'ACTIVE' GROUP BY 1, 2""",
        "legacy_orders": orders,
        "legacy_customers": f"SELECT * REPLACE (array_to_string(tags, ', ') AS tags), CAST(NULL AS VARCHAR) AS default_address_country_name FROM ({customers}) t",
        "legacy_products": f"""SELECT * REPLACE (CAST("variant_inventoryQuantity" AS VARCHAR) AS "variant_inventoryQuantity") FROM ({products}) t""",
        "mixed_order_items": f"""
SELECT store_name, currency_code, refund_restock_type, count(*) AS "rows", CAST(sum(line_item_quantity) AS BIGINT) AS quantity,
       min(processed_at_store_date) AS first_day, max(line_item_price) AS largest_price
FROM ({items}) t GROUP BY 1, 2, 3""",
        "contract_drift": f"""
WITH i AS (SELECT {counts}, count(line_item_discount) AS line_item_discount FROM ({items}) t),
n AS (UNPIVOT i ON COLUMNS(*) INTO NAME column_name VALUE k),
r AS (SELECT * FROM (VALUES {renamed}) v(old, new, typ))
SELECT 'order_items_insights' AS table_name, 'older' AS schema_set, old AS column_name, 'renamed' AS change, new || ' ' || typ AS produced,
       typ AS declared, k AS rows_with_value FROM r JOIN n ON n.column_name = r.new
UNION ALL SELECT 'order_items_insights', 'older', 'line_item_discount', 'extra', 'double', NULL, k FROM n WHERE column_name = 'line_item_discount'
UNION ALL VALUES ('order_items_insights', 'older', 'date', 'missing', NULL, 'date', 0),
                 ('order_items_insights', 'older', 'processed_at', 'missing', NULL, 'timestamp_ntz', 0),
                 ('customer_insights', 'older', 'default_address_country_name', 'missing', NULL, 'string', 0)
UNION ALL SELECT 'customer_insights', 'older', 'tags', 'type', 'array<string>', 'string', count(tags) FROM ({customers}) t
UNION ALL SELECT 'products_insights', 'older', 'variant_inventoryQuantity', 'type', 'bigint', 'string', count("variant_inventoryQuantity") FROM ({products}) t""",
        "component_summary": f"""
WITH c AS (SELECT 'customers' AS component, count(*) AS records FROM customer UNION ALL SELECT 'order_items', count(*) FROM lineitem),
r AS (SELECT component, 'completed' AS status, records, CAST(NULL AS VARCHAR) AS error_message FROM c
      UNION ALL VALUES ('orders', 'failed', 0, 'orders: no landed pages of orders'), ('products', 'cancelled', 0, NULL)
      UNION ALL SELECT 'run', 'failed', CAST(sum(records) AS BIGINT), 'Failed components: orders. orders: no landed pages of orders' FROM c)
SELECT 'nightly' AS run, * FROM r""",
        "job_cancel_log": f"""
WITH {BASE},
gone AS (SELECT job_id FROM state WHERE cur.status = 'pending'),
lines AS (SELECT job_id, "timestamp", log_level, message, component, log_id FROM logs
          UNION ALL SELECT job_id, TIMESTAMP '2024-01-31 00:00:00', 'WARNING', 'Job cancelled by user', 'main', '~' FROM gone)
SELECT job_id, "timestamp", log_level, message, component
FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY "timestamp" DESC, log_id DESC) AS r FROM lines) WHERE r = 1""",
        "sweep_counts": f"""
WITH {BASE}
SELECT count(*) AS cleaned, count(*) AS found FROM state
WHERE cur.status = 'pending' AND cur.started_at < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 HOUR""",
        "job_error_array": f"""
WITH {BASE},
ew AS (SELECT *, row_number() OVER of_job AS r, count(*) FILTER (log_level = 'ERROR') OVER (PARTITION BY job_id) AS error_count,
              count(*) FILTER (log_level = 'WARNING') OVER (PARTITION BY job_id) AS warning_count, count(*) OVER (PARTITION BY job_id) AS lines
       FROM logs WHERE log_level IN ('ERROR', 'WARNING') WINDOW of_job AS (PARTITION BY job_id ORDER BY "timestamp" DESC, log_id DESC))
SELECT job_id, error_count, warning_count, CAST(least(lines, 10) AS INTEGER) AS n_recent, CAST(r - 1 AS INTEGER) AS nth, "timestamp", component, message
FROM ew WHERE r <= 10""",
        "job_logs_bound": f"""
WITH {BASE}
SELECT "timestamp", log_level, message, component FROM logs
WHERE job_id = (SELECT job_id FROM logs GROUP BY job_id ORDER BY count(*) DESC, job_id LIMIT 1) ORDER BY "timestamp" DESC, log_id DESC LIMIT 100""",
        "customers_access_denied": f"""
WITH {CUSTOMER_PAGES}
SELECT t.* FROM ({customers}) t JOIN pc ON t.id = CAST(pc.c_custkey AS VARCHAR) WHERE {LOADED}
UNION ALL BY NAME
SELECT t.* FROM ({oracle['customers_flat_no_pii']}) t JOIN pc ON t.id = CAST(pc.c_custkey AS VARCHAR) WHERE page_class = 'access_denied'""",
    }
