"""Oracle SQL (DuckDB) for the store-configuration queries."""

from __future__ import annotations

from .oracle_jobs import AS_OF, job_name_sql

CFG = f"""
cfg AS (
  SELECT 'store-' || CAST(n_nationkey AS VARCHAR) || '.myshopify.com' AS merchant,
         'shpat_' || substr(sha256(n_name), 1, 32) AS token,
         'demo-project' AS gcp_project_id,
         'shopify_store_' || CAST(n_nationkey AS VARCHAR) AS bigquery_dataset,
         DATE '1995-01-01' + CAST(n_nationkey * 30 AS INTEGER) AS backfill_start_date,
         n_nationkey % 6 <> 5 AS is_active,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(n_nationkey AS INTEGER)) AS created_at,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(n_nationkey AS INTEGER))
           + to_days(CAST(n_nationkey AS INTEGER)) AS updated_at,
         'system' AS created_by,
         CASE WHEN n_nationkey % 2 = 0 THEN 'system' ELSE 'admin' END AS updated_by,
         CASE WHEN n_nationkey % 4 = 0 THEN '{{"MERCHANT_NOTE": "tier-' || CAST(n_nationkey % 3 AS VARCHAR)
              || '", "BACKFILL_START_DATE": "2020-01-01"}}' END AS metadata,
         CASE n_nationkey % 4
           WHEN 0 THEN strftime({AS_OF} - to_seconds(CAST(n_nationkey * 3 AS BIGINT)), '%Y-%m-%d %H:%M:%S') || ' UTC'
           WHEN 1 THEN strftime({AS_OF} - to_seconds(CAST(n_nationkey * 3 AS BIGINT)), '%Y-%m-%dT%H:%M:%S')
           WHEN 2 THEN 'yesterday' END AS last_updated,
         n_nationkey AS n, n_regionkey
  FROM nation
),
incoming AS (
  SELECT merchant, bigquery_dataset || '_v2' AS bigquery_dataset,
         CASE WHEN n % 3 = 0 THEN NULL ELSE backfill_start_date END AS backfill_start_date,
         n % 2 = 0 AS is_active, 'migration' AS created_by
  FROM cfg
),
existing AS (SELECT * FROM cfg WHERE n_regionkey <> 4)"""


def mask(v: str) -> str:
    return (f"CASE WHEN {v} IS NULL OR length({v}) < 16 THEN '********' "
            f"ELSE substr({v}, 1, 10) || repeat('*', length({v}) - 15) || right({v}, 5) END")


ORACLE: dict[str, str] = {}

ORACLE["store_list"] = f"""
WITH {CFG}
SELECT merchant, bigquery_dataset AS dataset, 'Yes' AS active,
       strftime(updated_at, '%Y-%m-%d %H:%M') AS updated
FROM cfg WHERE is_active ORDER BY merchant
"""

_BASE_KEYS = [("MERCHANT", "merchant"), ("TOKEN", "token"), ("GCP_PROJECT_ID", "gcp_project_id"),
              ("BIGQUERY_DATASET", "bigquery_dataset"),
              ("BACKFILL_START_DATE", "strftime(backfill_start_date, '%Y-%m-%d')"),
              ("last_updated", "strftime(updated_at, '%Y-%m-%dT%H:%M:%S') || '+00:00'"),
              ("is_active", "CASE WHEN is_active THEN 'true' ELSE 'false' END"),
              ("BIGQUERY_TABLE_CUSTOMER_INSIGHTS", "'customer_insights'"),
              ("BIGQUERY_TABLE_ORDER_INSIGHTS", "'order_insights'"),
              ("BIGQUERY_TABLE_ORDER_ITEMS_INSIGHTS", "'order_items_insights'"),
              ("BIGQUERY_TABLE_PRODUCT_INSIGHTS", "'products_insights'")]

ORACLE["store_config_overlay"] = f"""
WITH {CFG},
base AS ({" UNION ALL ".join(f"SELECT merchant, '{k}' AS k, {v} AS v FROM cfg WHERE is_active" for k, v in _BASE_KEYS)}),
meta AS (
  SELECT merchant, key AS k, json_extract_string(metadata, '$."' || key || '"') AS v
  FROM (SELECT merchant, metadata, unnest(json_keys(metadata)) AS key FROM cfg WHERE is_active AND metadata IS NOT NULL)
),
allp AS (
  SELECT merchant, k, v FROM meta
  UNION ALL
  SELECT b.merchant, b.k, b.v FROM base b
  WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.merchant = b.merchant AND m.k = b.k)
)
SELECT merchant,
       string_agg(k || '=' || CASE WHEN k = 'TOKEN' THEN {mask('v')} ELSE coalesce(v, '') END, ';' ORDER BY k)
         AS config_text
FROM allp GROUP BY merchant
"""

ORACLE["store_upsert_absent"] = f"""
WITH {CFG}
SELECT merchant, bigquery_dataset, is_active, created_by FROM existing
UNION ALL
SELECT merchant, bigquery_dataset, is_active, created_by FROM incoming
WHERE merchant NOT IN (SELECT merchant FROM existing)
"""

ORACLE["store_migration_summary"] = f"""
WITH {CFG}
SELECT CASE WHEN n_regionkey <> 4 THEN 'skipped' WHEN n % 7 = 6 THEN 'failed' ELSE 'migrated' END AS outcome, COUNT(*) AS stores
FROM cfg GROUP BY 1
"""

ORACLE["config_sources"] = f"""
WITH {CFG}
SELECT source, merchant, bigquery_dataset, backfill_start_date, is_active
FROM cfg JOIN (VALUES ('inline'), ('table'), ('file')) v(source) ON source <> 'inline' OR n = 3
"""

ORACLE["store_merge"] = f"""
WITH {CFG}
SELECT c.merchant, c.token, c.gcp_project_id, i.bigquery_dataset, i.backfill_start_date, i.is_active,
       {AS_OF} AS updated_at, CASE WHEN c.n_regionkey <> 4 THEN c.created_by ELSE 'admin' END AS created_by,
       'admin' AS updated_by,
       CASE WHEN c.n_regionkey <> 4 THEN c.metadata ELSE 'from ' || c.merchant END AS metadata
FROM incoming i JOIN cfg c ON c.merchant = i.merchant
"""

ORACLE["store_soft_delete"] = f"""
WITH {CFG}
SELECT merchant, CASE WHEN n_regionkey = 1 THEN false ELSE is_active END AS is_active,
       CASE WHEN n_regionkey = 1 THEN {AS_OF} ELSE updated_at END AS updated_at
FROM cfg
"""

ORACLE["store_update"] = f"""
WITH {CFG}
SELECT merchant, CASE WHEN merchant = 'store-3.myshopify.com' THEN 'shopify_test_store_3_v2'
                      ELSE bigquery_dataset END AS bigquery_dataset
FROM cfg
"""

ORACLE["store_recently_modified"] = f"""
WITH {CFG},
p AS (
  SELECT merchant, last_updated,
         coalesce(try_strptime(replace(last_updated, ' UTC', ''), '%Y-%m-%d %H:%M:%S'),
                  try_strptime(replace(last_updated, ' UTC', ''), '%Y-%m-%dT%H:%M:%S')) AS ts
  FROM cfg
)
SELECT merchant, last_updated FROM p
WHERE last_updated IS NULL OR ts IS NULL OR (epoch_us({AS_OF}) - epoch_us(ts)) // 1000000 <= 30
"""

ORACLE["config_validation"] = f"""
WITH {CFG},
cand AS (
  SELECT 'page-' || CAST(page_id AS VARCHAR) AS candidate_id, url AS merchant_url,
         CASE WHEN page_id % 3 = 0 THEN 'tok' || CAST(page_id AS VARCHAR) ELSE 'shpat_' || CAST(page_id AS VARCHAR) END AS token,
         CASE WHEN page_id % 7 = 0 THEN '' WHEN page_id % 4 = 0 THEN 'Bad-Name'
              ELSE 'shopify_p' || CAST(page_id AS VARCHAR) END AS dataset_name,
         CASE WHEN page_id % 11 = 0 THEN '' ELSE 'demo-project' END AS project_id,
         CASE page_id % 4 WHEN 0 THEN '2Gi' WHEN 1 THEN '4Gi' WHEN 2 THEN '8Gi' ELSE '16Gi' END AS memory,
         page_id % 5 <> 0 AS accept_terms
  FROM pages
  UNION ALL
  SELECT 'nation-' || CAST(n AS VARCHAR), ' https://' || merchant || '/admin ',
         'shpat_' || lpad(CAST(n AS VARCHAR), 30, 'x'),
         CASE WHEN n % 2 = 0 THEN 'shopify_new_' || CAST(n AS VARCHAR) ELSE 'shopify_store_' || CAST(n AS VARCHAR) END,
         'demo-project', '2Gi', true
  FROM cfg
),
c AS (
  SELECT *, split_part(regexp_replace(trim(merchant_url), 'https?://', '', 'g'), '/', 1) AS url,
         dataset_name IN (SELECT bigquery_dataset FROM cfg) AS ds_exists
  FROM cand
),
e AS (
  SELECT candidate_id, url AS merchant, {mask('token')} AS token_masked,
    concat_ws(' | ',
      CASE WHEN NOT coalesce(accept_terms, false) THEN 'You must confirm you have permission' END,
      CASE WHEN coalesce(url, '') = '' OR coalesce(token, '') = '' OR coalesce(dataset_name, '') = ''
           THEN 'All fields are required' END,
      CASE WHEN NOT (coalesce(url, '') <> '' AND ends_with(url, '.myshopify.com') AND NOT contains(url, '/')
                     AND NOT contains(url, ' '))
           THEN 'Store URL must end with .myshopify.com and not include protocol or path' END,
      CASE WHEN NOT coalesce(starts_with(token, 'shpat_'), false) THEN 'Access token must start with ''shpat_''' END,
      CASE WHEN coalesce(dataset_name, '') <> '' AND NOT starts_with(dataset_name, 'shopify_')
           THEN 'Dataset name must start with ''shopify_''' END,
      CASE WHEN coalesce(dataset_name, '') <> '' AND NOT regexp_matches(dataset_name, '^[a-z0-9_]+$')
           THEN 'Dataset name must contain only lowercase letters, numbers, and underscores' END,
      CASE WHEN coalesce(project_id, '') = '' THEN 'GCP Project ID is required' END,
      CASE WHEN NOT coalesce(memory IN ('2Gi', '4Gi', '8Gi'), false) THEN 'Memory must be 2Gi, 4Gi, or 8Gi' END,
      CASE WHEN coalesce(ds_exists, false) THEN 'Client already exists' END) AS errors
  FROM c
)
SELECT candidate_id, merchant, token_masked, errors, errors = '' AS valid FROM e
"""

ORACLE["job_names"] = f"""
WITH s AS (
  SELECT c_custkey,
    CASE c_custkey % 4
      WHEN 0 THEN upper(c_mktsegment) || '.Shop--' || CAST(c_nationkey % 3 AS VARCHAR) || '.myshopify.com'
      WHEN 1 THEN ' ' || lower(c_mktsegment) || '_store_' || CAST(c_nationkey % 3 AS VARCHAR)
      WHEN 2 THEN 'shopify-' || c_mktsegment || '-' || CAST(c_nationkey % 3 AS VARCHAR)
      ELSE '--' || c_mktsegment || '..' || CAST(c_nationkey % 3 AS VARCHAR) || '--' END AS store_name
  FROM customer
),
b AS (SELECT *, {job_name_sql('store_name')} AS base_name FROM s),
v AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY base_name ORDER BY c_custkey) AS version FROM b)
SELECT c_custkey, store_name, base_name, version,
       CASE WHEN version = 1 THEN base_name ELSE base_name || '-v' || CAST(version AS VARCHAR) END AS job_name
FROM v
"""

ORACLE["store_target"] = f"SELECT * FROM ({ORACLE['store_config_overlay']}) t WHERE merchant = 'store-3.myshopify.com'"
