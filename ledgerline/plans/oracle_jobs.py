"""DuckDB SQL for the job and log views, from their rules.

``state`` has one row per job: its latest event (``cur``), its earliest creation
event (``made``), both as whole rows, and the least start, store and data set of
its creation events."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

JOB_NAME_SQL = """(CASE WHEN starts_with(x, 'shopify-') THEN x ELSE 'shopify-' || x END)"""


def job_name_sql(store: str) -> str:
    x = (f"trim(regexp_replace(regexp_replace(lower(replace({store}, '.myshopify.com', '')), "
         f"'[^a-z0-9-]', '-', 'g'), '-+', '-', 'g'), '-')")
    return JOB_NAME_SQL.replace("x", x)


RUNNER_NAME = (f"CASE WHEN user_id // 12 = 0 THEN {job_name_sql('store')} "
               f"ELSE {job_name_sql('store')} || '-v' || CAST(user_id // 12 + 1 AS VARCHAR) END")

LEVEL = """CASE WHEN contains(msg, '[ERROR]') OR contains(msg, 'Error') OR contains(msg, 'error') THEN 'ERROR'
     WHEN contains(msg, '[WARNING]') OR contains(msg, 'Warning') THEN 'WARNING' ELSE 'INFO' END"""

COMPONENT = """CASE WHEN contains(lower(msg), 'customer') THEN 'customers'
     WHEN contains(lower(msg), 'order') AND contains(lower(msg), 'items') THEN 'order_items'
     WHEN contains(lower(msg), 'order') THEN 'orders'
     WHEN contains(lower(msg), 'product') THEN 'products' ELSE 'main' END"""

BASE = f"""
ev AS (
  SELECT event_id, user_id, event_type, value, props, CAST(ts AS TIMESTAMP) AS ts,
         json_extract_string(props, '$.k') AS k,
         'store-' || CAST(user_id % 12 AS VARCHAR) || '.myshopify.com' AS store
  FROM events
),
jobs AS (
  SELECT 'job-' || CAST(user_id AS VARCHAR) || '-' || CAST((dayofyear(ts) - 1) // 7 AS VARCHAR) AS job_id,
         CASE WHEN event_type = 'signup' OR event_id % 4 <> 0 THEN store ELSE '' END AS store_url,
         CASE WHEN event_type = 'signup' OR event_id % 4 <> 0
              THEN 'shopify_store_' || CAST(user_id % 12 AS VARCHAR) ELSE '' END AS dataset_name,
         CASE WHEN event_type = 'signup' THEN 'historical_load' ELSE 'status_update' END AS job_type,
         CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'running' WHEN 'view' THEN 'running'
              WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS status,
         ts AS started_at,
         CASE WHEN event_type IN ('purchase', 'error') THEN ts END AS completed_at,
         CASE WHEN event_type = 'error' THEN 'Failed components: customers. ' || props END AS error_message,
         CASE WHEN event_type = 'purchase' THEN CAST(trunc(value * 100) AS BIGINT) END AS records_processed,
         CAST(NULL AS BIGINT) AS duration_seconds,
         'system' AS created_by,
         event_id AS event_seq
  FROM ev
),
msgs AS (
  SELECT *, CASE event_type
      WHEN 'signup' THEN '[PROCESSING] Store: ' || store
      WHEN 'click' THEN '[FETCHING] Orders page ' || k
      WHEN 'view' THEN '[WARNING] Throttled by API, retry ' || k
      WHEN 'purchase' THEN '[SUCCESS] Uploaded ' || k || ' records of order items'
      ELSE '[ERROR] Failed to run customer insights: code ' || k || ' ' || repeat('trace ', CAST(k AS INTEGER) % 40)
    END AS msg
  FROM ev
),
logs AS (
  SELECT 'log-' || CAST(event_id AS VARCHAR) AS log_id, 'job-' || CAST(user_id AS VARCHAR) || '-' || CAST((dayofyear(ts) - 1) // 7 AS VARCHAR) AS job_id,
         ts AS "timestamp", {LEVEL} AS log_level, msg AS message, store AS store_url,
         {COMPONENT} AS component
  FROM msgs
  UNION ALL
  SELECT 'mark-' || CAST(event_id AS VARCHAR), 'job-' || CAST(user_id AS VARCHAR) || '-' || CAST((dayofyear(ts) - 1) // 7 AS VARCHAR), ts, 'INFO',
         'CLOUD_RUN_JOB_NAME:' || ({RUNNER_NAME}), store, 'system'
  FROM ev WHERE event_type = 'signup' AND user_id % 2 = 0
),
state AS (
  SELECT job_id, arg_max(event, (started_at, event_seq)) AS cur,
         arg_min(event, (started_at, event_seq)) FILTER (creates) AS made,
         min(started_at) FILTER (creates) AS made_at, min(store_url) FILTER (creates) AS made_store, min(dataset_name) FILTER (creates) AS made_dataset
  FROM (SELECT *, jobs AS event, job_type IS DISTINCT FROM 'status_update' AS creates FROM jobs) GROUP BY job_id
)"""

ORACLE: dict[str, str] = {}

ORACLE["jobs_active"] = f"""
WITH {BASE}
SELECT job_id, coalesce(nullif(cur.store_url, ''), made_store) AS store_url, coalesce(nullif(cur.dataset_name, ''), made_dataset) AS dataset_name,
       cur.job_type, cur.status, made_at AS started_at, date_sub('second', made_at, {AS_OF}) AS running_seconds
FROM state
WHERE cur.status IN ('pending', 'running') AND made_at >= {AS_OF} - INTERVAL 24 HOUR AND made_store IS NOT NULL AND made_dataset IS NOT NULL
"""

ORACLE["job_logs_topk"] = f"""
WITH {BASE}
SELECT job_id, "timestamp", log_level, left(message, 1000) AS message, component FROM logs
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY "timestamp" DESC, log_id DESC) <= 100
"""

ORACLE["job_error_summary"] = f"""
WITH {BASE},
newest AS (SELECT * FROM logs WHERE log_level IN ('ERROR', 'WARNING')
           QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY "timestamp" DESC, log_id DESC) <= 10),
texts AS (SELECT job_id, string_agg(format('{{}} [{{}}] {{}}', strftime("timestamp", '%Y-%m-%d %H:%M:%S'), coalesce(component, ''), message),
                                    ' | ' ORDER BY "timestamp" DESC, log_id DESC) AS recent_errors FROM newest GROUP BY job_id)
SELECT job_id, error_count, warning_count, recent_errors
FROM texts JOIN (SELECT job_id, count(*) FILTER (log_level = 'ERROR') AS error_count, count(*) FILTER (log_level = 'WARNING') AS warning_count
                 FROM logs GROUP BY job_id) USING (job_id)
"""

RECENT_CTES = """
failures AS (SELECT job_id, count(*) AS n FROM logs WHERE log_level = 'ERROR' GROUP BY job_id),
recent AS (
  SELECT job_id, made.store_url, made.dataset_name, made.job_type, cur.status, made.started_at, cur.completed_at, cur.error_message,
         cur.duration_seconds, cur.records_processed, coalesce(n, 0) AS error_count
  FROM state LEFT JOIN failures USING (job_id) WHERE made.store_url IS NOT NULL AND made.dataset_name IS NOT NULL
)"""

RECENT_BODY = f"WITH {BASE}, {RECENT_CTES}"

ORACLE["jobs_recent"] = f"""{RECENT_BODY}
SELECT * FROM recent ORDER BY started_at DESC, job_id DESC LIMIT 20
"""

ORACLE["jobs_summary"] = f"""{RECENT_BODY}
SELECT * FROM recent
"""

ORACLE["job_history"] = f"""
WITH {BASE}
SELECT job_id, status, started_at, job_type, event_seq FROM jobs ORDER BY job_id, started_at DESC
"""

STUCK = f"""
stuck AS (
  SELECT job_id, cur.store_url, cur.dataset_name, cur.started_at FROM state
  WHERE cur.status = 'pending' AND cur.started_at < {AS_OF} - INTERVAL 1 HOUR
)"""

ORACLE["jobs_stuck"] = f"""
WITH {BASE}, {STUCK}
SELECT * FROM stuck
"""

ORACLE["jobs_stuck_sweep"] = f"""
WITH {BASE}, {STUCK}
SELECT job_id, store_url, dataset_name, 'status_update' AS job_type, 'failed' AS status,
       {AS_OF} AS started_at, CAST(NULL AS TIMESTAMP) AS completed_at,
       'Job timeout - stuck for over 1 hours' AS error_message, CAST(NULL AS BIGINT) AS records_processed,
       CAST(NULL AS BIGINT) AS duration_seconds, 'system_cleanup' AS created_by
FROM stuck
"""

ORACLE["store_recent_job_logs"] = f"""
WITH {BASE},
five AS (SELECT store_url AS store, job_id FROM jobs WHERE store_url <> ''
         QUALIFY row_number() OVER (PARTITION BY store_url ORDER BY started_at DESC, event_seq DESC) <= 5)
SELECT store, "timestamp", log_level, message, store_url, component FROM (SELECT DISTINCT * FROM five) JOIN logs USING (job_id)
QUALIFY row_number() OVER (PARTITION BY store ORDER BY "timestamp" DESC, log_id DESC) <= 100
"""

ORACLE["store_job_status"] = f"""
WITH {BASE}
SELECT job_id, store_url, status, started_at, completed_at, error_message FROM jobs WHERE store_url <> ''
QUALIFY row_number() OVER (PARTITION BY store_url ORDER BY started_at DESC, event_seq DESC) <= 10
"""

ORACLE["logs_keyword_search"] = f"""
WITH {BASE}
SELECT job_id, "timestamp", log_level, component,
       CASE WHEN length(message) > 150 THEN substr(message, 1, 150) || '...' ELSE message END AS message
FROM logs
WHERE message LIKE '%Fetched%' OR message LIKE '%records%' OR message LIKE '%No %'
   OR message LIKE '%WARNING%' OR message LIKE '%ERROR%' OR message LIKE '%Failed%'
   OR message LIKE '%Uploaded%' OR message LIKE '%success%'
ORDER BY job_id, "timestamp"
"""

ORACLE["logs_fetch_search"] = f"""
WITH {BASE}
SELECT job_id, "timestamp", log_level, component,
       CASE WHEN length(message) > 150 THEN substr(message, 1, 150) || '...' ELSE message END AS message
FROM logs
WHERE message LIKE '%[FETCHING]%' OR message LIKE '%[SUCCESS]%' OR message LIKE '%[WARNING] No%'
   OR message LIKE '%Uploaded to BigQuery%'
ORDER BY job_id, "timestamp"
"""

STORES_CFG = """
cfg AS (
  SELECT 'store-' || CAST(n_nationkey AS VARCHAR) || '.myshopify.com' AS merchant,
         'shopify_store_' || CAST(n_nationkey AS VARCHAR) AS bigquery_dataset,
         CAST(DATE '1995-01-01' + to_days(CAST(n_nationkey * 30 AS INTEGER)) AS DATE) AS backfill_start_date,
         n_nationkey % 6 <> 5 AS is_active,
         CASE WHEN n_nationkey % 4 = 0 THEN '2020-01-01' END AS meta_start
  FROM nation
)"""

CONNECTED = f"""
WITH {BASE}, {STORES_CFG},
{RECENT_CTES},
newest AS (SELECT store_url, arg_max(recent, (started_at, job_id)) AS j FROM recent GROUP BY store_url),
connected AS (
  SELECT c.merchant AS store_url, c.bigquery_dataset AS dataset,
         coalesce(c.meta_start, strftime(c.backfill_start_date, '%Y-%m-%d')) AS start_date,
         coalesce(strftime(coalesce(j.completed_at, j.started_at), '%Y-%m-%d %H:%M'), 'Never') AS last_sync,
         CASE j.status WHEN 'completed' THEN 'Active' WHEN 'running' THEN 'Pipeline Running'
              WHEN 'failed' THEN 'Failed' WHEN 'cancelled' THEN 'Cancelled' ELSE 'Not Synced' END AS status
  FROM cfg c LEFT JOIN newest ON newest.store_url = c.merchant
  WHERE c.is_active
)"""

ORACLE["stores_connected"] = f"""{CONNECTED}
SELECT * FROM connected
"""

ORACLE["stores_metrics"] = f"""{CONNECTED}
SELECT COUNT(*) AS total_stores, COUNT(CASE WHEN status = 'Active' THEN 1 END) AS active_stores,
       COUNT(CASE WHEN status = 'Pipeline Running' THEN 1 END) AS running_pipelines
FROM connected
"""

RUNNER = f"""
runner AS (
  SELECT job_name, state,
         CASE WHEN state = 'PENDING' THEN 'Pending' WHEN state = 'ACTIVE' THEN 'Running'
              WHEN state = 'SUCCEEDED' THEN 'Completed' WHEN state = 'FAILED' THEN 'Failed'
              WHEN state = 'CANCELLED' THEN 'Cancelled' WHEN state = '1' THEN 'Pending'
              WHEN state = '2' THEN 'Running' WHEN state = '3' THEN 'Completed' WHEN state = '4' THEN 'Failed'
              WHEN state = '5' THEN 'Cancelled' ELSE state END AS label
  FROM (SELECT DISTINCT user_id, store, {RUNNER_NAME} AS job_name,
               CASE user_id % 7 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'SUCCEEDED'
                    WHEN 3 THEN 'FAILED' WHEN 4 THEN 'CANCELLED' WHEN 5 THEN '3' ELSE '4' END AS state
        FROM ev WHERE user_id % 7 <> 6)
),
marker AS (
  SELECT job_id, trim(split_part(arg_max(message, ("timestamp", log_id)), 'CLOUD_RUN_JOB_NAME:', 2)) AS marker_name
  FROM logs WHERE contains(message, 'CLOUD_RUN_JOB_NAME:') GROUP BY job_id
),
cand AS (
  SELECT rc.job_id, arg_min(ru.job_name, ru.version) AS cand_name, arg_min(ru.label, ru.version) AS cand_label
  FROM (SELECT job_id, {job_name_sql('store_url')} AS base FROM recent) rc
  JOIN (SELECT job_name, label, job_name AS base, 1 AS version FROM runner
        UNION ALL
        SELECT job_name, label, regexp_replace(job_name, '-v[0-9]+$', ''),
               CAST(regexp_extract(job_name, '-v([0-9]+)$', 1) AS BIGINT)
        FROM runner WHERE regexp_matches(job_name, '-v[1-9][0-9]*$') AND NOT regexp_matches(job_name, '-v1$')) ru
    ON ru.base = rc.base
  GROUP BY rc.job_id
),
matched AS (
  SELECT rc.*, coalesce(m.marker_name, c.cand_name) AS runner_job,
         CASE WHEN m.marker_name IS NOT NULL THEN coalesce(ru.label, 'No executions found') ELSE c.cand_label END
           AS runner_status
  FROM recent rc LEFT JOIN marker m ON m.job_id = rc.job_id
  LEFT JOIN cand c ON c.job_id = rc.job_id
  LEFT JOIN runner ru ON ru.job_name = m.marker_name
)"""

ORACLE["jobs_board"] = f"""{RECENT_BODY.replace('recent AS (', 'all_recent AS (')},
recent AS (SELECT * FROM all_recent ORDER BY started_at DESC, job_id DESC LIMIT 10),
{RUNNER}
SELECT store_url AS pipeline_name, coalesce(runner_job, '-') AS runner_job,
  CASE WHEN status IN ('running', 'pending') THEN 'Running' WHEN status = 'completed' THEN 'Completed'
       WHEN status = 'failed' THEN 'Failed' ELSE upper(substr(status, 1, 1)) || lower(substr(status, 2)) END AS status,
  coalesce(runner_status, '-') AS runner_status,
  coalesce(strftime(started_at, '%Y-%m-%d %H:%M'), 'N/A') AS started
FROM matched
"""

INHERIT = """
st AS (
  SELECT job_id, cur.status AS last_status, cur.started_at AS last_started, made.store_url AS first_store, made.dataset_name AS first_dataset,
         coalesce(nullif(cur.store_url, ''), made.store_url) AS store_url, coalesce(nullif(cur.dataset_name, ''), made.dataset_name) AS dataset_name
  FROM state
)"""

ORACLE["status_reconcile"] = f"""{RECENT_BODY},
{RUNNER}, {INHERIT}
SELECT m.job_id, st.store_url, st.dataset_name, 'status_update' AS job_type,
       CASE m.runner_status WHEN 'Completed' THEN 'completed' WHEN 'Failed' THEN 'failed' ELSE 'cancelled' END AS status,
       st.last_started AS started_at,
       CASE WHEN m.runner_status IN ('Completed', 'Failed') THEN {AS_OF} END AS completed_at,
       'Status updated from Cloud Run: ' || m.runner_status AS error_message,
       CAST(NULL AS BIGINT) AS records_processed,
       CASE WHEN m.runner_status IN ('Completed', 'Failed')
            THEN (epoch_us({AS_OF}) - epoch_us(st.last_started)) // 1000000 END AS duration_seconds,
       'system' AS created_by
FROM matched m JOIN st ON st.job_id = m.job_id
WHERE m.status = 'running' AND m.runner_status IN ('Completed', 'Failed', 'Cancelled')
"""

ORACLE["active_guard"] = f"""
WITH {BASE}, {INHERIT}
SELECT store_url, count(*) FILTER (last_status IN ('pending', 'running')) AS active_count, bool_or(last_status IN ('pending', 'running')) AS has_active
FROM st GROUP BY store_url
"""

ORACLE["guarded_create"] = f"""
WITH {BASE}, {INHERIT}, {STORES_CFG},
busy AS (SELECT DISTINCT store_url FROM st WHERE last_status IN ('pending', 'running'))
SELECT sha256(merchant || '|' || bigquery_dataset || '|' || '2024-01-31 00:00:00') AS job_id,
       merchant AS store_url, bigquery_dataset AS dataset_name, 'historical_load' AS job_type,
       'pending' AS status, {AS_OF} AS started_at, CAST(NULL AS TIMESTAMP) AS completed_at,
       CAST(NULL AS VARCHAR) AS error_message, CAST(NULL AS BIGINT) AS records_processed,
       CAST(NULL AS BIGINT) AS duration_seconds, 'onboarding' AS created_by
FROM cfg WHERE is_active AND merchant NOT IN (SELECT store_url FROM busy WHERE store_url IS NOT NULL)
"""

ORACLE["job_status_append"] = f"""
WITH {BASE}, {INHERIT}
SELECT job_id, store_url, dataset_name, 'status_update' AS job_type, 'completed' AS status,
       last_started AS started_at, {AS_OF} AS completed_at, CAST(NULL AS VARCHAR) AS error_message,
       CAST(NULL AS BIGINT) AS records_processed,
       (epoch_us({AS_OF}) - epoch_us(last_started)) // 1000000 AS duration_seconds, 'system' AS created_by
FROM st WHERE last_status = 'running'
"""

ORACLE["job_cancel"] = f"""
WITH {BASE}, {INHERIT}
SELECT job_id, coalesce(first_store, 'unknown') AS store_url, coalesce(first_dataset, 'unknown') AS dataset_name,
       'status_update' AS job_type, 'cancelled' AS status, {AS_OF} AS started_at,
       CAST(NULL AS TIMESTAMP) AS completed_at, 'Cancelled by user' AS error_message,
       CAST(NULL AS BIGINT) AS records_processed, CAST(NULL AS BIGINT) AS duration_seconds,
       'user_cancel' AS created_by
FROM st WHERE last_status = 'pending'
"""

_AFTER = """
SELECT job_id, {changed} AS status, CASE WHEN {hit} THEN {at} ELSE started_at END AS status_at
FROM (SELECT job_id, arg_max(status, (started_at, event_seq)) AS status, max(started_at) AS started_at
      FROM jobs GROUP BY job_id) j
"""

ORACLE["job_status_after_append"] = f"WITH {BASE}" + _AFTER.format(
    changed="CASE WHEN status = 'running' THEN 'completed' ELSE status END", hit="false", at="started_at")

ORACLE["job_cancel_after_append"] = f"WITH {BASE}" + _AFTER.format(
    changed="CASE WHEN status = 'pending' THEN 'cancelled' ELSE status END", hit="status = 'pending'", at=AS_OF)

ORACLE["reconcile_after_append"] = f"""{RECENT_BODY},
{RUNNER}""" + _AFTER.format(
    changed="""coalesce((SELECT CASE m.runner_status WHEN 'Completed' THEN 'completed' WHEN 'Failed' THEN 'failed'
                                                 WHEN 'Cancelled' THEN 'cancelled' END
                  FROM matched m WHERE m.job_id = j.job_id AND m.status = 'running'), j.status)""",
    hit="false", at="started_at")

ENDED = "ended AS (SELECT job_id FROM jobs GROUP BY job_id HAVING bool_or(status IN ('completed', 'failed', 'cancelled')))"

ORACLE["history_cleared"] = f"""
WITH {BASE}, {ENDED}
SELECT job_id, status, started_at, event_seq FROM jobs ANTI JOIN ended USING (job_id)
"""

ORACLE["history_cleared_logs"] = f"""
WITH {BASE}, {ENDED}
SELECT log_id, job_id, "timestamp", log_level FROM logs ANTI JOIN ended USING (job_id)
"""

ORACLE["jobs_hourly"] = f"""
WITH {BASE},
parts AS (
  SELECT date_trunc('hour', started_at) AS hour, (status = 'completed')::INT AS done, (status = 'failed')::INT AS lost, records_processed AS records,
         0 AS errors, NULL AS seconds, 1 AS of_jobs FROM jobs
  UNION ALL SELECT date_trunc('hour', "timestamp"), 0, 0, NULL, 1, NULL, 0 FROM logs WHERE log_level = 'ERROR'
  UNION ALL SELECT date_trunc('hour', cur.completed_at), 0, 0, NULL, 0, date_sub('second', made.started_at, cur.completed_at), 0
            FROM state WHERE cur.status IN ('completed', 'failed') AND made IS NOT NULL)
SELECT hour, sum(done)::BIGINT AS jobs_completed, sum(lost)::BIGINT AS jobs_failed,
       CASE WHEN sum(done) + sum(lost) > 0 THEN sum(done) / (sum(done) + sum(lost)) END AS success_rate,
       sum(records)::BIGINT AS records_processed, sum(errors)::BIGINT AS error_logs, sum(seconds)::DOUBLE / count(seconds) AS avg_duration_seconds
FROM parts GROUP BY hour
"""
