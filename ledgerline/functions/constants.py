"""Fixed values. These must equal the source application's behaviour for
results to match; they are stated here plainly, in natural order, together.
"""

# --- fixed values: store URL and runner naming ------------------------------
STORE_SUFFIX = ".myshopify.com"
TOKEN_PREFIX = "shpat_"
DATASET_PREFIX = "shopify_"
JOB_NAME_PREFIX = "shopify-"
JOB_NAME_MARKER = "CLOUD_RUN_JOB_NAME:"
JOB_NAME_VERSION = "^(.+)-v([2-9]|[1-9][0-9]{1,37})$"
MEMORY_CHOICES = ["2Gi", "4Gi", "8Gi"]

# --- fixed values: job model -------------------------------------------------
JOB_TYPES = ["historical_load", "daily_sync", "status_update"]
JOB_STATUSES = ["pending", "running", "completed", "failed", "cancelled"]
ACTIVE_STATUSES = ["pending", "running"]
TERMINAL_STATUSES = ["completed", "failed", "cancelled"]
STATUS_UPDATE = "status_update"
CANCEL_MESSAGE = "Cancelled by user"
CANCEL_CREATED_BY = "user_cancel"
CANCEL_LOG_LINE = "Job cancelled by user"
LOG_VIEW_CHARS = 1000
SWEEP_CREATED_BY = "system_cleanup"
SWEEP_MESSAGE = "Job timeout - stuck for over {hours} hours"
RECONCILE_MESSAGE = "Status updated from Cloud Run: {status}"

# --- fixed values: runner execution states (numeric code -> name -> label) --
RUNNER_STATE_CODES = [("1", "PENDING"), ("2", "ACTIVE"), ("3", "SUCCEEDED"),
                      ("4", "FAILED"), ("5", "CANCELLED")]
RUNNER_STATE_LABELS = [("EXECUTION_STATE_UNSPECIFIED", "Unknown"), ("ACTIVE", "Running"),
                       ("SUCCEEDED", "Completed"), ("FAILED", "Failed"),
                       ("CANCELLED", "Cancelled"), ("PENDING", "Pending")]
RUNNER_TERMINAL = [("Completed", "completed"), ("Failed", "failed"), ("Cancelled", "cancelled")]

# --- fixed values: store board labels ------------------------------------------
STORE_ACTIVE = "Active"
STORE_RUNNING = "Pipeline Running"
STORE_FAILED = "Failed"
STORE_CANCELLED = "Cancelled"
STORE_NOT_SYNCED = "Not Synced"
NEVER = "Never"

# --- fixed values: progress tags (DQ6) -----------------------------------------
PROGRESS_TAGS = [("[PROCESSING]", 25), ("[FETCHING]", 50), ("[SUCCESS]", 75), ("[COMPLETED]", 100)]

# --- fixed values: log search keywords (V9) ------------------------------------
RELEVANT_LOG_PATTERNS = ["%Fetched%", "%records%", "%No %", "%WARNING%", "%ERROR%",
                         "%Failed%", "%Uploaded%", "%success%"]
FETCH_LOG_PATTERNS = ["%[FETCHING]%", "%[SUCCESS]%", "%[WARNING] No%", "%Uploaded to BigQuery%"]

# --- fixed values: page triage messages (SRC12) -------------------------------
THROTTLED_TEXT = "Throttled"
ACCESS_DENIED_TEXT = "not approved to access the Customer object"

# --- fixed values: config validation messages (DQ1) ---------------------------
MSG_PERMISSION = "You must confirm you have permission"
MSG_REQUIRED = "All fields are required"
MSG_URL = "Store URL must end with .myshopify.com and not include protocol or path"
MSG_TOKEN = "Access token must start with 'shpat_'"
MSG_DATASET_PREFIX = "Dataset name must start with 'shopify_'"
MSG_DATASET_CHARS = "Dataset name must contain only lowercase letters, numbers, and underscores"
MSG_PROJECT = "GCP Project ID is required"
MSG_MEMORY = "Memory must be 2Gi, 4Gi, or 8Gi"
MSG_EXISTS = "Client already exists"

# --- fixed values: standard table names and expected-table check (SRC10) ------
TABLE_NAMES = {"BIGQUERY_TABLE_CUSTOMER_INSIGHTS": "customer_insights",
               "BIGQUERY_TABLE_ORDER_INSIGHTS": "order_insights",
               "BIGQUERY_TABLE_ORDER_ITEMS_INSIGHTS": "order_items_insights",
               "BIGQUERY_TABLE_PRODUCT_INSIGHTS": "products_insights"}
EXPECTED_TABLES = ["orders", "customers", "products", "order_items"]

# --- fixed values: defaults ------------------------------------------------------
DEFAULT_BACKFILL_START = "2024-01-01"
PRODUCTS_CHUNK_ROWS = 5000
