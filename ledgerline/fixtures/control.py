"""Control tables: store config, pipeline job events, pipeline logs, runner status.

In production these are append-only tables written by the loaders. For tests
and benchmarks they are derived by Spark from the driver's tables:

* ``store_config``: one row per nation, merchant ``store-{n}.myshopify.com``
  (stores 5-24 never get orders or jobs, exercising the left joins).
* ``pipeline_jobs``: one event per ``events`` row, job ``job-{user_id}-{week}``,
  store ``store-{user_id % 12}``; signup creates the job (historical_load,
  pending), click/view -> running, purchase -> completed, error -> failed
  (all three status_update). ``event_seq`` = event_id breaks started_at ties.
* ``pipeline_logs``: one line per event (text per event type), plus a runner
  marker line for every signup of an even user.
* ``runner_status``: one row per job runner name, state by user_id % 7.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as X
from .landing import STORE_TIMEZONES, _pick
from ..sources.tables import read

AS_OF = "2024-01-31 00:00:00"
JOB_STORES = 12


def as_of_col(as_of: str = AS_OF) -> Column:
    return F.to_timestamp(F.lit(as_of))


def merchant_of(k: Column) -> Column:
    return F.concat(F.lit("store-"), k.cast("string"), F.lit(K.STORE_SUFFIX))


# ---------------------------------------------------------------------------
# store_config (+ iana_timezone, last_updated as landed text)
# ---------------------------------------------------------------------------
def store_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    created = F.to_timestamp(F.lit("2024-01-01")) + F.make_interval(hours=k.cast("int"))
    as_of = as_of_col()
    lu_ts = as_of - F.make_interval(secs=(k * 3).cast("decimal(18,6)"))
    return n.select(
        merchant_of(k).alias("merchant"),
        F.concat(F.lit(K.TOKEN_PREFIX), F.substring(F.sha2(F.col("n_name"), 256), 1, 32)).alias("token"),
        F.lit("demo-project").alias("gcp_project_id"),
        F.concat(F.lit(K.DATASET_PREFIX), F.lit("store_"), k.cast("string")).alias("bigquery_dataset"),
        F.date_add(F.to_date(F.lit("1995-01-01")), (k * 30).cast("int")).alias("backfill_start_date"),
        (k % 6 != 5).alias("is_active"),
        created.alias("created_at"),
        (created + F.make_interval(days=k.cast("int"))).alias("updated_at"),
        F.lit("system").alias("created_by"),
        F.when(k % 2 == 0, F.lit("system")).otherwise(F.lit("admin")).alias("updated_by"),
        F.when(k % 4 == 0, F.concat(F.lit('{"MERCHANT_NOTE": "tier-'), (k % 3).cast("string"),
                                    F.lit('", "BACKFILL_START_DATE": "2020-01-01"}'))).alias("metadata"),
        _pick(STORE_TIMEZONES, k % 5).alias("iana_timezone"),
        F.when(k % 4 == 0, F.concat(F.date_format(lu_ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .when(k % 4 == 1, F.date_format(lu_ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k % 4 == 2, F.lit("yesterday")).alias("last_updated"),
    )


# ---------------------------------------------------------------------------
# pipeline_jobs / pipeline_logs
# ---------------------------------------------------------------------------
def _events(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def job_of(user_id: Column, ts: Column) -> Column:
    """A user's events of one calendar week (day-of-year buckets of 7) form one job."""
    return F.concat(F.lit("job-"), user_id.cast("string"), F.lit("-"),
                    F.floor((F.dayofyear(ts) - 1) / 7).cast("string"))


def pipeline_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_events_from(_events(spark, sf_dir))


def job_events_from(e: DataFrame) -> DataFrame:
    """Job event rows from an events DataFrame (batch or stream)."""
    t = F.col("event_type")
    u = F.col("user_id")
    store_k = u % JOB_STORES
    is_create = t == "signup"
    status = (F.when(is_create, "pending").when(t.isin("click", "view"), "running")
              .when(t == "purchase", "completed").otherwise("failed"))
    store = merchant_of(store_k)
    return e.select(
        job_of(u, F.col("ts")).alias("job_id"),
        # status events sometimes carry '' for store/dataset (filled later from the job)
        F.when(is_create | (F.col("event_id") % 4 != 0), store).otherwise(F.lit("")).alias("store_url"),
        F.when(is_create | (F.col("event_id") % 4 != 0),
               F.concat(F.lit(K.DATASET_PREFIX), F.lit("store_"), store_k.cast("string"))).otherwise(F.lit("")).alias("dataset_name"),
        F.when(is_create, F.lit("historical_load")).otherwise(F.lit(K.STATUS_UPDATE)).alias("job_type"),
        status.alias("status"),
        F.col("ts").alias("started_at"),
        F.when(t.isin("purchase", "error"), F.col("ts")).alias("completed_at"),
        F.when(t == "error", F.concat(F.lit("Failed components: customers. "), F.col("props"))).alias("error_message"),
        F.when(t == "purchase", (F.col("value") * 100).cast("bigint")).alias("records_processed"),
        F.lit(None).cast("bigint").alias("duration_seconds"),
        F.lit("system").alias("created_by"),
        F.col("event_id").alias("event_seq"),
    )


def _log_message(t: Column, k: Column, store: Column) -> Column:
    return (F.when(t == "signup", F.concat(F.lit("[PROCESSING] Store: "), store))
            .when(t == "click", F.concat(F.lit("[FETCHING] Orders page "), k))
            .when(t == "view", F.concat(F.lit("[WARNING] Throttled by API, retry "), k))
            .when(t == "purchase", F.concat(F.lit("[SUCCESS] Uploaded "), k, F.lit(" records of order items")))
            .otherwise(F.concat(F.lit("[ERROR] Failed to run customer insights: code "), k, F.lit(" "),
                                F.repeat(F.lit("trace "), (k.cast("int") % 40)))))


def pipeline_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return log_lines_from(e).unionByName(marker_lines_from(e))


def log_lines_from(e: DataFrame) -> DataFrame:
    """One log line per event (batch or stream)."""
    t = F.col("event_type")
    u = F.col("user_id")
    k = F.get_json_object("props", "$.k")
    store = merchant_of(u % JOB_STORES)
    msg = _log_message(t, k, store)          # classified and stored whole
    return e.select(
        F.concat(F.lit("log-"), F.col("event_id").cast("string")).alias("log_id"),
        job_of(u, F.col("ts")).alias("job_id"),
        F.col("ts").alias("timestamp"),
        X.log_level(msg).alias("log_level"),
        msg.alias("message"),
        store.alias("store_url"),
        X.log_component(msg).alias("component"),
        F.lit(None).cast("boolean").alias("is_error"),
        F.lit(None).cast("string").alias("error_type"))


def marker_lines_from(e: DataFrame) -> DataFrame:
    """Runner marker line for every signup of an even user."""
    t = F.col("event_type")
    u = F.col("user_id")
    store = merchant_of(u % JOB_STORES)
    return e.where((t == "signup") & (u % 2 == 0)).select(
        F.concat(F.lit("mark-"), F.col("event_id").cast("string")).alias("log_id"),
        job_of(u, F.col("ts")).alias("job_id"),
        F.col("ts").alias("timestamp"),
        F.lit("INFO").alias("log_level"),
        F.concat(F.lit(K.JOB_NAME_MARKER), runner_name(u)).alias("message"),
        store.alias("store_url"),
        F.lit("system").alias("component"),
        F.lit(None).cast("boolean").alias("is_error"),
        F.lit(None).cast("string").alias("error_type"))


def runner_name(user_id: Column) -> Column:
    """Runner job name of a user's job: base name of the store, versioned by
    the user's rank among users of the same store (base, -v2, -v3, ...)."""
    base = X.job_name(merchant_of(user_id % JOB_STORES))
    v = (F.floor(user_id / JOB_STORES) + 1).cast("bigint")
    return F.when(v == 1, base).otherwise(F.concat(base, F.lit("-v"), v.cast("string")))


RUNNER_STATES = ["PENDING", "ACTIVE", "SUCCEEDED", "FAILED", "CANCELLED", "3", "4"]


def runner_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per runner job (latest execution state); users with
    user_id % 7 == 6 never got a runner execution."""
    e = _events(spark, sf_dir)
    users = e.select("user_id").distinct()
    u = F.col("user_id")
    return users.where(u % 7 != 6).select(runner_name(u).alias("job_name"),
                                          _pick(RUNNER_STATES, u % 7).alias("state"))
