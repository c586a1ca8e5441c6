"""Job and log analytics over the append-only event tables.

The job table is event-sourced: a job's current state is a query. Instead of
ranking all records of a job twice (first and latest, as window functions
would), :func:`job_state` does it in one aggregation with ``min_by`` / ``max_by``
over (started_at, event_seq): one shuffle, map-side partial aggregation (sorted,
as whole records are kept), so a job with millions of records costs its share.

Top-k per group uses ``row_number() <= k``, which Spark plans with a map-side
WindowGroupLimit: each map task ships at most k rows per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import constants as K
from ..functions import exprs as X

def _order() -> Column:
    return F.struct("started_at", "event_seq")


def _is_create() -> Column:
    return (F.col("job_type") != K.STATUS_UPDATE) | F.col("job_type").isNull()


def job_state(jobs: DataFrame) -> DataFrame:
    """One row per job_id (W1, W2, A3 in one pass).

    * ``last``: the latest record (status, completion, error, ...)
    * ``first``: the earliest creation record (non status_update)
    * ``orig_*``: per-column minima over creation records (as V1 reads them)
    * ``max_seq``: the job's highest event_seq; an appended event takes the next one
    """
    last = F.struct("status", "store_url", "dataset_name", "job_type", "started_at", "completed_at",
                    "error_message", "duration_seconds", "records_processed")
    first = F.struct("started_at", "store_url", "dataset_name", "job_type")
    c = _is_create()
    return jobs.groupBy("job_id").agg(
        F.max_by(last, _order()).alias("last"),
        F.min_by(F.when(c, first), F.when(c, _order())).alias("first"),
        F.min(F.when(c, F.col("started_at"))).alias("orig_started_at"),
        F.min(F.when(c, F.col("store_url"))).alias("orig_store_url"),
        F.min(F.when(c, F.col("dataset_name"))).alias("orig_dataset_name"),
        F.max("event_seq").alias("max_seq"),
    )


def _store_of_job() -> Column:
    """Job's store: latest record's value unless empty (pitfall 21), else the creation record's."""
    return F.coalesce(F.nullif(F.col("last.store_url"), F.lit("")), F.col("first.store_url"))


# --------------------------------------------------------------------------- V1
def active_jobs(jobs: DataFrame, as_of: Column, within_hours: int = 24) -> DataFrame:
    s = job_state(jobs)
    return (s.where(F.col("last.status").isin(*K.ACTIVE_STATUSES)
                    & (F.col("orig_started_at") >= X.hours_before(as_of, within_hours))
                    & F.col("orig_store_url").isNotNull() & F.col("orig_dataset_name").isNotNull())
            .select("job_id",
                    F.coalesce(F.nullif(F.col("last.store_url"), F.lit("")), "orig_store_url").alias("store_url"),
                    F.coalesce(F.nullif(F.col("last.dataset_name"), F.lit("")), "orig_dataset_name").alias("dataset_name"),
                    F.col("last.job_type").alias("job_type"),
                    F.col("last.status").alias("status"),
                    F.col("orig_started_at").alias("started_at"),
                    X.seconds_between("orig_started_at", as_of).alias("running_seconds")))


# --------------------------------------------------------------------------- V2, V7, V8, L3
def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """Rows ranked 1..k per key (WindowGroupLimit keeps map output at <= k per key)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def job_logs(logs: DataFrame, job_id: str | None = None, limit: int = 100) -> DataFrame:
    """V2: latest `limit` log lines of a job (of every job when job_id is None)."""
    if job_id is not None:
        logs = logs.where(F.col("job_id") == job_id)
    return top_per_group(logs, ["job_id"], [F.desc("timestamp"), F.desc("log_id")], limit) \
        .select("job_id", "timestamp", "log_level", X.left("message", K.LOG_VIEW_CHARS).alias("message"), "component")


# --------------------------------------------------------------------------- V3
def recent_errors(logs: DataFrame, job_id: str | None = None, recent: int = 10) -> DataFrame:
    """V3 A5: counts of error and warning lines of each job and its latest ones as an array, newest first."""
    ew = logs.where(F.col("log_level").isin("ERROR", "WARNING"))
    if job_id is not None:
        ew = ew.where(F.col("job_id") == job_id)
    counts = ew.groupBy("job_id").agg(F.count_if(F.col("log_level") == "ERROR").alias("error_count"),
                                      F.count_if(F.col("log_level") == "WARNING").alias("warning_count"))
    top = (top_per_group(ew, ["job_id"], [F.desc("timestamp"), F.desc("log_id")], recent)
           .groupBy("job_id").agg(F.sort_array(F.collect_list(
               F.struct("timestamp", "log_id", "component", "message")), asc=False).alias("_r")))
    newest = F.transform("_r", lambda r: F.struct(r["timestamp"].alias("timestamp"), r["component"].alias("component"), r["message"].alias("message")))
    return counts.join(top, "job_id").select("job_id", "error_count", "warning_count", newest.alias("recent_errors"))


def error_summary(logs: DataFrame, job_id: str | None = None, recent: int = 10) -> DataFrame:
    """V3 with the latest lines as one text."""
    text = F.array_join(F.transform("recent_errors", lambda r: F.concat(
        F.date_format(r["timestamp"], "yyyy-MM-dd HH:mm:ss"), F.lit(" ["), F.coalesce(r["component"], F.lit("")),
        F.lit("] "), r["message"])), " | ")
    return recent_errors(logs, job_id, recent).withColumn("recent_errors", text)


# --------------------------------------------------------------------------- V4
def recent_jobs(jobs: DataFrame, logs: DataFrame, limit: int | None = 20) -> DataFrame:
    s = job_state(jobs).where(F.col("first").isNotNull())
    errors = logs.where(F.col("log_level") == "ERROR").groupBy("job_id").agg(F.count(F.lit(1)).alias("_e"))
    out = (s.where(F.col("first.store_url").isNotNull() & F.col("first.dataset_name").isNotNull())
           .join(errors, "job_id", "left")
           .select("job_id",
                   F.col("first.store_url").alias("store_url"),
                   F.col("first.dataset_name").alias("dataset_name"),
                   F.col("first.job_type").alias("job_type"),
                   F.col("last.status").alias("status"),
                   F.col("first.started_at").alias("started_at"),
                   F.col("last.completed_at").alias("completed_at"),
                   F.col("last.error_message").alias("error_message"),
                   F.col("last.duration_seconds").alias("duration_seconds"),
                   F.col("last.records_processed").alias("records_processed"),
                   F.coalesce("_e", F.lit(0).cast("bigint")).alias("error_count")))
    if limit is not None:
        out = out.orderBy(F.desc("started_at"), F.desc("job_id")).limit(limit)
    return out


# --------------------------------------------------------------------------- V5
def job_history(jobs: DataFrame, job_id: str | None = None) -> DataFrame:
    if job_id is not None:
        jobs = jobs.where(F.col("job_id") == job_id)
    return jobs.select("job_id", "status", "started_at", "job_type", "event_seq") \
        .orderBy("job_id", F.desc("started_at"), F.desc("event_seq"))


# --------------------------------------------------------------------------- V6
def stuck_jobs(jobs: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    s = job_state(jobs)
    return (s.where((F.col("last.status") == "pending") & (F.col("last.started_at") < X.hours_before(as_of, hours)))
            .select("job_id", F.col("last.store_url").alias("store_url"),
                    F.col("last.dataset_name").alias("dataset_name"), F.col("last.started_at").alias("started_at"),
                    F.col("max_seq")))


# --------------------------------------------------------------------------- V7 / V8
def store_recent_job_logs(jobs: DataFrame, logs: DataFrame, store_url: str | None = None,
                          jobs_per_store: int = 5, limit: int = 100) -> DataFrame:
    """V7: logs of the jobs behind a store's latest `jobs_per_store` job records
    (for every store when store_url is None), latest `limit` lines per store."""
    j = jobs.where(F.col("store_url") != "")
    if store_url is not None:
        j = j.where(F.col("store_url") == store_url)
    latest = (top_per_group(j, ["store_url"], [F.desc("started_at"), F.desc("event_seq")], jobs_per_store)
              .select(F.col("store_url").alias("store"), "job_id").distinct())
    lg = logs.join(latest, "job_id")          # semi join per store (J3)
    return top_per_group(lg, ["store"], [F.desc("timestamp"), F.desc("log_id")], limit) \
        .select("store", "timestamp", "log_level", "message", "store_url", "component")


def store_job_status(jobs: DataFrame, store_url: str | None = None, limit: int = 10) -> DataFrame:
    j = jobs.where(F.col("store_url") != "")
    if store_url is not None:
        j = j.where(F.col("store_url") == store_url)
    return top_per_group(j, ["store_url"], [F.desc("started_at"), F.desc("event_seq")], limit) \
        .select("job_id", "store_url", "status", "started_at", "completed_at", "error_message")


# --------------------------------------------------------------------------- V9
def keyword_search(logs: DataFrame, patterns: list[str] = K.RELEVANT_LOG_PATTERNS,
                   job_id: str | None = None, width: int = 150) -> DataFrame:
    if job_id is not None:
        logs = logs.where(F.col("job_id") == job_id)
    cond = F.lit(False)
    for p in patterns:
        cond = cond | F.col("message").like(p)
    return logs.where(cond).select("job_id", "timestamp", "log_level", "component",
                                   X.ellipsize("message", width).alias("message")) \
        .orderBy("job_id", "timestamp")


def logs_containing(logs: DataFrame, text: str, level: str | None = None) -> DataFrame:
    """FLT14: substring filter on the message, optionally on the level too."""
    cond = F.col("message").contains(text)
    if level is not None:
        cond = cond | F.col("log_level").contains(level)
    return logs.where(cond)


def job_logs_sql(logs: DataFrame, job_id: str, limit: int = 100) -> DataFrame:
    """FLT12 + L2 as parameterised SQL: values are bound as named parameters
    (never spliced into the text), the table is passed as a DataFrame."""
    spark = logs.sparkSession
    return spark.sql(
        "SELECT timestamp, log_level, message, component FROM {logs} "
        "WHERE job_id = :job_id ORDER BY timestamp DESC, log_id DESC LIMIT :lim",
        args={"job_id": job_id, "lim": limit}, logs=logs)


# --------------------------------------------------------------------------- V10
def latest_job_per_store(jobs: DataFrame, logs: DataFrame) -> DataFrame:
    r = recent_jobs(jobs, logs, limit=None)
    return r.groupBy("store_url").agg(F.max_by(F.struct("status", "completed_at", "started_at"),
                                               F.struct("started_at", "job_id")).alias("j"))


def connected_stores(stores: DataFrame, jobs: DataFrame, logs: DataFrame) -> DataFrame:
    lj = latest_job_per_store(jobs, logs)
    meta = F.from_json(F.col("metadata"), "map<string,string>")
    active = stores.where(F.col("is_active"))
    # the per-store job summary is derived (one row per store): AQE measures it
    # at runtime and turns the join into a broadcast when it is small, without
    # computing the summary twice as an eager size probe would
    return (active.join(lj, active.merchant == lj.store_url, "left")
            .select(F.col("merchant").alias("store_url"),
                    F.col("bigquery_dataset").alias("dataset"),
                    F.coalesce(meta["BACKFILL_START_DATE"], F.date_format("backfill_start_date", "yyyy-MM-dd")).alias("start_date"),
                    F.coalesce(F.date_format(F.coalesce("j.completed_at", "j.started_at"), "yyyy-MM-dd HH:mm"),
                               F.lit(K.NEVER)).alias("last_sync"),
                    X.store_status(F.col("j.status")).alias("status")))


def store_metrics(connected: DataFrame) -> DataFrame:
    return connected.agg(F.count(F.lit(1)).alias("total_stores"),
                         F.count_if(F.col("status") == K.STORE_ACTIVE).alias("active_stores"),
                         F.count_if(F.col("status") == K.STORE_RUNNING).alias("running_pipelines"))


# --------------------------------------------------------------------------- V11 / J7
def runner_match(jobs_df: DataFrame, logs: DataFrame, runner: DataFrame) -> DataFrame:
    """Runner job name and display status per job.

    1. the latest marker line in the job's logs names the runner job;
    2. else, of the runner jobs named base, base-v2, base-v3, ... (base from
       the store URL) that have an execution, the one with the lowest version.

    Names carry no upper version. Each runner name is split once: it is version
    1 of itself and, if it ends in -vN, version N of the rest; the lowest
    version of each base is one row, so a job joins one row on its base.
    """
    marks = (logs.where(F.col("message").contains(K.JOB_NAME_MARKER))
             .groupBy("job_id").agg(F.max_by(X.marker_job_name("message"), F.struct("timestamp", "log_id")).alias("marker_name")))
    rs = runner.select(F.col("job_name").alias("rname"), X.runner_state_label("state").alias("rlabel"))
    version = F.regexp_extract("rname", K.JOB_NAME_VERSION, 2)
    named = rs.select(F.explode(F.array_compact(F.array(
        F.struct(F.col("rname").alias("base"), F.lit(1).cast("decimal(38,0)").alias("version")),
        F.when(version != "", F.struct(F.regexp_extract("rname", K.JOB_NAME_VERSION, 1).alias("base"),
                                       version.cast("decimal(38,0)").alias("version")))))).alias("n"), "rname", "rlabel")
    cand = (named.groupBy(F.col("n.base").alias("_base"))
            .agg(F.min_by(F.struct("rname", "rlabel"), F.struct("n.version", "rname")).alias("cand")))
    j = (jobs_df.withColumn("_base", X.job_name(F.col("store_url")))
         .join(marks, "job_id", "left").join(cand, "_base", "left")
         .join(rs, F.col("marker_name") == rs.rname, "left"))
    name = F.coalesce("marker_name", "cand.rname")
    label = F.when(F.col("marker_name").isNotNull(), F.coalesce("rlabel", F.lit("No executions found"))) \
        .otherwise(F.col("cand.rlabel"))
    return j.select(*jobs_df.columns, name.alias("runner_job"), label.alias("runner_status")).drop("rname", "rlabel")


def jobs_board(jobs: DataFrame, logs: DataFrame, runner: DataFrame, shown: int = 10) -> DataFrame:
    r = runner_match(recent_jobs(jobs, logs, limit=shown), logs, runner)
    return r.select(F.col("store_url").alias("pipeline_name"),
                    F.coalesce("runner_job", F.lit("-")).alias("runner_job"),
                    X.board_status(F.col("status")).alias("status"),
                    F.coalesce("runner_status", F.lit("-")).alias("runner_status"),
                    F.coalesce(F.date_format("started_at", "yyyy-MM-dd HH:mm"), F.lit("N/A")).alias("started"))


# --------------------------------------------------------------------------- V12 / A11
def active_guard(jobs: DataFrame) -> DataFrame:
    s = job_state(jobs)
    return (s.select(_store_of_job().alias("store_url"), F.col("last.status").alias("status"))
            .groupBy("store_url").agg(F.count_if(F.col("status").isin(*K.ACTIVE_STATUSES)).alias("active_count"))
            .withColumn("has_active", F.col("active_count") > 0))


# --------------------------------------------------------------------------- V15
def hourly(jobs: DataFrame, logs: DataFrame) -> DataFrame:
    """Jobs ended, records, error lines and mean processing time by hour. The
    three inputs are counted into rows of one shape and summed up once by hour,
    so an hour that only one of them knows is an hour too, and no join is made."""
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")

    def part(hour, done=zero, lost=zero, records=none, errors=zero, seconds=none):
        return [F.window(hour, "1 hour").start.alias("hour"), done.cast("bigint").alias("_done"), lost.cast("bigint").alias("_lost"),
                records.alias("_records"), errors.alias("_errors"), seconds.alias("_seconds")]

    # jobs whose latest record is terminal, from the creation record to that record, by hour of completion
    ended = job_state(jobs).where(F.col("last.status").isin("completed", "failed") & F.col("first").isNotNull())
    rows = jobs.select(*part(F.col("started_at"), F.col("status") == "completed", F.col("status") == "failed", F.col("records_processed"))) \
        .unionByName(logs.where(F.col("log_level") == "ERROR").select(*part(F.col("timestamp"), errors=F.lit(1).cast("bigint")))) \
        .unionByName(ended.select(*part(F.col("last.completed_at"), seconds=X.seconds_between(F.col("first.started_at"), F.col("last.completed_at")).cast("bigint"))))
    done, lost = F.coalesce(F.sum("_done"), zero), F.coalesce(F.sum("_lost"), zero)
    return rows.groupBy("hour").agg(
        done.alias("jobs_completed"), lost.alias("jobs_failed"), F.when(done + lost > 0, done / (done + lost)).alias("success_rate"),
        F.sum("_records").alias("records_processed"), F.sum("_errors").alias("error_logs"),
        # exact integer sum / count (a floating-point running sum would depend on order)
        (F.sum("_seconds").cast("double") / F.count("_seconds")).alias("avg_duration_seconds"))
