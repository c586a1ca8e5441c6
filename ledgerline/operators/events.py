"""Job event mutations (MUT5-MUT10, MUT12). The job table is append-only, so
every mutation is a set-based DataFrame of new event rows (append them with
:func:`ledgerline.plans.load.append`). Ids are deterministic (sha2 of the
inputs) so a retried task or re-run produces the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as X
from .jobs import job_state, runner_match

EVENT_COLUMNS = ["job_id", "store_url", "dataset_name", "job_type", "status", "started_at",
                 "completed_at", "error_message", "records_processed", "duration_seconds", "created_by",
                 "event_seq"]


def _event(job_id: Column, store: Column, dataset: Column, job_type: Column, status: Column,
           started: Column, completed: Column, error: Column, records: Column, duration: Column,
           created_by: Column, event_seq: Column) -> list[Column]:
    return [job_id.alias("job_id"), store.alias("store_url"), dataset.alias("dataset_name"),
            job_type.alias("job_type"), status.alias("status"), started.alias("started_at"),
            completed.cast("timestamp").alias("completed_at"), error.cast("string").alias("error_message"),
            records.cast("bigint").alias("records_processed"), duration.cast("bigint").alias("duration_seconds"),
            created_by.alias("created_by"), event_seq.cast("bigint").alias("event_seq")]


def _next_seq(nth: Column | int = 1) -> Column:
    """event_seq of an event appended to a job: above all the job has, so that
    the event wins the tie on started_at that it inherits. Of a sweep and a
    cancel of one moment the cancel is the later one, whichever was written first."""
    return F.coalesce(F.col("max_seq"), F.lit(0)) + nth


def _inherit(col: str) -> Column:
    """Attribute of the job's latest record, '' treated as missing."""
    return F.coalesce(F.nullif(F.col(f"last.{col}"), F.lit("")), F.col(f"first.{col}"))


def status_events(jobs: DataFrame, requests: DataFrame, as_of: Column) -> DataFrame:
    """MUT7: status events for (job_id, status, error_message, records_processed)
    requests; they inherit store/dataset/started_at from the job's latest record;
    completed_at and duration only for completed/failed. Of several requests for
    one job, those with a terminal status come last (then by their columns)."""
    s = job_state(jobs)
    done = F.col("status").isin("completed", "failed")
    nth = F.row_number().over(Window.partitionBy("job_id").orderBy(
        F.col("status").isin(*K.TERMINAL_STATUSES), "status", "error_message", "records_processed"))
    r = requests.join(s, "job_id").withColumn("_nth", nth)
    return r.select(*_event(
        F.col("job_id"), _inherit("store_url"), _inherit("dataset_name"), F.lit(K.STATUS_UPDATE),
        F.col("status"), F.col("last.started_at"), F.when(done, as_of), F.col("error_message"),
        F.col("records_processed"), F.when(done, X.seconds_between(F.col("last.started_at"), as_of)),
        F.lit("system"), _next_seq(F.col("_nth"))))


def complete_running(jobs: DataFrame, as_of: Column) -> DataFrame:
    """Registry form of MUT7: every job whose latest status is running completes at as_of."""
    s = job_state(jobs).where(F.col("last.status") == "running")
    req = s.select("job_id", F.lit("completed").alias("status"), F.lit(None).cast("string").alias("error_message"),
                   F.lit(None).cast("bigint").alias("records_processed"))
    return status_events(jobs, req, as_of)


def cancel_events(jobs: DataFrame, as_of: Column, job_ids: DataFrame | None = None) -> DataFrame:
    """MUT8: cancel requested jobs (default: every job whose latest status is pending)."""
    s = job_state(jobs)
    s = s.join(job_ids, "job_id", "left_semi") if job_ids is not None else s.where(F.col("last.status") == "pending")
    return s.select(*_event(
        F.col("job_id"), F.coalesce(F.col("first.store_url"), F.lit("unknown")),
        F.coalesce(F.col("first.dataset_name"), F.lit("unknown")), F.lit(K.STATUS_UPDATE), F.lit("cancelled"),
        as_of, F.lit(None), F.lit(K.CANCEL_MESSAGE), F.lit(None), F.lit(None), F.lit(K.CANCEL_CREATED_BY),
        _next_seq(2)))


def sweep_events(stuck: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    """MUT9: failed events for stuck jobs (input: V6 rows)."""
    return stuck.select(*_event(
        F.col("job_id"), F.col("store_url"), F.col("dataset_name"), F.lit(K.STATUS_UPDATE), F.lit("failed"),
        as_of, F.lit(None), F.lit(K.SWEEP_MESSAGE.format(hours=hours)), F.lit(None), F.lit(None),
        F.lit(K.SWEEP_CREATED_BY), _next_seq()))


def create_events(requests: DataFrame, as_of: Column, job_type: str = "historical_load") -> DataFrame:
    """MUT6: pending creation events for (store_url, dataset_name, created_by) requests."""
    jid = F.sha2(F.concat_ws("|", F.col("store_url"), F.col("dataset_name"), as_of.cast("string")), 256)
    return requests.select(*_event(
        jid, F.col("store_url"), F.col("dataset_name"), F.lit(job_type), F.lit("pending"), as_of,
        F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.coalesce(F.col("created_by"), F.lit("system")), F.lit(1)))


def guarded_create(requests: DataFrame, jobs: DataFrame, as_of: Column) -> DataFrame:
    """MUT10: refuse stores that already have an active job (A11 as an anti join).
    Of several requests of one store, the smallest (dataset, then requester) is taken."""
    from .jobs import active_guard
    busy = active_guard(jobs).where("has_active").select("store_url")
    one = requests.groupBy("store_url").agg(F.min(F.struct("dataset_name", "created_by")).alias("_r")) \
        .select("store_url", "_r.*")
    return create_events(one.join(busy, "store_url", "left_anti"), as_of)


def reconcile_events(jobs: DataFrame, logs: DataFrame, runner: DataFrame, as_of: Column) -> DataFrame:
    """MUT12: jobs still 'running' whose runner finished get a status event
    (set-based over every job, not only the rows shown on the board)."""
    from .jobs import recent_jobs
    matched = runner_match(recent_jobs(jobs, logs, limit=None), logs, runner)
    m = F.create_map(*[F.lit(x) for kv in K.RUNNER_TERMINAL for x in kv])
    req = (matched.where((F.col("status") == "running") & F.col("runner_status").isin(*[a for a, _ in K.RUNNER_TERMINAL]))
           .select("job_id", m[F.col("runner_status")].alias("status"),
                   F.concat(F.lit("Status updated from Cloud Run: "), F.col("runner_status")).alias("error_message"),
                   F.lit(None).cast("bigint").alias("records_processed")))
    return status_events(jobs, req, as_of)


def clear_history(jobs: DataFrame, logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """MUT5: delete whole jobs that reached a terminal status (all their rows,
    so no stale 'pending' row resurfaces) and their logs (J4 as anti joins)."""
    done = jobs.where(F.col("status").isin(*K.TERMINAL_STATUSES)).select("job_id").distinct()
    return jobs.join(done, "job_id", "left_anti"), logs.join(done, "job_id", "left_anti")


LOG_COLUMNS = ["log_id", "job_id", "timestamp", "log_level", "message", "store_url", "component",
               "is_error", "error_type"]


def log_events(lines: DataFrame) -> DataFrame:
    """SNK4 rows for pipeline_logs from (job_id, timestamp, log_level, message,
    store_url, component) requests: the whole message (views cut it), deterministic log_id (FN27)."""
    lid = F.sha2(F.concat_ws("|", F.col("job_id"), F.col("timestamp").cast("string"), F.col("message")), 256)
    return lines.select(lid.alias("log_id"), "job_id", F.col("timestamp").cast("timestamp").alias("timestamp"),
                        "log_level", "message", "store_url", "component",
                        F.lit(None).cast("boolean").alias("is_error"), F.lit(None).cast("string").alias("error_type"))


def cancel_log_lines(cancelled: DataFrame) -> DataFrame:
    """MUT8: the log line of each cancel event (input: :func:`cancel_events` rows)."""
    return log_events(cancelled.select("job_id", F.col("started_at").alias("timestamp"), F.lit("WARNING").alias("log_level"),
                                       F.lit(K.CANCEL_LOG_LINE).alias("message"), "store_url", F.lit("main").alias("component")))


def sweep_result(stuck: DataFrame, written: DataFrame) -> DataFrame:
    """MUT9: (cleaned, found): stuck jobs whose failed event was written, and all stuck jobs."""
    done = written.where(F.col("created_by") == K.SWEEP_CREATED_BY).select("job_id").distinct()
    return stuck.select("job_id").join(done.withColumn("_done", F.lit(1)), "job_id", "left") \
        .agg(F.count("_done").alias("cleaned"), F.count(F.lit(1)).alias("found"))
