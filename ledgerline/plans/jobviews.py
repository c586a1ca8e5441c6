"""Job/log analytics queries (V1-V12, V15, MUT5-MUT10, MUT12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as EV
from ..operators import jobs as J
from ..fixtures import control as C
from .registry import query

HOURS_STUCK = 1


def _tables(spark, sf_dir):
    return C.pipeline_jobs(spark, sf_dir), C.pipeline_logs(spark, sf_dir)


@query("jobs_active")
def jobs_active(spark, sf_dir):
    """SRC8 V1 W1 A3 J1 FLT6-FLT9 FN14-FN16: active jobs of the last 24 h."""
    jobs, _ = _tables(spark, sf_dir)
    return J.active_jobs(jobs, C.as_of_col())


@query("job_logs_topk")
def job_logs_topk(spark, sf_dir):
    """V2 L2 FLT12: latest 100 log lines of every job."""
    _, logs = _tables(spark, sf_dir)
    return J.job_logs(logs, limit=100)


@query("job_error_summary")
def job_error_summary(spark, sf_dir):
    """V3 A4 A5 L3: error/warning counts and the 10 latest of them per job."""
    _, logs = _tables(spark, sf_dir)
    return J.error_summary(logs)


@query("jobs_recent")
def jobs_recent(spark, sf_dir):
    """20 most recent jobs with status and error count."""
    jobs, logs = _tables(spark, sf_dir)
    return J.recent_jobs(jobs, logs, limit=20)


@query("jobs_summary")
def jobs_summary(spark, sf_dir):
    """V4 without the limit: one summary row for every job."""
    jobs, logs = _tables(spark, sf_dir)
    return J.recent_jobs(jobs, logs, limit=None)


@query("job_history")
def job_history(spark, sf_dir):
    """V5 L1: every record of every job, newest first."""
    jobs, _ = _tables(spark, sf_dir)
    return J.job_history(jobs)


@query("jobs_stuck")
def jobs_stuck(spark, sf_dir):
    """V6 W1 FLT7: jobs whose latest status is pending for over an hour."""
    jobs, _ = _tables(spark, sf_dir)
    return J.stuck_jobs(jobs, C.as_of_col(), HOURS_STUCK).drop("max_seq")


@query("jobs_stuck_sweep")
def jobs_stuck_sweep(spark, sf_dir):
    """MUT9: failed events for the stuck jobs."""
    jobs, _ = _tables(spark, sf_dir)
    return EV.sweep_events(J.stuck_jobs(jobs, C.as_of_col(), HOURS_STUCK), C.as_of_col(), HOURS_STUCK).drop("event_seq")


@query("store_recent_job_logs")
def store_recent_job_logs(spark, sf_dir):
    """Per store, latest 100 log lines of its 5 latest job records."""
    jobs, logs = _tables(spark, sf_dir)
    return J.store_recent_job_logs(jobs, logs)


@query("store_job_status")
def store_job_status(spark, sf_dir):
    """V8 L2: per store, its 10 latest job records."""
    jobs, _ = _tables(spark, sf_dir)
    return J.store_job_status(jobs)


@query("logs_keyword_search")
def logs_keyword_search(spark, sf_dir):
    """V9 FLT10 FN18: relevant log lines, messages cut at 150 chars."""
    _, logs = _tables(spark, sf_dir)
    return J.keyword_search(logs)


@query("logs_fetch_search")
def logs_fetch_search(spark, sf_dir):
    """V9 (second search): fetch-related log lines."""
    from ..functions import constants as K
    _, logs = _tables(spark, sf_dir)
    return J.keyword_search(logs, K.FETCH_LOG_PATTERNS)


@query("stores_connected")
def stores_connected(spark, sf_dir):
    """V10 J6 P13 FN24 FN25: active stores with their latest job's status."""
    jobs, logs = _tables(spark, sf_dir)
    return J.connected_stores(C.store_config(spark, sf_dir), jobs, logs)


@query("stores_metrics")
def stores_metrics(spark, sf_dir):
    """Total / active / running store counts."""
    jobs, logs = _tables(spark, sf_dir)
    return J.store_metrics(J.connected_stores(C.store_config(spark, sf_dir), jobs, logs))


@query("jobs_board")
def jobs_board(spark, sf_dir):
    """V11 J7 P14 FN23 FN24 FN26: the 10 latest jobs with their runner job and status."""
    jobs, logs = _tables(spark, sf_dir)
    return J.jobs_board(jobs, logs, C.runner_status(spark, sf_dir))


@query("status_reconcile")
def status_reconcile(spark, sf_dir):
    """MUT12: running jobs whose runner finished -> status events."""
    jobs, logs = _tables(spark, sf_dir)
    return EV.reconcile_events(jobs, logs, C.runner_status(spark, sf_dir), C.as_of_col()).drop("event_seq")


@query("active_guard")
def active_guard(spark, sf_dir):
    """Active-job count and guard flag per store."""
    jobs, _ = _tables(spark, sf_dir)
    return J.active_guard(jobs)


@query("guarded_create")
def guarded_create(spark, sf_dir):
    """MUT6 MUT10: one load request per active store; stores with an active job are refused."""
    from pyspark.sql import functions as F
    jobs, _ = _tables(spark, sf_dir)
    req = C.store_config(spark, sf_dir).where("is_active").select(
        F.col("merchant").alias("store_url"), F.col("bigquery_dataset").alias("dataset_name"),
        F.lit("onboarding").alias("created_by"))
    return EV.guarded_create(req, jobs, C.as_of_col()).drop("event_seq")


@query("job_status_append")
def job_status_append(spark, sf_dir):
    """MUT7 J10 FN15: running jobs complete at as_of (inherited fields, duration)."""
    jobs, _ = _tables(spark, sf_dir)
    return EV.complete_running(jobs, C.as_of_col()).drop("event_seq")


@query("job_cancel")
def job_cancel(spark, sf_dir):
    """MUT8: pending jobs are cancelled by the user."""
    jobs, _ = _tables(spark, sf_dir)
    return EV.cancel_events(jobs, C.as_of_col()).drop("event_seq")


@query("history_cleared")
def history_cleared(spark, sf_dir):
    """MUT5 J4: job rows left after clearing terminal jobs."""
    jobs, logs = _tables(spark, sf_dir)
    return EV.clear_history(jobs, logs)[0].select("job_id", "status", "started_at", "event_seq")


@query("history_cleared_logs")
def history_cleared_logs(spark, sf_dir):
    """MUT5 J4: log rows left after clearing terminal jobs."""
    jobs, logs = _tables(spark, sf_dir)
    return EV.clear_history(jobs, logs)[1].select("log_id", "job_id", "timestamp", "log_level")


@query("jobs_hourly")
def jobs_hourly(spark, sf_dir):
    """Hourly completed/failed/success rate/records/error lines."""
    jobs, logs = _tables(spark, sf_dir)
    return J.hourly(jobs, logs)


@query("error_lines")
def error_lines(spark, sf_dir):
    """FLT14: log lines whose text contains '[ERROR]'."""
    _, logs = _tables(spark, sf_dir)
    return J.logs_containing(logs, "[ERROR]").select("log_id", "job_id", "log_level")


def _state_after(spark, jobs, events):
    """SNK4 + W1: events appended to a copy of the job table, then every job's
    latest status derived again from the stored rows."""
    from ..session import fresh_path
    from .load import append
    path = fresh_path(spark, "pipeline_jobs")
    append(jobs.select(*EV.EVENT_COLUMNS), path)
    append(events, path)
    return J.job_state(spark.read.parquet(path)).select(
        "job_id", F.col("last.status").alias("status"), F.col("last.started_at").alias("status_at"))


@query("jobs_after_sweep")
def jobs_after_sweep(spark, sf_dir):
    """MUT9 + SNK4 + W1: every job's status once the stuck jobs' failed events are stored."""
    jobs, _ = _tables(spark, sf_dir)
    stuck = J.stuck_jobs(jobs, C.as_of_col(), HOURS_STUCK)
    return _state_after(spark, jobs, EV.sweep_events(stuck, C.as_of_col(), HOURS_STUCK))


@query("job_status_after_append")
def job_status_after_append(spark, sf_dir):
    """MUT7 + SNK4 + W1: every job's status once the running jobs' completions are stored."""
    jobs, _ = _tables(spark, sf_dir)
    return _state_after(spark, jobs, EV.complete_running(jobs, C.as_of_col()))


@query("job_cancel_after_append")
def job_cancel_after_append(spark, sf_dir):
    """MUT8 + SNK4 + W1: every job's status once the pending jobs' cancellations are stored."""
    jobs, _ = _tables(spark, sf_dir)
    return _state_after(spark, jobs, EV.cancel_events(jobs, C.as_of_col()))


@query("reconcile_after_append")
def reconcile_after_append(spark, sf_dir):
    """MUT12 + SNK4 + W1: every job's status once the runner's outcomes are stored."""
    jobs, logs = _tables(spark, sf_dir)
    return _state_after(spark, jobs, EV.reconcile_events(jobs, logs, C.runner_status(spark, sf_dir), C.as_of_col()))


@query("job_cancel_log")
def job_cancel_log(spark, sf_dir):
    """MUT8 SNK4: the log lines of the cancelled jobs, stored with the job's other lines and read back."""
    from ..session import fresh_path
    from .load import append
    jobs, logs = _tables(spark, sf_dir)
    path = fresh_path(spark, "pipeline_logs")
    append(logs.select(*EV.LOG_COLUMNS), path)
    append(EV.cancel_log_lines(EV.cancel_events(jobs, C.as_of_col())), path)
    return J.job_logs(spark.read.parquet(path), limit=1)


@query("sweep_counts")
def sweep_counts(spark, sf_dir):
    """MUT9: (cleaned, found) of the sweep of stuck jobs, from the events as stored."""
    from ..session import fresh_path
    from .load import append
    jobs, _ = _tables(spark, sf_dir)
    path, stuck = fresh_path(spark, "pipeline_jobs"), J.stuck_jobs(jobs, C.as_of_col(), HOURS_STUCK)
    append(EV.sweep_events(stuck, C.as_of_col(), HOURS_STUCK), path)
    return EV.sweep_result(stuck, spark.read.parquet(path))


@query("job_error_array")
def job_error_array(spark, sf_dir):
    """V3 A5: error and warning counts of each job with the array of its ten
    latest lines, of which each element is a row here."""
    from pyspark.sql import functions as F
    _, logs = _tables(spark, sf_dir)
    return J.recent_errors(logs).select("job_id", "error_count", "warning_count", F.size("recent_errors").alias("n_recent"),
                                        F.posexplode("recent_errors").alias("nth", "e")) \
        .select("job_id", "error_count", "warning_count", "n_recent", "nth", "e.timestamp", "e.component", "e.message")


@query("job_logs_bound")
def job_logs_bound(spark, sf_dir):
    """FLT12: log lines of one job, the one with most lines, by SQL with bound parameters."""
    _, logs = _tables(spark, sf_dir)
    job = logs.groupBy("job_id").count().orderBy(F.desc("count"), "job_id").first().job_id
    return J.job_logs_sql(logs, job, 100)
