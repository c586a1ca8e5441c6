"""Job events, store config and classification cases (FIXTURES.md section 4)."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import exprs as X
from ledgerline.operators import events as EV
from ledgerline.operators import jobs as J
from ledgerline.operators import stores as S

JOB_DDL = ("job_id string, store_url string, dataset_name string, job_type string, status string, "
           "started_at timestamp, completed_at timestamp, error_message string, records_processed bigint, "
           "duration_seconds bigint, created_by string, event_seq bigint")
T = lambda s: dt.datetime.fromisoformat(s)


def as_of():
    return F.to_timestamp(F.lit("2024-01-31 00:00:00"))


def _jobs(spark, rows):
    full = [(j, st, "shopify_x", jt, s, T(ts), None, None, None, None, "system", seq)
            for j, st, jt, s, ts, seq in rows]
    return spark.createDataFrame(full, JOB_DDL)


def test_tie_on_started_at_broken_by_event_seq(spark):
    jobs = _jobs(spark, [("a", "s1", "historical_load", "pending", "2024-01-30 10:00:00", 1),
                         ("a", "", "status_update", "running", "2024-01-30 12:00:00", 2),
                         ("a", "", "status_update", "completed", "2024-01-30 12:00:00", 3)])
    r = J.job_state(jobs).first()
    assert r.last.status == "completed" and r.first.store_url == "s1"
    # '' in the latest record does not hide the job's store
    assert J.active_guard(jobs).first().store_url == "s1"


def test_stuck_and_active_windows(spark):
    jobs = _jobs(spark, [("p2h", "s", "historical_load", "pending", "2024-01-30 22:00:00", 1),
                         ("p30m", "s", "historical_load", "pending", "2024-01-30 23:30:00", 2),
                         ("r25h", "s", "historical_load", "pending", "2024-01-29 23:00:00", 3),
                         ("r25h", "s", "status_update", "running", "2024-01-30 01:00:00", 4)])
    stuck = {r.job_id for r in J.stuck_jobs(jobs, as_of(), 1).collect()}
    assert stuck == {"p2h"}
    active = {r.job_id: r.running_seconds for r in J.active_jobs(jobs, as_of()).collect()}
    assert set(active) == {"p2h", "p30m"} and active["p30m"] == 1800
    sweep = EV.sweep_events(J.stuck_jobs(jobs, as_of(), 1), as_of(), 1).first()
    assert sweep.status == "failed" and sweep.error_message == "Job timeout - stuck for over 1 hours"


def test_clear_history_removes_whole_jobs(spark):
    jobs = _jobs(spark, [("done", "s", "historical_load", "pending", "2024-01-30 10:00:00", 1),
                         ("done", "s", "status_update", "completed", "2024-01-30 11:00:00", 2),
                         ("open", "s", "historical_load", "pending", "2024-01-30 10:00:00", 3)])
    logs = spark.createDataFrame([("l1", "done"), ("l2", "open")], "log_id string, job_id string")
    j, lg = EV.clear_history(jobs, logs)
    assert {r.job_id for r in j.collect()} == {"open"}
    assert {r.log_id for r in lg.collect()} == {"l2"}


def test_status_event_inherits_and_times(spark):
    jobs = _jobs(spark, [("a", "s1", "historical_load", "pending", "2024-01-30 10:00:00", 1),
                         ("a", "", "status_update", "running", "2024-01-30 23:00:00", 2)])
    r = EV.complete_running(jobs, as_of()).first()
    assert r.store_url == "s1" and r.started_at == T("2024-01-30 23:00:00")
    assert r.completed_at == T("2024-01-31 00:00:00") and r.duration_seconds == 3600
    c = EV.cancel_events(jobs, as_of(), spark.createDataFrame([("a",)], "job_id string")).first()
    assert c.status == "cancelled" and c.completed_at is None and c.error_message == "Cancelled by user"


def test_guarded_create_refuses_busy_store(spark):
    jobs = _jobs(spark, [("a", "busy", "historical_load", "running", "2024-01-30 10:00:00", 1)])
    req = spark.createDataFrame([("busy", "d1", None), ("free", "d2", None)],
                                "store_url string, dataset_name string, created_by string")
    out = EV.guarded_create(req, jobs, as_of()).collect()
    assert [r.store_url for r in out] == ["free"] and out[0].status == "pending"


def test_config_breaking_every_rule(spark):
    cand = spark.createDataFrame([("c1", "http://bad.example.com/x", "tok", "Bad-Name", "", "1Gi", False)],
                                 "candidate_id string, merchant_url string, token string, dataset_name string, "
                                 "project_id string, memory string, accept_terms boolean")
    existing = spark.createDataFrame([("Bad-Name",)], "bigquery_dataset string")
    errs = S.validate(cand, existing).first().errors
    assert len(errs) == 8 and errs[0].startswith("You must confirm")
    assert "Client already exists" in errs and "All fields are required" not in errs


def test_log_classifier_rules(spark):
    df = spark.createDataFrame([("[ERROR] boom",), ("Warning: slow",), ("Fetched order items",), ("plain",),
                                ("[FETCHING] Customers page 1",)], "m string")
    got = df.select(X.log_level("m"), X.log_component("m"), X.progress_stage("m")).collect()
    assert [tuple(r) for r in got] == [("ERROR", "main", None), ("WARNING", "main", None),
                                       ("INFO", "order_items", None), ("INFO", "main", None),
                                       ("INFO", "customers", 50)]


def test_job_name_sanitiser(spark):
    df = spark.createDataFrame([("My.Store--Name.myshopify.com",), ("shopify-ok",), ("--A__b--",)], "s string")
    assert [r[0] for r in df.select(X.job_name("s")).collect()] == [
        "shopify-my-store-name", "shopify-ok", "shopify-a-b"]


def test_token_mask(spark):
    df = spark.createDataFrame([("abcde",), ("shpat_123456",), ("shpat_" + "x" * 34,)], "t string")
    got = [r[0] for r in df.select(X.mask_token("t")).collect()]
    assert got[0] == "********" and got[1] == "********"          # short tokens never shown
    assert got[2] == "shpat_xxxx" + "*" * 25 + "xxxxx"


def test_runner_state_labels(spark):
    df = spark.createDataFrame([("SUCCEEDED",), ("2",), ("9",), ("WEIRD",)], "s string")
    assert [r[0] for r in df.select(X.runner_state_label("s")).collect()] == ["Completed", "Running", "Unknown", "WEIRD"]


def test_store_mutations(spark):
    cols = ", ".join(f"{c} string" if c not in ("backfill_start_date", "is_active", "created_at", "updated_at") else
                     {"backfill_start_date": "backfill_start_date date", "is_active": "is_active boolean",
                      "created_at": "created_at timestamp", "updated_at": "updated_at timestamp"}[c]
                     for c in S.CONFIG_COLUMNS)
    t0 = T("2024-01-01 00:00:00")
    target = spark.createDataFrame([("m1", "t", "p", "d1", dt.date(2024, 1, 1), True, t0, t0, "u", "u", None)], cols)
    src = spark.createDataFrame([("m1", "t2", "p", "d1b", None, False, t0, t0, "x", "x", None),
                                 ("m2", "t3", "p", "d2", dt.date(2024, 2, 1), True, t0, t0, "x", "x", None)], cols)
    once = S.insert_absent(target, src)
    twice = S.insert_absent(once, src)
    assert sorted(r.merchant for r in twice.collect()) == ["m1", "m2"]            # MUT1 twice == once
    assert {r.merchant: r.bigquery_dataset for r in once.collect()}["m1"] == "d1"  # existing untouched
    merged = {r.merchant: r for r in S.merge(target, src, as_of(), "admin").collect()}
    assert merged["m1"].backfill_start_date is None and merged["m1"].is_active is False   # null overwrites
    assert merged["m1"].created_by == "u" and merged["m2"].created_by == "admin"
    soft = S.soft_delete(target, spark.createDataFrame([("m1",)], "merchant string"), as_of()).first()
    assert soft.is_active is False and soft.updated_at == T("2024-01-31 00:00:00")


def test_config_overlay_metadata_wins(spark):
    df = spark.createDataFrame([("m1", "shpat_" + "a" * 30, "p", "d", dt.date(2024, 1, 1), True,
                                 T("2024-01-02 00:00:00"), '{"BIGQUERY_DATASET": "override", "X": "1"}')],
                               "merchant string, token string, gcp_project_id string, bigquery_dataset string, "
                               "backfill_start_date date, is_active boolean, updated_at timestamp, metadata string")
    cfg = S.config_records(df).first().config
    assert cfg["BIGQUERY_DATASET"] == "override" and cfg["X"] == "1" and cfg["MERCHANT"] == "m1"
    assert cfg["BIGQUERY_TABLE_ORDER_INSIGHTS"] == "order_insights"


def test_log_events_keep_text_and_stable_ids(spark):
    req = spark.createDataFrame([("j1", T("2024-01-30 10:00:00"), "ERROR", "x" * 1500, "s", "main")],
                                "job_id string, timestamp timestamp, log_level string, message string, "
                                "store_url string, component string")
    a, b = EV.log_events(req).first(), EV.log_events(req).first()
    assert len(a.message) == 1500 and a.log_id == b.log_id and a.is_error is None
