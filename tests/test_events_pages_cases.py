"""Appended events take effect; pages that report errors beside their data; runner names of any version."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import constants as K
from ledgerline.operators import events as EV
from ledgerline.operators import flatten
from ledgerline.operators import jobs as J
from ledgerline.operators import stores as S
from ledgerline.sources import pages as PG

JOB_DDL = ("job_id string, store_url string, dataset_name string, job_type string, status string, "
           "started_at timestamp, completed_at timestamp, error_message string, records_processed bigint, "
           "duration_seconds bigint, created_by string, event_seq bigint")
LOG_DDL = "log_id string, job_id string, timestamp timestamp, message string"
DAY = dt.datetime(2024, 1, 30, 10)


def as_of():
    return F.to_timestamp(F.lit("2024-01-31 00:00:00"))


def _jobs(spark, *rows):
    return spark.createDataFrame([(j, st, "d", jt, s, DAY, None, None, None, None, "system", seq)
                                  for j, st, jt, s, seq in rows], JOB_DDL)


def _status(jobs, events):
    return {r.job_id: r.last.status for r in J.job_state(jobs.unionByName(events)).collect()}


def test_status_event_wins_the_tie_on_started_at(spark):
    jobs = _jobs(spark, ("a", "s", "historical_load", "pending", 3), ("a", "s", K.STATUS_UPDATE, "running", 9),
                 ("b", "s", "historical_load", "failed", 4))
    done = EV.complete_running(jobs, as_of())
    assert [(r.job_id, r.event_seq) for r in done.collect()] == [("a", 10)]
    assert _status(jobs, done) == {"a": "completed", "b": "failed"}


def test_terminal_request_of_a_batch_comes_last(spark):
    jobs = _jobs(spark, ("a", "s", "historical_load", "pending", 3))
    req = spark.createDataFrame([("a", "completed", None, None), ("a", "running", None, None)],
                                "job_id string, status string, error_message string, records_processed bigint")
    events = EV.status_events(jobs, req, as_of())
    assert sorted(r.event_seq for r in events.collect()) == [4, 5]
    assert _status(jobs, events) == {"a": "completed"}


def test_two_requests_of_one_store_make_one_event(spark):
    req = spark.createDataFrame([("s", "d2", "x"), ("s", "d1", None), ("s", "d1", "y")],
                                "store_url string, dataset_name string, created_by string")
    out = EV.guarded_create(req, _jobs(spark).limit(0), as_of()).collect()
    assert [(r.store_url, r.dataset_name) for r in out] == [("s", "d1")]


@pytest.mark.parametrize("names, found", [
    (["foo-v6", "foo-v12"], "foo-v6"),
    (["foo-v12", "foo", "foo-v2"], "foo"),
    (["foo-v1", "foo-v05", "other"], None),
])
def test_runner_of_any_version(spark, names, found):
    jobs = spark.createDataFrame([("a", "foo" + K.STORE_SUFFIX)], "job_id string, store_url string")
    runner = spark.createDataFrame([(K.JOB_NAME_PREFIX + n, "SUCCEEDED") for n in names], "job_name string, state string")
    got = J.runner_match(jobs, spark.createDataFrame([], LOG_DDL), runner).first()
    assert got.runner_job == (found and K.JOB_NAME_PREFIX + found)


def test_store_whose_name_looks_like_a_version(spark):
    jobs = spark.createDataFrame([("a", "foo-v3" + K.STORE_SUFFIX)], "job_id string, store_url string")
    runner = spark.createDataFrame([(K.JOB_NAME_PREFIX + "foo-v3", "FAILED")], "job_name string, state string")
    assert J.runner_match(jobs, spark.createDataFrame([], LOG_DDL), runner).first().runner_job == K.JOB_NAME_PREFIX + "foo-v3"


def test_product_pages_with_errors_and_null_nodes(spark, tmp_path):
    def product(k):
        return {"node": {"id": f"gid://x/Product/{k}", "title": f"t{k}", "variants": {"edges": [
            {"node": {"id": f"gid://x/ProductVariant/{k}{v}"}} for v in range(2)] + [{"node": None}]}}}
    part = tmp_path / "store_name=s1" / "month=2024-01"
    part.mkdir(parents=True)
    pages = [{"data": {"products": {"edges": [product(1), {"node": None}, product(2)]}}},
             {"data": {"products": {"edges": [product(3)]}}, "errors": [{"message": "Internal error"}]},
             {"data": None, "errors": [{"message": "Internal error"}]}]
    (part / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
    read = PG.read_pages(spark, str(tmp_path), "products")
    flat = flatten.products(PG.nodes(read, "products"))
    assert sorted(r.variant_id for r in flat.collect()) == ["10", "11", "20", "21", "30", "31"]
    assert PG.quarantine(read, "products").count() == 2


def test_inserted_store_keeps_its_metadata(spark):
    kinds = {"backfill_start_date": "date", "is_active": "boolean", "created_at": "timestamp", "updated_at": "timestamp"}
    ddl = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in S.CONFIG_COLUMNS)
    row = lambda m, meta: (m, "t", "p", "d", None, True, None, None, "u", "u", meta)
    target = spark.createDataFrame([row("m1", "old")], ddl)
    merged = S.merge(target, spark.createDataFrame([row("m1", "new"), row("m2", "new"), row("m2", "newer")], ddl), as_of())
    got = {r.merchant: r for r in merged.collect()}
    assert merged.count() == 2 and got["m1"].metadata == "old" and got["m2"].metadata == "new"
    assert got["m1"].created_at is None and got["m1"].created_by == "u"      # a stored null is still a stored store


def test_a_cancel_outranks_a_sweep_of_the_same_moment(spark):
    jobs = _jobs(spark, ("a", "s", "historical_load", "pending", 3))
    sweep = EV.sweep_events(J.stuck_jobs(jobs, as_of(), 1), as_of(), 1)
    cancel = EV.cancel_events(jobs, as_of())
    assert sweep.count() == 1
    assert _status(jobs, sweep.unionByName(cancel)) == _status(jobs, cancel.unionByName(sweep)) == {"a": "cancelled"}


def test_denied_pages_come_without_personal_fields(spark, tmp_path):
    def page(n, name, denied=False):
        out = {"page": n, "errors": [{"message": "This app is " + K.ACCESS_DENIED_TEXT}]} if denied else {
            "page": n, "data": {"customers": {"edges": [{"node": {"id": f"gid://x/Customer/{n}", "email": name} if name else {"id": f"gid://x/Customer/{n}"}}]}}}
        return json.dumps(out)
    for root, lines in (("a", [page(1, "x@e"), page(2, None, denied=True)]), ("b", [page(1, None), page(2, None)])):
        part = tmp_path / root / "store_name=s1" / "month=2024-01"
        part.mkdir(parents=True)
        (part / "p.json").write_text("\n".join(lines))
    got = PG.nodes_with_fallback(PG.read_pages(spark, str(tmp_path / "a"), "customers"), PG.read_pages(spark, str(tmp_path / "b"), "customers_no_pii"),
                                 "customers", "customers_no_pii")
    assert sorted((r.id, r.email) for r in flatten.customers(got).collect()) == [("1", "x@e"), ("2", "")]
