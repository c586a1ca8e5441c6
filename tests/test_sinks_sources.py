"""Sinks (SNK2, SNK4, SNK5, SNK7), config sources (SRC6), parameterised SQL
(FLT12), substring filter (FLT14), profile samples (L4), component isolation (DQ4)."""
import json
import os

from pyspark.sql import functions as F

from ledgerline.operators import jobs as J
from ledgerline.operators import quality as Q
from ledgerline.operators import stores as S
from ledgerline.plans import load
from ledgerline.session import fresh_path
from ledgerline.fixtures import control as C


def test_chunked_write_bounds_files(spark):
    df = spark.range(12000).select(F.lit("s1").alias("store_name"), F.col("id").cast("string").alias("id"),
                                   F.col("id").alias("variant_id"))
    path = fresh_path(spark, "t-chunk")
    assert load.load_chunked(df, path) == 12000
    counts = [spark.read.parquet(os.path.join(path, "store_name=s1", f)).count()
              for f in os.listdir(os.path.join(path, "store_name=s1")) if f.endswith(".parquet")]
    assert max(counts) <= 5000 and sum(counts) == 12000


def test_append_and_json_config_write(spark, sf_small):
    path = fresh_path(spark, "t-append")
    jobs = C.pipeline_jobs(spark, sf_small)
    n1 = load.append(jobs.limit(10), path)
    n2 = load.append(jobs.limit(5), path)
    assert (n1, n2) == (10, 5) and spark.read.parquet(path).count() == 15
    out = load.write_config_json(S.config_text(S.config_records(C.store_config(spark, sf_small))),
                                 fresh_path(spark, "t-cfg"))
    assert spark.read.json(out).count() == C.store_config(spark, sf_small).where("is_active").count()


def test_config_source_precedence(spark, sf_small):
    inline = json.dumps([{"MERCHANT": "a.myshopify.com", "TOKEN": "shpat_x", "BIGQUERY_DATASET": "shopify_a",
                          "BACKFILL_START_DATE": "2024-01-01"}])
    r = S.resolve_configs(spark, inline_json=inline, table_path="/nonexistent").first()
    assert r.merchant == "a.myshopify.com" and r.is_active is True
    one = S.resolve_configs(spark, inline_json=json.dumps({"MERCHANT": "b", "TOKEN": "t"})).collect()
    assert [x.merchant for x in one] == ["b"]
    path = fresh_path(spark, "t-cfgfile")
    os.makedirs(path)
    with open(os.path.join(path, "cfg.json"), "w") as f:
        json.dump([{"MERCHANT": "c", "TOKEN": "t", "is_active": False}], f, indent=2)
    r = S.resolve_configs(spark, file_path=path, multi_line=True).first()
    assert r.merchant == "c" and r.is_active is False


def test_require_target(spark, sf_small):
    recs = S.config_records(C.store_config(spark, sf_small))
    assert S.require_target(recs, "store-1.myshopify.com").count() == 1
    try:
        S.require_target(recs, "nope.myshopify.com")
        raise AssertionError("expected an error")
    except ValueError as e:
        assert "not found" in str(e)


def test_parameterised_sql_and_contains(spark, sf_small):
    logs = C.pipeline_logs(spark, sf_small)
    job = logs.select("job_id").first()[0]
    a = J.job_logs_sql(logs, job, 5).collect()
    b = J.job_logs(logs, job, 5).drop("job_id").collect()
    assert a == b and len(a) <= 5
    hits = J.logs_containing(logs, "[ERROR]").select("log_level").distinct().collect()
    assert [r[0] for r in hits] == ["ERROR"]


def test_output_contracts(spark, sf_small):
    from ledgerline.operators import events as EV
    from ledgerline.sources import pages as PG
    jobs = C.pipeline_jobs(spark, sf_small)
    as_of = C.as_of_col()
    assert EV.sweep_events(J.stuck_jobs(jobs, as_of, 1), as_of).columns == EV.EVENT_COLUMNS
    assert EV.cancel_events(jobs, as_of).columns == EV.EVENT_COLUMNS
    assert EV.complete_running(jobs, as_of).columns == EV.EVENT_COLUMNS
    logs = C.pipeline_logs(spark, sf_small)
    assert logs.columns == EV.LOG_COLUMNS
    assert EV.log_events(logs.select("job_id", "timestamp", "log_level", "message", "store_url",
                                     "component")).columns == EV.LOG_COLUMNS
    from ledgerline.plans import entities
    flat = entities.orders_flat(spark, sf_small)
    rows, path = load.load_full_refresh(flat, fresh_path(spark, "t-orders"), load.ORDERS_LAYOUT)
    assert rows == flat.count() and "processed_month=" in str(os.listdir(f"{path}/{os.listdir(path)[0]}"))
    env = spark.createDataFrame([(None, [("Throttled",)]), (None, None)],
                                "data struct<orders:struct<edges:array<string>>>, errors array<struct<message:string>>")
    classes = {r[0] for r in PG.triage(env, "orders").select("page_class").collect()}
    assert classes <= set(PG.PAGE_CLASSES) and classes == {"rate_limited", "missing_data"}
