"""Profiles that merge, samples, catalog counts, components side by side, log lines stored whole."""
import datetime as dt
import threading
import time

from pyspark.sql import functions as F

from ledgerline.operators import events as EV
from ledgerline.operators import jobs as J
from ledgerline.operators import quality as Q
from ledgerline.plans import components as CO
from ledgerline.plans import quality_plans
from ledgerline.session import fresh_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_profile_repeats_no_row(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    got = Q.profile(df)
    assert "Expand" not in plan_of(got) and plan_of(got).count("ReadSchema: struct<l_tax:double>") >= 1
    r = {x.column_name: x for x in got.collect()}
    assert r["l_returnflag"].distinct_count == df.select("l_returnflag").distinct().count() and r["l_returnflag"].max_length == 1


def test_sketches_of_partitions_merge(spark, tmp_path):
    rows = spark.range(30000).select((F.col("id") % 7).cast("string").alias("p"), F.col("id"), (F.col("id") % 1000).cast("double").alias("d"),
                                     F.when(F.col("id") % 3 == 0, F.repeat(F.lit("x"), (F.col("id") % 11).cast("int"))).alias("t"),
                                     F.array(F.col("id") % 5).alias("a"), (F.col("id") % 2 == 0).alias("b"))
    path = str(tmp_path / "profile")
    assert Q.refresh_profile(rows.where("p < '3'"), F.col("p"), path) == 3
    assert Q.refresh_profile(rows, F.col("p"), path) == 4  # the three known ones are not profiled again
    assert Q.refresh_profile(rows, F.col("p"), path) == 0
    got = {r.column_name: r for r in Q.merged_profile(spark.read.schema(Q.SKETCH_SCHEMA).parquet(path)).collect()}
    for r in Q.profile(rows).collect():
        g = got[r.column_name]
        assert g.partitions == 7 and g.row_count == 30000 and g.null_count == r.null_count and g.max_length == r.max_length
        assert abs(g.distinct_estimate - r.distinct_count) <= 0.06 * r.distinct_count, r.column_name


def test_samples_are_three_distinct_values(spark):
    df = spark.createDataFrame([(i % 4, None if i < 5 else 2.5, "y" * 300 if i % 2 else None, dt.datetime(2024, 1, 1, i % 2), [i]) for i in range(50)],
                               "i int, d double, s string, t timestamp_ntz, a array<int>")
    got = {r.column_name: r.samples for r in Q.samples(df).collect()}
    assert got == {"i": ["0", "1", "2"], "d": ["2.5000"], "s": ["y" * 200], "t": ["2024-01-01 00:00:00", "2024-01-01 01:00:00"]}
    assert {r.column_name: r.samples for r in Q.samples(df.limit(0)).collect()} == {"i": [], "d": [], "s": [], "t": []}


def test_catalog_counts_read_no_column(spark, sf_small):
    df = quality_plans.catalog_counts(spark, sf_small)
    scans = [x for x in plan_of(df).split("\n") if "FileScan" in x]
    assert len(scans) == 14 and all("ReadSchema: struct<>" in x for x in scans)
    assert Q.catalog_counts(spark, "default").columns == ["table_name", "row_count"]


def test_one_failure_or_cancel_does_not_stop_the_others(spark):
    def boom():
        raise RuntimeError("bad page")
    run = CO.Run(spark, "r")
    run.cancel("late")
    got = {r.component: (r.status, r.records, r.error_message) for r in run.run(
        {"customers": lambda: 3, "orders": boom, "products": lambda: spark.range(4).count(), "late": boom}).collect()}
    assert got["customers"] == ("completed", 3, None) and got["products"] == ("completed", 4, None)
    assert got["orders"] == ("failed", 0, "orders: bad page") and got["late"] == ("cancelled", 0, None)
    assert got["run"] == ("failed", 7, "Failed components: orders. orders: bad page")
    only = CO.Run(spark, "r2")
    only.cancel("a")
    assert only.run({"a": boom, "b": lambda: 1}).where("component = 'run'").first().status == "cancelled"


def test_a_running_component_is_cancelled_by_its_tag(spark):
    run, began = CO.Run(spark, "r"), threading.Event()

    def slow():
        began.set()
        return spark.range(0, 40, 1, 8) \
            .mapInPandas(lambda it: (time.sleep(60) or b for b in it), "id bigint").count()

    def stop():
        began.wait(30)
        time.sleep(3)
        run.cancel("slow")
    threading.Thread(target=stop).start()
    start = time.time()
    got = {r.component: r.status for r in run.results({"slow": slow, "quick": lambda: spark.range(10).count()})}
    assert got == {"slow": "cancelled", "quick": "completed"} and time.time() - start < 45


def test_log_lines_are_stored_whole_and_cut_in_the_view(spark):
    rows = spark.createDataFrame([("j", dt.datetime(2024, 1, 1), "INFO", "m" * 5000, "s", "main")],
                                 "job_id string, timestamp timestamp, log_level string, message string, store_url string, component string")
    logs = EV.log_events(rows)
    assert len(logs.first().message) == 5000 and len(J.job_logs(logs).first().message) == 1000
    assert logs.columns == EV.LOG_COLUMNS


def test_sweep_counts_what_was_written(spark):
    stuck = spark.createDataFrame([("a",), ("b",)], "job_id string")
    written = spark.createDataFrame([("a", "system_cleanup"), ("a", "system_cleanup"), ("b", "system")], "job_id string, created_by string")
    assert tuple(EV.sweep_result(stuck, written).first()) == (1, 2)
