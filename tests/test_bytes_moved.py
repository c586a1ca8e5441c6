"""What the order, declared-table and status-stream queries move: shuffles sized by the tables, one sort a grouping, bounded writers, one pass over events."""
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.nesting import nest_split
from ledgerline.plans import declared as D
from ledgerline.session import configure, fresh_path, setting
from ledgerline.sources import tables
from ledgerline.streaming import changelog as L
from ledgerline.streaming import jobs_stream as ST


@pytest.fixture
def initial(spark):
    before = spark.conf.get(tables.INITIAL, None)
    spark.conf.unset(tables.INITIAL)
    yield
    spark.conf.unset(tables.INITIAL) if before is None else spark.conf.set(tables.INITIAL, before)


def test_shuffles_begin_with_partitions_for_the_largest_table(spark, initial, monkeypatch):
    folder = fresh_path(spark, "sized")
    spark.range(20_000).write.parquet(f"{folder}/orders.parquet")
    spark.range(10).write.parquet(f"{folder}/customer.parquet")
    tables.read(spark, folder, "orders")
    assert spark.conf.get(tables.INITIAL, None) is None  # small: the session's own number is enough
    monkeypatch.setattr(tables, "SHUFFLE_BYTES", 1000)
    tables.read(spark, folder, "orders", spread=False)
    sized = int(spark.conf.get(tables.INITIAL))
    assert sized > int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables.read(spark, folder, "customer")
    assert int(spark.conf.get(tables.INITIAL)) == sized  # a small table doesn't take it back


def test_children_are_sorted_once_for_grouping_and_join(spark):
    configure(spark)
    kids = spark.range(4000).select((F.col("id") % 900).alias("p"), F.col("id"))
    parents = spark.range(1000).withColumnRenamed("id", "q")
    g = nest_split(kids, ["p"], F.struct("id"), F.col("id"), ordered=False)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        joined = parents.join(g, F.col("q") == F.col("p"), "left")
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ObjectHashAggregate" not in plan and plan.count("Sort [") == 2  # one a side of the join
    assert len(rows) == 1000 and sorted(x.id for r in rows for x in r["items"] or []) == list(range(4000))


def test_a_large_bucket_is_written_by_several_tasks(spark):
    n, root = 60_000, fresh_path(spark, "decl")
    df = schemas.reconcile(spark.range(0, n, 1, 8).select(
        F.lit("th.myshopify.com").alias("store_name"), F.lit("7").alias("customer_id"), F.lit("PAID").alias("display_financial_status"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit(dt.date(2022, 3, 4)).alias("processed_at_store_date")), schemas.contract("order_insights"))
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k"):
        path = D.write_version(df, root, "order_insights")
    files = glob.glob(f"{path.removeprefix('file:')}/store_name=*/processed_year=2022/*.parquet")
    assert len(files) > 1 and len({f.rsplit("_", 1)[1] for f in files}) == 1  # one bucket
    assert D.publish(spark, root, "order_insights", path, ["th.myshopify.com"]) == {"th.myshopify.com": "published"}
    assert D.read_declared(spark, "order_insights", ["th.myshopify.com"]).agg(F.count_distinct("name"), F.count("name")).first() == (n, n)


def test_deliveries_are_landed_in_one_pass(spark):
    start = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, start + dt.timedelta(days=i % 20) if i % 50 else None, i % 7, "click", 1.0, "{}") for i in range(300)],
                                   "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    base = fresh_path(spark, "deliveries")
    folders = ST.land_deliveries(events, f"{base}/all")
    want = sorted((r["_at"], r.event_id) for r in ST.event_deliveries(events).collect())
    got = []
    for k, folder in enumerate(folders):
        L.deliver(spark, folder, f"{base}/source/{k}")
        got += [(k, r.event_id) for r in spark.read.schema(events.schema).parquet(f"{base}/source/{k}").collect()]
    assert sorted(got) == want and len(want) > 300
    first = events.where("event_id % 20 = 0 and event_id % 101 <> 5 and ts is not null and event_id % 97 <> 0")
    assert spark.read.schema(events.schema).parquet(ST.land_deliveries(first, f"{base}/first")[1]).count() == 0  # an empty folder
