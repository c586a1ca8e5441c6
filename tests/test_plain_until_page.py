"""Nested documents are built late, pages land compressed, rows are numbered without a second move."""
import glob
import os

from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from ledgerline.fixtures import landing
from ledgerline.operators.ranking import split_row_number
from ledgerline.plans import declared as D
from ledgerline.plans import entities
from ledgerline.plans.registry import all_queries
from ledgerline.sources import pages as PG


def _lines(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_order_items_are_nested_after_grouping_and_join(spark, sf_small):
    lines = _lines(landing.order_item_docs(spark, sf_small))
    built = [i for i, x in enumerate(lines) if "gid://shop/LineItem" in x]
    assert built and max(built) < min(i for i, x in enumerate(lines) if " Join " in x or x.startswith("Join"))


def test_landed_pages_are_compressed_and_dealt_by_runs_of_pages(spark, sf_small):
    entities._landed(spark, sf_small, "orders")
    folder = entities._LANDED[(spark.sparkContext.applicationId, sf_small, "orders", "_error_for")].removeprefix("file:")
    files = [f for f in glob.glob(f"{folder}/**/part-*", recursive=True) if os.path.getsize(f)]
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert len(files) == len({os.path.dirname(f) for f in files})  # a month of fewer than 16 pages is one file


def test_numbering_moves_rows_once(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
                                    F.xxhash64("id").alias("o"), F.col("id").alias("v"))
    out = split_row_number(rows, ["k"], ["o"], partitions=6)
    want = rows.withColumn("row_number", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("bigint"))
    assert out.columns == want.columns and out.exceptAll(want).count() == 0 and out.count() == 5000
    assert not any("Exchange" in x and "Broadcast" not in x for x in out._jdf.queryExecution().executedPlan().toString().splitlines())


def test_replay_moves_only_pages_to_load(spark):
    kind = "store_name string, month string, page bigint, data struct<orders: struct<edges: array<struct<node: struct<name: string>>>>>, errors array<struct<message: string>>"
    data = Row(orders=Row(edges=[Row(node=Row(name="#1"))]))
    fetched = spark.createDataFrame([("s", "m", 1, data, None), ("s", "m", 2, data, None), ("s", "m", 2, data, None), ("s", "m", 3, data, None)], kind)
    q = spark.createDataFrame([("s", "m", 1, True), ("s", "m", 2, False), ("s", "m", 2, False), ("s", "m", 9, False)], "store_name string, month string, page bigint, loaded boolean")
    again, left = PG.replay(q, fetched, "orders")
    assert [r.page for r in again.collect()] == [2] and [r.page for r in left.collect()] == [9]
    lines = _lines(again)
    assert next(i for i, x in enumerate(lines) if "Aggregate" in x) < next(i for i, x in enumerate(lines) if "LeftSemi" in x)


def test_one_store_loads_from_orders_made_once(spark, sf_small, monkeypatch):
    seen, load = [], D.load_table
    monkeypatch.setattr(D, "load_table", lambda df, *a, **b: seen.append("\n".join(_lines(df))) or load(df, *a, **b))
    all_queries()["load_one_store"](spark, sf_small)
    assert len(seen) == 2 and not any("Join" in x for x in seen)
