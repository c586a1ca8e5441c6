"""Declared tables show loads, one whole version at a time; older schema sets are read beside the current one."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.plans import declared as D
from ledgerline.plans import load
from ledgerline.session import fresh_path

A, B, C = (f"t{c}.myshopify.com" for c in "abc")


def orders(spark, rows):
    """Order rows (store, name, day, total), all other columns null."""
    df = spark.createDataFrame([(s, n, d, t) for s, n, d, t in rows], "store_name string, name string, processed_at_store_date date, total_price double")
    return schemas.reconcile(df, schemas.contract("order_insights"))


def shown(df):
    return sorted((r.store_name, r.name, r.total_price) for r in df.collect())


def test_a_reader_sees_one_whole_version(spark):
    root, d = fresh_path(spark, "decl"), dt.date
    first = [(A, f"#{i}", d(2020, 1 + i % 12, 3), 1.0) for i in range(40)] + [(B, f"#{i}", d(2020, 2, 3), 1.0) for i in range(5)] + [(A, "#none", None, 1.0)]
    assert D.load_table(orders(spark, first), root, "order_insights") == {A: "published", B: "published"}
    before = D.read_declared(spark, "order_insights", [A, B])
    assert shown(before) == sorted((s, n, t) for s, n, _, t in first)
    second = [(A, f"#{i}", d(2020, 1 + i % 3, 3), 2.0) for i in range(7)]
    assert D.load_table(orders(spark, second), root, "order_insights", [A]) == {A: "published"}
    assert shown(before) == sorted((s, n, t) for s, n, _, t in first)  # a reader that began before goes on with its version
    after = D.read_declared(spark, "order_insights", [A, B])
    assert shown(after) == sorted([(s, n, t) for s, n, _, t in second] + [(s, n, t) for s, n, _, t in first if s == B])
    plan = after.where("store_name = 'ta.myshopify.com' and processed_year = '2020'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processed_year" in plan


def test_empty_loads_keep_the_target_and_old_versions_go(spark):
    root, d = fresh_path(spark, "decl"), dt.date(2021, 5, 6)
    D.load_table(orders(spark, [(B, "#1", d, 1.0), (C, "#2", d, 1.0)]), root, "order_insights")
    assert D.load_table(orders(spark, [(B, "#3", d, 3.0)]), root, "order_insights", [B, C]) == {B: "published", C: "kept"}
    assert shown(D.read_declared(spark, "order_insights", [B, C])) == [(B, "#3", 3.0), (C, "#2", 1.0)]
    for i in range(3):
        D.load_table(orders(spark, [(B, f"#{i}", d, 9.0)]), root, "order_insights", [B])
    assert len(D.expire_versions(spark, root, "order_insights", [B, C], keep=1)) == 2  # of five versions two are in use and one is kept
    assert shown(D.read_declared(spark, "order_insights", [B, C])) == [(B, "#2", 9.0), (C, "#2", 1.0)]
    assert D.expire_versions(spark, root, "order_insights", [B, C], keep=1) == []


def test_tables_are_bucketed_and_sorted(spark):
    root = fresh_path(spark, "decl")
    database = D.declare(spark, root, "tnew.myshopify.com", buckets=4)
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {database}.order_items_insights").collect()}
    assert rows["Num Buckets"] == "4" and "name" in rows["Bucket Columns"] and "line_item_sku" in rows["Bucket Columns"]
    assert spark.table(f"{D.declare(spark, root, 'tnew.myshopify.com', legacy=True)}.customer_insights").schema["tags"].dataType.simpleString() == "string"
    assert spark.table(f"{D.database_of('tnew.myshopify.com')}.order_items_insights").count() == 0


def test_full_refresh_keeps_a_record_of_each_version(spark):
    root = fresh_path(spark, "refresh")
    df = orders(spark, [(A, "#1", dt.date(2020, 1, 3), 1.0)])
    _, one = load.load_full_refresh(df, root, load.ORDERS_LAYOUT)
    _, two = load.load_full_refresh(df, root, load.ORDERS_LAYOUT)
    assert load.current_version(spark, root) == two != one
    assert load.load_full_refresh(df.limit(0), root, load.ORDERS_LAYOUT) == (0, None) and load.current_version(spark, root) == two


def test_produced_tables_equal_the_declared_ones(spark):
    for table, made in load.table_contracts(spark).items():
        declared = schemas.contract(table)
        if "store_name" not in declared.names:
            made = made.fromDDL(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made if f.name != "store_name"))
        assert schemas.drift(made, declared) == [], table


def test_reconcile_and_drift(spark):
    target = schemas.contract("customer_insights")
    old = spark.createDataFrame([("s", "a, b", "7"), ("s", "", "x"), ("s", None, None)], "store_name string, tags string, orders_count string")
    got = schemas.reconcile(old, target)
    assert got.schema.simpleString() == target.simpleString()
    assert [(r.tags, r.orders_count, r.email) for r in got.collect()] == [(["a, b"], 7, None), ([], None, None), ([], None, None)]
    new = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "tags array<string>")
    assert [r.tags for r in schemas.reconcile(new, schemas.contract("customer_insights", legacy=True)).collect()] == ["a, b", "", ""]
    d = {(n, c) for n, c, _, _ in schemas.drift(old.withColumn("more", F.lit(1)).schema, target)}
    assert {("tags", "type"), ("orders_count", "type"), ("email", "missing"), ("more", "extra")} <= d
