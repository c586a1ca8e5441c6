"""What large products and full loads hold in memory and on disk at once."""
import datetime as dt
import glob
import json
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline import schemas
from ledgerline.fixtures import landing
from ledgerline.operators import flatten
from ledgerline.plans import declared as D
from ledgerline.plans import entities, load, passes
from ledgerline.session import fresh_path, work_dir
from ledgerline.sources import pages as PG

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _local(path):
    return path.removeprefix("file:")


@pytest.fixture
def tables(spark):
    """Orders with and without lines, lines twice and without an order, null keys."""
    folder, day = fresh_path(spark, "tables"), dt.datetime(1997, 3, 4)
    put = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}.parquet")
    put("orders", [(k, k % 4, "O", 10.0 * (k or 0), day + dt.timedelta(days=40 * (k or 0)), "1-URGENT") for k in [*range(60), 7]]
        + [(None, 1, "F", 1.0, day, "5-LOW")],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    put("customer", [(k, f"Customer#{k}", k + 3, 0.0, "S") for k in range(3)],
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    line = lambda k, n: (k, n % 6, 2, n, 3.0 + n, 9.5, 0.1, 0.02, "R" if n % 2 else "A", "F" if n % 3 else "O", day)
    put("lineitem", [line(k % 50, k // 50) for k in range(170)] + [line(5, 1), line(999, 1), line(None, 1)] + [line(11, n) for n in range(300)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    put("part", [(k, f"part {k}", f"Brand#{k}", "LARGE", 1, 900.0 + k) for k in range(5)],
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put("nation", [(k, f"N{k}", 0) for k in range(8)], "n_nationkey int, n_name string, n_regionkey int")
    return folder


def test_a_variants_row_does_not_carry_its_whole_product(spark, tmp_path):
    variants = [{"node": {"id": f"gid://shop/ProductVariant/{i}", "sku": f"S{i}"}} for i in range(40)] + [{"node": None}]
    product = {"id": "gid://shop/Product/7", "title": "T", "tags": ["a", "b"], "variants": {"edges": variants},
               "media": {"nodes": [{"image": {"url": ""}}, {"image": {"url": "u"}}]}}
    page = {"page": 0, "data": {"products": {"edges": [{"node": product}, {"node": {"id": "8", "title": "no variants"}}]}}}
    (tmp_path / "store_name=s" / "month=all").mkdir(parents=True)
    (tmp_path / "store_name=s" / "month=all" / "p.txt").write_text(json.dumps(page))
    flat = flatten.products(PG.nodes(PG.read_pages(spark, str(tmp_path), "products"), "products"))
    rows = flat.collect()
    assert sorted(int(r.variant_id) for r in rows) == list(range(40))
    assert {(r.store_name, r.id, r.title, r.tags, r.variant_image_url, r.variant_inventoryQuantity) for r in rows} == {("s", "7", "T", "a, b", "u", 0)}
    plan = flat._jdf.queryExecution().executedPlan().toString()
    carried = re.findall(r"Generate explode\(.*?\), \[([^\]]*)\], false, \[_v#", plan)
    assert carried and "node#" not in carried[0] and "title#" in carried[0]


def _plain(df):
    return sorted(repr((r.store_name, r.o_orderkey, r.o_orderdate, r.doc_part, r.o_totalprice, sorted(map(repr, r["items"])))) for r in df.collect())


def test_order_items_written_by_slices_are_all_order_items(spark, tables, monkeypatch):
    want = _plain(landing.order_items_plain(spark, tables))
    assert len(want) > 60 and any("Row" in w for w in want)
    for slice_bytes in (1, landing.SLICE_BYTES):  # sixteen slices; one
        monkeypatch.setattr(landing, "SLICE_BYTES", slice_bytes)
        before = set(glob.glob(f"{_local(work_dir(spark))}/order-items-*"))
        assert _plain(landing.order_items_kept(spark, tables)) == want
        new, = set(glob.glob(f"{_local(work_dir(spark))}/order-items-*")) - before
        assert len(glob.glob(f"{new}/slice-*")) == (landing.MOST_SLICES if slice_bytes == 1 else 1)


def test_passes_hold_all_rows_once_and_equal_keys_together(spark, monkeypatch):
    monkeypatch.setattr(passes, "PASS_BYTES", 1)
    df = spark.range(0, 3000, 1, 4).select((F.col("id") % 40).alias("k"), "id").withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    seen, firsts = [], []
    passes.in_passes(df, [F.col("k")], lambda rows, first: (seen.append([(r.k, r.id) for r in rows.collect()]), firsts.append(first)))
    assert len(seen) > 4 and firsts == [True] + [False] * (len(seen) - 1)
    assert sorted(i for part in seen for _, i in part) == list(range(3000))
    assert sum(len({k for k, _ in part}) for part in seen) == 40
    assert spark.conf.get(CLEANUP) == "false" and not glob.glob(f"{_local(work_dir(spark))}/passes-*")
    calls = []
    passes.in_passes(df.where("id < 0"), [F.col("k")], lambda rows, first: calls.append((rows.count(), first)))
    assert calls == [(0, True)]


def test_a_full_refresh_needs_the_disk_for_a_part_of_its_rows_at_a_time(spark, monkeypatch):
    written = []
    monkeypatch.setattr(load, "write_table", lambda df, *a, put=load.write_table, **b: written.append(put(df, *a, **b)) or written[-1])
    df = spark.range(0, 4000, 1, 4).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("store_name"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 900).cast("int")).alias("processed_at_store_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit("x").alias("line_item_sku"), "id")
    monkeypatch.setattr(passes, "PASS_BYTES", 1)
    root = fresh_path(spark, "refresh")
    rows, path = load.load_full_refresh(df, root)
    assert rows == 4000 and len(written) > 4 and sum(written) == 4000 and max(written) < 2000
    back = spark.read.parquet(path)
    assert sorted(r.id for r in back.collect()) == list(range(4000)) and load.current_version(spark, root) == path
    folders = back.select("store_name", "processed_month").distinct().count()
    assert len(glob.glob(f"{_local(path)}/*/*/*.parquet")) == folders  # as from one shuffle: a file a partition


def test_a_declared_version_is_written_in_passes(spark, monkeypatch):
    monkeypatch.setattr(passes, "PASS_BYTES", 1)
    parts = []
    monkeypatch.setattr(D, "in_passes", lambda df, keys, write: passes.in_passes(df, keys, lambda rows, first: (parts.append(first), write(rows, first))))
    n, root, stores = 3000, fresh_path(spark, "decl"), [f"pass{k}.myshopify.com" for k in range(3)]
    df = schemas.reconcile(spark.range(0, n, 1, 4).select(
        F.concat(F.lit("pass"), F.col("id") % 3, F.lit(".myshopify.com")).alias("store_name"), F.col("id").cast("string").alias("name"),
        (F.col("id") % 40).cast("string").alias("customer_id"), F.lit("PAID").alias("display_financial_status"),
        F.when(F.col("id") % 50 != 0, F.date_add(F.lit(dt.date(2019, 1, 1)), (F.col("id") % 1700).cast("int"))).alias("processed_at_store_date")),
        schemas.contract("order_insights"))
    assert D.load_table(df, root, "order_insights") == dict.fromkeys(stores, "published")
    assert len(parts) > 4 and parts == [True] + [False] * (len(parts) - 1)
    back = D.read_declared(spark, "order_insights", stores)
    assert sorted((r.store_name, r.name, r.processed_at_store_date or dt.date.min) for r in back.collect()) \
        == sorted((r.store_name, r.name, r.processed_at_store_date or dt.date.min) for r in df.collect())
    assert D.load_table(df.where("name = '-'"), root, "order_insights", stores[:1]) == {stores[0]: "kept"}
    assert back.count() == n


def test_mixed_order_items_make_their_documents_once(spark, tables):
    found = lambda: set(glob.glob(f"{_local(work_dir(spark))}/order-items-*"))
    before = found()
    got = {tuple(r) for r in E.queries()["mixed_order_items"](spark, tables).collect()}
    assert len(found() - before) == 1  # both schema sets are written from the same rows
    want = entities.order_items_flat(spark, tables).groupBy("store_name", "currency_code", "refund_restock_type").agg(
        F.count(F.lit(1)), F.sum("line_item_quantity"), F.min("processed_at_store_date"), F.max("line_item_price"))
    assert got == {tuple(r) for r in want.collect()} and len(got) > 4
    assert {r[0] for r in got} >= {"store-0.myshopify.com", "store-3.myshopify.com", None}
    assert not [f for f in glob.glob(f"{_local(work_dir(spark))}/mixed-*/*/*/*.parquet") if ".zstd." not in f]
