"""Unreadable pages keep their text, replay settles the quarantine once, ranges and store starts prune, windows follow the start date."""
import datetime as dt
import json

from dateutil.relativedelta import relativedelta
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import exprs as X
from ledgerline.plans import entities as E
from ledgerline.sources import pages as PG


def page(n, names, errors=None, data=True):
    out = {"page": n}
    if data:
        out["data"] = {"orders": {"edges": [{"node": None if x is None else {"name": x, "processedAt": "2024-01-05T00:00:00Z"}} for x in names]}}
    if errors:
        out["errors"] = [{"message": errors}]
    return json.dumps(out)


def landed(spark, root, store, month, lines, name="p.txt"):
    folder = root / f"store_name={store}" / f"month={month}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines))
    return PG.read_pages(spark, str(root), "orders")


def names(df):
    return sorted(r[0] for r in df.select("name").collect())


def test_unreadable_pages_keep_their_text(spark, tmp_path):
    cut = page(3, ["c", "d"])[:-9]
    pages = landed(spark, tmp_path / "a", "s", "2024-01", [page(1, ["a", None]), page(2, ["b"], "Internal error"), cut, "not json at all", page(4, [], "Throttled", data=False), page(5, [], data=False)])
    assert names(PG.nodes(pages, "orders")) == ["a", "b"]  # nothing of a page that ends too early
    q = PG.write_quarantine(pages, "orders", str(tmp_path / "q"))
    got = {(r.page_class, r.page): r for r in q.collect()}
    assert set(got) == {("error", 2), ("malformed", 3), ("malformed", None), ("rate_limited", 4), ("missing_data", 5)}
    assert got["malformed", 3].page_text == cut and got["malformed", None].page_text == "not json at all"
    assert all(r.page_file.endswith("p.txt") for r in got.values()) and [k for k, r in got.items() if r.loaded] == [("error", 2)]
    assert json.loads(got["error", 2].page_text)["errors"][0]["message"] == "Internal error"


def test_replay_settles_each_page_once(spark, tmp_path):
    pages = landed(spark, tmp_path / "a", "s", "2024-01", [page(1, ["a"]), page(2, ["b"], "Internal error"), page(3, ["c"])[:-5], page(4, [], "Throttled", data=False), page(6, [], data=False)])
    PG.write_quarantine(pages, "orders", str(tmp_path / "q"))
    q = PG.write_quarantine(pages, "orders", str(tmp_path / "q"))  # a run repeated after a failure writes its pages again
    again = landed(spark, tmp_path / "b", "s", "2024-01", [page(1, ["a"]), page(2, ["b"]), page(3, ["c"]), page(4, [], "Throttled", data=False)])
    again = landed(spark, tmp_path / "b", "s", "2024-01", [page(3, ["c"])], "second.txt")
    load, left = PG.replay(q, again, "orders")
    assert names(PG.nodes(load, "orders")) == ["c"]  # b was loaded beside its error, a was never in quarantine
    assert {(r.page_class, r.page) for r in left.collect()} == {("rate_limited", 4), ("missing_data", 6)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_and_store_starts_prune_the_scan(spark, tmp_path):
    for store in ("s1", "s2"):
        for month in ("2023-11", "2023-12", "2024-01", PG.UNDATED):
            pages = landed(spark, tmp_path / "a", store, month, [page(1, [f"{store}-{month}"])])
    one = PG.nodes(PG.in_months(pages, "2023-12-10", "2024-01-03"), "orders")
    assert names(one) == ["s1-2023-12", "s1-2024-01", "s2-2023-12", "s2-2024-01"] and "month#" in plan_of(one).split("PartitionFilters:")[1].split("]")[0]
    starts = spark.createDataFrame([("s1", dt.date(2023, 12, 15)), ("s3", dt.date(2020, 1, 1)), ("s2", dt.date(2030, 1, 1))], "store_name string, start date")
    starts.write.parquet(str(tmp_path / "starts"))
    rows = PG.nodes(PG.from_store_start(pages, spark.read.parquet(str(tmp_path / "starts")), F.lit(dt.date(2024, 1, 31))), "orders")
    assert names(rows) == ["s1-2023-12", "s1-2024-01"]
    assert "dynamicpruning" in plan_of(rows).split("PartitionFilters:")[1].split("]")[0].lower()


def test_backfill_queries_prune_at_run_time(spark, sf_small):
    assert "dynamicpruning" in plan_of(E.items_backfill(spark, sf_small)).lower()


@settings(max_examples=40, deadline=None)
@given(st.dates(dt.date(2015, 1, 1), dt.date(2024, 12, 31)), st.integers(-40, 1500))
def test_windows_follow_the_start_date(spark, start, days):
    end = start + dt.timedelta(days)
    want, day = [], start
    while day <= end:
        want.append((day, day + relativedelta(months=1) - dt.timedelta(1)))
        day += relativedelta(months=1)
    got = spark.createDataFrame([(start, end)], "s date, e date").select(F.explode(X.window_starts("s", "e")).alias("d")) \
        .select("d", X.window_end("d").alias("z")).collect()
    assert [tuple(r) for r in got] == want


def test_pages_hold_many_nodes_and_stay_bounded(spark, sf_small):
    sizes = [r[0] for r in E._landed(spark, sf_small, "orders").where("data is not null and _corrupt_record is null").select(F.size("data.orders.edges")).collect()]
    assert max(sizes) > 3 and max(sizes) <= E.PAGE_NODES
    parts = [r[0] for r in E._landed(spark, sf_small, "products", E._product_error).select(F.size("data.products.edges")).collect()]
    assert max(parts) <= E.PAGE_NODES
