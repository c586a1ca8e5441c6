"""The change log of the keyed streams: failures between write and commit, late and repeated events, bounded state, compaction."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.session import fresh_path
from ledgerline.streaming import changelog as L
from ledgerline.streaming import jobs_stream as S

KEYS, ORDER, SCHEMA = S.SYNC_KEYS, S.SYNC_ORDER, S.SYNC_SCHEMA


def day(n, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hour)


def batch(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(spark, root):
    return {(r.store_name, r.order_id): r.status for r in S.synced(spark, root).collect()}


def test_only_committed_batches_are_read_and_a_batch_counts_once(spark, monkeypatch):
    root = fresh_path(spark, "log")
    sink = L.commit_sink(root)
    sink(batch(spark, ("s", 1, "pending", day(1)), ("s", 1, "paid", day(2)), ("t", 7, "pending", day(1))), 0)
    with monkeypatch.context() as m:
        m.setattr(L, "_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sink(batch(spark, ("s", 1, "half", day(9))), 1)
    assert state(spark, root) == {("s", 1): "paid", ("t", 7): "pending"}  # written, not committed
    again = batch(spark, ("s", 1, "older", day(1)), ("s", 2, "pending", day(3)))
    sink(again, 1)
    sink(batch(spark, ("s", 2, "other", day(9))), 1)  # a batch that is committed is not taken again
    want = {("s", 1): "paid", ("s", 2): "pending", ("t", 7): "pending"}
    assert state(spark, root) == want
    assert L.compact(spark, root, SCHEMA, KEYS, ORDER) == 1 == L.compact(spark, root, SCHEMA, KEYS, ORDER)
    assert state(spark, root) == want
    sink(batch(spark, ("t", 7, "paid", day(1)), ("s", 2, "older", day(2))), 2)  # equal order: the later batch wins
    want["t", 7] = "paid"
    assert state(spark, root) == want
    assert L.drop_compacted(spark, root) == [0] and state(spark, root) == want
    L.compact(spark, root, SCHEMA, KEYS, ORDER)
    assert state(spark, root) == want and state(spark, fresh_path(spark, "no-log")) == {}


def test_compaction_that_fails_changes_nothing(spark, monkeypatch):
    root = fresh_path(spark, "log")
    L.commit_sink(root)(batch(spark, ("s", 1, "pending", day(1))), 0)
    with monkeypatch.context() as m:
        m.setattr(L, "_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            L.compact(spark, root, SCHEMA, KEYS, ORDER)
    L.commit_sink(root)(batch(spark, ("s", 1, "paid", day(2))), 1)
    assert state(spark, root) == {("s", 1): "paid"} and L.compact(spark, root, SCHEMA, KEYS, ORDER) == 1


def test_a_stream_goes_on_after_a_failure_in_the_sink(spark, monkeypatch):
    out = fresh_path(spark, "sync")
    batch(spark, ("s", 1, "pending", day(1)), ("s", 2, "pending", day(1))).write.parquet(f"{out}/source/0")
    S.run_sync(spark, f"{out}/source", out)
    batch(spark, ("s", 1, "paid", day(2)), ("s", 3, "pending", day(2))).write.parquet(f"{out}/source/1")
    with monkeypatch.context() as m:
        m.setattr(L, "_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            S.run_sync(spark, f"{out}/source", out)
    assert state(spark, out) == {("s", 1): "pending", ("s", 2): "pending"}
    S.run_sync(spark, f"{out}/source", out)
    S.run_sync(spark, f"{out}/source", out)  # nothing new
    assert state(spark, out) == {("s", 1): "paid", ("s", 2): "pending", ("s", 3): "pending"}
    assert L.appended(spark, out, SCHEMA).count() == 4


EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def deliver(spark, out, n, rows):
    df = spark.createDataFrame([(i, t, u, kind, 1.0, '{"k": 1}') for i, t, u, kind in rows], EVENTS)
    df.write.parquet(f"{out}/source/{n}")
    S._state_store(spark)
    S.run_status(spark, f"{out}/source", df.schema, out)


def test_late_and_repeated_events_go_to_the_side(spark):
    out = fresh_path(spark, "status")
    deliver(spark, out, 0, [(1, day(0), 5, "signup"), (2, day(0, 3), 5, "click"), (2, day(0, 3), 5, "click"), (3, day(5), 6, "signup")])
    deliver(spark, out, 1, [(4, day(1), 5, "error"), (3, day(5), 6, "signup"), (5, day(4), 6, "purchase"), (6, day(6), 6, "click")])
    got = {r.event_seq: r.status for r in S.job_status(spark, out).collect()}
    assert got == {2: "running", 6: "running"}  # event 4 came four days behind the newest one: late, not taken
    side = {(r.event_seq, r.reason, r.times) for r in L.appended(spark, out, S.SIDE_SCHEMA, "side").collect()}
    assert side == {(2, "repeated", 1), (4, "late", 1), (3, "repeated", 1)}


def test_state_does_not_grow_with_the_stream(spark):
    """Twelve deliveries of two days and 60 events each: the state holds what the watermark spans."""
    out, seen = fresh_path(spark, "status"), []
    S._state_store(spark)
    for k in range(12):
        rows = [(1000 * k + i, day(2 * k, i % 48), i, "click", 1.0, '{"k": 1}') for i in range(60)]
        df = spark.createDataFrame(rows, EVENTS)
        df.write.parquet(f"{out}/source/{k}")
        stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{out}/source")
        q = S.status_stream(stream).writeStream.outputMode("append").foreachBatch(S.status_sink(out)) \
            .option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
        seen.append(max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]))
    assert max(seen[6:]) <= max(seen[:6]) <= 400, seen


def test_closed_jobs_leave_the_base(spark):
    out = fresh_path(spark, "status")
    deliver(spark, out, 0, [(1, day(0), 1, "signup"), (2, day(0, 1), 1, "purchase"), (3, day(0), 2, "signup"), (4, day(20), 3, "error")])
    L.compact(spark, out, S.STATUS_SCHEMA, S.STATUS_KEYS, S.STATUS_ORDER, S.closed_before(spark, out))
    of = lambda archived: {r.event_seq: r.status for r in L.current(spark, out, S.STATUS_SCHEMA, S.STATUS_KEYS, S.STATUS_ORDER, archived).collect()}
    assert of(True) == {2: "completed", 3: "pending", 4: "failed"} and of(False) == {3: "pending", 4: "failed"}
    deliver(spark, out, 1, [(5, day(19), 3, "click"), (6, day(25), 2, "click")])
    L.compact(spark, out, S.STATUS_SCHEMA, S.STATUS_KEYS, S.STATUS_ORDER, S.closed_before(spark, out))
    got = of(True)
    assert got[2] == "completed" and got[6] == "running"
    assert 2 not in of(False)
