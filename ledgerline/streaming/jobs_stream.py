"""Structured Streaming forms of the log classifier (ST1), current job status
(ST2) and incremental entity sync (ST3).

All three read landed files as streams (new files = new data) and checkpoint in
the shared work folder. ST1 is stateless and writes through the Parquet file
sink, whose commit log makes it exactly-once. ST2 and ST3 append to a change log
(:mod:`ledgerline.streaming.changelog`) by batch id: a batch counts once it is
committed, comes again whole after a failure, and nothing is overwritten; the
latest row of a key is resolved when the log is read or compacted.

``run_available_now`` drives a query over everything available and stops,
which is how tests and the registry compare a stream with its batch form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import quality as Q
from ..session import configure, fresh_path, setting
from ..fixtures import control as C
from ..sources.tables import read
from . import changelog as L


# Keyed streaming state (one buffer per job / entity key) can reach millions of
# keys; the RocksDB provider keeps it off the JVM heap with incremental checkpoints.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Counting the rows of the state for the progress report reads each key once more when it is put.
COUNT_STATE = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def _state_store(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != STATE_STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A driver table as a file stream (schema taken from the table, no inference)."""
    _state_store(configure(spark))
    schema = read(spark, sf_dir, name).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(sf_dir)


def run_available_now(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# --------------------------------------------------------------------------- ST1
def classify_stream(events: DataFrame) -> DataFrame:
    """ST1: stateless per-line classification (same expressions as batch DQ2)."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    lines = C.log_lines_from(e).unionByName(C.marker_lines_from(e))
    return Q.classify(lines).select("log_id", "job_id", "timestamp", "level",
                                    F.col("component_guess").alias("component"), "stage")


def stream_log_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "stream-log-classify")
    w = classify_stream(table_stream(spark, sf_dir, "events")).writeStream.format("parquet").option("path", out + "/data")
    run_available_now(w, out + "/_checkpoint")
    return spark.read.parquet(out + "/data")


# --------------------------------------------------------------------------- ST2
STATUS_SCHEMA = "job_id string, status string, status_at timestamp, event_seq bigint"
STATUS_KEYS, STATUS_ORDER = ["job_id"], ["status_at", "event_seq"]
SIDE_SCHEMA = "job_id string, event_seq bigint, status string, status_at timestamp, reason string, times bigint"
DELAY = "2 days"  # how far behind the newest event one may be


def status_rows(events: DataFrame) -> DataFrame:
    """One status row per event."""
    jobs = C.job_events_from(events.withColumn("ts", F.col("ts").cast("timestamp")))
    return jobs.select("job_id", "status", F.col("started_at").alias("status_at"), "event_seq")


def status_stream(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """ST2: the rows as they arrive, and beside them (``accepted``) those that are
    within the watermark and not repeated. Spark's state holds the ids of events
    that are not older than the watermark, so it does not grow with the stream."""
    rows = status_rows(events)
    accepted = rows.withWatermark("status_at", delay).dropDuplicatesWithinWatermark(["job_id", "event_seq"])
    return accepted.withColumn("accepted", F.lit(True)).unionByName(rows.withColumn("accepted", F.lit(False)))


def status_sink(root: str, delay: str = DELAY):
    """Appends the accepted rows (the latest of a job) to the log, and the rest to
    a side table: late ones (at or before the watermark that held for the batch)
    and repeated ones, with how often they came."""

    def watermark(spark: SparkSession, batch_id: int):
        newest = [m["newest_ms"] for b, m in L.committed(spark, root).items() if b < batch_id and m.get("newest_ms") is not None]
        return F.timestamp_millis(F.lit(max(newest))) - F.expr(f"INTERVAL {delay}") if newest else F.lit(None).cast("timestamp")

    def arrivals(spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(f"{STATUS_SCHEMA}, accepted boolean").parquet(f"{root}/arrivals/batch={batch_id:012d}")

    def prepare(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{root}/arrivals/batch={batch_id:012d}")  # the stateful plan runs once
        rows = arrivals(spark, batch_id)
        per = rows.groupBy("job_id", "event_seq").agg(F.max("status").alias("status"), F.max("status_at").alias("status_at"),
                                                      F.count_if(~F.col("accepted")).alias("came"), F.count_if("accepted").alias("taken"))
        late = F.coalesce(F.col("status_at") <= watermark(spark, batch_id), F.lit(False))
        side = per.where("came > taken").select("job_id", "event_seq", "status", "status_at",
                                                F.when(late, "late").otherwise("repeated").alias("reason"), (F.col("came") - F.col("taken")).alias("times"))
        changes = rows.where("accepted").drop("accepted").withColumn("batch", F.lit(batch_id))
        return {"changes": L.latest(changes, STATUS_KEYS, STATUS_ORDER).drop("batch"), "side": side}

    def note(spark: SparkSession, batch_id: int) -> dict:
        newest = arrivals(spark, batch_id).agg(F.max(F.unix_millis("status_at"))).first()[0]
        return {"newest_ms": newest}

    return L.commit_sink(root, prepare, note)


def closed_before(spark: SparkSession, root: str, keep: str = "7 days"):
    """Condition of :func:`changelog.compact`: a job has ended more than ``keep`` before the newest event."""
    newest = max((m["newest_ms"] for m in L.committed(spark, root).values() if m.get("newest_ms") is not None), default=None)
    if newest is None:
        return F.lit(False)
    return F.col("status").isin(*K.TERMINAL_STATUSES) & (F.col("status_at") < F.timestamp_millis(F.lit(newest)) - F.expr(f"INTERVAL {keep}"))


def run_status(spark: SparkSession, source: str, schema, out: str) -> None:
    """One run of ST2 over what has arrived in ``source``."""
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
    run_available_now(status_stream(stream).writeStream.outputMode("append").foreachBatch(status_sink(out)), out + "/_checkpoint")


def job_status(spark: SparkSession, out: str) -> DataFrame:
    return L.current(spark, out, STATUS_SCHEMA, STATUS_KEYS, STATUS_ORDER)


DELIVERIES = 4


def event_deliveries(events: DataFrame) -> DataFrame:
    """Stand-in input: events as they arrive, with the number of their delivery
    (``_at``; one is of eight days); some come two deliveries late, some twice in
    theirs and once more in the next."""
    own = F.least(F.floor((F.dayofyear(F.col("ts").cast("timestamp")) - 1) / 8), F.lit(DELIVERIES - 1))
    e = F.col("event_id")
    at = F.when(e % 101 == 5, F.array(F.least(own + 2, F.lit(DELIVERIES - 1)))).when(
        e % 97 == 0, F.array(own, own, F.least(own + 1, F.lit(DELIVERIES - 1)))).otherwise(F.array(own))
    return events.withColumn("_at", F.explode(at))


def land_deliveries(events: DataFrame, path: str) -> list[str]:
    """Write all deliveries in one pass, a folder each; returns the folders. A delivery
    without events is an empty folder."""
    spark = events.sparkSession
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(DELIVERIES)):
        event_deliveries(events).write.partitionBy("_at").parquet(path)
    folders = [f"{path}/_at={k}" for k in range(DELIVERIES)]
    for folder in folders:
        p, fs = L._fs(spark, folder)
        fs.mkdirs(p)
    return folders


def _delivered_status(spark: SparkSession, sf_dir: str) -> str:
    out = fresh_path(spark, "stream-job-status")
    _state_store(spark)
    events = read(spark, sf_dir, "events")
    for k, folder in enumerate(land_deliveries(events, f"{out}/deliveries")):
        L.deliver(spark, folder, f"{out}/source/{k}")
        with setting(spark, COUNT_STATE, "false"):
            run_status(spark, f"{out}/source", events.schema, out)
        if k % 2:
            L.compact(spark, out, STATUS_SCHEMA, STATUS_KEYS, STATUS_ORDER, closed_before(spark, out))
    return out


def stream_job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2 over several deliveries, each by a run that goes on where the last one
    stopped, compacted after every second one."""
    return job_status(spark, _delivered_status(spark, sf_dir))


def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: the side table of the same runs."""
    return L.appended(spark, _delivered_status(spark, sf_dir), SIDE_SCHEMA, "side") \
        .groupBy("job_id", "event_seq", "reason").agg(F.sum("times").alias("times"))


# --------------------------------------------------------------------------- ST3
SYNC_SCHEMA = "store_name string, order_id bigint, status string, updated_at timestamp"
SYNC_KEYS, SYNC_ORDER = ["store_name", "order_id"], ["updated_at"]


def order_versions(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Stand-in input: order change records. Every order is created 'pending';
    orders that moved on get a second record five days later with their final status."""
    c = customers.select("c_custkey", C.merchant_of(F.col("c_nationkey") % 5).alias("store_name"))
    o = orders.join(c, orders.o_custkey == c.c_custkey)
    ts = F.col("o_orderdate").cast("timestamp")
    v = F.array(F.struct(F.lit("pending").alias("status"), ts.alias("updated_at")),
                F.when(F.col("o_orderstatus") != "O", F.struct(F.col("o_orderstatus").alias("status"),
                                                              (ts + F.expr("INTERVAL 5 DAYS")).alias("updated_at"))))
    return o.select("store_name", F.col("o_orderkey").alias("order_id"), F.explode(v).alias("r")) \
        .where(F.col("r").isNotNull()).select("store_name", "order_id", "r.status", "r.updated_at")


def run_sync(spark: SparkSession, source: str, out: str) -> None:
    """ST3: one run over the change records that have arrived in ``source``."""
    stream = spark.readStream.schema(SYNC_SCHEMA).option("recursiveFileLookup", "true").parquet(source)
    run_available_now(stream.writeStream.outputMode("append").foreachBatch(L.commit_sink(out)), out + "/_checkpoint")


def synced(spark: SparkSession, out: str) -> DataFrame:
    return L.current(spark, out, SYNC_SCHEMA, SYNC_KEYS, SYNC_ORDER)


def stream_incremental_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3 over three deliveries: a third of the orders each, and in the last one
    the first records of all orders once more, older than what is known of them.
    The log is compacted between them; a batch only adds its own rows."""
    out = fresh_path(spark, "stream-sync")
    records = order_versions(read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer"))
    third = F.pmod(F.col("order_id"), F.lit(3))
    for k, rows in enumerate((records.where(third == 0), records.where(third == 1), records.where((third == 2) | (F.col("status") == "pending")))):
        rows.write.parquet(f"{out}/source/{k}")
        run_sync(spark, f"{out}/source", out)
        if k == 1:
            L.compact(spark, out, SYNC_SCHEMA, SYNC_KEYS, SYNC_ORDER)
    return synced(spark, out)
