"""Streaming queries (ST1-ST3): each runs its stream over everything available
(availableNow) and returns the sink table it produced."""

from __future__ import annotations

from ..streaming import jobs_stream as S
from .registry import query


@query("stream_log_classify")
def stream_log_classify(spark, sf_dir):
    """ST1: live log classification into an exactly-once Parquet sink."""
    return S.stream_log_classify(spark, sf_dir)


@query("stream_job_status")
def stream_job_status(spark, sf_dir):
    """ST2: current job status from events that come in several deliveries, some late or repeated."""
    return S.stream_job_status(spark, sf_dir)


@query("stream_late_events")
def stream_late_events(spark, sf_dir):
    """ST2: events that came after the watermark or again, from the side table."""
    return S.stream_late_events(spark, sf_dir)


@query("stream_incremental_sync")
def stream_incremental_sync(spark, sf_dir):
    """ST3: incremental order sync over several batches into a change log, latest wins per (store, id)."""
    return S.stream_incremental_sync(spark, sf_dir)
