"""Load components of one run side by side (DQ4, DQ5, A10).

Each component is a function that runs Spark jobs and returns the number of
rows that it loaded (counted by an observation of its own write). Components
run in threads, each under a job tag of its own and in a scheduler pool of its
own, so that with ``spark.scheduler.mode=FAIR`` none waits for another's tasks.
One that fails does not stop the others; one can be cancelled by its tag.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..sources import pages
from .load import ComponentResult, run_status

SCHEMA = "run string, component string, status string, records bigint, error_message string"


class Run:
    """One run of components; :meth:`cancel` may come from any thread, before or while a component runs."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self._id = uuid.uuid4().hex[:12]
        self._cancelled: set[str] = set()
        self._lock = threading.Lock()

    def _tag(self, component: str) -> str:
        return f"{self._id}-{component}"

    def cancel(self, component: str) -> None:
        """No job of the component starts any more, and those that run are stopped."""
        with self._lock:
            self._cancelled.add(component)
        self.spark.sparkContext.cancelJobsWithTag(self._tag(component))

    def _one(self, component: str, load: Callable[[], int | None]) -> ComponentResult:
        sc = self.spark.sparkContext
        if component in self._cancelled:
            return ComponentResult(component, "cancelled", 0, None)
        sc.addJobTag(self._tag(component))
        sc.setLocalProperty("spark.scheduler.pool", component)
        try:
            records = int(load() or 0)
        except Exception as e:  # noqa: BLE001 - a component's failure is its result
            if component in self._cancelled:
                return ComponentResult(component, "cancelled", 0, None)
            return ComponentResult(component, "failed", 0, f"{component}: {e}"[:1000])
        finally:
            sc.removeJobTag(self._tag(component))
            sc.setLocalProperty("spark.scheduler.pool", None)
        return ComponentResult(component, "completed", records, None)

    def results(self, components: dict[str, Callable[[], int | None]], at_once: int = 4) -> list[ComponentResult]:
        """Results in the components' order."""
        one = inheritable_thread_target(self.spark)(self._one)
        with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
            return list(pool.map(lambda kv: one(*kv), components.items()))

    def run(self, components: dict[str, Callable[[], int | None]], at_once: int = 4) -> DataFrame:
        """A row per component and one of the whole run (SCHEMA)."""
        results = self.results(components, at_once)
        status, message, total = run_status(results)
        rows = [(self.name, r.component, r.status, r.records, r.error) for r in results]
        return self.spark.createDataFrame([*rows, (self.name, "run", status, total, message)], SCHEMA)


def landed_pages(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Pages of a landing folder; it is an error if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(f"no landed pages of {entity}")
    return pages.read_pages(spark, path, entity)
