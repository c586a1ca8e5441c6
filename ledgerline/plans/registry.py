"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or data Spark derives from them) in
full; parameters such as a job id, store or ``as_of`` instant are the
operator's own feature, not a way to shrink the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
            configure(spark)
            return publish(fn(spark, sf_dir, **options))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def publish(df: DataFrame) -> DataFrame:
    """Published timestamps are UTC wall clock (TIMESTAMP_NTZ), as the loaders
    store them; the session time zone is UTC, so the cast keeps the value."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import TimestampType
    if not any(isinstance(f.dataType, TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # import for registration side effects
    from . import declared_plans, entities, jobviews, quality_plans, stores_plans, stream_plans  # noqa: F401
    return dict(QUERIES)
