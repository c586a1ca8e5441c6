"""Data-quality and catalog queries (DQ2-DQ6, A6-A8, A10, A13, L4, SRC9-SRC11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..fixtures import control as C
from ..sources.tables import TABLES, read, table_path
from .registry import query



@query("log_classify")
def log_classify(spark, sf_dir):
    """DQ2 DQ6 FLT14: level, component and progress stage of every log line."""
    logs = C.pipeline_logs(spark, sf_dir)
    return Q.classify(logs).select("log_id", "level", F.col("component_guess").alias("component"), "stage")


@query("job_progress")
def job_progress(spark, sf_dir):
    """DQ6: progress of every job from its latest tagged line."""
    return Q.job_progress(Q.classify(C.pipeline_logs(spark, sf_dir)))


@query("table_profile")
def table_profile(spark, sf_dir):
    """DQ3 A6 A7 A8 A13: per-column dtype, nulls, distinct values, max length of every table."""
    parts = [Q.profile(read(spark, sf_dir, t, spread=False)).select(F.lit(t).alias("table_name"), "*") for t in TABLES]
    return reduce(DataFrame.unionByName, parts)


@query("profile_incremental")
def profile_incremental(spark, sf_dir):
    """DQ3: a growing table profiled by partition (line items by year of shipping):
    first the years before 1996, then the whole table, of which only the new
    years are aggregated; their sketches merged, and held against exact counts."""
    from ..session import fresh_path
    path, rows = fresh_path(spark, "profile"), read(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    Q.refresh_profile(rows.where(year < 1996), year, path)
    Q.refresh_profile(rows, year, path)
    merged = Q.merged_profile(spark.read.schema(Q.SKETCH_SCHEMA).parquet(path))
    exact = Q.profile(rows).select("column_name", "distinct_count")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.06 * F.col("distinct_count")
    return merged.join(F.broadcast(exact), "column_name").select(  # a row a column
        "column_name", "dtype", "partitions", "row_count", "null_count", "max_length", near.alias("within_6_percent"))


@query("profile_samples")
def profile_samples(spark, sf_dir):
    """L4: three sample values of every column of every table (one text)."""
    parts = [Q.samples(read(spark, sf_dir, t, spread=False)).select(F.lit(t).alias("table_name"), "column_name", F.array_join("samples", " | ").alias("samples"))
             for t in TABLES]
    return reduce(DataFrame.unionByName, parts)


@query("catalog_counts")
def catalog_counts(spark, sf_dir):
    """SRC9 A1: the tables that a catalog database lists, counted from their files' footers."""
    from ..session import work_dir
    database = "tables_" + "".join(c if c.isalnum() else "_" for c in sf_dir.strip("/").lower())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{work_dir(spark)}/{database}.db'")
    for t in TABLES:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t} USING parquet LOCATION '{table_path(sf_dir, t)}'")
    return Q.catalog_counts(spark, database)


@query("table_counts")
def table_counts(spark, sf_dir):
    """SRC9 A1: row count of every table."""
    return Q.table_counts({t: read(spark, sf_dir, t, spread=False) for t in TABLES})


@query("table_expected")
def table_expected(spark, sf_dir):
    """SRC10: expected tables with their count, or a missing mark."""
    return Q.expected_tables(spark, Q.table_counts({t: read(spark, sf_dir, t, spread=False) for t in TABLES}))


@query("table_schema")
def table_schema(spark, sf_dir):
    """SRC11: column names and types of each table, with non-null counts."""
    return Q.table_schema({t: read(spark, sf_dir, t, spread=False) for t in TABLES})


@query("run_summary")
def run_summary(spark, sf_dir):
    """A10 DQ4 DQ5: per run records, failed components, status, first errors."""
    return Q.run_summary(C.pipeline_jobs(spark, sf_dir), C.pipeline_logs(spark, sf_dir))


@query("component_summary")
def component_summary(spark, sf_dir):
    """DQ4 DQ5 A10: four load components at once, each a job of its own: two
    write their tables, one fails on a landing folder that is not there, one was
    cancelled; their results and the run's as rows."""
    from ..session import fresh_path
    from ..sources import pages as PG
    from . import components as CO
    from . import entities as E
    from .load import write_table
    root = fresh_path(spark, "components")
    run = CO.Run(spark, "nightly")
    run.cancel("products")
    return run.run({
        "customers": lambda: write_table(E.customers_flat(spark, sf_dir), f"{root}/customer_insights"),
        "orders": lambda: write_table(PG.nodes(CO.landed_pages(spark, f"{root}/landing/orders", "orders"), "orders"), f"{root}/order_insights"),
        "order_items": lambda: write_table(E.order_items_flat(spark, sf_dir), f"{root}/order_items_insights"),
        "products": lambda: write_table(E.products_flat(spark, sf_dir), f"{root}/products_insights")})
