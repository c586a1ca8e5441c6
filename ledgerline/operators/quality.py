"""Data quality: log classification, progress stage, column profiles, table
counts and schemas, run summaries (DQ2-DQ6, A6-A8, A10, A13, SRC9-SRC11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import constants as K
from ..functions import exprs as X
from .jobs import top_per_group


# --------------------------------------------------------------------------- DQ2 / DQ6
def classify(lines: DataFrame, text: str = "message") -> DataFrame:
    """DQ2 + DQ6 per line: level, component, progress stage. Stateless, so the
    same function serves batch tables and streams."""
    t = F.col(text)
    return lines.withColumns({"level": X.log_level(t), "component_guess": X.log_component(t),
                              "stage": X.progress_stage(t)})


def job_progress(classified: DataFrame) -> DataFrame:
    """DQ6: per job, the stage of its latest tagged line (one hash aggregation)."""
    tagged = classified.where(F.col("stage").isNotNull())
    return tagged.groupBy("job_id").agg(
        F.max_by("stage", F.struct("timestamp", "log_id")).alias("progress"),
        F.max("timestamp").alias("last_tagged_at"))


# --------------------------------------------------------------------------- DQ3 / A6-A8 / A13 / L4
def _length(f) -> Column:
    return (F.max(F.length(F.col(f"`{f.name}`"))) if isinstance(f.dataType, StringType) else F.lit(None)).cast("bigint")


def profile(df: DataFrame) -> DataFrame:
    """Exact profile, a row per column: nulls, distinct values, longest text.
    Each column is an aggregation of its own that reads this column alone, so
    the table is read once in all and no row is repeated for each column; the
    distinct values of one column meet in one shuffle, combined in the map tasks."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        parts.append(df.select(c).agg(F.count_if(c.isNull()).alias("null_count"), F.count_distinct(c).alias("distinct_count"), _length(f).alias("max_length"))
                     .select(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"), "null_count", "distinct_count", "max_length"))
    return reduce(DataFrame.unionByName, parts)


SKETCH_SIZE = 12  # 2 ** 12 places: a standard error of 1.6 %
SKETCH_SCHEMA = "partition string, column_name string, dtype string, row_count bigint, null_count bigint, max_length bigint, sketch binary"


def _sketched(f) -> Column:
    c = F.col(f"`{f.name}`")
    kept = c if f.dataType.typeName() in ("integer", "long") else F.concat(F.lit("="), c.cast("string"))  # a sketch ignores empty texts
    return F.hll_sketch_agg(kept, F.lit(SKETCH_SIZE))


def partition_profile(df: DataFrame, partition: Column) -> DataFrame:
    """A row per partition and column (SKETCH_SCHEMA) in one pass over the rows:
    counts, longest text, and a sketch of the distinct values."""
    fields = df.schema.fields
    wide = df.groupBy(partition.cast("string").alias("_partition")).agg(
        F.count(F.lit(1)).alias("_rows"), *[x for i, f in enumerate(fields) for x in (
            F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}"), _length(f).alias(f"_l{i}"), _sketched(f).alias(f"_s{i}"))])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"), F.col("_rows").alias("row_count"),
                              F.col(f"_n{i}").alias("null_count"), F.col(f"_l{i}").alias("max_length"), F.col(f"_s{i}").alias("sketch"))
                     for i, f in enumerate(fields)])
    return wide.select(F.col("_partition").alias("partition"), F.inline(rows))


def refresh_profile(df: DataFrame, partition: Column, path: str) -> int:
    """Profile the partitions that the profile table at ``path`` lacks and append
    them; returns how many there were. Rows of known partitions are not
    aggregated again (nor read, where ``partition`` is a partition column)."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        known = spark.read.schema(SKETCH_SCHEMA).parquet(path).select(F.col("partition").alias("_known")).distinct()
        df = df.join(F.broadcast(known), partition.cast("string").eqNullSafe(F.col("_known")), "left_anti")  # a row a partition
    rows = Observation("profile")
    partition_profile(df, partition).observe(rows, F.count(F.lit(1)).alias("n")) \
        .write.mode("append").parquet(path)
    return int(rows.get["n"]) // max(1, len(df.schema.fields))


def merged_profile(profiles: DataFrame) -> DataFrame:
    """The table's profile from its partitions': sums, maxima, and merged sketches."""
    return profiles.groupBy("column_name", "dtype").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.max("max_length").alias("max_length"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))


SAMPLES = 3
SAMPLE_TEXT = 200


def _as_text(c: Column, kind: str) -> Column:
    """A sampled value as text, cut as the report shows it."""
    if kind in ("double", "float"):
        c = c.cast("decimal(38,4)")
    elif kind.startswith("timestamp"):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.left(c.cast("string"), F.lit(SAMPLE_TEXT))


def samples(df: DataFrame) -> DataFrame:
    """L4: up to three sample values of each column, its smallest distinct ones,
    none of them null. Each is a minimum above the one before, so the buffers of
    an aggregation hold one value a column whatever the table holds, and tasks
    merge them; nested columns have none."""
    fields = [f for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    steps: list[list[Column]] = []
    for k in range(SAMPLES):
        above = [F.col(f"`{f.name}`") if not k else F.when(F.col(f"`{f.name}`") > df.agg(steps[-1][i]).scalar(), F.col(f"`{f.name}`")) for i, f in enumerate(fields)]
        steps.append([F.min(c) for c in above])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.array_compact(F.array(*[
        _as_text(F.col(f"_{k}_{i}"), f.dataType.typeName()) for k in range(SAMPLES)])).alias("samples")) for i, f in enumerate(fields)])
    return df.agg(*[c.alias(f"_{k}_{i}") for k, step in enumerate(steps) for i, c in enumerate(step)]).select(F.inline(rows))


# --------------------------------------------------------------------------- SRC9 / SRC10 / SRC11
def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def catalog_counts(spark: SparkSession, database: str) -> DataFrame:
    """SRC9: the tables that the catalog lists in a database, with their row
    counts. A count reads no column: row counts come from the files' footers."""
    names = sorted(t.name for t in spark.catalog.listTables(database))
    if not names:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return table_counts({n: spark.table(f"`{database}`.`{n}`") for n in names})


def expected_tables(spark: SparkSession, counts: DataFrame, expected: list[str] = K.EXPECTED_TABLES) -> DataFrame:
    exp = spark.createDataFrame([(t,) for t in expected], "table_name string")
    return (exp.join(counts, "table_name", "left")
            .select("table_name", "row_count",
                    F.when(F.col("row_count").isNull(), "missing").otherwise("found").alias("status")))


def table_schema(tables: dict[str, DataFrame]) -> DataFrame:
    """SRC11 with a data pass: (table, column, type, non-null count)."""
    parts = []
    for name, df in tables.items():
        cols = df.schema.fields
        wide = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(cols)])
        arr = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                                 F.col(f"c{i}").alias("non_null")) for i, f in enumerate(cols)])
        parts.append(wide.select(F.lit(name).alias("table_name"), F.inline(arr)))
    return reduce(DataFrame.unionByName, parts)


# --------------------------------------------------------------------------- A10 / DQ4 / DQ5
def run_summary(jobs: DataFrame, logs: DataFrame, first_errors: int = 3) -> DataFrame:
    """A10: per run (job): records total, failed components, final status and
    the first three error details (bounded: top-3 per job before collecting)."""
    rec = jobs.groupBy("job_id").agg(F.coalesce(F.sum("records_processed"), F.lit(0).cast("bigint")).alias("total_records"))
    err = logs.where(F.col("log_level") == "ERROR")
    comps = err.groupBy("job_id").agg(F.array_sort(F.collect_set("component")).alias("_c"))   # <= #components
    first = (top_per_group(err, ["job_id"], [F.asc("timestamp"), F.asc("log_id")], first_errors)
             .groupBy("job_id").agg(F.sort_array(F.collect_list(F.struct(
                 "timestamp", "log_id", F.concat(F.initcap("component"), F.lit(": "), F.col("message")).alias("d")))).alias("_e")))
    j = rec.join(comps, "job_id", "left").join(first, "job_id", "left")
    failed = F.coalesce(F.size("_c"), F.lit(0)) > 0
    msg = F.concat(F.lit("Failed components: "), F.array_join("_c", ", "), F.lit(". "),
                   F.array_join(F.transform("_e", lambda e: e["d"]), " | "))
    return j.select("job_id", "total_records",
                    F.coalesce(F.array_join("_c", ", "), F.lit("")).alias("failed_components"),
                    F.when(failed, "failed").otherwise("completed").alias("status"),
                    F.when(failed, msg).alias("error_message"))
