"""Store configuration queries (SRC5 SRC6 P12 V14 MUT1-MUT4 MUT11 FLT13 DQ1 FN22 W3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stores as S
from ..fixtures import control as C
from ..sources.tables import read
from .registry import query

UPDATE_TARGET = "store-3.myshopify.com"


def _existing(spark, sf_dir):
    """The stored table: configs of nations outside region 4."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cfg = C.store_config(spark, sf_dir)
    return cfg.join(n, cfg.merchant == C.merchant_of(n.n_nationkey)).where(F.col("n_regionkey") != 4) \
        .select(*S.CONFIG_COLUMNS)


def _incoming(spark, sf_dir):
    """Configs arriving from a file (SRC6): every nation, new dataset names,
    no backfill date for every third store (a null that must overwrite)."""
    cfg = C.store_config(spark, sf_dir)
    k = F.regexp_extract("merchant", r"store-([0-9]+)\.", 1).cast("int")
    return cfg.select(
        "merchant", "token", "gcp_project_id",
        F.concat(F.col("bigquery_dataset"), F.lit("_v2")).alias("bigquery_dataset"),
        F.when(k % 3 == 0, F.lit(None).cast("date")).otherwise(F.col("backfill_start_date")).alias("backfill_start_date"),
        (k % 2 == 0).alias("is_active"),
        C.as_of_col().alias("created_at"), C.as_of_col().alias("updated_at"),
        F.lit("migration").alias("created_by"), F.lit("migration").alias("updated_by"),
        F.lit(None).cast("string").alias("metadata"))


@query("store_list")
def store_list(spark, sf_dir):
    """V14 SRC5 FLT3 FN25: active stores ordered by merchant."""
    return S.store_list(C.store_config(spark, sf_dir))


@query("store_config_overlay")
def store_config_overlay(spark, sf_dir):
    """SRC6 P12 FN21: config record per active store with the metadata overlay."""
    return S.config_text(S.config_records(C.store_config(spark, sf_dir)))


@query("store_upsert_absent")
def store_upsert_absent(spark, sf_dir):
    """MUT1 J8 L5 SET2: insert only the stores not yet present."""
    return S.insert_absent(_existing(spark, sf_dir), _incoming(spark, sf_dir)) \
        .select("merchant", "bigquery_dataset", "is_active", "created_by")


@query("store_migration_summary")
def store_migration_summary(spark, sf_dir):
    """Migrated / skipped / failed counts; some incoming configs come without a token."""
    k = F.regexp_extract("merchant", r"store-([0-9]+)\.", 1).cast("int")
    return S.migration_summary(_existing(spark, sf_dir), _incoming(spark, sf_dir).withColumn("token", F.when(k % 7 != 6, F.col("token"))))


@query("store_merge")
def store_merge(spark, sf_dir):
    """MUT2 MUT11: update matched stores (nulls overwrite, metadata stays), append the others with their metadata."""
    incoming = _incoming(spark, sf_dir).withColumn("metadata", F.concat(F.lit("from "), F.col("merchant")))
    return S.merge(_existing(spark, sf_dir), incoming, C.as_of_col(), user="admin") \
        .select("merchant", "token", "gcp_project_id", "bigquery_dataset", "backfill_start_date", "is_active",
                "updated_at", "created_by", "updated_by", "metadata")


@query("store_soft_delete")
def store_soft_delete(spark, sf_dir):
    """MUT3: deactivate the stores of region 1."""
    n = read(spark, sf_dir, "nation").where("n_regionkey = 1").select(C.merchant_of(F.col("n_nationkey")).alias("merchant"))
    return S.soft_delete(C.store_config(spark, sf_dir), n, C.as_of_col()).select("merchant", "is_active", "updated_at")


@query("store_update")
def store_update(spark, sf_dir):
    """MUT4: point update of one store's dataset name."""
    return S.update_column(C.store_config(spark, sf_dir), "bigquery_dataset", "shopify_test_store_3_v2",
                           UPDATE_TARGET).select("merchant", "bigquery_dataset")


@query("store_recently_modified")
def store_recently_modified(spark, sf_dir):
    """FLT13: configs modified in the last 30 s (several text formats)."""
    return S.recently_modified(C.store_config(spark, sf_dir), C.as_of_col()).select("merchant", "last_updated")


def _candidates(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", "url")
    i = F.col("page_id")
    from_pages = p.select(
        F.concat(F.lit("page-"), i.cast("string")).alias("candidate_id"),
        F.col("url").alias("merchant_url"),
        F.when(i % 3 == 0, F.concat(F.lit("tok"), i.cast("string"))).otherwise(F.concat(F.lit("shpat_"), i.cast("string"))).alias("token"),
        F.when(i % 7 == 0, F.lit("")).when(i % 4 == 0, F.lit("Bad-Name")).otherwise(F.concat(F.lit("shopify_p"), i.cast("string"))).alias("dataset_name"),
        F.when(i % 11 == 0, F.lit("")).otherwise(F.lit("demo-project")).alias("project_id"),
        F.element_at(F.array(F.lit("2Gi"), F.lit("4Gi"), F.lit("8Gi"), F.lit("16Gi")), (i % 4 + 1).cast("int")).alias("memory"),
        (i % 5 != 0).alias("accept_terms"))
    n = read(spark, sf_dir, "nation").select("n_nationkey")
    k = F.col("n_nationkey")
    from_nations = n.select(
        F.concat(F.lit("nation-"), k.cast("string")).alias("candidate_id"),
        F.concat(F.lit(" https://"), C.merchant_of(k), F.lit("/admin ")).alias("merchant_url"),
        F.concat(F.lit("shpat_"), F.lpad(k.cast("string"), 30, "x")).alias("token"),
        F.when(k % 2 == 0, F.concat(F.lit("shopify_new_"), k.cast("string")))
        .otherwise(F.concat(F.lit("shopify_store_"), k.cast("string"))).alias("dataset_name"),
        F.lit("demo-project").alias("project_id"), F.lit("2Gi").alias("memory"), F.lit(True).alias("accept_terms"))
    return from_pages.unionByName(from_nations)


@query("config_validation")
def config_validation(spark, sf_dir):
    """DQ1 FN19-FN21: all violated onboarding rules per candidate config."""
    v = S.validate(_candidates(spark, sf_dir), C.store_config(spark, sf_dir))
    return v.select("candidate_id", "merchant", "token_masked",
                    F.array_join("errors", " | ").alias("errors"), (F.size("errors") == 0).alias("valid"))


@query("job_names")
def job_names(spark, sf_dir):
    """FN22 W3: runner job names per customer store, versioned per base name."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    k, seg, nk = F.col("c_custkey"), F.col("c_mktsegment"), (F.col("c_nationkey") % 3).cast("string")
    name = (F.when(k % 4 == 0, F.concat(F.upper(seg), F.lit(".Shop--"), nk, F.lit(".myshopify.com")))
            .when(k % 4 == 1, F.concat(F.lit(" "), F.lower(seg), F.lit("_store_"), nk))
            .when(k % 4 == 2, F.concat(F.lit("shopify-"), seg, F.lit("-"), nk))
            .otherwise(F.concat(F.lit("--"), seg, F.lit(".."), nk, F.lit("--"))))
    s = c.select("c_custkey", name.alias("store_name"), F.col("c_custkey").alias("created"))
    return S.versioned_job_names(s, order=["created", "c_custkey"]) \
        .select("c_custkey", "store_name", "base_name", "version", "job_name")


@query("config_json_roundtrip")
def config_json_roundtrip(spark, sf_dir):
    """SNK7 + SRC6: config records written to a JSON file (the file fallback)
    and read back through the file source."""
    from ..session import fresh_path
    from .load import write_config_json
    recs = C.store_config(spark, sf_dir).select(
        F.col("merchant").alias("MERCHANT"), F.col("token").alias("TOKEN"),
        F.col("gcp_project_id").alias("GCP_PROJECT_ID"), F.col("bigquery_dataset").alias("BIGQUERY_DATASET"),
        F.date_format("backfill_start_date", "yyyy-MM-dd").alias("BACKFILL_START_DATE"),
        F.col("is_active"), F.col("metadata"))
    path = write_config_json(recs, fresh_path(spark, "store_config_json"))
    back = S.resolve_configs(spark, file_path=path)
    return back.select("merchant", "bigquery_dataset", "backfill_start_date", "is_active")


@query("store_target")
def store_target(spark, sf_dir):
    """FLT4: the config record of one store alone; a store that is not configured is an error."""
    return S.config_text(S.require_target(S.config_records(C.store_config(spark, sf_dir)), UPDATE_TARGET))


@query("config_sources")
def config_sources(spark, sf_dir):
    """SRC6: each config source as it is chosen: inline text (before all others), the table, the file."""
    from ..session import fresh_path
    from .load import write_config_json
    cfg = C.store_config(spark, sf_dir)
    table = fresh_path(spark, "store_config")
    cfg.write.parquet(table)
    record = cfg.select(F.col("merchant").alias("MERCHANT"), F.col("token").alias("TOKEN"), F.col("gcp_project_id").alias("GCP_PROJECT_ID"),
                        F.col("bigquery_dataset").alias("BIGQUERY_DATASET"), F.date_format("backfill_start_date", "yyyy-MM-dd").alias("BACKFILL_START_DATE"), "is_active")
    path = write_config_json(record, fresh_path(spark, "store_config_json"))
    inline = record.where(F.col("MERCHANT") == UPDATE_TARGET).select(F.to_json(F.struct("*"))).first()[0]  # one store's record
    chosen = {"inline": S.resolve_configs(spark, inline, table, path), "table": S.resolve_configs(spark, None, table, path),
              "file": S.resolve_configs(spark, None, None, path)}
    cols = ["merchant", "bigquery_dataset", "backfill_start_date", "is_active"]
    parts = [df.select(F.lit(name).alias("source"), *cols) for name, df in chosen.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
