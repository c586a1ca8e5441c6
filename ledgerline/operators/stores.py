"""Store configuration: listing, config records, mutations, validation.

The store_config table is a small control table (one row per store). Plain
Parquet has no MERGE, so each mutation returns the *new version* of the table
as a DataFrame, to be written to a new
folder (readers never see a half-written table).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as X

CONFIG_COLUMNS = ["merchant", "token", "gcp_project_id", "bigquery_dataset", "backfill_start_date",
                  "is_active", "created_at", "updated_at", "created_by", "updated_by", "metadata"]


# --------------------------------------------------------------------------- SRC5 / V14
def configs(stores: DataFrame, active_only: bool = True) -> DataFrame:
    s = stores.where(F.col("is_active")) if active_only else stores
    return s.orderBy("merchant")


def store_list(stores: DataFrame, active_only: bool = True) -> DataFrame:
    return configs(stores, active_only).select(
        F.col("merchant"), F.col("bigquery_dataset").alias("dataset"),
        F.when(F.coalesce("is_active", F.lit(True)), "Yes").otherwise("No").alias("active"),
        F.coalesce(F.date_format("updated_at", "yyyy-MM-dd HH:mm"), F.lit(K.NEVER)).alias("updated"))


# --------------------------------------------------------------------------- P12 / SRC6 / FLT4
def config_records(stores: DataFrame, active_only: bool = True, target: str | None = None) -> DataFrame:
    """Config record per store as a map<string,string>: upper-case keys, the
    standard table names, then the metadata JSON laid over (its keys win)."""
    s = configs(stores, active_only)
    if target is not None:                                              # FLT4
        s = s.where(F.col("merchant") == target)
    pairs = [("MERCHANT", F.col("merchant")), ("TOKEN", F.col("token")),
             ("GCP_PROJECT_ID", F.col("gcp_project_id")), ("BIGQUERY_DATASET", F.col("bigquery_dataset")),
             ("BACKFILL_START_DATE", F.date_format("backfill_start_date", "yyyy-MM-dd")),
             ("last_updated", F.concat(F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))),
             ("is_active", F.lower(F.col("is_active").cast("string")))]
    pairs += [(k, F.lit(v)) for k, v in K.TABLE_NAMES.items()]
    base = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
    meta = F.coalesce(F.from_json(F.col("metadata"), "map<string,string>"), F.create_map().cast("map<string,string>"))
    # spark.sql.mapKeyDedupPolicy=LAST_WIN (set by session.configure): metadata keys win
    return s.select("merchant", F.map_concat(base, meta).alias("config"))


def require_target(records: DataFrame, target: str) -> DataFrame:
    """FLT4: a single-store run whose store is not configured is an error."""
    if records.where(F.col("merchant") == target).limit(1).count() == 0:
        raise ValueError(f"Target store {target} not found in configuration")
    return records.where(F.col("merchant") == target)


def config_text(records: DataFrame) -> DataFrame:
    """Render a config map as sorted ``key=value`` text; the token is masked (FN21)."""
    def kv(e):
        v = F.when(e["key"] == "TOKEN", X.mask_token(e["value"])).otherwise(F.coalesce(e["value"], F.lit("")))
        return F.concat(e["key"], F.lit("="), v)
    return records.select("merchant", F.array_join(F.transform(F.array_sort(F.map_entries("config")), kv), ";")
                          .alias("config_text"))


# --------------------------------------------------------------------------- SRC6
CONFIG_RECORD_DDL = ("MERCHANT string, TOKEN string, GCP_PROJECT_ID string, BIGQUERY_DATASET string, "
                     "BACKFILL_START_DATE string, is_active boolean, metadata string")


def resolve_configs(spark, inline_json: str | None = None, table_path: str | None = None,
                    file_path: str | None = None, multi_line: bool = False) -> DataFrame:
    """SRC6: config source precedence: inline JSON (one config or a list),
    else the config table, else a JSON file. The choice is made on the driver
    from what is given; the data itself is read by Spark. Files are JSON Lines
    (as SNK7 writes them) unless ``multi_line`` (one pretty-printed array)."""
    if inline_json:
        one = spark.createDataFrame([(inline_json,)], "j string")
        arr = F.when(F.trim("j").startswith("["), F.from_json("j", f"array<struct<{_colon(CONFIG_RECORD_DDL)}>>")) \
            .otherwise(F.array(F.from_json("j", f"struct<{_colon(CONFIG_RECORD_DDL)}>")))
        recs = one.select(F.inline(arr))
        return recs.select(F.col("MERCHANT").alias("merchant"), F.col("TOKEN").alias("token"),
                           F.col("GCP_PROJECT_ID").alias("gcp_project_id"),
                           F.col("BIGQUERY_DATASET").alias("bigquery_dataset"),
                           F.to_date("BACKFILL_START_DATE").alias("backfill_start_date"),
                           F.coalesce("is_active", F.lit(True)).alias("is_active"), "metadata")
    if table_path:
        return spark.read.parquet(table_path)
    if file_path:
        recs = spark.read.schema(CONFIG_RECORD_DDL).option("multiLine", multi_line).json(file_path)
        return recs.select(F.col("MERCHANT").alias("merchant"), F.col("TOKEN").alias("token"),
                           F.col("GCP_PROJECT_ID").alias("gcp_project_id"),
                           F.col("BIGQUERY_DATASET").alias("bigquery_dataset"),
                           F.to_date("BACKFILL_START_DATE").alias("backfill_start_date"),
                           F.coalesce("is_active", F.lit(True)).alias("is_active"), "metadata")
    raise ValueError("no store configuration source given")


def _colon(ddl: str) -> str:
    return ", ".join(f"{p.strip().split(' ')[0]}:{p.strip().split(' ')[1]}" for p in ddl.split(","))


# --------------------------------------------------------------------------- MUT1 / J8 / A12
def insert_absent(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """MUT1: insert configs whose merchant is absent; existing rows stay as they are.
    Of several configs of one merchant in the batch, the smallest (by its columns in order) is inserted."""
    one = incoming.groupBy("merchant").agg(F.min(F.struct(*CONFIG_COLUMNS)).alias("_c")).select("_c.*")
    new = one.join(target.select("merchant"), "merchant", "left_anti")
    return target.select(*CONFIG_COLUMNS).unionByName(new.select(*CONFIG_COLUMNS))


REQUIRED = ["merchant", "token", "gcp_project_id", "bigquery_dataset"]


def migration_summary(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Counts of a config migration: skipped (there already), failed (a
    required field is missing), migrated."""
    t = target.select("merchant").distinct().withColumn("_exists", F.lit(True))
    lacking = reduce(Column.__or__, [F.coalesce(F.trim(c), F.lit("")) == "" for c in REQUIRED])
    o = incoming.join(t, "merchant", "left").select(
        F.when(F.col("_exists"), "skipped").when(lacking, "failed").otherwise("migrated").alias("outcome"))
    return o.groupBy("outcome").agg(F.count(F.lit(1)).alias("stores"))


# --------------------------------------------------------------------------- MUT2 / MUT11
MERGE_COLUMNS = ["token", "gcp_project_id", "bigquery_dataset", "backfill_start_date", "is_active"]


def merge(target: DataFrame, source: DataFrame, as_of: Column, user: str = "system",
          insert: bool = True) -> DataFrame:
    """MUT2 (WHEN MATCHED UPDATE by merchant) and, with insert=True, MUT11
    (replace-or-append). A null source value overwrites: the flags of the two
    sides, not coalesce, pick the value. An inserted store keeps its metadata;
    an updated one keeps the target's. Of several source rows of one merchant,
    the smallest (by its columns in order) is taken."""
    taken = MERGE_COLUMNS + ["metadata"]
    s = (source.groupBy("merchant").agg(F.min(F.struct(*taken)).alias("_c"))
         .select("merchant", *[F.col(f"_c.{c}").alias(f"_s_{c}") for c in taken], F.lit(True).alias("_hit")))
    how = "full_outer" if insert else "left"
    j = target.withColumn("_known", F.lit(True)).join(s, "merchant", how)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    known = F.coalesce(F.col("_known"), F.lit(False))
    out = [F.col("merchant")]
    for c in MERGE_COLUMNS:
        out.append(F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
    out += [F.when(known, F.col("created_at")).otherwise(as_of).alias("created_at"),
            F.when(hit, as_of).otherwise(F.col("updated_at")).alias("updated_at"),
            F.when(known, F.col("created_by")).otherwise(F.lit(user)).alias("created_by"),
            F.when(hit, F.lit(user)).otherwise(F.col("updated_by")).alias("updated_by"),
            F.when(known, F.col("metadata")).otherwise(F.col("_s_metadata")).alias("metadata")]
    return j.select(*out).select(*CONFIG_COLUMNS)


# --------------------------------------------------------------------------- MUT3 / MUT4
def soft_delete(target: DataFrame, merchants: DataFrame, as_of: Column) -> DataFrame:
    """MUT3: is_active=false, updated_at=now for the given merchants."""
    m = merchants.select("merchant").distinct().withColumn("_del", F.lit(True))
    j = target.join(m, "merchant", "left")
    d = F.coalesce(F.col("_del"), F.lit(False))
    return j.select(*[F.when(d, F.lit(False)).otherwise(F.col(c)).alias(c) if c == "is_active"
                      else F.when(d, as_of).otherwise(F.col(c)).alias(c) if c == "updated_at"
                      else F.col(c) for c in CONFIG_COLUMNS])


def update_column(target: DataFrame, column: str, value, merchant: str) -> DataFrame:
    """MUT4: UPDATE one column WHERE merchant = x."""
    return target.withColumn(column, F.when(F.col("merchant") == merchant, F.lit(value)).otherwise(F.col(column)))


# --------------------------------------------------------------------------- FLT13
def recently_modified(records: DataFrame, as_of: Column, seconds: int = 30) -> DataFrame:
    """Keep configs modified within `seconds` of as_of. Text in no known format
    counts as modified now (kept); no timestamp at all is kept too."""
    x = F.replace(F.col("last_updated"), F.lit(" UTC"), F.lit(""))
    ts = F.coalesce(F.try_to_timestamp(x, F.lit("yyyy-MM-dd HH:mm:ss")),
                    F.try_to_timestamp(x, F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    age = X.seconds_between(ts, as_of)
    return records.where(F.col("last_updated").isNull() | ts.isNull() | (age <= seconds))


# --------------------------------------------------------------------------- DQ1
def validate(candidates: DataFrame, existing_datasets: DataFrame) -> DataFrame:
    """DQ1: every violated rule, in order, as an array of messages.

    candidates: merchant_url, token, dataset_name, project_id, memory, accept_terms.
    """
    ex = existing_datasets.select(F.col("bigquery_dataset").alias("_ds")).distinct().withColumn("_exists", F.lit(True))
    c = candidates.join(ex, candidates.dataset_name == ex._ds, "left")
    url = X.normalize_url(F.col("merchant_url"))
    tok, ds, proj = F.col("token"), F.col("dataset_name"), F.col("project_id")
    empty = lambda v: F.coalesce(v, F.lit("")) == ""
    rules = [
        (~F.coalesce(F.col("accept_terms"), F.lit(False)), K.MSG_PERMISSION),
        (empty(url) | empty(tok) | empty(ds), K.MSG_REQUIRED),
        (~X.valid_store_url(url), K.MSG_URL),
        (~F.coalesce(tok.startswith(K.TOKEN_PREFIX), F.lit(False)), K.MSG_TOKEN),
        (~empty(ds) & ~ds.startswith(K.DATASET_PREFIX), K.MSG_DATASET_PREFIX),
        (~empty(ds) & ~ds.rlike("^[a-z0-9_]+$"), K.MSG_DATASET_CHARS),
        (empty(proj), K.MSG_PROJECT),
        (~F.coalesce(F.col("memory").isin(*K.MEMORY_CHOICES), F.lit(False)), K.MSG_MEMORY),
        (F.coalesce(F.col("_exists"), F.lit(False)), K.MSG_EXISTS),
    ]
    errors = F.filter(F.array(*[F.when(cond, F.lit(msg)) for cond, msg in rules]), lambda e: e.isNotNull())
    return c.select("candidate_id", url.alias("merchant"), X.mask_token(tok).alias("token_masked"),
                    errors.alias("errors"))


# --------------------------------------------------------------------------- FN22 / W3
def versioned_job_names(stores: DataFrame, name_col: str = "store_name", order: list[str] = ("created",)) -> DataFrame:
    """Runner job names, unique per base name: base, base-v2, base-v3, ...
    in order of creation (``order`` must be unique within a base name). The
    numbering is a split row number, so one very common base name is
    numbered by many tasks."""
    from .ranking import split_row_number
    named = stores.withColumn("base_name", X.job_name(F.col(name_col)))
    return (split_row_number(named, ["base_name"], list(order), out="version")
            .withColumn("job_name", F.when(F.col("version") == 1, F.col("base_name"))
                        .otherwise(F.concat(F.col("base_name"), F.lit("-v"), F.col("version").cast("string")))))
