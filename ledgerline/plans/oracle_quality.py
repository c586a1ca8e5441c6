"""Oracle SQL (DuckDB) for the data-quality and catalog queries."""

from __future__ import annotations

from ..sources.tables import TABLES
from .oracle_jobs import BASE, COMPONENT, LEVEL

# Column names and Spark type names of the driver's tables (as Spark reads them).
TABLE_COLUMNS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}

ORACLE: dict[str, str] = {}

STAGE = """CASE WHEN contains(message, '[PROCESSING]') THEN 25 WHEN contains(message, '[FETCHING]') THEN 50
     WHEN contains(message, '[SUCCESS]') THEN 75 WHEN contains(message, '[COMPLETED]') THEN 100 END"""

ORACLE["log_classify"] = f"""
WITH {BASE}
SELECT log_id, {LEVEL.replace('msg', 'message')} AS level, {COMPONENT.replace('msg', 'message')} AS component,
       {STAGE} AS stage
FROM logs
"""

ORACLE["job_progress"] = f"""
WITH {BASE},
t AS (SELECT job_id, log_id, "timestamp", {STAGE} AS stage FROM logs),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY job_id ORDER BY "timestamp" DESC, log_id DESC) AS rn
      FROM t WHERE stage IS NOT NULL)
SELECT job_id, stage AS progress, "timestamp" AS last_tagged_at FROM r WHERE rn = 1
"""


def _profile(table: str) -> str:
    parts = []
    for name, typ in TABLE_COLUMNS[table]:
        ml = f"max(length({name}))" if typ == "string" else "CAST(NULL AS INTEGER)"
        parts.append(f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{typ}' AS dtype, "
                     f"COUNT(*) - COUNT({name}) AS null_count, COUNT(DISTINCT {name}) AS distinct_count, "
                     f"{ml} AS max_length FROM {table}")
    return "\nUNION ALL\n".join(parts)


ORACLE["table_profile"] = "\nUNION ALL\n".join(_profile(t) for t in TABLES)

ORACLE["table_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES)

ORACLE["table_expected"] = f"""
WITH counts AS ({ORACLE['table_counts']}),
exp AS (SELECT * FROM (VALUES ('orders'), ('customers'), ('products'), ('order_items')) v(table_name))
SELECT exp.table_name, counts.row_count, CASE WHEN counts.row_count IS NULL THEN 'missing' ELSE 'found' END AS status
FROM exp LEFT JOIN counts ON counts.table_name = exp.table_name
"""

ORACLE["table_schema"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{ty}' AS data_type, COUNT({c}) AS non_null FROM {t}"
    for t, cols in TABLE_COLUMNS.items() for c, ty in cols)

ORACLE["run_summary"] = f"""
WITH {BASE},
rec AS (SELECT job_id, CAST(coalesce(SUM(records_processed), 0) AS BIGINT) AS total_records FROM jobs GROUP BY job_id),
err AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY job_id ORDER BY "timestamp", log_id) AS r
        FROM logs WHERE log_level = 'ERROR'),
comps AS (SELECT job_id, string_agg(DISTINCT component, ', ' ORDER BY component) AS comps FROM err GROUP BY job_id),
firsts AS (SELECT job_id, string_agg(upper(substr(component, 1, 1)) || lower(substr(component, 2)) || ': ' || message,
                                     ' | ' ORDER BY "timestamp", log_id) AS details
           FROM err WHERE r <= 3 GROUP BY job_id)
SELECT rec.job_id, rec.total_records, coalesce(comps.comps, '') AS failed_components,
       CASE WHEN comps.comps IS NOT NULL THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN comps.comps IS NOT NULL THEN 'Failed components: ' || comps.comps || '. ' || firsts.details END
         AS error_message
FROM rec LEFT JOIN comps ON comps.job_id = rec.job_id LEFT JOIN firsts ON firsts.job_id = rec.job_id
"""

ORACLE["profile_incremental"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{ty}' AS dtype, COUNT(DISTINCT year(l_shipdate)) AS partitions, COUNT(*) AS row_count, "
    f"COUNT(*) - COUNT({c}) AS null_count, CAST({f'max(length({c}))' if ty == 'string' else 'NULL'} AS BIGINT) AS max_length, "
    f"true AS within_6_percent FROM lineitem" for c, ty in TABLE_COLUMNS["lineitem"])


def _samples(table: str, column: str, kind: str) -> str:
    text = {"double": f"CAST(CAST({column} AS DECIMAL(38,4)) AS VARCHAR)", "timestamp_ntz": f"strftime({column}, '%Y-%m-%d %H:%M:%S')"}.get(
        kind, f"CAST({column} AS VARCHAR)")
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, coalesce(string_agg(t, ' | ' ORDER BY v), '') AS samples FROM "
            f"(SELECT DISTINCT {column} AS v, left({text}, 200) AS t FROM {table} WHERE {column} IS NOT NULL ORDER BY v LIMIT 3)")


ORACLE["profile_samples"] = "\nUNION ALL\n".join(
    _samples(t, c, ty) for t in TABLES for c, ty in TABLE_COLUMNS[t] if not ty.startswith("array"))

ORACLE["catalog_counts"] = ORACLE["table_counts"]
