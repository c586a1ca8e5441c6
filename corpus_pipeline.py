"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), calls one operator on everything that
its predecessor kept, and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of
``documents``; columns beyond those pass through. Rows with equal ids are
handled as each operator says; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import decontam, near_dup, packing, site_lines, toxicity
from ledgerline.llm.common import reachable, table
from ledgerline.llm.queries import token_file
from ledgerline.session import configure, materialize

#: Two stages are not expressible in SQL (a trained classifier, a tokenizer); tests/llm holds run() against a plain version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the classifier learns from all labels."""
    models = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *rest).alias("_rest"))
    kept = toxicity.score(rows, models, keep=("text", "_rest")).where(F.col("score") < toxicity.THRESHOLD)
    return kept.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"_rest.`{c}`") for c in docs.columns])


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that their source repeats; n_chars
    follows the text. A column named as the operator's count keeps its values."""
    count, aside = "n_dropped_lines", "_n_dropped_lines"
    while aside in docs.columns:
        aside = "_" + aside
    out = site_lines.drop_site_lines(docs.withColumnRenamed(count, aside), F.col("source"))
    chars = F.when(F.col(count) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", chars).select(*[F.col(f"`{aside if c == count else c}`").alias(c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates
    (five-word shingles, similarity of 0.8 or more). Of rows that share an id,
    the one whose text has the smallest hash stays; rows without an id stay."""
    found = near_dup.find_components(docs, shingle=5, percent=80)
    ids = found.where("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", F.xxhash64("text").alias("_hash"))
    first = Window.partitionBy("doc_id").orderBy("_hash")
    named = rows.where(F.col("doc_id").isNotNull()).join(ids, "doc_id", "left_semi") \
        .withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
    return named.select("_row").union(rows.where(F.col("doc_id").isNull()).select("_row")).select("_row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontam.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids, with the ids."""
    return packing.pack(docs, token_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(reachable(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
