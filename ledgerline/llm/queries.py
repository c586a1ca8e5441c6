"""Registered queries of the subpackage: thin calls of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arc_warc, brown_lm, compression_rules, decontam, langid, merkle, near_dup, packing, recipes, shards, site_lines, toxicity, variants
from .common import table


def token_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(table(spark, sf_dir, "documents"))


def op2_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score_texts(table(spark, sf_dir, "documents"))


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_byte_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(table(spark, sf_dir, "documents"))


def op5_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages, their source as the site."""
    docs = table(spark, sf_dir, "documents").withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("bigint"))
    return site_lines.drop_site_lines(docs, F.col("source")).select(
        "doc_id", "source", "n_lines", "n_dropped_lines", F.octet_length("text").cast("bigint").alias("kept_bytes"),
        F.sha2("text", 256).alias("text_sha256"))


def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_warc.archive_pages(table(spark, sf_dir, "pages")) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules.judge(table(spark, sf_dir, "documents"))


def op9_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.find_components(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op10_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), token_file()).drop("ids")


def op11_frequency_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_merkle_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_line_feeds())


def op13_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.exact_copies(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ppm_language, op2_brown_classes, op3_positional_index, op4_byte_prefix_shards, op5_nnpu_toxicity, op6_site_lines, op7_arc_to_warc,
    op8_compression_bands, op9_bayes_minhash, op10_hilbert_packing, op11_frequency_trie, op12_merkle_rollup, op13_chunk_recipes)}
