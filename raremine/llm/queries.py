"""One query per operator over the driver tables, with production parameters,
and its DuckDB twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raremine.llm import decontaminate, extraction, oracle, packing, passages, phrases, pii, quality, sharding, simhash, spelling, suffix_dedup, token_counts, warc
from raremine.sources.tables import read_table

SHARDS = 40


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_classes(read_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[pii.count_of("base", k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(pii.span_names("base").cast("binary"), 256).alias("base_sha256"),
                        pii.span_names("spans").alias("spans"))


def op7_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_text(read_table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicate_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read_table(spark, sf_dir, "documents"),
                                             read_table(spark, sf_dir, "benchmark"))
    items = F.coalesce(F.array_sort("items"), F.array().cast("array<string>"))
    n_hit = decontaminate.words_covered(F.col("spans"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_forms(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_suffix_dedup, op3_warc, op4_quality, op5_passages, op6_pii, op7_extraction, op8_simhash, op9_decontamination, op10_packing, op11_token_counts, op12_phrases, op13_spelling)}
SQL = dict(oracle.SQL)
