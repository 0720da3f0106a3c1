"""Corpus pipeline: quality rules, SimHash near-duplicates, benchmark
decontamination, redaction of personal data, best-fit packing.

STAGES is the list of (name, function).  Each function takes (spark, docs,
sf_dir) and returns a DataFrame; every result is written as Parquet in the
shared folder and read again as the next stage's docs.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raremine.llm import decontaminate, packing, pii, quality, simhash
from raremine.llm.store import written
from raremine.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules refuse go."""
    return quality.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest id."""
    return simhash.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a benchmark passage go."""
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("PII", personal_data), ("best-fit packing", packed)]

#: The method of nearly every stage is beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage{k + 1}")
    return docs
