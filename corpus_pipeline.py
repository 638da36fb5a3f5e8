"""The corpus pipeline: each stage is written as Parquet and read again as the documents of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloft.llm import decontaminate, exact_dedup, langid, mix, simhash
from tallyloft.llm.common import table
from tallyloft.session import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach."""
    return langid.identified(docs, langid.learn(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact_dedup.deduplicate(docs, exact_dedup.DigestIndex(spark))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.deduplicate(docs, words=3, max_bits=3)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which passages of the benchmark are less than one word in twenty."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row per draw, shard by shard."""
    planned = mix.plan(docs)
    return mix.mixed(docs, planned, mix.draws(planned))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontamination", uncontaminated),
    ("mixing", mixture),
]

# The language models and the drawing of blocks have no SQL form; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
