"""The corpus pipeline: quality rules, near-dedup, decontamination, personal data, mixing; each stage works on all that the last one kept.

`run` applies the stages in a row and writes each one's result to the shared folder, as Parquet, before the next reads
it. No stage samples, caps or cuts what it sees. Cases (nulls, empty texts, ties, repeated rows, empty tables, other
columns) are those of the operators, which say so each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodeweave.llm import mixing, pii, quality, simhash, tiling
from lodeweave.llm.common import read_table, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go; lines that too many distinct texts of a source share go from the others."""
    return quality.filtered(docs, share=quality.TEXTS_SHARE, least=quality.TEXTS_DOCS, distinct=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return tiling.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked."""
    return pii.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken, repeated or left out until each source has its share."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: Fingerprints and string tiling are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
