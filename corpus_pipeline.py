"""The training-data pipeline: each stage keeps rows of documents for the next; the last mixes what is left.

run() writes each stage's rows as Parquet in the shared folder and rereads them as the next stage's documents.

Null texts count as empty. Stages take tables with other columns, whatever their names, and hand them on; an empty table gives an
empty one. Rows may repeat and doc_id may be null or shared: what becomes of them is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smeltery.llm import contamination, exact_dups, language, mixing, near_dups
from smeltery.llm.shared import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, null and empty ones too, go; those with a language stay, however sure the network is of it.
    Repeated rows are judged each for itself."""
    return language.identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, white space aside, the one with the most code points stays, then the smallest doc_id, null
    last; of repeated rows one."""
    return exact_dups.without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id, null last. Rows that share a
    doc_id are documents of their own; documents without words are in no group and stay."""
    return near_dups.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go: at least one word in twenty. Null and empty documents and items hold none."""
    return contamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document; documents without words have none to take. Rows that repeat are mixed each."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language id", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

# Language identification is a trained model and the mix draws slots: tests/llm/test_pipeline.py compares run() with plain versions
# of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
