"""From raw documents to packed sequences, each stage one operator of ``tabloom.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabloom.durable import new_folder, removed, workspace, written
from tabloom.llm import digest_index, divergence_rules, personal_data, simhash
from tabloom.llm.queries import packed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return divergence_rules.passing(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return digest_index.distinct_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the one with the smallest doc_id stays."""
    return simhash.one_per_group(docs, radius=2, shingle=3)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by the name of their kind; n_chars follows the text."""
    return personal_data.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences of at most 1024."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mask_personal_data", mask_personal_data),
    ("pack_sequences", pack_sequences),
]

#: SimHash, checksums and packing have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each over all that the one before it kept.

    What a stage stores for itself goes when its rows are written, and these go when the next stage's are. The last
    stage's own tables, and the rows it has read, stay for the result to be read from: run it in a ``workspace``, and
    they go at its end.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, "pipeline")
        with workspace(spark):
            docs = written(stage(spark, docs, sf_dir), name, folder)
        if before:
            removed(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
