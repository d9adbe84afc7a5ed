"""A corpus made ready for training: one operator after the other, each stage a written table.

Each stage works on all that the one before kept, and returns the columns of
``documents``; the last returns the packed sequences' pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import line_dedup, packing, shared, simhash, source_mix, toxicity

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    labels = shared.table(spark, sf_dir, "labels")
    return toxicity.without_toxic(docs, labels).select(*DOCUMENT)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; one left empty goes."""
    return line_dedup.without_repeated_lines(docs).select(*DOCUMENT)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.without_near_copies(docs).select(*DOCUMENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole copy."""
    return source_mix.mixed_documents(docs).select(*DOCUMENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their sequence and place there."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", keep_one_of_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack),
]

# A trained network, hashes and tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
