"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage is (name, function of spark, docs and sf_dir). All but the last
return the columns of documents as they came, with fewer rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from canopy.llm._store import Work, opened, release, table
from canopy.llm.decontaminate import keep_uncontaminated
from canopy.llm.exact_dedup import keep_first
from canopy.llm.pack import pack
from canopy.llm.quality import keep_quality
from canopy.llm.simhash import keep_representatives


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above their language's threshold go."""
    return keep_quality(spark, docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest identifier stays."""
    return keep_first(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near fingerprints, the document with the smallest identifier stays."""
    return keep_representatives(spark, docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of any benchmark item go."""
    return keep_uncontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece, with its sequence and its place there."""
    return pack(spark, docs)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", packing),
]

#: The model, the fingerprints and the tokenizer are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, docs = Work(spark, "pipeline"), table(spark, sf_dir, "documents")
    previous = None
    for name, stage in STAGES:
        mark = opened()
        docs = work.save(stage(spark, docs, sf_dir), name)
        release(mark)
        if previous:
            work.drop(previous)
        previous = name
    return docs
