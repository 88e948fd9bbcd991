"""From raw documents to packed training sequences: five stages, each on everything that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the next stage's
docs. All but the last return the columns of documents. A null or empty text is rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statuta.llm import line_dedup, mixing, packing, quality, registry, similar
from statuta.llm.shared import Scratch


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    return quality.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that another place has already; those left without any line go."""
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return similar.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placement of every document's tokens in sequences of 4096."""
    return packing.pack(docs, registry.tokenizer_path())


STAGES = [
    ("quality", reject_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Training, shingle graphs and tokenisation have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
