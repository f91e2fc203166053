"""Corpus pipeline: five stages over the documents, each one of the
training-data operators, each working on all that its predecessor kept.

1. quality rules: documents that the adaptive rules reject go;
2. line dedup: chunks of lines that repeat across documents go;
3. near dedup: one document of each SimHash component stays;
4. mixing: documents are drawn to the target weights of their sources;
5. encoding: sampled SentencePiece ids of every text.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adherence.llm import line_dedup, mixing, piece_lattice, quality_rules, simhash
from adherence.session import work_path

#: No SQL: XXH64 fingerprints, bisected weights and sampled pieces.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_lattice.encode(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("simhash_dedup", near_duplicates),
          ("mix_sources", mixed), ("piece_encoding", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result lies in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = work_path(spark, "pipeline", name, unique=True)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
