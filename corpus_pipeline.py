"""The training-data pipeline over documents: each stage is one operator, and its table is the next stage's input.

Stages keep the columns of documents until the last, which returns the encoding of each row that the mix takes.
ORACLE_SQL is None: neither the language model nor the subset-sum mix can be put in SQL; tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallgrass.llm.bpe import encode_decode
from tallgrass.llm.common import written
from tallgrass.llm.exact_dedup import drop_copies
from tallgrass.llm.mixing import mix
from tallgrass.llm.near_dedup import drop_near
from tallgrass.llm.quality import keep_good
from tallgrass.llm.vocabulary import BYTE_BPE, vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct normalised text."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each document of the mix, as digests."""
    return encode_decode(docs, vocabulary_path(BYTE_BPE))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("MinHash near-dedup", near), ("mixing sources to target weights", mixed), ("BPE encoding and decoding", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each table between stages is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i}")
    return docs
