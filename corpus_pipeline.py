"""The corpus pipeline: documents in, written token ids out, one operator a stage."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from convlens.llm import decontaminate, mixing, packing, simhash, toxicity
from convlens.session import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to one and a half times on average."""
    return mixing.mix(docs, max_repetition=1.5)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture written as bit-packed token ids; place, size and checksum of each document, read back."""
    path = packing.new_path(spark)
    packing.write_blocks(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packing.read_documents(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

#: A trained classifier, fingerprints and a tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
