"""Corpus pipeline: the stages that turn ``documents`` into packed training sequences.

Each stage is ``(name, function)``; a function takes (spark, docs, sf_dir) and
returns the rows that stay, with the columns of documents (the last one: the
packed pieces).  :func:`run` writes each stage's result as Parquet into the
shared checkpoint folder and reads it back, so a lost executor costs a stage
at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm import decontam, packing, pii, simhash, toxicity
from daypulse.llm.common import table
from daypulse.llm.tokenizers_path import vocabulary
from daypulse.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under 0.5; null and empty texts count as their score says."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one whose doc_id names it."""
    return simhash.keep_one(docs, shingle=3, max_bits=2).select(*COLUMNS)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark text."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), every=True).select(*COLUMNS)


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each span of personal data replaced by its kind; n_chars follows."""
    return pii.mask(docs, pii.train(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the packed sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaked),
    ("pii", mask_personal),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after the other."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
