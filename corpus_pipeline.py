"""The corpus pipeline: documents in, packed training windows out.

Every stage takes (spark, docs, sf_dir); docs is all that the stage before it kept, reread from Parquet. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuegrid.llm import copies, packing, quality, recompress, rules
from venuegrid.llm.common import scratch_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that nearest-neighbour votes do not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return quality.keep_good(docs, labels, threshold=0.3)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and resemble their language."""
    return rules.keep_sound(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: 5-word shingles, Jaccard similarity of 0.8 or more."""
    return copies.keep_one(docs, shingle=5, radius=8, alike=0.8)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word windows that an earlier document has."""
    return recompress.remove_repeats(docs, window=50)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens, with their token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=2, length=4096, ids=True, fold=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]
#: SQL expresses neither nearest neighbours in a learned space nor a tokenizer's ids; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{scratch_dir(spark)}/stage{k}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
