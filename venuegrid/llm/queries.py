"""The registered corpus queries and the SQL to hold them against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuegrid.llm import jaccard, licences, oracles, packing, pieces, quality, recompress, resample, rules, sharding, simhash, topk, trie, urls
from venuegrid.llm.common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash over 4-word shingles, links at 4 or fewer differing bits, components by smallest doc_id."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of each document once repeated windows of 50 words go from all but their first document."""
    return recompress.repeats(table(spark, sf_dir, "documents"), window=50)


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2, length=4096, fold=True).drop("ids")


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes, equal texts together."""
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and distances from the language references for all documents."""
    found = rules.judge(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("char_distance", "common_distance")})


ORACLE["op9_quality_rules"] = oracles.quality_rules()


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learned from labels that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.classify(table(spark, sf_dir, "documents"), labels, threshold=0.3)


URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by rule, else by character language models."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products for every embedding whose vec_id is divisible by 20."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


ORACLE["op1_topk"] = oracles.TOPK


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digest, whole-text licence and licence notices of every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


ORACLE["op10_licenses"] = oracles.licence_scan()


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text and whether they decode to it."""
    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of 3-word shingle sets and components of links at a Jaccard similarity of 0.9 or more."""
    return jaccard.join(table(spark, sf_dir, "documents"), shingle=3, num=90, den=100)


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), every=20, most=4)


@query
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark, and the ranks of the five in a hundred drawn."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), buckets=10_000, least_words=20, share=(5, 100), seed=42)
