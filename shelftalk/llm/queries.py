"""One query for each corpus operator, over the whole table of documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftalk.llm import bpe, centroids, classifier, embeddings, fingerprints, licenses, packing
from shelftalk.llm import phrases, quality, resampling, sharding, simhash, suffixes
from shelftalk.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_fingerprints(spark, d):
    return fingerprints.edited_fingerprints(documents(spark, d))


@query
def op2_licenses(spark, d):
    return licenses.scan_licenses(documents(spark, d))


@query
def op3_simhash(spark, d):
    return simhash.near_duplicates(documents(spark, d))


@query
def op4_packing(spark, d):
    return packing.pack_documents(documents(spark, d), WORD_TOKENIZER, size=2048, end_id=0)


@query
def op5_phrases(spark, d):
    return phrases.repeated_words(documents(spark, d))


@query
def op6_byte_bpe(spark, d):
    return bpe.round_trip(documents(spark, d), BYTE_RANKS, public_tokenizers.PATTERN)


@query
def op7_quality_rules(spark, d):
    measured = quality.measure(documents(spark, d).select("doc_id", "text"))
    fields = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "n_failed_lines", "lost",
    )
    return measured.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[f"quality.{c}" for c in fields]
    )


@query
def op8_sharding(spark, d):
    placed = sharding.vector_shards(documents(spark, d), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_suffixes(spark, d):
    return suffixes.repeated_bytes(documents(spark, d))


@query
def op10_classifier(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return classifier.score_documents(documents(spark, d), labels)


@query
def op11_resampling(spark, d):
    target = spark.read.parquet(f"{d}/benchmark.parquet")
    return resampling.resample(documents(spark, d), target)


@query
def op12_centroids(spark, d):
    return centroids.cluster(spark.read.parquet(f"{d}/embeddings.parquet"))


@query
def op13_embeddings(spark, d):
    return embeddings.near_duplicates(spark.read.parquet(f"{d}/embeddings.parquet"))
