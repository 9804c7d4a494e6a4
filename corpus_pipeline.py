"""Training-corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes ``(spark, docs, sf_dir)``.  All but the last return the columns of
``documents``; the next stage works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from factloom.llm import decontaminate, quality, similar, simhash, substrings, tokens
from factloom.llm.shared import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at the threshold or above."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, COLUMNS).where(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, linked by SimHash
    as in op1 or by a five-word Jaccard similarity of 0.8 or more.  Rows that share an id
    are one document; rows without an id stay."""
    groups = simhash.near_duplicates(docs, more=similar.similar_links(docs))
    copies = groups.where("component_id < doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(copies, "doc_id", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages; a text without any is unchanged."""
    done = substrings.drop_repeats(docs, COLUMNS)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    size = F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    return done.select("doc_id", text.alias("text"), "lang", "source", size.alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=COLUMNS)
    return found.where("n_hit = 0").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of what they decode to."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = tokens.decode_documents(tokens.encode_documents(docs, *vocabulary), *vocabulary)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level bpe", tokenize),
]

# Fitting, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
