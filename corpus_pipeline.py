"""Corpus pipeline: quality, exact copies, near copies, source mix, packed sequences.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
documents. A stage's result is written and read again before the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from minutemark.llm import exact_dedup, mixing, packing, quality, simhash
from minutemark.llm.common import cut

#: The packed tokenizer's file, by its name in the installed collection of public tokenizers.
TOKENIZER = "word_bpe_49k.json"

#: SQL has no form for the classifier, the fingerprints' links or the rounding; the tests compare with brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    return quality.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with the same text, the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs, exact_dedup.DigestIndex(spark, f"pipeline_digests_{uuid.uuid4().hex}"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within three bits, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.apply_mix(docs, weights=(1, 2, 3))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048 tokens."""
    from public_tokenizers import path

    return packing.pack_documents(docs, path(TOKENIZER), cap=2048)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
