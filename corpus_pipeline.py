"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and calls one operator on all that
its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import group_join, packing, pii, quality, substring_dedup
from postlens.llm.common import drop_stored, stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def resized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, if it is there, as the texts are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the quality classifier rejects go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return group_join.keep_firsts(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A passage stays in the first document that holds it."""
    return resized(substring_dedup.drop_repeats(docs, "passage"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind."""
    return resized(pii.mask_pii(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts and their places in sequences of 4,096 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", classify),
    ("near_duplicates", near_duplicates),
    ("repeated_lines", repeated_lines),
    ("personal_data", personal_data),
    ("packing", pack),
]

# Tokens can't be expressed in SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result written and read again."""
    docs, old = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if old is not None:
            drop_stored(old)
        old = docs
    return STAGES[-1][1](spark, docs, sf_dir)
