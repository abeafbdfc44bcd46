"""A corpus-cleaning pipeline over ``documents``.

Each stage works on all rows that the stage before it kept, and its result is
written as Parquet and read again. All stages but the last return the columns of
``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from driftline.llm import block_naming, golay, lang_mixture, packing
from driftline.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows; rows that no mixture of the languages explains
    better than evenly spread trigrams go. All rows stay if nothing was learned."""
    model = lang_mixture.train(docs)
    if not model.languages:
        return docs
    return docs.where(lang_mixture.spoken(docs, model))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return block_naming.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays."""
    return golay.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens; see ``packing.pack`` for the columns."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language id", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("packing", pack),
]
#: SQL can express neither the mixture model nor the tokenizer; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
