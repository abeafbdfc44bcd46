"""Sentence counts and sentence-length statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions import text as tx


def sentence_stats(content: DataFrame, drop_wordless: bool = False) -> DataFrame:
    """Mean, sample variance and their ratio of words per sentence.

    One row per ``(to_id, date)``. A text that ends in a full stop and a space
    has a last sentence without words, which counts unless ``drop_wordless``.
    Computed from whole-number sums, so the order of rows cannot change a digit.
    """
    cleaned = content.select("to_id", "date", tx.punctuated(F.col("text")).alias("text")).where(
        F.col("text") != ""
    )
    lengths = cleaned.select(
        "to_id", "date", F.explode(tx.sentence_word_counts(F.col("text"))).alias("word_count")
    )
    if drop_wordless:
        lengths = lengths.where(F.col("word_count") > 0)
    count = F.col("word_count").cast("long")
    sums = lengths.groupBy("to_id", "date").agg(
        F.count("*").cast("decimal(19,0)").alias("n"),
        F.sum(count).cast("decimal(19,0)").alias("s"),
        F.sum(count * count).cast("decimal(19,0)").alias("q"),
    )
    n, s, one = F.col("n"), F.col("s"), F.lit(1).cast("decimal(1,0)")
    spread = (n * F.col("q") - s * s).cast("double")
    return sums.select(
        "to_id",
        "date",
        (s.cast("double") / n.cast("double")).alias("avg_word_count"),
        F.try_divide(spread, (n * (n - one)).cast("double")).alias("variance"),
        F.try_divide(spread, ((n - one) * s).cast("double")).alias("relative_variance"),
    )


def valid_sentences(content: DataFrame) -> DataFrame:
    """Rows whose text ends like a sentence and holds a letter or digit."""
    return content.where(tx.is_sentence(F.col("text")))


def sentence_count_avg(content: DataFrame) -> DataFrame:
    """Adds ``sentence_count`` and ``avg_sentence_length`` to valid rows."""
    cleaned = content.withColumn("text", tx.punctuated(F.col("text")))
    counted = valid_sentences(cleaned).withColumn("_n", tx.sentence_word_counts(F.col("text")))
    total = F.aggregate("_n", F.lit(0), lambda acc, n: acc + n)
    return counted.select(
        *[c for c in content.columns if c != "text"],
        F.size("_n").alias("sentence_count"),
        (total / F.size("_n")).alias("avg_sentence_length"),
    )
