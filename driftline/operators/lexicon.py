"""Word lists, hits and misses per revision, word counts and uncommonness.

Counts are additive over the text pieces of a revision (pieces are joined with
a space, so no word spans two), hence words are counted where the piece is read
and only (revision, number) pairs are shuffled. The text itself never is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import text as tx
from driftline.operators.revisions import assemble, known_ids, metadata_times, revision_id
from driftline.operators.scale import (
    BROADCAST_BYTES,
    bit_is_set,
    bit_maps,
    fits_broadcast,
    sifted,
    skew_join,
)
from driftline.session import written

# Fixed value: the frequency of a word that has none.
DEFAULT_FREQUENCY = 0.00001


def build_lexicon(*lists: DataFrame, letters: bool = True) -> DataFrame:
    """Distinct lower-cased words of several one-column (``word``) lists.

    ``letters`` cleans entries like the text they are compared with, so that a
    hyphenated entry can match; without it entries are only lower-cased.
    """
    every = lists[0].select("word")
    for more in lists[1:]:
        every = every.unionByName(more.select("word"))
    word = tx.letters_only(F.col("word")) if letters else F.lower("word")
    return every.select(F.trim(word).alias("word")).where(F.col("word") != "").distinct()


def _words(content: DataFrame, words: Column) -> DataFrame:
    """``id, word`` for each of the words; text without any gives an empty word.

    The id is worked out before the words are laid out, once per text.
    """
    laid = content.select(revision_id().alias("id"), words.alias("_w")).where("id IS NOT NULL")
    word = F.coalesce("_word", F.lit("")).alias("word")
    return laid.select("id", F.explode_outer("_w").alias("_word")).select("id", word)


def _looked_up(
    words: DataFrame, lookup: DataFrame, key: str, max_bytes: int
) -> DataFrame:
    """``words`` (key, word) left-joined to ``lookup`` with a multiplicity ``n``.

    A lookup that is too large to broadcast is met by per-(key, word) counts, so
    that a frequent word is shuffled once per key and its rows can be salted.
    """
    if fits_broadcast(lookup, max_bytes):
        return words.withColumn("n", F.lit(1).cast("long")).join(
            F.broadcast(lookup), "word", "left"
        )
    counted = words.groupBy(key, "word").agg(F.count("*").alias("n"))
    return skew_join(counted, lookup, ["word"], "left", spread_by=[key])


def revision_word_tally(
    content: DataFrame, lexicon: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``id, misses, hits`` on cleaned words; revisions without words count 0."""
    words = _words(content, tx.clean_words(F.col("text")))
    marked = _looked_up(words, lexicon.select("word", F.lit(1).alias("listed")), "id", max_bytes)
    real = F.col("word") != ""
    return marked.groupBy("id").agg(
        F.sum(F.when(real & F.col("listed").isNull(), F.col("n")).otherwise(0)).alias("misses"),
        F.sum(F.when(real & F.col("listed").isNotNull(), F.col("n")).otherwise(0)).alias("hits"),
    )


def register_sql(spark: SparkSession, lexicon: DataFrame) -> None:
    """Offer ``count_uncommon_words(text)`` to SQL, over a view ``lexicon``.

    Meant for ad-hoc questions on cleaned text: Spark joins on the text itself.
    ``lexicon_misses`` is the way to score whole tables.
    """
    lexicon.select("word").createOrReplaceTempView("lexicon")
    spark.sql(
        r"""CREATE OR REPLACE TEMPORARY FUNCTION count_uncommon_words(t STRING) RETURNS INT
        RETURN (SELECT CAST(count_if(l.word IS NULL) AS INT)
                FROM explode(filter(split(t, '\\s+'), w -> w <> '')) AS x(word)
                LEFT JOIN lexicon l ON l.word = x.word)"""
    )


def lexicon_misses(
    content: DataFrame, meta: DataFrame, lexicon: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``to_id, timestamp, uncommon_word_count``: words not in the lexicon."""
    tally = revision_word_tally(content, lexicon, max_bytes)
    return tally.join(metadata_times(meta), "id").select(
        F.col("id").alias("to_id"), "timestamp", F.col("misses").alias("uncommon_word_count")
    )


def lexicon_hits(
    content: DataFrame, meta: DataFrame, lexicon: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``to_id, timestamp, common_word_count``: raw pieces found in the lexicon."""
    words = _words(content, tx.raw_words(F.lower("text")))
    marked = _looked_up(words, lexicon.select("word", F.lit(1).alias("listed")), "id", max_bytes)
    hits = marked.groupBy("id").agg(
        F.sum(F.when(F.col("listed").isNotNull(), F.col("n")).otherwise(0)).alias("hits")
    )
    return hits.join(metadata_times(meta), "id").select(
        F.col("id").alias("to_id"), "timestamp", F.col("hits").alias("common_word_count")
    )


def uncommon_growth(misses: DataFrame) -> DataFrame:
    """``year, month, total_uncommon_words`` from per-revision misses, in order."""
    day = F.to_date("timestamp")
    return (
        misses.groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.sum("uncommon_word_count").alias("total_uncommon_words"))
        .orderBy("year", "month")
    )


def _tally_words(content: DataFrame, by: Sequence[str], each: bool = False) -> DataFrame:
    """``by, id, word, count`` where the empty word has a row per revision; other
    words have one (without id), or one per revision if ``each`` is set.

    Counts equal those of splitting each revision's whole text. Inner words are
    counted piece by piece. The empty words that a split yields at the blank
    edges of a text depend on its first and last piece only: each piece adds one
    row without a word that carries its place and its edges, so the text is read
    once and both kinds of row are counted before the one shuffle.
    """
    text = F.col("text")
    blank = F.when(text == "", 2).otherwise(0)
    at_start = F.when((text == "") | text.rlike(r"\A\s"), 1).otherwise(0)
    at_end = F.when((text == "") | text.rlike(r"\s\z"), 1).otherwise(0)
    # One number orders pieces and tells if the piece is empty and has a blank edge.
    # A piece without a place counts as a first one; no text has no place.
    place = F.when(text.isNotNull(), F.coalesce(F.col("piece").cast("long"), F.lit(0)) * 4)
    words = F.coalesce(F.array_remove(tx.spaced_words(text), ""), F.array().cast("array<string>"))
    pieces = content.select(
        *by,
        revision_id().alias("id"),
        (place + blank + at_start).alias("head"),
        (place + blank + at_end).alias("tail"),
        F.array_append(words, F.lit(None).cast("string")).alias("_w"),
    )
    # A second select, so that the edges are looked at once per piece, not per word.
    rows = pieces.select(*by, "id", "head", "tail", F.explode("_w").alias("word"))
    edge = F.col("word").isNull()
    owner = F.col("id") if each else F.when(edge, F.col("id"))
    tally = rows.groupBy(*by, "word", owner.alias("id")).agg(
        F.count("*").alias("n"), F.min("head").alias("head"), F.max("tail").alias("tail")
    )
    one_piece = F.shiftright("head", 2) == F.shiftright("tail", 2)
    is_blank = F.col("head").bitwiseAND(F.lit(2)) == 2
    empty = (
        F.when(F.col("head").isNull() | (one_piece & is_blank), 1)
        .otherwise(F.col("head") % 2 + F.col("tail") % 2)
    )
    count = F.when(edge, empty).otherwise(F.col("n")).cast("long")
    return tally.select(
        *by, "id", F.coalesce("word", F.lit("")).alias("word"), count.alias("count")
    )


def _with_id(content: DataFrame, ids: DataFrame, max_bytes: int) -> DataFrame | None:
    """Content of the revisions in ``ids`` if these can be broadcast, else None.

    Ids that are too many for a list are broadcast as bit maps, an eighth of a byte
    each where they lie close together, as counted ids do. Ids that lie far apart make
    a Bloom filter; the few ids of ``content`` that it takes for known ones are found
    by a join of ids alone, and listed.
    """
    keyed = content.withColumn("_id", revision_id())
    if fits_broadcast(ids, max_bytes):
        few = F.broadcast(ids.select(F.col("id").alias("_id")))
        return keyed.join(few, "_id", "left_semi").drop("_id")
    maps = bit_maps(ids, "id", max_bytes)
    if maps is not None:
        found = F.col("_map") == F.bitmap_bucket_number("_id")
        found = found & bit_is_set(F.bitmap_bit_position("_id"))
        return keyed.join(F.broadcast(maps), found, "left_semi").drop("_id")
    named = ids.select(F.col("id").alias("_id"))
    # A null has a hash too.
    passed = sifted(keyed.where("_id IS NOT NULL"), named, "_id", max_bytes)
    if passed is None:
        return None
    wrong = passed.select("_id").distinct().join(named.hint("merge"), "_id", "left_anti")
    wrong = written(wrong)
    if not fits_broadcast(wrong, max_bytes):
        return None
    return passed.join(F.broadcast(wrong), "_id", "left_anti").drop("_id")


def _tally_known(
    content: DataFrame, meta: DataFrame | None, by: Sequence[str], max_bytes: int
) -> DataFrame:
    """The tally of revisions that have metadata, or of all if ``meta`` is None.

    Ids that may be broadcast, listed, as bit maps or as a Bloom filter, sort out the
    texts where they are read. Beyond that words are counted per revision first and the counts meet the
    ids, so text is not moved either way. A revision's distinct words are bounded by
    its text.
    """
    if meta is None:
        return _tally_words(content, by)
    ids = known_ids(meta)
    known = _with_id(content, ids, max_bytes)
    if known is not None:
        return _tally_words(known, by)
    return _tally_words(content, by, each=True).join(ids.hint("merge"), "id", "left_semi")


def word_counts(
    content: DataFrame, meta: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Lower-cased white-space words with their counts, over all texts."""
    return (
        _tally_known(content, meta, [], max_bytes)
        .groupBy("word")
        .agg(F.sum("count").alias("count"))
        .where(F.col("count") > 0)
    )


def word_counts_by_title(
    content: DataFrame, meta: DataFrame | None = None, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Word counts per title, and over all titles where ``all_titles`` is 1.

    Both grains are summed from one tally, so the text is read once.
    """
    return (
        _tally_known(content, meta, ["title"], max_bytes)
        .groupingSets([["title", "word"], ["word"]], "title", "word")
        .agg(F.sum("count").alias("count"), F.grouping("title").alias("all_titles"))
        .where(F.col("count") > 0)
        .select("title", "word", "count", F.col("all_titles").cast("int"))
    )


def top_words(counts: DataFrame, n: int | None = None) -> DataFrame:
    """Words by falling count, ties in word order; the first ``n`` if given."""
    ranked = counts.orderBy(F.desc("count"), "word")
    return ranked if n is None else ranked.limit(n)


def max_hit_revision(content: DataFrame, hits: DataFrame, preview: int = 100) -> DataFrame:
    """The revision with most hits, its word count and the start of its text."""
    best = hits.orderBy(F.desc("common_word_count"), "to_id").limit(1)
    ids = best.select(F.col("to_id").alias("id"))
    texts = assemble(
        content.withColumn("id", revision_id()).join(F.broadcast(ids), "id", "left_semi"),
        ["id"],
        chunked=True,
    )
    return texts.join(F.broadcast(best), texts["id"] == best["to_id"]).select(
        "to_id",
        "timestamp",
        "common_word_count",
        F.size(F.split("full_text", r"\s+")).alias("text_word_count"),
        tx.preview(F.col("full_text"), preview).alias("truncated_text"),
    )


def uncommonness(
    content: DataFrame,
    frequencies: DataFrame,
    meta: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``to_id, uncommon_index``: mean of 1/frequency over a revision's words.

    Words without a frequency get DEFAULT_FREQUENCY; no words give null. With
    ``meta`` only revisions that have metadata are scored.
    """
    ids = None if meta is None else known_ids(meta)
    if ids is not None:
        kept = _with_id(content, ids, max_bytes)
        content, ids = (content, ids) if kept is None else (kept, None)
    words = _words(content, tx.unicode_words(F.col("text")))
    known = _looked_up(words, frequencies.select("word", "freq"), "id", max_bytes)
    real = F.col("word") != ""
    weight = F.col("n") / F.coalesce("freq", F.lit(DEFAULT_FREQUENCY))
    scored = known.groupBy("id").agg(
        F.sum(F.when(real, weight)).alias("s"),
        F.sum(F.when(real, F.col("n")).otherwise(0)).alias("c"),
    )
    if ids is not None:
        scored = scored.join(ids.hint("merge"), "id", "left_semi")
    return scored.select(F.col("id").alias("to_id"), F.try_divide("s", "c").alias("uncommon_index"))


def lexicon_score(
    content: DataFrame, weights: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Sentiment as the summed ``weight`` of a revision's words, per word.

    ``id, total_weight, words, score``; ``score`` is null without words.
    """
    words = _words(content, tx.unicode_words(F.col("text")))
    known = _looked_up(words, weights.select("word", "weight"), "id", max_bytes)
    real = F.col("word") != ""
    return (
        known.groupBy("id")
        .agg(
            F.sum(F.col("n") * F.coalesce("weight", F.lit(0))).alias("total_weight"),
            F.sum(F.when(real, F.col("n")).otherwise(0)).alias("words"),
        )
        .withColumn("score", F.try_divide("total_weight", "words"))
    )


def log_odds_weights(
    words: DataFrame, side: str = "is_first", word: str = "word", strength: float = 1000.0
) -> DataFrame:
    """How much more one side uses each word: log-odds with a Dirichlet prior.

    ``words`` has a row for each occurrence and a boolean ``side``. Every word begins
    with ``strength`` pseudo-counts in all, dealt out by how often both sides use it,
    so that rare words don't get extreme odds. ``word, first, second, log_odds, z``;
    ``z`` is the difference of the log-odds over its standard deviation.
    """
    counts = words.where(F.col(side).isNotNull() & F.col(word).isNotNull()).groupBy(
        F.col(word).alias("word")
    ).agg(F.count_if(F.col(side)).alias("first"), F.count_if(~F.col(side)).alias("second"))
    counts = written(counts)
    total = counts.agg(F.sum("first").alias("a"), F.sum("second").alias("b"))
    a, b = total.select("a").scalar(), total.select("b").scalar()
    prior = F.lit(float(strength)) * (F.col("first") + F.col("second")) / (a + b)
    odds = lambda mine, all_: F.log(
        (mine + prior) / (all_ + F.lit(float(strength)) - mine - prior)
    )
    deviation = F.sqrt(1 / (F.col("first") + prior) + 1 / (F.col("second") + prior))
    return counts.withColumn("log_odds", odds(F.col("first"), a) - odds(F.col("second"), b)).withColumn(
        "z", F.col("log_odds") / deviation
    )
