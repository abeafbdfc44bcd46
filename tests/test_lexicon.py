import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftline.operators import lexicon, revisions

CONTENT = "to_id string, title string, piece int, text string"


@pytest.fixture(scope="module")
def content(spark):
    return spark.createDataFrame(
        [
            ("1", "t", 0, "Delve into AI, ever-changing"),
            ("1", "t", 1, "AI ai the"),
            ("2", "t", 0, None),
            ("3", "t", 0, ""),
            ("4", "u", 0, "ai delve"),
            ("5", "u", 0, "without metadata"),
            ("x", "u", 0, "not a number"),
        ],
        CONTENT,
    )


@pytest.fixture(scope="module")
def meta(spark):
    stamp = F.col("timestamp").try_cast("timestamp_ntz")
    return spark.createDataFrame(
        [
            (1, "2022-11-01T00:00:00Z"),
            (1, "2022-11-01T00:00:00Z"),
            (2, "2022-11-05T00:00:00Z"),
            (3, "2022-12-05T00:00:00Z"),
            (4, "bad"),
            (6, "2023-01-01T00:00:00Z"),
        ],
        "id long, timestamp string",
    ).withColumn("timestamp", stamp)


@pytest.fixture(scope="module")
def words(spark):
    data = [("AI",), ("ai",), ("ever-changing",), ("delve",)]
    return lexicon.build_lexicon(spark.createDataFrame(data, "word string"))


def test_build_lexicon(spark, words, rows):
    assert rows(words) == [("ai",), ("delve",), ("everchanging",)]
    raw = spark.createDataFrame([("AI",), ("ever-changing",), ("--",)], "word string")
    kept = lexicon.build_lexicon(raw, letters=False)
    assert rows(kept) == [("--",), ("ai",), ("ever-changing",)]


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_misses_and_hits(content, meta, words, rows, max_bytes):
    tally = lexicon.revision_word_tally(content, words, max_bytes)
    got = {r["id"]: (r["misses"], r["hits"]) for r in tally.collect()}
    assert got[1] == (2, 5) and got[2] == (0, 0) and got[3] == (0, 0) and got[4] == (0, 2)
    misses = lexicon.lexicon_misses(content, meta, words, max_bytes)
    assert rows(misses, "to_id", "uncommon_word_count") == [(1, 2), (2, 0), (3, 0), (4, 0)]
    hits = lexicon.lexicon_hits(content, meta, words, max_bytes)
    # Raw pieces: "AI," and "ever-changing" are not entries of the cleaned list.
    assert rows(hits, "to_id", "common_word_count") == [(1, 3), (2, 0), (3, 0), (4, 2)]


def test_growth_keeps_months_without_misses(content, meta, words):
    growth = lexicon.uncommon_growth(lexicon.lexicon_misses(content, meta, words))
    assert [tuple(r) for r in growth.collect()] == [
        (None, None, 0),
        (2022, 11, 2),
        (2022, 12, 0),
    ]


def brute_counts(pieces):
    """Split each revision's text, pieces joined with a space."""
    texts = {}
    for to_id, _, piece, text in sorted(pieces, key=lambda p: (p[0], p[2])):
        texts.setdefault(to_id, [])
        if text is not None:
            texts[to_id].append(text)
    counts = Counter()
    for parts in texts.values():
        counts.update(re.split(r"[ \t\n\x0b\f\r]+", " ".join(parts).lower()))
    return counts


def test_word_counts_equal_whole_texts(spark):
    rng = random.Random(3)
    options = ["", " ", "a", " a", "a ", " A b ", "\n", None, "b\tc"]
    pieces = [
        (str(i), "t", p, rng.choice(options))
        for i in range(200)
        for p in range(rng.randint(1, 3))
    ]
    df = spark.createDataFrame(pieces, CONTENT)
    got = {r["word"]: r["count"] for r in lexicon.word_counts(df).collect()}
    assert got == dict(brute_counts(pieces))


def test_word_counts_skip_unknown_revisions(content, meta):
    got = {r["word"]: r["count"] for r in lexicon.word_counts(content, meta).collect()}
    assert "metadata" not in got and "number" not in got
    assert got["delve"] == 2 and got[""] == 2


def exchanged(df):
    """Names of the columns that each shuffle of a plan moves."""
    plans, found = [df._jdf.queryExecution().sparkPlan(), df._jdf.queryExecution().executedPlan()], []
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.initialPlan()
        if "Exchange" in plan.nodeName():
            output = plan.output()
            found.append({output.apply(i).name() for i in range(output.size())})
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return found


@pytest.mark.parametrize("max_bytes", [0, 1 << 26])
def test_counting_never_shuffles_text(spark, content, meta, max_bytes):
    """Also where neither the ids nor the frequencies may be broadcast."""
    freq = spark.createDataFrame([("ai", 0.5)], "word string, freq double")
    plain = lexicon.word_counts(content, meta)
    for df, want in (
        (lexicon.word_counts(content, meta, max_bytes), plain),
        (lexicon.word_counts_by_title(content, meta, max_bytes), lexicon.word_counts_by_title(content, meta)),
        (lexicon.uncommonness(content, freq, meta, max_bytes), lexicon.uncommonness(content, freq, meta)),
    ):
        moved = exchanged(df)
        assert moved and not any(columns & {"text", "_w"} for columns in moved)
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_many_close_ids_sort_out_texts_where_they_are_read(spark, content):
    """Ids whose list is too large to broadcast but whose bit maps are not."""
    meta = spark.range(1, 20_000).select("id", F.lit("2022-01-01").cast("timestamp_ntz").alias("timestamp"))
    few = 1 << 18
    freq = spark.createDataFrame([("ai", 0.5)], "word string, freq double")
    for df, want in (
        (lexicon.word_counts(content, meta, few), lexicon.word_counts(content, meta)),
        (lexicon.word_counts_by_title(content, meta, few), lexicon.word_counts_by_title(content, meta)),
        (lexicon.uncommonness(content, freq, meta, few), lexicon.uncommonness(content, freq, meta)),
    ):
        assert "SortMergeJoin" not in df._jdf.queryExecution().sparkPlan().toString()
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def shuffled_rows(df):
    """Rows that the shuffles of a frame wrote when it ran."""
    df.collect()
    plans, rows = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        if "QueryStage" in plan.nodeName():
            plan = plan.plan()
        if plan.nodeName() == "Exchange":
            rows += plan.metrics().apply("shuffleRecordsWritten").value()
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return rows


def test_words_by_title_are_summed_over_revisions_before_they_move(spark):
    """With too many ids for a list, equal words of one title are one row of a task."""
    pieces = [(str(i), "t", 0, " ".join(f"w{k}" for k in range(20))) for i in range(1, 501)]
    content = spark.createDataFrame(pieces, CONTENT)
    meta = spark.range(1, 20_000).select("id", F.lit("2022-01-01").cast("timestamp_ntz").alias("timestamp"))
    counts = lexicon.word_counts_by_title(content, meta, 1 << 18)
    # 20 words a task and 500 rows for edges; with a row for each revision it would be 10,500 and more.
    assert 520 <= shuffled_rows(counts) < 1_500
    assert {r["count"] for r in counts.collect()} == {500}


@pytest.mark.parametrize("few", [1 << 18, 1 << 13])
def test_many_far_ids_sort_out_texts_where_they_are_read(spark, few):
    """Ids too many for a list and too far apart for bit maps; with the smaller limit
    the Bloom filter lets ids through that are not known."""
    pieces = [(str(i), f"t{i % 3}", p, f"w{i} a") for i in range(200) for p in range(2)]
    content = spark.createDataFrame([*pieces, ("x", "t", 0, "y"), (None, "t", 0, "z")], CONTENT)
    far = F.when(F.col("id") < 100, F.col("id") * 2).otherwise(F.col("id") * 1_000_003)
    meta = spark.range(20_000).select(far.alias("id"), F.lit("2022-01-01").cast("timestamp_ntz").alias("timestamp"))
    freq = spark.createDataFrame([("a", 0.5)], "word string, freq double")
    for df, want in (
        (lexicon.word_counts(content, meta, few), lexicon.word_counts(content, meta)),
        (lexicon.word_counts_by_title(content, meta, few), lexicon.word_counts_by_title(content, meta)),
        (lexicon.uncommonness(content, freq, meta, few), lexicon.uncommonness(content, freq, meta)),
    ):
        assert "SortMergeJoin" not in df._jdf.queryExecution().sparkPlan().toString()
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_pieces_without_a_place(spark):
    df = spark.createDataFrame([("1", "t", None, t) for t in ("a b", "c d", "x")], CONTENT)
    got = {r["word"]: r["count"] for r in lexicon.word_counts(df).collect()}
    assert got == dict.fromkeys("abcdx", 1)


def test_word_counts_by_title(content, rows):
    both = lexicon.word_counts_by_title(content)
    totals = both.where("all_titles = 1").select("word", "count")
    assert rows(totals) == rows(lexicon.word_counts(content).select("word", "count"))
    assert rows(both.where("all_titles = 0 AND word = 'delve'")) == [
        ("t", "delve", 1, 0),
        ("u", "delve", 1, 0),
    ]


def test_top_words_breaks_ties_by_word(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3)], "word string, count long")
    assert [r["word"] for r in lexicon.top_words(counts, 2).collect()] == ["c", "a"]


def test_max_hit_revision(content, meta, words):
    hits = lexicon.lexicon_hits(content, meta, words)
    best = lexicon.max_hit_revision(content, hits, preview=9).collect()
    assert [(r["to_id"], r["text_word_count"], r["truncated_text"]) for r in best] == [
        (1, 7, "Delve int")
    ]


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_uncommonness(spark, content, max_bytes):
    freq = spark.createDataFrame([("ai", 0.5), ("delve", 0.25)], "word string, freq double")
    scored = lexicon.uncommonness(content, freq, max_bytes=max_bytes)
    got = {r["to_id"]: r["uncommon_index"] for r in scored.collect()}
    # delve into ai ever changing / ai ai the
    assert got[1] == pytest.approx((4 + 1e5 + 2 + 1e5 + 1e5 + 2 + 2 + 1e5) / 8)
    assert got[4] == pytest.approx(3.0) and got[2] is None and got[3] is None


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_lexicon_score(spark, content, max_bytes):
    weights = spark.createDataFrame([("ai", -1), ("delve", 2)], "word string, weight long")
    scored = lexicon.lexicon_score(content, weights, max_bytes)
    got = {r["id"]: (r["total_weight"], r["words"], r["score"]) for r in scored.collect()}
    assert got[4] == (1, 2, 0.5) and got[1][:2] == (-1, 8) and got[3] == (0, 0, None)


def test_sql_name(spark, words):
    lexicon.register_sql(spark, words)
    got = spark.sql(
        "SELECT count_uncommon_words(t) FROM VALUES (1, 'ai and the'), (2, ''), (3, NULL) v(i, t) "
        "ORDER BY i"
    )
    assert [r[0] for r in got.collect()] == [2, 0, 0]


def test_assemble_in_chunks(spark, monkeypatch):
    pieces = [(1, i, f"p{i}") for i in range(30)] + [(2, 0, None)]
    df = spark.createDataFrame(pieces, "id long, piece int, text string").repartition(4)
    whole = " ".join(f"p{i}" for i in range(30))
    monkeypatch.setattr(revisions, "PIECES_PER_CHUNK", 4)
    for chunked in (None, True, False):
        got = {r["id"]: r["full_text"] for r in revisions.assemble(df, ["id"], chunked).collect()}
        assert got == {1: whole, 2: ""}


def test_log_odds_weights(spark):
    """Equal use gives 0, one-sided frequent words the largest z, rare ones less."""
    rows = [(True, "yes")] * 50 + [(False, "no")] * 50 + [(True, "rare"), (None, "yes"), (True, None)]
    rows += [(True, "same")] * 30 + [(False, "same")] * 30
    df = spark.createDataFrame(rows, "is_first boolean, word string")
    got = {r["word"]: r for r in lexicon.log_odds_weights(df, strength=10.0).collect()}
    a, b = 81, 80
    for word, first, second in (("yes", 50, 0), ("no", 0, 50), ("rare", 1, 0), ("same", 30, 30)):
        prior = 10.0 * (first + second) / (a + b)
        odds = lambda mine, total, prior=prior: math.log((mine + prior) / (total + 10.0 - mine - prior))
        delta = odds(first, a) - odds(second, b)
        z = delta / math.sqrt(1 / (first + prior) + 1 / (second + prior))
        assert (got[word]["first"], got[word]["second"]) == (first, second)
        assert abs(got[word]["log_odds"] - delta) < 1e-12 and abs(got[word]["z"] - z) < 1e-12
    assert got["yes"]["z"] > got["rare"]["z"] > 0 > got["no"]["z"]
    assert lexicon.log_odds_weights(df.limit(0)).count() == 0
