import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftline.operators import revisions


@pytest.fixture(scope="module")
def meta(spark):
    rng = random.Random(4)
    data = [("big", i, f"2020-01-{rng.randint(1, 28):02d}") for i in range(120)]
    data += [("small", 1000, "2020-02-01"), ("small", 1001, "2020-02-01"), ("one", 2000, None)]
    return spark.createDataFrame(data, "title string, id long, timestamp string").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


@pytest.mark.parametrize("rows_per_task", [1000, 10])
def test_pairs_follow_the_newest_first_list(meta, rows, rows_per_task):
    listed = {}
    for r in meta.collect():
        listed.setdefault(r["title"], []).append((r["timestamp"], r["id"]))
    want = []
    for title, items in listed.items():
        items.sort(reverse=True)
        want += [
            (title, newer[1], older[1], older[0])
            for newer, older in zip(items, items[1:], strict=False)
        ]
    got = revisions.revision_pairs(meta, rows_per_task)
    assert rows(got, "title", "from_id", "to_id", "date") == sorted(want, key=repr)


@pytest.mark.parametrize("rows_per_task", [1000, 10])
def test_line_diff_counts_repeated_lines(spark, rows, rows_per_task):
    rng = random.Random(5)
    data = [
        (title, i, f"2020-01-{i % 28 + 1:02d}", "\n".join(rng.choices("abc", k=rng.randint(0, 5))))
        for title in ("x", "y")
        for i in range(40)
    ]
    history = spark.createDataFrame(data, "title string, id long, timestamp string, text string")
    want = []
    for title in ("x", "y"):
        versions = sorted((d for d in data if d[0] == title), key=lambda d: (d[2], d[1]))
        for old, new in zip(versions, versions[1:], strict=False):
            before, after = Counter(old[3].split("\n")), Counter(new[3].split("\n"))
            for line in before | after:
                if after[line] != before[line]:
                    want.append((title, old[1], new[1], line, after[line] - before[line]))
    got = revisions.revision_line_diff(history, rows_per_task)
    assert rows(got, "title", "from_id", "to_id", "line", "change") == sorted(want, key=repr)


def test_content_join_drops_what_has_no_partner(spark, rows):
    content = spark.createDataFrame(
        [("1", 0, "a"), ("1", 1, "b"), ("9", 0, "c"), ("z", 0, "d"), (None, 0, "e")],
        "to_id string, piece int, text string",
    )
    meta = spark.createDataFrame([(1, "t0"), (1, "t1"), (2, "t2")], "id long, timestamp string")
    for hot in (None, 1):
        joined = revisions.revision_content(content, meta, hot_rows=hot)
        assert rows(joined, "id", "piece", "text", "timestamp") == [
            (1, 0, "a", "t1"),
            (1, 1, "b", "t1"),
        ]
    texts = revisions.revision_text(content, meta)
    assert rows(texts) == [(1, "t1", "a b")]


def test_chars_ignore_records_without_revision(spark, rows):
    records = spark.createDataFrame(
        [("1", "d", "ab"), ("1", "d", "c"), ("1", "e", None), (None, None, "zzz")],
        "to_id string, date string, text string",
    )
    assert rows(revisions.revision_chars(records)) == [("1", "d", 3), ("1", "e", None)]


def test_since_is_exclusive(meta, rows):
    late = revisions.revisions_since(meta, "2020-01-28")
    assert rows(late, "id") == [(1000,), (1001,)]
    assert {tuple(r) for r in revisions.revisions_per_title(meta).collect()} == {
        ("big", 120),
        ("small", 2),
        ("one", 1),
    }


def test_outstanding_matches_whole_titles(spark, rows):
    titles = spark.createDataFrame([("War",), ("War in X",), ("War",)], "title string")
    done = spark.createDataFrame([("War",)], "title string")
    assert rows(revisions.outstanding(titles, done)) == [("War in X",)]
