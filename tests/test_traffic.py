import pytest
from pyspark.sql import functions as F

from driftline.operators import traffic


@pytest.fixture(scope="module")
def totals(spark):
    return spark.createDataFrame(
        [("Main_Page", 100), ("Special:Search", 90), ("B", 50), ("A", 50), ("C", 10)],
        "article string, views long",
    )


def test_filter_then_cut_and_cut_then_filter(totals):
    first = traffic.top_n_filtered(totals, 3)
    assert [r["article"] for r in first.collect()] == ["A", "B", "C"]
    assert [r["article"] for r in traffic.top_n_then_filter(totals, 3).collect()] == ["A"]
    labels = [tuple(r) for r in traffic.ranked_label(first).collect()]
    assert labels == [("#1", "A", 50), ("#2", "B", 50), ("#3", "C", 10)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(
        [
            ("Top", "Category:Sub", True),
            ("Top", "Page1", False),
            ("Top", "Both", False),
            ("Sub", "Both", False),
            ("Sub", "Page2", False),
            ("Sub", "Category:Third", True),
            ("Third", "Deep", False),
        ],
        "category string, member string, is_subcat boolean",
    )


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_expansion_stops_after_one_level(edges, rows, max_bytes):
    expanded = traffic.category_expand(edges, max_bytes)
    assert rows(expanded.where("category = 'Top'"), "page") == [("Both",), ("Page1",), ("Page2",)]
    assert rows(expanded.where("category = 'Sub'"), "page") == [("Both",), ("Deep",), ("Page2",)]


def test_second_hop(spark, edges, rows):
    links = spark.createDataFrame([(1, "Sub"), (2, "Sub"), (3, "Gone")], "id int, link string")
    assert rows(traffic.second_hop(links, edges)) == [("Both",), ("Page2",)]


def test_views(spark, rows):
    members = spark.createDataFrame(
        [("X", "a"), ("X", "a"), ("Y", "a"), ("Y", "b")], "category string, member string"
    )
    views = spark.createDataFrame(
        [("a", "2022010100", 1), ("a", "2022010200", 2), ("a", "2022020100", 4),
         ("b", "2022020100", 8), ("z", "2022020100", 16)],
        "article string, timestamp string, views long",
    )
    assert rows(traffic.views_by_category(members, views)) == [
        ("X", "a", 7),
        ("Y", "a", 7),
        ("Y", "b", 8),
    ]
    assert rows(traffic.views_by_period(views)) == [("202201", 3), ("202202", 28)]
    assert rows(traffic.views_by_period(views, 8))[0] == ("20220101", 1)
    combined = traffic.views_by_category_period(members, views)
    assert rows(combined.where("combined = 1"), "period", "views") == [
        ("202201", 6),
        ("202202", 16),
    ]
    parts = combined.where("combined = 0").agg(F.sum("views")).first()[0]
    assert parts == 22


@pytest.mark.parametrize("rows_per_task", [1000, 13])
def test_batches_are_whole_and_in_order(spark, rows_per_task):
    names = [f"t{i:03d}" for i in range(120)]
    titles = spark.createDataFrame([(n,) for n in names + names[:5]], "title string")
    batches = traffic.batch_titles(titles.repartition(6), 50, "|", rows_per_task)
    got = {r["batch"]: r["titles"].split("|") for r in batches.collect()}
    assert got == {0: names[:50], 1: names[50:100], 2: names[100:]}


def test_top_articles_keep_those_without_revisions(spark, totals, rows):
    meta = spark.createDataFrame(
        [("A", "2020-01-01"), ("A", "2022-01-01"), ("C", "2022-01-01")],
        "title string, timestamp string",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    top = traffic.top_articles_revisions(totals.where("views <= 50"), meta, 2, "2021-01-01")
    assert rows(top) == [("A", 50, 2, 1), ("B", 50, 0, 0)]


def test_links(spark, rows):
    texts = spark.createDataFrame(
        [(1, "{x} [[Category:A]] {y} [[Category:B|k]] [[Category:A]]"), (2, "none"), (3, None)],
        "id int, text string",
    )
    assert rows(traffic.extract_links(texts, "id")) == [(1, "A"), (1, "B")]
