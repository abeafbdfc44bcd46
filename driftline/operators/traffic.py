"""Top articles, page views by article, category and month, category trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions import text as tx
from driftline.operators.scale import (
    BROADCAST_BYTES,
    ROWS_PER_TASK,
    lookup_join,
    running_total,
    skew_join,
)

# Titles that are no articles.
SPECIAL_PREFIX = "Special:"
MAIN_PAGE = "Main_Page"
CATEGORY_PREFIX = "Category:"


def _is_article(title: Column) -> Column:
    return ~title.startswith(SPECIAL_PREFIX) & (title != MAIN_PAGE)


def _by_views() -> list[Column]:
    return [F.desc("views"), F.asc("article")]


def views_by_article(views: DataFrame) -> DataFrame:
    return views.groupBy("article").agg(F.sum("views").alias("views"))


def top_n_filtered(totals: DataFrame, n: int) -> DataFrame:
    """The ``n`` most viewed articles; special pages never take a place."""
    return totals.where(_is_article(F.col("article"))).orderBy(*_by_views()).limit(n)


def top_n_then_filter(totals: DataFrame, n: int) -> DataFrame:
    """Articles among the ``n`` most viewed titles; may be fewer than ``n``."""
    return totals.orderBy(*_by_views()).limit(n).where(_is_article(F.col("article")))


def ranked_label(top: DataFrame) -> DataFrame:
    """``#1``, ``#2`` ... by views, for a list already cut to its first rows."""
    ordered = top.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("views")).alias("_v"), "article"))).alias("a")
    )
    return ordered.select(F.posexplode("a").alias("_i", "_s")).select(
        F.concat(F.lit("#"), F.col("_i") + 1).alias("rank"),
        F.col("_s.article").alias("article"),
        (-F.col("_s._v")).alias("views"),
    )


def views_by_category(members: DataFrame, views: DataFrame) -> DataFrame:
    """Views of each article under each category it belongs to."""
    pairs = members.select("category", F.col("member").alias("article")).distinct()
    return skew_join(
        pairs, views_by_article(views), ["article"], "inner", spread_by=["category"]
    ).select("category", "article", "views")


def views_by_period(views: DataFrame, chars: int = 6, by: Sequence[str] = ()) -> DataFrame:
    """Views per period, the first ``chars`` of the time stamp (6 months, 8 days)."""
    return views.groupBy(*by, F.substring("timestamp", 1, chars).alias("period")).agg(
        F.sum("views").alias("views")
    )


def views_by_category_period(
    members: DataFrame, views: DataFrame, chars: int = 6
) -> DataFrame:
    """Views per category and period, and summed over categories (category null).

    Views are reduced to one row per article and period before the join. An
    article in two categories counts in both, also in the sum.
    """
    pairs = members.select("category", F.col("member").alias("article")).distinct()
    reduced = views_by_period(views, chars, by=["article"])
    per_category = (
        skew_join(pairs, reduced, ["article"], "inner", spread_by=["category"])
        .groupBy("category", "period")
        .agg(F.sum("views").alias("views"))
    )
    return (
        per_category.groupingSets([["category", "period"], ["period"]], "category", "period")
        .agg(F.sum("views").alias("views"), F.grouping("category").alias("_all"))
        .select("category", "period", "views", F.col("_all").cast("int").alias("combined"))
    )


def category_expand(edges: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Pages of each category and of its direct sub-categories, once each.

    ``edges`` has ``category, member, is_subcat``. One level only, as a page of
    a sub-category's own sub-category does not belong to the top category.
    """
    name = F.regexp_replace("member", f"^{CATEGORY_PREFIX}", "")
    pages = edges.where(
        ~F.col("is_subcat") & ~F.col("member").startswith(CATEGORY_PREFIX)
    ).select("category", F.col("member").alias("page"))
    parents = edges.where(F.col("is_subcat")).select(
        name.alias("category"), F.col("category").alias("parent")
    )
    below = lookup_join(
        pages, parents.distinct(), ["category"], "inner", spread_by=["page"], max_bytes=max_bytes
    ).select(F.col("parent").alias("category"), "page")
    return pages.unionByName(below).distinct()


def extract_links(
    texts: DataFrame, key: str, text: str = "text", pattern: str = tx.CATEGORY_LINK
) -> DataFrame:
    """Distinct linked names per text."""
    return texts.select(
        key, F.explode(tx.linked_names(F.col(text), pattern)).alias("link")
    ).where(F.col("link") != "")


def second_hop(links: DataFrame, edges: DataFrame) -> DataFrame:
    """Members of any category that is linked from the texts, once each."""
    wanted = links.select(F.col("link").alias("category")).distinct()
    return (
        skew_join(edges, wanted, ["category"], "left_semi", spread_by=["member"])
        .where(~F.col("member").startswith(CATEGORY_PREFIX))
        .select("member")
        .distinct()
    )


def batch_titles(
    titles: DataFrame, size: int = 50, sep: str = "|", rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """Titles in order, ``size`` to a batch, joined with ``sep``."""
    ranked = running_total(
        titles.select("title").distinct(),
        [],
        [F.asc("title")],
        F.lit(1).cast("long"),
        "_rank",
        rows_per_task,
    )
    batch = F.floor((F.col("_rank") - 1) / F.lit(size)).cast("long")
    return ranked.groupBy(batch.alias("batch")).agg(
        F.expr(f"listagg(title, '{sep}') within group (order by title)").alias("titles"),
        F.count("*").alias("n"),
    )


def top_articles_revisions(
    totals: DataFrame, meta: DataFrame, n: int, since: str
) -> DataFrame:
    """Revisions of the top ``n`` articles: all, and those later than ``since``."""
    top = totals.orderBy(*_by_views()).limit(n)
    recent = F.col("timestamp") > F.lit(since).cast("timestamp_ntz")
    titles = top.select(F.col("article").alias("title"))
    counts = (
        lookup_join(meta, titles, ["title"], "left_semi", spread_by=["id"])
        .groupBy("title")
        .agg(
            F.count("*").alias("revisions"),
            F.count(F.when(recent, F.lit(1))).alias("recent_revisions"),
        )
    )
    joined = counts.join(top, F.col("title") == F.col("article"), "right")
    return joined.select(
        "article",
        "views",
        F.coalesce("revisions", F.lit(0).cast("long")).alias("revisions"),
        F.coalesce("recent_revisions", F.lit(0).cast("long")).alias("recent_revisions"),
    )
