"""Queries on page views, categories and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions import text as tx
from driftline.operators import traffic
from driftline.plans import adapters as ad
from driftline.plans.registry import query

TITLED = """titled AS (
  SELECT CASE event_type WHEN 'error' THEN 'Special:' || user_id WHEN 'signup' THEN 'Main_Page'
              ELSE 'Article_' || user_id END AS article,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS views
  FROM events GROUP BY 1)"""
EDGES = """edges AS (
  SELECT r_name AS category, 'Category:' || n_name AS member, TRUE AS is_subcat
  FROM region JOIN nation ON n_regionkey = r_regionkey
  UNION ALL SELECT n_name, s_name, FALSE FROM nation JOIN supplier ON s_nationkey = n_nationkey
  UNION ALL SELECT n_name, c_name, FALSE FROM nation JOIN customer ON c_nationkey = n_nationkey)"""
LINKS = """links AS (
  SELECT DISTINCT page_id, trim(unnest(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS link
  FROM pages)"""


@query(
    "top_n_filtered",
    f"""WITH {TITLED} SELECT article, views FROM titled
WHERE NOT starts_with(article, 'Special:') AND article <> 'Main_Page'
ORDER BY views DESC, article LIMIT 50""",
)
def top_n_filtered(spark, sf_dir):
    totals = traffic.views_by_article(ad.titled_views(spark, sf_dir))
    return traffic.top_n_filtered(totals, 50)


@query(
    "top_n_then_filter",
    f"""WITH {TITLED}
SELECT article, views FROM (SELECT * FROM titled ORDER BY views DESC, article LIMIT 50)
WHERE NOT starts_with(article, 'Special:') AND article <> 'Main_Page'""",
)
def top_n_then_filter(spark, sf_dir):
    totals = traffic.views_by_article(ad.titled_views(spark, sf_dir))
    return traffic.top_n_then_filter(totals, 50)


@query(
    "top_n_ranked",
    f"""WITH {TITLED},
top AS (SELECT * FROM titled WHERE NOT starts_with(article, 'Special:') AND article <> 'Main_Page'
        ORDER BY views DESC, article LIMIT 20)
SELECT '#' || row_number() OVER (ORDER BY views DESC, article) AS rank, article, views FROM top""",
)
def top_n_ranked(spark, sf_dir):
    totals = traffic.views_by_article(ad.titled_views(spark, sf_dir))
    return traffic.ranked_label(traffic.top_n_filtered(totals, 20))


@query(
    "views_by_article",
    """SELECT CAST(user_id AS VARCHAR) AS article,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS views FROM events GROUP BY 1""",
)
def views_by_article(spark, sf_dir):
    return traffic.views_by_article(ad.event_views(spark, sf_dir))


@query(
    "views_by_category",
    """SELECT n_name AS category, CAST(user_id AS VARCHAR) AS article,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS views
FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
GROUP BY 1, 2""",
)
def views_by_category(spark, sf_dir):
    return traffic.views_by_category(ad.members(spark, sf_dir), ad.event_views(spark, sf_dir))


@query(
    "views_monthly",
    """SELECT strftime(o_orderdate, '%Y%m') AS period,
       CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS views FROM orders GROUP BY 1""",
)
def views_monthly(spark, sf_dir):
    return traffic.views_by_period(ad.order_views(spark, sf_dir))


@query(
    "views_daily",
    """SELECT strftime(ts, '%Y%m%d') AS period,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS views FROM events GROUP BY 1""",
)
def views_daily(spark, sf_dir):
    return traffic.views_by_period(ad.event_views(spark, sf_dir), chars=8)


@query(
    "views_monthly_combined",
    """SELECT n_name AS category, strftime(o_orderdate, '%Y%m') AS period,
       CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS views,
       CAST(grouping(n_name) AS INTEGER) AS combined
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY GROUPING SETS ((n_name, strftime(o_orderdate, '%Y%m')),
                        (strftime(o_orderdate, '%Y%m')))""",
)
def views_monthly_combined(spark, sf_dir):
    return traffic.views_by_category_period(
        ad.members(spark, sf_dir), ad.order_views(spark, sf_dir)
    )


@query(
    "category_expand",
    f"""WITH {EDGES}
SELECT category, member AS page FROM edges WHERE NOT is_subcat
UNION
SELECT p.category, c.member FROM edges p JOIN edges c
  ON p.is_subcat AND NOT c.is_subcat AND c.category = replace(p.member, 'Category:', '')""",
)
def category_expand(spark, sf_dir):
    return traffic.category_expand(ad.edges(spark, sf_dir))


@query("extract_links", f"WITH {LINKS} SELECT page_id, link FROM links WHERE link <> ''")
def extract_links(spark, sf_dir):
    return ad.links(spark, sf_dir)


@query(
    "category_second_hop",
    f"""WITH {LINKS}
SELECT DISTINCT 'conversation ' || conv_id AS member
FROM (SELECT conv_id, unnest(string_split_regex(text, '\\s+')) AS category FROM conversations)
WHERE category IN (SELECT replace(link, '/', '') FROM links)""",
)
def category_second_hop(spark, sf_dir):
    found = ad.links(spark, sf_dir).withColumn("link", F.replace("link", F.lit("/"), F.lit("")))
    return traffic.second_hop(found.where(F.col("link") != ""), ad.word_edges(spark, sf_dir))


@query(
    "batch_titles",
    """SELECT batch, string_agg(title, '|' ORDER BY title) AS titles, count(*) AS n
FROM (SELECT title, (row_number() OVER (ORDER BY title) - 1) // 50 AS batch
      FROM (SELECT DISTINCT c_name AS title FROM customer)) GROUP BY batch""",
)
def batch_titles(spark, sf_dir):
    named = ad.table(spark, sf_dir, "customer").select(F.col("c_name").alias("title"))
    return traffic.batch_titles(named)


@query(
    "top_articles_revisions",
    """WITH v AS (SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS views
           FROM events GROUP BY 1),
top AS (SELECT * FROM v ORDER BY views DESC, CAST(user_id AS VARCHAR) LIMIT 100)
SELECT CAST(user_id AS VARCHAR) AS article, views, count(o_orderkey) AS revisions,
       count(o_orderkey) FILTER (WHERE o_orderdate > TIMESTAMP '1998-01-01') AS recent_revisions
FROM top LEFT JOIN orders ON o_custkey = user_id GROUP BY 1, 2""",
)
def top_articles_revisions(spark, sf_dir):
    totals = traffic.views_by_article(ad.event_views(spark, sf_dir))
    meta = ad.metadata(spark, sf_dir).withColumn("title", F.col("user").cast("string"))
    return traffic.top_articles_revisions(totals, meta, 100, "1998-01-01")


@query(
    "normalize_title",
    """SELECT s_suppkey, replace(trim(regexp_replace(raw, '^Category:', '')), ' ', '_') AS title
FROM (SELECT s_suppkey, 'Category: ' || s_name || ' of nation ' || s_nationkey || ' ' AS raw
      FROM supplier)""",
)
def normalize_title(spark, sf_dir):
    raw = F.concat(
        F.lit("Category: "), "s_name", F.lit(" of nation "), F.col("s_nationkey").cast("string"),
        F.lit(" "),
    )
    return ad.table(spark, sf_dir, "supplier").select(
        "s_suppkey", tx.normal_title(raw).alias("title")
    )
