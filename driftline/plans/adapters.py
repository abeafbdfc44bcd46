"""The given tables seen as revisions, page views, categories and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import text as tx
from driftline.operators.lexicon import build_lexicon
from driftline.operators.scale import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as texts, with a date spread over 2400 days from 1995 on."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("doc_id") % 2400).cast("int"))
    texts = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return spread(texts, "doc_id").select(
        "doc_id", F.col("source").alias("title"), day.alias("date"), "text"
    )


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revision content: one row per line of a document."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("to_id"),
        "title",
        "date",
        F.posexplode(F.split("text", "\n")).alias("piece", "text"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revision metadata: orders, titled by priority, made by customers."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_custkey").alias("user"),
        F.col("o_orderpriority").alias("title"),
        F.round("o_totalprice").cast("long").alias("size"),
        F.col("o_orderstatus").alias("state"),
    )


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``month, revisions`` over all metadata."""
    from driftline.operators.series import monthly_counts

    return monthly_counts(metadata(spark, sf_dir), "timestamp")


def monthly_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        metadata(spark, sf_dir)
        .groupBy("title", F.trunc("timestamp", "month").alias("month"))
        .agg(F.count("*").alias("revisions"))
    )


def listed_words(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name).select(F.explode(tx.raw_words(F.col("text"))).alias("word"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_lexicon(listed_words(spark, sf_dir, "benchmark"))


def raw_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_lexicon(listed_words(spark, sf_dir, "benchmark"), letters=False)


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative frequency of each word of the benchmark texts."""
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(tx.unicode_words(F.col("text"))).alias("word")
    )
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("word", (F.col("n") / total).alias("freq"))


def word_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """+1 for words used more by assistants than by users, -1 the other way."""
    side = F.when(F.col("role") == "assistant", 1).when(F.col("role") == "user", -1).otherwise(0)
    words = table(spark, sf_dir, "conversations").select(
        side.alias("side"), F.explode(tx.unicode_words(F.col("text"))).alias("word")
    )
    return (
        words.groupBy("word")
        .agg(F.signum(F.sum("side")).cast("long").alias("weight"))
        .where(F.col("weight") != 0)
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revision history: turns of a conversation, one day apart."""
    first = F.lit("2024-01-01").cast("date")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("title"),
        F.col("turn").alias("id"),
        F.date_add(first, F.col("turn").cast("int")).cast("timestamp_ntz").alias("timestamp"),
        "text",
    )


def event_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views: events, an article being a user; time stamps YYYYMMDD00."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("article"),
        F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("00")).alias("timestamp"),
        F.round(F.col("value") * 100).cast("long").alias("views"),
    )


def order_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views over many months: orders, an article being a customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("article"),
        F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("00")).alias("timestamp"),
        F.round("o_totalprice").cast("long").alias("views"),
    )


def titled_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views with special pages among the titles, by event type."""
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    title = (
        F.when(kind == "error", F.concat(F.lit("Special:"), user))
        .when(kind == "signup", F.lit("Main_Page"))
        .otherwise(F.concat(F.lit("Article_"), user))
    )
    return table(spark, sf_dir, "events").select(
        title.alias("article"), F.round(F.col("value") * 100).cast("long").alias("views")
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as categories of their customers."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    return customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"]).select(
        F.col("n_name").alias("category"), F.col("c_custkey").cast("string").alias("member")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category tree: regions hold nations, nations hold suppliers and customers."""
    regions, nations = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    tree = regions.join(nations, regions["r_regionkey"] == nations["n_regionkey"]).select(
        F.col("r_name").alias("category"),
        F.concat(F.lit("Category:"), "n_name").alias("member"),
        F.lit(True).alias("is_subcat"),
    )
    named = nations.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("category"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("key"), F.col("s_name").alias("member")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("key"), F.col("c_name").alias("member")
    )
    pages = suppliers.unionByName(customers).join(named, "key")
    return tree.unionByName(pages.select("category", "member", F.lit(False).alias("is_subcat")))


def word_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as categories of the conversations they occur in."""
    return table(spark, sf_dir, "conversations").select(
        F.explode(F.array_distinct(tx.raw_words(F.col("text")))).alias("category"),
        F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("member"),
        F.lit(False).alias("is_subcat"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link targets in page markup."""
    from driftline.operators.traffic import extract_links

    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    return extract_links(pages, "page_id", "html", 'href="([^"]+)"')


def turn_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftline.operators.perplexity import tokens_of

    turns = spread(table(spark, sf_dir, "conversations"), "conv_id", "turn").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("doc"),
        "text",
    )
    return tokens_of(turns, "doc")


def phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event of 60 days per region, 400 days apart from 1996 on."""
    start = F.date_add(F.lit("1996-01-01").cast("date"), F.col("r_regionkey") * 400)
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("event"), start.alias("start"), F.date_add(start, 59).alias("stop")
    )
