"""Readers of landed records and flattening of nested payloads.

A payload column holds the response text of one request. Payloads are parsed
with a declared schema and flattened row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions import dates as dt
from driftline.functions import text as tx
from driftline.sources import schemas

# File name endings of the two kinds of revision files, and the
# text of an article without content.
META_SUFFIX = "_revisions.json"
CONTENT_SUFFIX = "_revision_content.json"
NO_CONTENT = "No content available"
# How CSV files tell null from empty text and escape quotes.
CSV_FORM = {"nullValue": r"\N", "escape": '"'}


def _unescaped(name: Column) -> Column:
    """Percent escapes undone; a name that has no valid ones stays as it is."""
    decoded = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    return F.when(F.contains(name, F.lit("%")), decoded).otherwise(name)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _before(name: Column, suffix: str) -> Column:
    """The name without ``suffix``, empty if it doesn't end in it."""
    rest = F.substring(name, F.lit(1), F.length(name) - len(suffix))
    return F.when(~name.endswith(suffix), "").otherwise(rest)


def title_of(file_path: Column, suffix: str = META_SUFFIX) -> Column:
    """The title a file or folder name ends in, before ``suffix``.

    ``file_path`` is that of ``_metadata``, a URI. The name is cut out first and
    unescaped then, so that a title may hold slashes and percent signs. A
    partition folder, ``column=title``, is escaped once more by its writer.
    Cut at slashes, as this is done for every row: a pattern that looks for the name
    takes time that grows with the square of its length.
    """

    def of_folder(name: Column) -> Column:
        value = F.regexp_extract(name, r"^[A-Za-z_]\w*=(.*)$", 1)
        return _once(value, lambda v: F.when(v != "", _unescaped(v)).otherwise(name))

    def of_parts(parts: Column) -> Column:
        # A path without a folder has one part, which is tried again.
        folder = F.coalesce(F.try_element_at(parts, F.lit(-2)), F.element_at(parts, 1))
        named = _once(_before(folder, suffix), lambda name: _once(_unescaped(name), of_folder))
        as_file = _before(F.element_at(parts, -1), suffix)
        return _once(as_file, lambda name: F.when(name != "", _unescaped(name)).otherwise(named))

    return _once(F.split(file_path, "/"), of_parts)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Revision metadata of all titles in one scan; title from the path if absent."""
    rows = spark.read.schema(schemas.REVISION_META).json(path)
    return rows.withColumn(
        "title", F.coalesce("title", title_of(F.col("_metadata.file_path"), META_SUFFIX))
    ).withColumn("timestamp", dt.parse_utc(F.col("timestamp")))


def read_content(spark: SparkSession, path: str) -> DataFrame:
    """Content records of all titles in one scan, in the order they were landed.

    A record that doesn't say its ``piece`` is placed where it stands in its file:
    by the block of the file a task reads, and by a running number inside the task,
    which reads a block from front to back. Blocks start at least 64 KB apart, so
    the number leaves room for files of 4 TB. Numbers rise along a file and have
    gaps; pieces of one revision are expected in one file.
    """
    rows = spark.read.schema(schemas.REVISION_CONTENT).json(path)
    block = F.shiftright(F.col("_metadata.file_block_start"), 16)
    running = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return rows.withColumn("piece", F.coalesce("piece", F.shiftleft(block, 33) + running))


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """Both record kinds from one folder; fields a kind lacks are null."""
    return spark.read.schema(schemas.MIXED).option("recursiveFileLookup", "true").json(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.WORD).csv(path, header=True)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files of ``write_csv``."""
    return spark.read.schema(schema).options(**CSV_FORM).csv(path, header=True)


def read_json_list(spark: SparkSession, path: str, column: str = "title") -> DataFrame:
    """The strings of JSON arrays, one array a file; a file has to fit a row."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.explode(F.from_json("value", "array<string>")).alias(column))


def listed_titles(spark: SparkSession, path: str) -> DataFrame:
    """``title, has_meta, has_content`` from file names alone; no file is opened."""
    # The name a record file has, also where its folder carries the title.
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"))
    )
    meta, content = title_of(F.col("path"), META_SUFFIX), title_of(F.col("path"), CONTENT_SUFFIX)
    named = files.select(
        F.coalesce(F.nullif(content, F.lit("")), meta).alias("title"),
        (content != "").alias("is_content"),
        (meta != "").alias("is_meta"),
    ).where(F.col("title") != "")
    return named.groupBy("title").agg(
        F.bool_or("is_meta").alias("has_meta"), F.bool_or("is_content").alias("has_content")
    )


def complete_titles(listing: DataFrame) -> DataFrame:
    """Titles that have both files."""
    return listing.where(F.col("has_meta") & F.col("has_content")).select("title")


def revision_ids(records: DataFrame) -> DataFrame:
    """Distinct revision ids; a record that was landed twice counts once."""
    return records.where(F.col("id").isNotNull()).select("id").distinct()


def _parsed(payloads: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    return payloads.withColumn("_p", F.from_json(column, schema))


def top_views(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """``article, views`` of the first item of each payload."""
    first = F.get("_p.items", F.lit(0))["articles"]
    rest = [c for c in payloads.columns if c != column]
    return _parsed(payloads, column, schemas.TOP_VIEWS).select(*rest, F.inline(first))


def page_views(payloads: DataFrame, column: str = "payload") -> DataFrame:
    rest = [c for c in payloads.columns if c != column]
    return _parsed(payloads, column, schemas.PAGE_VIEWS).select(*rest, F.inline("_p.items"))


def registrations(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """``timestamp, new_users`` of the first item."""
    first = F.get("_p.items", F.lit(0))["results"]
    rest = [c for c in payloads.columns if c != column]
    flat = _parsed(payloads, column, schemas.REGISTRATIONS).select(*rest, F.inline(first))
    return flat.withColumnRenamed("new_registered_users", "new_users").withColumn(
        "timestamp", dt.parse_utc(F.col("timestamp"))
    )


def category_members(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Edges ``category, member, is_subcat`` from rows ``category, payload``."""
    parsed = _parsed(payloads, column, schemas.CATEGORY_MEMBERS)
    return parsed.select(
        "category", F.explode("_p.query.categorymembers").alias("m")
    ).select(
        "category",
        F.col("m.title").alias("member"),
        F.col("m.title").startswith("Category:").alias("is_subcat"),
    )


def page_texts(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """``page_id, title, text``: first revision of each page, or NO_CONTENT."""
    parsed = _parsed(payloads, column, schemas.PAGE_MAP)
    pages = parsed.select(F.explode("_p.query.pages").alias("page_id", "page"))
    text = F.get("page.revisions", F.lit(0))["slots"]["main"]["content"]
    return pages.select(
        "page_id", F.col("page.title").alias("title"),
        F.coalesce(text, F.lit(NO_CONTENT)).alias("text"),
    )


def page_summaries(payloads: DataFrame, chars: int = 500) -> DataFrame:
    """Titles with the start of their text."""
    return page_texts(payloads).select("title", tx.preview(F.col("text"), chars).alias("summary"))


def revision_listing(records: DataFrame) -> DataFrame:
    """Rows from ``title, revisions``; missing comment or content becomes empty."""
    return records.select("title", F.inline("revisions")).select(
        "title",
        "id",
        dt.parse_utc(F.col("timestamp")).alias("timestamp"),
        "user",
        F.coalesce("comment", F.lit("")).alias("comment"),
        F.coalesce("content", F.lit("")).alias("content"),
    )


def diff_pieces(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One content row per hunk of a diff, stamped with ids, title and date.

    ``payloads`` has ``from_id, to_id, title, date, payload``. A payload without
    a diff gives no row; see ``diffless``.
    """
    parsed = _parsed(payloads, column, schemas.DIFF)
    return parsed.select(
        F.col("from_id").cast("string").alias("from_id"),
        F.col("to_id").cast("string").alias("to_id"),
        "title",
        "date",
        F.posexplode("_p.diff").alias("_i", "hunk"),
    ).select(
        "from_id", "to_id", "title", "date", F.col("_i").cast("long").alias("piece"), "hunk.text"
    )


def diffless(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Payloads that hold no diff."""
    parsed = _parsed(payloads, column, schemas.DIFF)
    return parsed.where(F.col("_p.diff").isNull()).drop("_p")
