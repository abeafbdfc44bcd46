"""Queries that write landed records to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions import dates as dt
from driftline.operators import activity, lexicon, revisions
from driftline.plans import adapters as ad
from driftline.plans.registry import query
from driftline.plans.text_queries import LINES
from driftline.session import scratch_path
from driftline.sources import landed, schemas, sinks
from driftline.streaming import ingest


def _iso(ts):
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def _meta_records(spark, sf_dir):
    """Metadata titled by the document it belongs to, or ``unmatched``."""
    docs = ad.table(spark, sf_dir, "documents").select("doc_id", "source")
    orders = ad.table(spark, sf_dir, "orders")
    titled = orders.join(docs, orders["o_orderkey"] == docs["doc_id"], "left")
    return titled.select(
        F.coalesce("source", F.lit("unmatched")).alias("title"),
        F.col("o_orderkey").alias("id"),
        _iso("o_orderdate").alias("timestamp"),
    )


def _content_records(spark, sf_dir):
    return ad.content(spark, sf_dir).withColumns(
        {"date": F.col("date").cast("string"), "piece": F.col("piece").cast("long")}
    )


@query(
    "src_jsonl_roundtrip",
    f"""WITH {LINES}
SELECT to_id, title, CAST(date AS VARCHAR) AS date, piece, text FROM lines""",
)
def src_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "content")
    sinks.write_json(_content_records(spark, sf_dir), path)
    return landed.read_content(spark, path).select("to_id", "title", "date", "piece", "text")


def _landed_content(spark, sf_dir):
    """Content as it is landed: hunks of a revision one after another, without a
    number, in one file for each title."""
    path = scratch_path(spark, "landed-content")
    hunks = _content_records(spark, sf_dir).withColumn("type", F.lit(1))
    named = hunks.withColumn("file", F.concat("title", F.lit(landed.CONTENT_SUFFIX)))
    in_order = named.repartition("file").sortWithinPartitions("file", "to_id", "piece")
    in_order.drop("piece").write.partitionBy("file").json(path)
    return landed.read_content(spark, path)


@query(
    "landed_content_text",
    """SELECT doc_id AS to_id, o_orderdate AS timestamp, replace(text, chr(10), ' ') AS full_text
FROM documents JOIN orders ON o_orderkey = doc_id""",
)
def landed_content_text(spark, sf_dir):
    return revisions.revision_text(_landed_content(spark, sf_dir), ad.metadata(spark, sf_dir))


@query(
    "landed_content_words",
    rf"""SELECT source AS title, word, count(*) AS count
FROM (SELECT source, unnest(string_split_regex(lower(text), '[\s\x0b]+')) AS word FROM documents)
GROUP BY source, word""",
)
def landed_content_words(spark, sf_dir):
    counts = lexicon.word_counts_by_title(_landed_content(spark, sf_dir))
    return counts.where("all_titles = 0").select("title", "word", "count")


@query(
    "mixed_scan_chars",
    f"""WITH {LINES}
SELECT to_id, CAST(date AS VARCHAR) AS date, CAST(sum(length(text)) AS BIGINT) AS text_length
FROM lines GROUP BY ALL""",
)
def mixed_scan_chars(spark, sf_dir):
    path = scratch_path(spark, "mixed")
    sinks.write_json(_meta_records(spark, sf_dir), f"{path}/metadata")
    sinks.write_json(_content_records(spark, sf_dir), f"{path}/content")
    return revisions.revision_chars(landed.read_mixed(spark, path))


def _land_by_file(spark, sf_dir, path):
    meta = _meta_records(spark, sf_dir)
    named = meta.withColumn("file", F.concat("title", F.lit(landed.META_SUFFIX))).drop("title")
    sinks.write_by(named, path, "file")


@query(
    "title_from_path",
    """SELECT coalesce(source, 'unmatched') AS title, o_orderkey AS id, o_orderdate AS timestamp
FROM orders LEFT JOIN documents ON doc_id = o_orderkey""",
)
def title_from_path(spark, sf_dir):
    path = scratch_path(spark, "by-title")
    _land_by_file(spark, sf_dir, path)
    rows = landed.read_metadata(spark, f"{path}/file=*{landed.META_SUFFIX}")
    return rows.select("title", "id", "timestamp")


@query("complete_pairs", "SELECT DISTINCT source AS title FROM documents")
def complete_pairs(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    _land_by_file(spark, sf_dir, path)
    texts = _content_records(spark, sf_dir)
    named = texts.withColumn("file", F.concat("title", F.lit(landed.CONTENT_SUFFIX)))
    sinks.write_by(named.drop("title"), path, "file")
    return landed.complete_titles(landed.listed_titles(spark, path))


@query(
    "sink_partitioned",
    """SELECT o_orderkey AS id, o_orderdate AS timestamp, o_orderpriority AS title FROM orders""",
)
def sink_partitioned(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    rows = ad.metadata(spark, sf_dir).select("id", "timestamp", "title")
    sinks.write_by(rows, path, "title", kind="parquet")
    return spark.read.parquet(path).select("id", "timestamp", "title")


@query(
    "sink_csv_roundtrip",
    f"""WITH {LINES}
SELECT to_id, CAST(date AS VARCHAR) AS date, CAST(sum(length(text)) AS BIGINT) AS text_length
FROM lines GROUP BY ALL""",
)
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    sinks.write_csv(revisions.revision_chars(ad.content(spark, sf_dir)), path)
    return landed.read_csv(spark, path, "to_id string, date string, text_length long")


@query(
    "lexicon_csv_roundtrip",
    r"""SELECT DISTINCT regexp_replace(lower(w), '[^a-zA-Z]', '', 'g') AS word
FROM (SELECT unnest(string_split_regex(text, '[\s\x0b]+')) AS w FROM benchmark)
WHERE regexp_replace(lower(w), '[^a-zA-Z]', '', 'g') <> ''""",
)
def lexicon_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "lexicon")
    sinks.write_lexicon(ad.lexicon(spark, sf_dir), path)
    return lexicon.build_lexicon(landed.read_lexicon(spark, path))


@query(
    "sink_append_dedupe",
    "SELECT o_orderkey AS id, count(*) AS copies, o_orderdate AS timestamp FROM orders "
    "GROUP BY o_orderkey, o_orderdate",
)
def sink_append_dedupe(spark, sf_dir):
    """Records appended twice, as after a repeated run, count once when read."""
    path = scratch_path(spark, "append")
    rows = _meta_records(spark, sf_dir)
    sinks.append_json(rows, path)
    saved = sinks.append_counted(rows, path)
    once = revisions.metadata_times(landed.read_metadata(spark, path))
    total = once.agg(F.count("*")).scalar()
    return once.select("id", "timestamp", (F.lit(saved) / total).cast("long").alias("copies"))


@query("title_list_roundtrip", "SELECT DISTINCT c_name AS title FROM customer")
def title_list_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "titles")
    sinks.write_lines(ad.table(spark, sf_dir, "customer"), "c_name", path)
    return spark.read.text(path).select(F.col("value").alias("title")).distinct()


@query("title_json_roundtrip", "SELECT c_name AS title FROM customer")
def title_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "title-list")
    sinks.write_json_list(ad.table(spark, sf_dir, "customer"), "c_name", path)
    return landed.read_json_list(spark, path)


@query("revision_ids", "SELECT DISTINCT o_orderkey AS id FROM orders")
def revision_ids(spark, sf_dir):
    """Ids of metadata that was landed twice."""
    path = scratch_path(spark, "ids")
    for _ in range(2):
        sinks.append_json(_meta_records(spark, sf_dir), path)
    return landed.revision_ids(landed.read_metadata(spark, path))


# Payloads -------------------------------------------------------------------


@query(
    "flatten_array_payload",
    r"""SELECT conv_id, turn, article, length(article) AS views
FROM (SELECT conv_id, turn, unnest(string_split_regex(text, '[\s\x0b]+')) AS article
      FROM conversations)""",
)
def flatten_array_payload(spark, sf_dir):
    words = F.split("text", r"\s+")
    articles = F.transform(
        words, lambda w: F.struct(w.alias("article"), F.length(w).alias("views"))
    )
    body = F.struct(F.array(F.struct(articles.alias("articles"))).alias("items"))
    payloads = ad.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.to_json(body).alias("payload")
    )
    return landed.top_views(payloads)


@query(
    "flatten_page_views",
    """SELECT CAST(user_id AS VARCHAR) AS article, strftime(ts, '%Y%m%d') || '00' AS timestamp,
       CAST(round(value * 100) AS BIGINT) AS views FROM events""",
)
def flatten_page_views(spark, sf_dir):
    item = F.struct("article", "timestamp", "views")
    payloads = ad.event_views(spark, sf_dir).select(
        F.to_json(F.struct(F.array(item).alias("items"))).alias("payload")
    )
    return landed.page_views(payloads)


@query(
    "flatten_registrations",
    """SELECT CAST(date_trunc('month', f) AS TIMESTAMP) AS timestamp, count(*) AS new_users
FROM (SELECT o_custkey, min(o_orderdate) AS f FROM orders GROUP BY 1) GROUP BY 1""",
)
def flatten_registrations(spark, sf_dir):
    from driftline.operators.activity import new_users_monthly

    monthly = new_users_monthly(ad.metadata(spark, sf_dir))
    result = F.struct(
        _iso("month").alias("timestamp"), F.col("new_users").alias("new_registered_users")
    )
    item = F.struct(F.array(result).alias("results"))
    payloads = monthly.select(
        F.to_json(F.struct(F.array(item).alias("items"))).alias("payload")
    )
    return landed.registrations(payloads)


@query(
    "flatten_category_members",
    """SELECT r_name AS category, 'Category:' || n_name AS member, TRUE AS is_subcat
FROM region JOIN nation ON n_regionkey = r_regionkey
UNION ALL
SELECT n_name, s_name, FALSE FROM nation JOIN supplier ON s_nationkey = n_nationkey
UNION ALL
SELECT n_name, c_name, FALSE FROM nation JOIN customer ON c_nationkey = n_nationkey""",
)
def flatten_category_members(spark, sf_dir):
    one = F.array(F.struct(F.col("member").alias("title")))
    body = F.struct(F.struct(one.alias("categorymembers")).alias("query"))
    payloads = ad.edges(spark, sf_dir).select("category", F.to_json(body).alias("payload"))
    return landed.category_members(payloads)


@query(
    "flatten_map_payload",
    """SELECT CAST(page_id AS VARCHAR) AS page_id, url AS title,
       CASE WHEN contains(url, '?') THEN 'No content available' ELSE html END AS text FROM pages""",
)
def flatten_map_payload(spark, sf_dir):
    return landed.page_texts(_page_payloads(spark, sf_dir))


def _page_payloads(spark, sf_dir):
    pages = ad.table(spark, sf_dir, "pages")
    slot = F.struct(F.struct(F.struct(F.col("html").alias("content")).alias("main")).alias("slots"))
    page = F.struct(
        F.col("url").alias("title"),
        F.when(~F.col("url").contains("?"), F.array(slot)).alias("revisions"),
    )
    body = F.struct(
        F.struct(F.create_map(F.col("page_id").cast("string"), page).alias("pages")).alias("query")
    )
    return pages.select(F.to_json(body).alias("payload"))


# Payloads of several elements, one for each word of a turn.
TURN_WORDS = r"""w AS (SELECT conv_id, turn, u.word, u.i FROM conversations,
  LATERAL (SELECT unnest(ws) AS word, unnest(range(len(ws))) AS i
           FROM (SELECT string_split_regex(text, '[\s\x0b]+') AS ws)) u WHERE text IS NOT NULL)"""


def _turn_payloads(spark, sf_dir, element, around, *keep):
    """A payload for each turn: ``around`` the array of ``element(word, number)``."""
    elements = F.transform(F.split("text", r"\s+"), element)
    turns = ad.table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    return turns.select(*keep, F.to_json(around(elements)).alias("payload"))


@query(
    "flatten_page_views_many",
    f"""WITH {TURN_WORDS}
SELECT conv_id, turn, word AS article, CAST(2024010100 + i AS VARCHAR) AS timestamp,
       length(word) AS views FROM w""",
)
def flatten_page_views_many(spark, sf_dir):
    def item(word, i):
        stamp = (F.lit(2024010100) + i).cast("string")
        return F.struct(
            word.alias("article"), stamp.alias("timestamp"), F.length(word).alias("views")
        )

    payloads = _turn_payloads(
        spark, sf_dir, item, lambda items: F.struct(items.alias("items")), "conv_id", "turn"
    )
    return landed.page_views(payloads)


@query(
    "flatten_registrations_many",
    f"""WITH {TURN_WORDS}
SELECT conv_id, turn, TIMESTAMP '2024-01-01' + to_days(CAST(i AS INTEGER)) AS timestamp,
       length(word) AS new_users FROM w""",
)
def flatten_registrations_many(spark, sf_dir):
    def result(word, i):
        day = F.date_add(F.lit("2024-01-01").cast("date"), i)
        return F.struct(
            _iso(day).alias("timestamp"), F.length(word).alias("new_registered_users")
        )

    def around(results):
        return F.struct(F.array(F.struct(results.alias("results"))).alias("items"))

    payloads = _turn_payloads(spark, sf_dir, result, around, "conv_id", "turn")
    return landed.registrations(payloads)


@query(
    "flatten_category_members_many",
    f"""WITH {TURN_WORDS}
SELECT conv_id || '/' || turn AS category, word AS member, FALSE AS is_subcat FROM w
UNION ALL SELECT conv_id || '/' || turn, 'Category:' || word, TRUE FROM w""",
)
def flatten_category_members_many(spark, sf_dir):
    def around(titles):
        sub = F.transform(titles, lambda t: F.struct(F.concat(F.lit("Category:"), t["title"]).alias("title")))
        both = F.concat(titles, sub).alias("categorymembers")
        return F.struct(F.struct(both).alias("query"))

    name = F.concat_ws("/", "conv_id", "turn").alias("category")
    payloads = _turn_payloads(
        spark, sf_dir, lambda word: F.struct(word.alias("title")), around, name
    )
    return landed.category_members(payloads)


@query(
    "flatten_pages_many",
    f"""WITH {TURN_WORDS}
SELECT conv_id || '/' || turn || '/' || i AS page_id, word AS title,
       CASE WHEN i % 3 = 2 THEN 'No content available' ELSE word END AS text FROM w""",
)
def flatten_pages_many(spark, sf_dir):
    def entry(word, i):
        main = F.struct(word.alias("content")).alias("main")
        revision = F.struct(F.struct(main).alias("slots"))
        page = F.struct(
            word.alias("title"), F.when(i % 3 != 2, F.array(revision)).alias("revisions")
        )
        return F.struct(F.concat_ws("/", "conv_id", "turn", i).alias("key"), page.alias("value"))

    def around(entries):
        pages = F.map_from_entries(entries).alias("pages")
        return F.struct(F.struct(pages).alias("query"))

    return landed.page_texts(_turn_payloads(spark, sf_dir, entry, around))


@query(
    "flatten_revisions_many",
    f"""WITH {TURN_WORDS}
SELECT conv_id || '/' || turn AS title, i AS id, word AS user,
       CASE WHEN i % 2 = 0 THEN word ELSE '' END AS comment, '' AS content,
       TIMESTAMP '2024-01-01' + to_days(CAST(i AS INTEGER)) AS timestamp FROM w""",
)
def flatten_revisions_many(spark, sf_dir):
    path = scratch_path(spark, "listing-many")

    def entry(word, i):
        day = F.date_add(F.lit("2024-01-01").cast("date"), i)
        return F.struct(
            i.alias("id"), _iso(day).alias("timestamp"), word.alias("user"),
            F.when(i % 2 == 0, word).alias("comment"),
        )

    turns = ad.table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    records = turns.select(
        F.concat_ws("/", "conv_id", "turn").alias("title"),
        F.transform(F.split("text", r"\s+"), entry).alias("revisions"),
    )
    sinks.write_json(records, path)
    return landed.revision_listing(landed.read_json(spark, path, schemas.REVISION_LISTING))


@query(
    "page_summaries",
    """SELECT url AS title, substring(CASE WHEN contains(url, '?') THEN 'No content available'
                                      ELSE html END, 1, 500) AS summary FROM pages""",
)
def page_summaries(spark, sf_dir):
    return landed.page_summaries(_page_payloads(spark, sf_dir))


@query(
    "flatten_revision_listing",
    """SELECT CAST(conv_id AS VARCHAR) AS title, turn AS id, role AS user, '' AS comment,
       text AS content, TIMESTAMP '2024-01-01' + to_days(CAST(turn AS INTEGER)) AS timestamp
FROM conversations""",
)
def flatten_revision_listing(spark, sf_dir):
    path = scratch_path(spark, "listing")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int"))
    entry = F.struct(
        F.col("turn").alias("id"),
        _iso(day).alias("timestamp"),
        F.col("role").alias("user"),
        F.col("text").alias("content"),
    )
    records = ad.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("title"), F.array(entry).alias("revisions")
    )
    sinks.write_json(records, path)
    return landed.revision_listing(landed.read_json(spark, path, schemas.REVISION_LISTING))


def _diff_payloads(spark, sf_dir):
    """Conversation turns as diffs; a turn of a single line has none."""
    lines = F.split("text", "\n")
    hunks = F.transform(
        lines, lambda line, i: F.struct(F.lit(1).alias("type"), i.alias("lineNumber"),
                                        line.alias("text"))
    )
    body = F.struct(F.when(F.size(lines) > 1, hunks).alias("diff"))
    return ad.history(spark, sf_dir).select(
        (F.col("id") - 1).alias("from_id"),
        F.col("id").alias("to_id"),
        "title",
        F.to_date("timestamp").cast("string").alias("date"),
        F.to_json(body).alias("payload"),
    )


@query(
    "flatten_diff",
    """SELECT CAST(turn - 1 AS VARCHAR) AS from_id, CAST(turn AS VARCHAR) AS to_id,
       CAST(conv_id AS VARCHAR) AS title,
       CAST(DATE '2024-01-01' + CAST(turn AS INTEGER) AS VARCHAR) AS date,
       generate_subscripts(string_split(text, chr(10)), 1) - 1 AS piece,
       unnest(string_split(text, chr(10))) AS text
FROM conversations WHERE contains(text, chr(10))""",
)
def flatten_diff(spark, sf_dir):
    return landed.diff_pieces(_diff_payloads(spark, sf_dir))


@query(
    "flatten_diff_rejected",
    """SELECT CAST(conv_id AS VARCHAR) AS title, turn AS to_id
FROM conversations WHERE NOT contains(text, chr(10))""",
)
def flatten_diff_rejected(spark, sf_dir):
    return landed.diffless(_diff_payloads(spark, sf_dir)).select("title", "to_id")


# Incremental ----------------------------------------------------------------


def _orders_stream(spark, sf_dir):
    schema = ad.table(spark, sf_dir, "orders").schema
    # A pattern, so that the table may be one file or a folder of files.
    return ingest.arriving(spark, f"{sf_dir}/orders*.parquet", schema, "parquet")


@query("stream_ingest", "SELECT o_orderkey, o_orderdate FROM orders")
def stream_ingest(spark, sf_dir):
    base = scratch_path(spark, "ingest")
    stream = _orders_stream(spark, sf_dir).select("o_orderkey", "o_orderdate")
    ingest.land_new_files(stream, f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table")


@query("stream_dedupe", "SELECT DISTINCT o_custkey FROM orders")
def stream_dedupe(spark, sf_dir):
    base = scratch_path(spark, "dedupe")
    stream = _orders_stream(spark, sf_dir).select("o_custkey", "o_orderdate")
    ingest.without_repeats(
        stream, "o_custkey", "o_orderdate", "36500 days", f"{base}/table", f"{base}/checkpoint"
    )
    return spark.read.parquet(f"{base}/table").select("o_custkey")


@query(
    "stream_windowed_counts",
    """SELECT CAST(floor(epoch(o_orderdate) / 2592000) * 2592000 AS BIGINT) AS start_second,
       count(*) AS n FROM orders GROUP BY 1""",
)
def stream_windowed_counts(spark, sf_dir):
    base = scratch_path(spark, "windows")
    stream = _orders_stream(spark, sf_dir).select("o_orderdate")
    ingest.windowed_counts(
        stream, "o_orderdate", "30 days", "36500 days", f"{base}/updates", f"{base}/checkpoint"
    )
    counts = ingest.latest_counts(spark, f"{base}/updates")
    return counts.select(F.unix_timestamp("start").alias("start_second"), "n")


@query(
    "stream_closed_windows",
    """WITH w AS (
  SELECT CAST(floor(epoch(o_orderdate) / 2592000) * 2592000 AS BIGINT) AS start_second,
         count(*) AS n FROM orders GROUP BY 1)
SELECT start_second, start_second + 2592000 AS end_second, n FROM w
WHERE start_second + 2592000 <= (SELECT epoch(max(o_orderdate)) - 864000 FROM orders)""",
)
def stream_closed_windows(spark, sf_dir):
    """Older orders arrive first; the rest comes with a file of late repeats of them,
    after a restart. A third run finds nothing new."""
    base = scratch_path(spark, "closed")
    orders = ad.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    newer = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    late = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    files = [[orders.where(~newer)], [orders.where(newer), orders.where(late)], []]
    for arrived in files:
        for part in arrived:
            part.write.mode("append").parquet(f"{base}/files")
        stream = ingest.arriving(spark, f"{base}/files", orders.schema, "parquet")
        ingest.closed_windows(
            stream, "o_orderdate", "30 days", "10 days", f"{base}/table", f"{base}/checkpoint"
        )
    return spark.read.parquet(f"{base}/table").select(
        F.unix_timestamp("start").alias("start_second"),
        F.unix_timestamp("end").alias("end_second"), "n",
    )


BURSTS = """runs AS (
  SELECT user_id, ts, sum(CASE WHEN ts - before <= INTERVAL 6 HOUR THEN 0 ELSE 1 END)
           OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)),
bursts AS (
  SELECT user_id AS user, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS stop_us,
         count(*) AS edits
  FROM runs GROUP BY user_id, run HAVING count(*) >= 3)"""


def _burst_columns(bursts):
    return bursts.select(
        "user", F.unix_micros("start").alias("start_us"), F.unix_micros("stop").alias("stop_us"),
        "edits",
    )


@query("edit_bursts", f"WITH {BURSTS} SELECT user, start_us, stop_us, edits FROM bursts")
def edit_bursts(spark, sf_dir):
    instant = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    events = ad.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("user"), instant.alias("timestamp")
    )
    return _burst_columns(activity.edit_bursts(events, "6 hours", 3))


@query(
    "stream_edit_bursts",
    f"""WITH {BURSTS} SELECT user, start_us, stop_us, edits FROM bursts
WHERE stop_us + 21600000000 <= (SELECT epoch_us(max(ts)) // 1000 * 1000 - 3600000000 FROM events)""",
)
def stream_edit_bursts(spark, sf_dir):
    base = scratch_path(spark, "bursts")
    schema = ad.table(spark, sf_dir, "events").schema
    events = ingest.arriving(spark, f"{sf_dir}/events*.parquet", schema, "parquet").select(
        F.col("user_id").alias("user"), F.col("ts").alias("timestamp")
    )
    ingest.closed_bursts(events, "6 hours", 3, "1 hour", f"{base}/table", f"{base}/checkpoint")
    return _burst_columns(spark.read.parquet(f"{base}/table"))
