"""The registered queries of the corpus operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import (
    best_position,
    block_naming,
    bpe_codec,
    class_lm,
    golay,
    lang_mixture,
    packing,
    piece_codec,
    prefix_forest,
    tool_calls,
    turn_trie,
    url_trie,
    warc,
)
from driftline.llm.common import crc32_of_id, stored, table
from driftline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


@query("op1_lang_mixture")
def op1_lang_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_of_id(F.col("doc_id")) % 3 == 1
    model = lang_mixture.train(docs.where(~held_out))
    judged = docs.select(
        "doc_id", held_out.alias("held_out"), lang_mixture.predicted(docs, model).alias("p")
    )
    return judged.select("doc_id", "held_out", "p.*")


@query("op2_prefix_forest")
def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5
    )


TOOLS = (
    tool_calls.Parameter("search", "query", "string", True),
    tool_calls.Parameter("search", "limit", "integer", True),
    tool_calls.Parameter("translate", "text", "string", True),
    tool_calls.Parameter("translate", "target", "string", True),
    tool_calls.Parameter("measure", "text", "string", True),
    tool_calls.Parameter("measure", "length", "number", False),
    tool_calls.Parameter("measure", "strict", "boolean", False),
)


def _tool_chat(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as the turns imply them.

    Every assistant turn is a call about its whole text, and the user turn after
    it is the result. Calls depend on the call at half their turn. The tool and
    the arguments follow from the turn, some against the tool's schema.
    """
    text, turn = F.coalesce("text", F.lit("")), F.col("turn")
    call_id = lambda t: F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), t)
    name = F.element_at(
        F.array(*map(F.lit, ("search", "translate", "measure", "archive"))),
        (F.floor(turn / 2) % 4 + 1).cast("int"),
    )
    arguments = (
        F.when(F.col("name") == "search", F.to_json(F.struct(
            text.alias("query"), F.length(text).alias("limit"))))
        .when((F.col("name") == "translate") & text.contains("\n"), F.to_json(F.struct(
            text.alias("text"), F.lit("en").alias("target"))))
        .when(F.col("name") == "translate", F.to_json(F.struct(
            text.alias("text"), F.lit("en").alias("language"))))
        .otherwise(F.to_json(F.struct(
            text.alias("text"), (F.length(text) > 500).alias("strict"),
            F.length(text).cast("string").alias("length"))))
    )
    calls = (
        conversations.where("role = 'assistant'")
        .withColumn("name", name)
        .select(
            "conv_id",
            call_id(turn).alias("call_id"),
            "turn",
            "name",
            arguments.alias("arguments"),
            F.when(turn > 1, F.array(call_id(F.floor(turn / 2))))
            .otherwise(F.array().cast("array<string>"))
            .alias("after"),
        )
    )
    results = conversations.where("role = 'user' AND turn > 0").select(
        "conv_id", call_id(turn - 1).alias("call_id"), "turn", text.alias("content")
    )
    return calls, results


@query(
    "op3_tool_calls",
    r"""
    WITH RECURSIVE calls AS (
        SELECT conv_id, 'call-' || conv_id || '-' || turn AS call_id, turn, coalesce(text, '') AS t,
               ['search', 'translate', 'measure', 'archive'][1 + (turn // 2) % 4] AS name
        FROM conversations WHERE role = 'assistant'
    ), results AS (
        SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, turn AS result_turn,
               coalesce(text, '') AS result
        FROM conversations WHERE role = 'user' AND turn > 0
    ), chained AS (
        SELECT c.conv_id, c.turn, 0 AS level FROM calls c
        WHERE c.turn <= 1 OR NOT EXISTS (
            SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn // 2)
        UNION ALL
        SELECT c.conv_id, c.turn, h.level + 1 FROM chained h JOIN calls c
        ON c.conv_id = h.conv_id AND c.turn // 2 = h.turn AND c.turn > 1
    ), made AS (
        SELECT *, CASE
            WHEN name = 'search' THEN
                json_object('limit', length(t), 'query', t)
            WHEN name = 'translate' AND contains(t, chr(10)) THEN
                json_object('target', 'en', 'text', t)
            WHEN name = 'translate' THEN json_object('language', 'en', 'text', t)
            ELSE json_object('length', length(t)::VARCHAR, 'strict', length(t) > 500, 'text', t)
        END AS arguments, CASE
            WHEN name = 'archive' THEN ['unknown tool']
            WHEN name = 'measure' THEN ['wrong type length']
            WHEN name = 'translate' AND NOT contains(t, chr(10)) THEN
                ['missing target', 'unexpected language']
            ELSE [] END AS argued
        FROM calls
    ), linked AS (
        SELECT coalesce(m.conv_id, r.conv_id) AS conv_id, coalesce(m.call_id, r.call_id) AS call_id,
               m.name, m.turn, r.result_turn, h.level, m.name IS NOT NULL AND m.argued = [] AS valid,
               list_concat(coalesce(m.argued, []), list_filter([
                   CASE WHEN m.name IS NULL THEN 'result without call' END,
                   CASE WHEN m.name IS NOT NULL AND r.call_id IS NULL THEN 'no result' END,
                   CASE WHEN m.turn > 1 AND NOT EXISTS (
                       SELECT 1 FROM calls p
                       WHERE p.conv_id = m.conv_id AND p.turn = m.turn // 2
                   ) THEN 'unknown dependency' END], lambda x: x IS NOT NULL)) AS problems,
               CAST(json_object('arguments', m.arguments,
                    'call_id', coalesce(m.call_id, r.call_id),
                    'name', m.name, 'result', r.result) AS VARCHAR) AS message
        FROM made m FULL OUTER JOIN results r ON m.conv_id = r.conv_id AND m.call_id = r.call_id
        LEFT JOIN chained h ON h.conv_id = m.conv_id AND h.turn = m.turn
    )
    SELECT conv_id, call_id, name, turn, result_turn, level, row_number() OVER (
               PARTITION BY conv_id
               ORDER BY level NULLS LAST, coalesce(turn, result_turn), call_id) AS position,
           valid, array_to_string(problems, '; ') AS problems, message
    FROM linked
    """,
)
def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = _tool_chat(table(spark, sf_dir, "conversations"))
    linked = tool_calls.link(calls, results, TOOLS)
    return linked.withColumn("problems", F.array_join("problems", "; "))


@query(
    "op4_warc_segments",
    r"""
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
               sha1(coalesce(html, '')) AS digest
        FROM pages
    ), coded AS (
        SELECT page_id, payload_bytes, digest, list_aggregate(list_transform(range(32), lambda i:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
                ('0x' || substr(digest, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))
            ) & 31)::INTEGER, 1)), 'string_agg', '') AS payload_digest
        FROM p
    ), held AS (
        SELECT *, max(page_id) OVER (PARTITION BY digest, payload_bytes) AS holder FROM coded
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> holder THEN holder END AS refers_to
    FROM held
    """,
)
def op4_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url", F.encode("html", "UTF-8").alias("payload")
    )
    path = scratch_path(spark, "archives")
    warc.write_archives(pages, path, least=0)
    read = warc.read_payloads(spark, path)
    page = lambda c: warc.row_id(F.col(c)).cast("long")
    rows = stored(
        read.select(
            page("record_id").alias("page_id"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.when(F.col("warc_type") == "revisit", F.col("digest"))
            .otherwise(warc.payload_digest(F.col("payload")))
            .alias("payload_digest"),
            F.col("warc_type").alias("record_type"),
            page("refers_to").alias("refers_to"),
            "record_id",
            F.col("refers_to").alias("refers_to_record"),
        ),
        "archived",
    )
    # A revisit has the length of what it refers to; the answering side is unique.
    held = rows.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("payload_bytes").alias("held_bytes")
    )
    return rows.join(held, "refers_to_record", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "held_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


@query("op6_class_lm")
def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_of_id(F.col("doc_id")) % 7 == 2
    model, vocabulary = class_lm.train(docs.where(~held_out))
    scored = class_lm.score(docs, model, vocabulary)
    return scored.withColumn("held_out", held_out)


URL_RULES = (
    url_trie.Rule("block", "net", "/"),
    url_trie.Rule("allow", "example.net", "/en/"),
    url_trie.Rule("block", "example.com", "/de/"),
    url_trie.Rule("allow", "org", "/fr/"),
)


@query(
    "op7_url_trie",
    r"""
    WITH cut AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0
                             THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parts AS (
        SELECT page_id,
               translate(regexp_extract(rest, '^[^/?#]*', 0),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut
    ), ruled AS (
        SELECT *, CASE
            WHEN (host = 'example.net' OR host LIKE '%.example.net')
                 AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com')
                 AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        END AS rule FROM parts
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled
    """,
)
def op7_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_trie.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op10_block_naming",
    r"""
    WITH n AS (
        SELECT doc_id,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
        FROM documents
    ), g AS (
        SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size, sha256(body) AS text_sha256
        FROM n
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
)
def op10_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op5_golay_simhash")
def op5_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = golay.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)
    return groups.select("doc_id", golay.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


@query("op8_bpe_two_tier")
def op8_bpe_two_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_codec.round_trip_digests(
        table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN
    )


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary)


@query(
    "op12_turn_trie",
    r"""
    WITH t AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
               length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS k,
               octet_length(encode(coalesce(text, ''))) AS bytes
        FROM conversations WHERE conv_id IS NOT NULL
    ), c AS (
        SELECT conv_id, conv_id - conv_id % 5 AS lender, xor(4294967295, list_reduce(
            list_concat([4294967295::BIGINT], flatten(list_transform(
                range(1, length(conv_id::VARCHAR) + 1), lambda i: list_concat(
                    [ascii(substr(conv_id::VARCHAR, i::INTEGER, 1))::BIGINT],
                    [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
            lambda r, x: CASE WHEN x >= 0 THEN xor(r, x)
                              WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END
        )) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM t)
    ), r AS (
        SELECT c.conv_id, 0 AS part, pos, k, bytes FROM c JOIN t ON t.conv_id = lender AND pos <= h
        UNION ALL
        SELECT c.conv_id, 1, pos, k, bytes FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
    ), seqs AS (
        SELECT c.conv_id, coalesce(ks, []) AS ks, coalesce(bs, []) AS bs FROM c LEFT JOIN (
            SELECT conv_id, list(k ORDER BY part, pos) AS ks, list(bytes ORDER BY part, pos) AS bs
            FROM r GROUP BY conv_id) USING (conv_id)
    ), members AS (
        SELECT conv_id, d AS depth, list_slice(ks, 1, d) AS p, bs, d = len(ks) AS ends
        FROM (SELECT conv_id, ks, bs, unnest(range(0, len(ks) + 1)) AS d FROM seqs)
    ), nodes AS (
        SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               max(CASE WHEN depth > 0 THEN bs[depth] ELSE 0 END) AS bytes,
               coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id),
                        '') AS ended
        FROM members GROUP BY p, depth
    ), kids AS (
        SELECT list_slice(p, 1, depth - 1) AS p, count(*) AS n_children FROM nodes WHERE depth > 0
        GROUP BY ALL
    ), above AS (
        SELECT list_slice(p, 1, a) AS p, (n_convs - 1) * bytes AS saved, n_children IS NULL AS leaf
        FROM (SELECT nodes.*, n_children, unnest(range(0, depth + 1)) AS a
              FROM nodes LEFT JOIN kids USING (p))
    ), sums AS (
        SELECT p, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves
        FROM above GROUP BY p
    )
    SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs,
           coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
           sha256(n.ended) AS ends_sha256
    FROM nodes n JOIN sums USING (p) LEFT JOIN kids USING (p)
    LEFT JOIN nodes up ON n.depth > 0 AND up.p = list_slice(n.p, 1, n.depth - 1)
    """,
)
def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lend = lambda c: (c - c % 5, crc32_of_id(c) % 9)
    convs, turns = turn_trie.rebuilt(table(spark, sf_dir, "conversations"), lend)
    return turn_trie.prefix_nodes(convs, turns)


@query("op13_piece_prefix_table")
def op13_piece_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.round_trip_digests(table(spark, sf_dir, "documents"), model)


@query(
    "op11_best_position",
    r"""
    WITH d AS (
        SELECT doc_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents
    ), q AS (
        SELECT item_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), asked AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL
    ), sizes AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL
    ), total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes
    ), held AS (
        SELECT doc_id, term, count(*) AS tf FROM d
        WHERE term IN (SELECT term FROM q) GROUP BY ALL
    ), weighed AS (
        SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))
                          AS BIGINT) AS w
        FROM held, total GROUP BY term, docs
    ), gains AS (
        SELECT doc_id, term, w * ((1000000000 * tf)
               // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // words)))) AS gain
        FROM held JOIN weighed USING (term) JOIN sizes USING (doc_id), total
    ), scored AS (
        SELECT item_id, doc_id, CAST(sum(times * gain) AS BIGINT) AS score
        FROM asked JOIN gains USING (term) GROUP BY ALL
    )
    SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
    QUALIFY row_number() OVER w <= 10
    """,
)
def op11_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.ranked(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10
    )
