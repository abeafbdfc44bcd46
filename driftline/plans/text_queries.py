"""Queries on revision text: lexicon, words, sentences, revisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions import text as tx
from driftline.operators import activity, lexicon, line_diff, revisions, sentences
from driftline.plans import adapters as ad
from driftline.plans.registry import query

# SQL building blocks. Pieces of a text are joined with white space, so most
# statements may work on the whole text, as an independent check.
DAY = "DATE '1995-01-01' + CAST(doc_id % 2400 AS INTEGER)"
LINES = f"""lines AS (
  SELECT CAST(doc_id AS VARCHAR) AS to_id, source AS title, {DAY} AS date,
         unnest(string_split(text, chr(10))) AS text,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS piece
  FROM documents)"""
CLEAN = r"regexp_replace(lower(text), '[^a-zA-Z\s\x0b]', '', 'g')"
SPACES = (
    r"'[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}]+'"
)
PUNCTUATED = r"regexp_replace(text, '[^\w\s\x0b.,!?]', ' ', 'g')"
UNICODE_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def _split_clean(source: str, key: str) -> str:
    return (
        f"SELECT {key}, unnest(string_split_regex({CLEAN}, '[\\s\\x0b]+')) AS word FROM {source}"
    )


def _sentences(text: str) -> str:
    return (
        rf"string_split(regexp_replace({text}, '([.!?]) +', '\1' || chr(1), 'g'), chr(1))"
    )


def _sentence_words(sentence: str) -> str:
    return (
        rf"len(list_filter(string_split_regex({sentence}, '[\s\x0b]+'), lambda w: w <> ''))"
    )


TALLY = f"""lex AS (SELECT DISTINCT word FROM ({_split_clean('benchmark', 'item_id')})
  WHERE word <> ''),
tally AS (
  SELECT d.doc_id,
         count(*) FILTER (WHERE t.word <> '' AND l.word IS NULL) AS misses,
         count(*) FILTER (WHERE t.word <> '' AND l.word IS NOT NULL) AS hits
  FROM documents d
  LEFT JOIN ({_split_clean('documents', 'doc_id')}) t ON t.doc_id = d.doc_id
  LEFT JOIN lex l ON l.word = t.word
  GROUP BY d.doc_id)"""
RAW_HITS = f"""raw_lex AS (
  SELECT DISTINCT lower(word) AS word
  FROM (SELECT unnest(string_split_regex(text, {SPACES})) AS word FROM benchmark)
  WHERE word <> ''),
raw_hits AS (
  SELECT d.doc_id, count(l.word) AS hits
  FROM documents d
  LEFT JOIN (SELECT doc_id, lower(unnest(string_split_regex(text, {SPACES}))) AS word
             FROM documents) t ON t.doc_id = d.doc_id
  LEFT JOIN raw_lex l ON l.word = t.word
  GROUP BY d.doc_id)"""
WORDS = r"unnest(string_split_regex(lower(text), '[\s\x0b]+')) AS word"


@query(
    "uncommon_growth",
    f"""WITH {TALLY}
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(sum(misses) AS BIGINT) AS total_uncommon_words
FROM tally JOIN orders ON o_orderkey = doc_id GROUP BY 1, 2 ORDER BY 1, 2""",
)
def uncommon_growth(spark, sf_dir):
    misses = lexicon.lexicon_misses(
        ad.content(spark, sf_dir), ad.metadata(spark, sf_dir), ad.lexicon(spark, sf_dir)
    )
    return lexicon.uncommon_growth(misses)


@query(
    "lexicon_misses",
    f"""WITH {TALLY}
SELECT doc_id AS to_id, o_orderdate AS timestamp, misses AS uncommon_word_count
FROM tally JOIN orders ON o_orderkey = doc_id""",
)
def lexicon_misses(spark, sf_dir):
    return lexicon.lexicon_misses(
        ad.content(spark, sf_dir), ad.metadata(spark, sf_dir), ad.lexicon(spark, sf_dir)
    )


def _hits(spark, sf_dir):
    return lexicon.lexicon_hits(
        ad.content(spark, sf_dir), ad.metadata(spark, sf_dir), ad.raw_lexicon(spark, sf_dir)
    )


@query(
    "lexicon_hits",
    f"""WITH {RAW_HITS}
SELECT doc_id AS to_id, o_orderdate AS timestamp, hits AS common_word_count
FROM raw_hits JOIN orders ON o_orderkey = doc_id""",
)
def lexicon_hits(spark, sf_dir):
    return _hits(spark, sf_dir)


@query(
    "max_hit_revision",
    rf"""WITH {RAW_HITS}
SELECT h.doc_id AS to_id, o_orderdate AS timestamp, hits AS common_word_count,
       CAST(len(string_split_regex(text, '[\s\x0b]+')) AS INTEGER) AS text_word_count,
       substring(replace(text, chr(10), ' '), 1, 100) AS truncated_text
FROM raw_hits h JOIN orders ON o_orderkey = h.doc_id JOIN documents d ON d.doc_id = h.doc_id
ORDER BY hits DESC, h.doc_id LIMIT 1""",
)
def max_hit_revision(spark, sf_dir):
    return lexicon.max_hit_revision(ad.content(spark, sf_dir), _hits(spark, sf_dir))


@query(
    "lexicon_build",
    f"""SELECT DISTINCT word FROM (
  SELECT regexp_replace(lower(word), '[^a-zA-Z]', '', 'g') AS word FROM (
    SELECT unnest(string_split_regex(text, {SPACES})) AS word FROM benchmark
    UNION ALL
    SELECT unnest(string_split_regex(text, {SPACES})) AS word FROM conversations))
WHERE word <> '' ORDER BY word""",
)
def lexicon_build(spark, sf_dir):
    return lexicon.build_lexicon(
        ad.listed_words(spark, sf_dir, "benchmark"), ad.listed_words(spark, sf_dir, "conversations")
    ).orderBy("word")


@query(
    "word_counts",
    f"""SELECT word, count(*) AS count
FROM (SELECT {WORDS} FROM documents JOIN orders ON o_orderkey = doc_id) GROUP BY word""",
)
def word_counts(spark, sf_dir):
    return lexicon.word_counts(ad.content(spark, sf_dir), ad.metadata(spark, sf_dir))


@query(
    "word_counts_by_title",
    f"""SELECT source AS title, word, count(*) AS count,
       CAST(grouping(source) AS INTEGER) AS all_titles
FROM (SELECT source, {WORDS} FROM documents JOIN orders ON o_orderkey = doc_id)
GROUP BY GROUPING SETS ((source, word), (word))""",
)
def word_counts_by_title(spark, sf_dir):
    return lexicon.word_counts_by_title(ad.content(spark, sf_dir), ad.metadata(spark, sf_dir))


@query(
    "top_words",
    f"""SELECT word, count(*) AS count
FROM (SELECT {WORDS} FROM documents JOIN orders ON o_orderkey = doc_id)
GROUP BY word ORDER BY count DESC, word""",
)
def top_words(spark, sf_dir):
    counts = lexicon.word_counts(ad.content(spark, sf_dir), ad.metadata(spark, sf_dir))
    return lexicon.top_words(counts)


@query(
    "uncommonness",
    f"""WITH w AS (SELECT unnest({UNICODE_WORDS}) AS word FROM benchmark),
f AS (SELECT word, count(*) / (SELECT count(*) FROM w) AS freq FROM w GROUP BY word)
SELECT d.doc_id AS to_id, round(avg(1 / coalesce(freq, 0.00001)) FILTER (WHERE t.word <> ''), 4)
         AS uncommon_index
FROM documents d
JOIN orders ON o_orderkey = d.doc_id
LEFT JOIN (SELECT doc_id, unnest({UNICODE_WORDS}) AS word FROM documents) t
  ON t.doc_id = d.doc_id
LEFT JOIN f ON f.word = t.word
GROUP BY d.doc_id""",
)
def uncommonness(spark, sf_dir):
    scored = lexicon.uncommonness(
        ad.content(spark, sf_dir), ad.frequencies(spark, sf_dir), ad.metadata(spark, sf_dir)
    )
    return scored.withColumn("uncommon_index", F.round("uncommon_index", 4))


@query(
    "lexicon_sentiment",
    f"""WITH side AS (
  SELECT CASE role WHEN 'assistant' THEN 1 WHEN 'user' THEN -1 ELSE 0 END AS s,
         unnest({UNICODE_WORDS}) AS word FROM conversations),
weights AS (SELECT word, CAST(sign(sum(s)) AS BIGINT) AS weight FROM side GROUP BY word)
SELECT d.doc_id AS to_id, CAST(coalesce(sum(weight), 0) AS BIGINT) AS total_weight,
       count(t.word) AS words,
       round(coalesce(sum(weight), 0) / nullif(count(t.word), 0), 6) AS score
FROM documents d
LEFT JOIN (SELECT doc_id, unnest({UNICODE_WORDS}) AS word FROM documents) t
  ON t.doc_id = d.doc_id
LEFT JOIN weights w ON w.word = t.word
GROUP BY d.doc_id""",
)
def lexicon_sentiment(spark, sf_dir):
    scored = lexicon.lexicon_score(ad.content(spark, sf_dir), ad.word_weights(spark, sf_dir))
    return scored.select(
        F.col("id").alias("to_id"), "total_weight", "words", F.round("score", 6).alias("score")
    )


# Sentences ------------------------------------------------------------------


@query("clean_text", f"SELECT doc_id, {PUNCTUATED} AS text FROM documents")
def clean_text(spark, sf_dir):
    return ad.documents(spark, sf_dir).select("doc_id", tx.punctuated(F.col("text")).alias("text"))


@query(
    "token_counts",
    rf"""SELECT doc_id,
  CAST(len(list_filter(string_split_regex({CLEAN}, '[\s\x0b]+'), lambda w: w <> '')) AS INTEGER)
    AS clean_words,
  CAST(len(list_filter(string_split_regex(text, {SPACES}), lambda w: w <> '')) AS INTEGER)
    AS raw_words,
  CAST(len(string_split_regex(lower(text), '[\s\x0b]+')) AS INTEGER) AS spaced_words,
  CAST(len({UNICODE_WORDS}) AS INTEGER) AS unicode_words
FROM documents""",
)
def token_counts(spark, sf_dir):
    text = F.col("text")
    return ad.documents(spark, sf_dir).select(
        "doc_id",
        F.size(tx.clean_words(text)).alias("clean_words"),
        F.size(tx.raw_words(text)).alias("raw_words"),
        F.size(tx.spaced_words(text)).alias("spaced_words"),
        F.size(tx.unicode_words(text)).alias("unicode_words"),
    )


@query(
    "sentence_split",
    f"""WITH {LINES}
SELECT to_id, CAST(piece AS INTEGER) AS piece,
       CAST(generate_subscripts({_sentences('text')}, 1) - 1 AS INTEGER) AS position,
       unnest({_sentences('text')}) AS sentence
FROM lines""",
)
def sentence_split(spark, sf_dir):
    return ad.content(spark, sf_dir).select(
        "to_id", "piece", F.posexplode(tx.sentences(F.col("text"))).alias("position", "sentence")
    )


@query(
    "valid_sentence_filter",
    rf"""WITH {LINES}
SELECT to_id, CAST(piece AS INTEGER) AS piece, text FROM lines
WHERE regexp_matches(text, '[a-zA-Z0-9]+.*[.!?]\n?$')""",
)
def valid_sentence_filter(spark, sf_dir):
    return sentences.valid_sentences(ad.content(spark, sf_dir)).select("to_id", "piece", "text")


@query(
    "sentence_stats",
    f"""WITH {LINES},
cleaned AS (SELECT to_id, date, {PUNCTUATED} AS text FROM lines),
cut AS (SELECT to_id, date, unnest({_sentences('text')}) AS s FROM cleaned WHERE text <> ''),
counts AS (SELECT to_id, date, {_sentence_words('s')} AS n FROM cut),
sums AS (SELECT to_id, date, count(*) AS c, sum(n) AS s, sum(n * n) AS q
         FROM counts GROUP BY to_id, date)
SELECT to_id, date, round(s / c, 6) AS avg_word_count,
       round(CAST(c * q - s * s AS DOUBLE) / nullif(c * (c - 1), 0), 6) AS variance,
       round(CAST(c * q - s * s AS DOUBLE) / nullif((c - 1) * s, 0), 6) AS relative_variance
FROM sums""",
)
def sentence_stats(spark, sf_dir):
    stats = sentences.sentence_stats(ad.content(spark, sf_dir))
    rounded = {
        name: F.round(name, 6) for name in ("avg_word_count", "variance", "relative_variance")
    }
    return stats.withColumns(rounded)


@query(
    "sentence_count_avg",
    rf"""WITH {LINES},
cleaned AS (SELECT to_id, piece, {PUNCTUATED} AS text FROM lines),
valid AS (SELECT * FROM cleaned WHERE regexp_matches(text, '[a-zA-Z0-9]+.*[.!?]\n?$')),
cut AS (SELECT to_id, piece, unnest({_sentences('text')}) AS s FROM valid)
SELECT to_id, CAST(piece AS INTEGER) AS piece, CAST(count(*) AS INTEGER) AS sentence_count,
       round(avg({_sentence_words('s')}), 6) AS avg_sentence_length
FROM cut GROUP BY to_id, piece""",
)
def sentence_count_avg(spark, sf_dir):
    rows = ad.content(spark, sf_dir).select("to_id", "piece", "text")
    return sentences.sentence_count_avg(rows).withColumn(
        "avg_sentence_length", F.round("avg_sentence_length", 6)
    )


# Revisions ------------------------------------------------------------------


@query(
    "rev_content_join",
    f"""WITH {LINES}
SELECT CAST(to_id AS BIGINT) AS id, CAST(piece AS INTEGER) AS piece, o_orderdate AS timestamp, text
FROM lines JOIN orders ON o_orderkey = CAST(to_id AS BIGINT)""",
)
def rev_content_join(spark, sf_dir):
    joined = revisions.revision_content(ad.content(spark, sf_dir), ad.metadata(spark, sf_dir))
    return joined.select("id", "piece", "timestamp", "text")


@query(
    "revision_text",
    """SELECT doc_id AS to_id, o_orderdate AS timestamp, replace(text, chr(10), ' ') AS full_text
FROM documents JOIN orders ON o_orderkey = doc_id""",
)
def revision_text(spark, sf_dir):
    return revisions.revision_text(ad.content(spark, sf_dir), ad.metadata(spark, sf_dir))


@query(
    "revision_chars",
    f"""WITH {LINES}
SELECT to_id, date, CAST(sum(length(text)) AS BIGINT) AS text_length
FROM lines GROUP BY to_id, date""",
)
def revision_chars(spark, sf_dir):
    return revisions.revision_chars(ad.content(spark, sf_dir))


@query(
    "revisions_since",
    """SELECT o_orderkey AS id, o_orderdate AS timestamp, o_orderpriority AS title
FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'""",
)
def revisions_since(spark, sf_dir):
    late = revisions.revisions_since(ad.metadata(spark, sf_dir), "1998-01-01")
    return late.select("id", "timestamp", "title")


@query(
    "revisions_per_title",
    "SELECT o_orderpriority AS title, count(*) AS revisions FROM orders GROUP BY 1",
)
def revisions_per_title(spark, sf_dir):
    return revisions.revisions_per_title(ad.metadata(spark, sf_dir))


@query(
    "revision_pairs",
    """SELECT title, from_id, to_id, date FROM (
  SELECT o_orderpriority AS title, o_orderkey AS to_id, o_orderdate AS date,
         lag(o_orderkey) OVER (PARTITION BY o_orderpriority
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS from_id
  FROM orders) WHERE from_id IS NOT NULL""",
)
def revision_pairs(spark, sf_dir):
    return revisions.revision_pairs(ad.metadata(spark, sf_dir))


LINE_DIFF = """WITH v AS (
  SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before, text
  FROM conversations),
l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations),
c AS (SELECT conv_id, turn, line, count(*) AS n FROM l GROUP BY ALL),
pairs AS (SELECT conv_id, before, turn FROM v WHERE before IS NOT NULL),
news AS (SELECT p.conv_id, p.before, p.turn, line, n FROM pairs p
         JOIN c ON c.conv_id = p.conv_id AND c.turn = p.turn),
olds AS (SELECT p.conv_id, p.before, p.turn, line, n FROM pairs p
         JOIN c ON c.conv_id = p.conv_id AND c.turn = p.before)
SELECT CAST(coalesce(a.conv_id, b.conv_id) AS VARCHAR) AS title,
       coalesce(a.before, b.before) AS from_id, coalesce(a.turn, b.turn) AS to_id,
       coalesce(a.line, b.line) AS line, coalesce(a.n, 0) - coalesce(b.n, 0) AS change
FROM news a FULL JOIN olds b
  ON a.conv_id = b.conv_id AND a.turn = b.turn AND a.line = b.line
WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)"""


@query("revision_line_diff", LINE_DIFF)
def revision_line_diff(spark, sf_dir):
    return revisions.revision_line_diff(ad.history(spark, sf_dir))


@query("revision_hunks_net", LINE_DIFF)
def revision_hunks_net(spark, sf_dir):
    """Ordered hunks summed up by line, which must give the difference as bags."""
    hunks = line_diff.revision_hunks(ad.history(spark, sf_dir))
    change = F.sum(F.when(F.col("type") == line_diff.ADDED, 1).otherwise(-1))
    return (
        hunks.groupBy("title", "from_id", "to_id", F.col("text").alias("line"))
        .agg(change.alias("change"))
        .where(F.col("change") != 0)
    )


@query(
    "revision_rebuilt",
    """SELECT CAST(conv_id AS VARCHAR) AS title, turn AS id, coalesce(text, '') AS text
FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1""",
)
def revision_rebuilt(spark, sf_dir):
    history = ad.history(spark, sf_dir)
    return line_diff.rebuilt_texts(history, line_diff.revision_hunks(history))


@query(
    "worklist_anti",
    """SELECT DISTINCT c_name AS title FROM customer
WHERE c_name NOT IN (SELECT c_name FROM customer JOIN events ON user_id = c_custkey)""",
)
def worklist_anti(spark, sf_dir):
    customers = ad.table(spark, sf_dir, "customer")
    seen = ad.table(spark, sf_dir, "events").select("user_id").distinct()
    finished = customers.join(seen, customers["c_custkey"] == seen["user_id"], "left_semi")
    named = F.col("c_name").alias("title")
    return revisions.outstanding(customers.select(named), finished.select(named))


@query(
    "keyword_frequency",
    f"""WITH {LINES},
words AS (SELECT date_trunc('month', date) AS month, {UNICODE_WORDS} AS w FROM lines),
kw AS (SELECT unnest(['the', 'der', 'les', 'que']) AS keyword),
c AS (SELECT month, keyword, len(list_filter(w, lambda x: x = keyword)) AS n FROM words, kw)
SELECT CAST(month AS DATE) AS month, keyword, CAST(sum(n) AS BIGINT) AS occurrences,
       count(*) FILTER (WHERE n > 0) AS texts
FROM c GROUP BY ALL""",
)
def keyword_frequency(spark, sf_dir):
    return activity.keyword_frequency(ad.content(spark, sf_dir), ["the", "der", "les", "que"])


@query(
    "avg_edit_size",
    f"""WITH {LINES}
SELECT CAST(date_trunc('month', date) AS DATE) AS month,
       round(avg(length(text)), 6) AS avg_edit_size, count(*) AS edits
FROM lines GROUP BY 1""",
)
def avg_edit_size(spark, sf_dir):
    sizes = activity.avg_edit_size(ad.content(spark, sf_dir))
    return sizes.withColumn("avg_edit_size", F.round("avg_edit_size", 6))


@query(
    "phrase_overlap",
    f"""WITH w AS (SELECT doc_id, {UNICODE_WORDS} AS w FROM documents),
p AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS phrase
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w))
SELECT phrase, count(*) AS texts FROM p GROUP BY phrase HAVING count(*) >= 3""",
)
def phrase_overlap(spark, sf_dir):
    return activity.phrase_overlap(ad.documents(spark, sf_dir), words=5, at_least=3)


@query(
    "repeated_passages",
    f"""WITH d AS (SELECT doc_id, {UNICODE_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i - 1 AS pos, array_to_string(w[i : i + 4], ' ') AS phrase
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d)),
often AS (SELECT phrase FROM g GROUP BY phrase HAVING count(DISTINCT doc_id) >= 3),
kept AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run
         FROM g WHERE phrase IN (SELECT phrase FROM often)),
runs AS (SELECT doc_id, min(pos) AS start, count(*) + 4 AS words FROM kept GROUP BY doc_id, run)
SELECT r.doc_id, r.start AS "begin", r.words,
       array_to_string(list_slice(w, r.start + 1, r.start + r.words), ' ') AS passage
FROM runs r JOIN d ON d.doc_id = r.doc_id""",
)
def repeated_passages(spark, sf_dir):
    return activity.repeated_passages(ad.documents(spark, sf_dir), "doc_id", words=5, at_least=3)


@query(
    "phrase_frequency",
    f"""WITH b AS (SELECT {UNICODE_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT array_to_string(w[i : i + n - 1], ' ') AS phrase
      FROM (SELECT w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
            FROM (SELECT w, unnest([1, 2, 3]) AS n FROM b))),
{LINES},
l AS (SELECT row_number() OVER () AS line, CAST(date_trunc('month', date) AS DATE) AS month,
             {UNICODE_WORDS} AS w FROM lines),
g AS (SELECT line, month, array_to_string(w[i : i + n - 1], ' ') AS phrase
      FROM (SELECT line, month, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
            FROM (SELECT line, month, w, unnest([1, 2, 3]) AS n FROM l)))
SELECT month, phrase, count(*) AS occurrences, count(DISTINCT line) AS texts
FROM g WHERE phrase IN (SELECT phrase FROM p) GROUP BY month, phrase""",
)
def phrase_frequency(spark, sf_dir):
    """All sequences of one to three words of the benchmark texts as keywords."""
    told = ad.table(spark, sf_dir, "benchmark").select(tx.unicode_words(F.col("text")).alias("w"))
    every = F.concat(*[tx.word_sequences(F.col("w"), n) for n in (1, 2, 3)])
    phrases = told.where(F.size("w") > 0).select(F.explode(every).alias("phrase"))
    return activity.phrase_frequency(ad.content(spark, sf_dir), phrases)


ODDS = f"""c AS (
  SELECT word, count(*) FILTER (WHERE role = 'assistant') AS first,
         count(*) FILTER (WHERE role <> 'assistant') AS second
  FROM (SELECT role, unnest({UNICODE_WORDS}) AS word FROM conversations WHERE role IS NOT NULL)
  GROUP BY word),
t AS (SELECT sum(first) AS a, sum(second) AS b FROM c),
p AS (SELECT *, 1000.0::DOUBLE * (first + second) / (a + b) AS prior FROM c, t),
odds AS (
  SELECT word, first, second,
         ln((first + prior) / (a + 1000.0 - first - prior))
           - ln((second + prior) / (b + 1000.0 - second - prior)) AS log_odds,
         sqrt(1 / (first + prior) + 1 / (second + prior)) AS deviation FROM p)"""


def _odds(spark, sf_dir):
    turns = ad.table(spark, sf_dir, "conversations").select(
        (F.col("role") == "assistant").alias("is_first"),
        F.explode(tx.unicode_words(F.col("text"))).alias("word"),
    )
    return lexicon.log_odds_weights(turns)


@query(
    "log_odds_weights",
    f"""WITH {ODDS} SELECT word, first, second, round(log_odds, 6) AS log_odds,
       round(log_odds / deviation, 6) AS z FROM odds""",
)
def log_odds_weights(spark, sf_dir):
    return _odds(spark, sf_dir).withColumns(
        {c: F.round(c, 6) for c in ("log_odds", "z")}
    )


@query(
    "log_odds_scores",
    f"""WITH {ODDS},
d AS (SELECT doc_id, unnest({UNICODE_WORDS}) AS word FROM documents),
s AS (SELECT doc_id, sum(CASE WHEN word <> '' THEN coalesce(log_odds / deviation, 0) END) AS z,
             count(*) AS words FROM d LEFT JOIN odds USING (word) GROUP BY doc_id)
SELECT o.doc_id AS to_id, coalesce(words, 0) AS words, round(z / words, 6) AS score
FROM documents o LEFT JOIN s USING (doc_id)""",
)
def log_odds_scores(spark, sf_dir):
    """Texts scored by the z-scores of their words, fitted on the two roles."""
    weights = _odds(spark, sf_dir).select("word", F.col("z").alias("weight"))
    scored = lexicon.lexicon_score(ad.content(spark, sf_dir), weights)
    return scored.select(F.col("id").alias("to_id"), "words", F.round("score", 6).alias("score"))


@query(
    "uncommon_words_by_sql",
    r"""WITH l AS (SELECT DISTINCT unnest(string_split_regex(text, '[\s\x0b]+')) AS word FROM benchmark),
t AS (SELECT conv_id, turn, text, row_number() OVER () AS row FROM conversations),
w AS (SELECT row, unnest(string_split_regex(text, '[\s\x0b]+')) AS word FROM t)
SELECT conv_id, turn, CAST(coalesce(n, 0) AS INTEGER) AS uncommon_words FROM t LEFT JOIN (
  SELECT row, count(*) AS n FROM w
  WHERE word <> '' AND word NOT IN (SELECT word FROM l WHERE word IS NOT NULL) GROUP BY row) USING (row)""",
)
def uncommon_words_by_sql(spark, sf_dir):
    """Words of a turn that no benchmark text holds, by the SQL name."""
    told = ad.table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", r"\s+")).alias("word"))
    lexicon.register_sql(spark, told.distinct())
    turns = ad.table(spark, sf_dir, "conversations")
    return turns.selectExpr("conv_id", "turn", "count_uncommon_words(text) AS uncommon_words")
