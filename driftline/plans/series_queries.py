"""Queries on time series, editor activity and token windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions import dates as dt
from driftline.operators import (
    activity,
    lexicon,
    perplexity,
    revisions,
    sentences,
    series,
    spectrum,
    traffic,
)
from driftline.plans import adapters as ad
from driftline.plans.registry import query
from driftline.plans.text_queries import (
    LINES,
    PUNCTUATED,
    SPACES,
    TALLY,
    _sentence_words,
    _sentences,
)
from driftline.session import written

MONTHS = """months AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
  count(*) AS revisions FROM orders GROUP BY 1)"""
STATS = f"""{LINES},
cut AS (SELECT to_id, date, unnest({_sentences('text')}) AS s
        FROM (SELECT to_id, date, {PUNCTUATED} AS text FROM lines) WHERE text <> ''),
stats AS (SELECT to_id, date, var_samp({_sentence_words('s')}) /
                              nullif(avg({_sentence_words('s')}), 0) AS v
          FROM cut GROUP BY to_id, date)"""
SPECTRUM = """pts AS (
  SELECT o_orderpriority AS title, date_trunc('month', o_orderdate) AS month, count(*) AS x
  FROM orders GROUP BY 1, 2),
num AS (SELECT title, x, row_number() OVER (PARTITION BY title ORDER BY month) - 1 AS t,
               count(*) OVER (PARTITION BY title) AS n FROM pts),
spectrum AS (
  SELECT title, k, n, CASE WHEN 2 * k = n THEN -0.5 ELSE k / n END AS frequency,
         sqrt(pow(sum(x * cos(2 * pi() * k * t / n)), 2) +
              pow(sum(x * sin(2 * pi() * k * t / n)), 2)) AS magnitude
  FROM (SELECT *, unnest(generate_series(0, n // 2)) AS k FROM num) GROUP BY title, k, n)"""


@query(
    "revisions_monthly",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS revisions
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-15' GROUP BY 1""",
)
def revisions_monthly(spark, sf_dir):
    return series.monthly_counts(ad.metadata(spark, sf_dir), "timestamp", since="1997-06-15")


@query(
    "records_per_month",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS records
FROM orders GROUP BY 1, 2""",
)
def records_per_month(spark, sf_dir):
    return series.records_per_month(ad.metadata(spark, sf_dir), "timestamp")


@query(
    "rolling_mean",
    f"""WITH {STATS}
SELECT to_id, date, round(CASE WHEN count(v) OVER w = 30 THEN avg(v) OVER w END, 6)
         AS rolling_mean
FROM stats WINDOW w AS (ORDER BY date, CAST(to_id AS BIGINT)
                        ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean(spark, sf_dir):
    stats = written(sentences.sentence_stats(ad.content(spark, sf_dir)))
    order = [F.asc("date"), revisions.revision_id().asc()]
    rolled = series.rolling_mean(stats, "relative_variance", 30, order)
    return rolled.select("to_id", "date", F.round("rolling_mean", 6).alias("rolling_mean"))


@query(
    "rolling_mean_monthly",
    f"""WITH {MONTHS}
SELECT month, revisions,
       round(CASE WHEN count(*) OVER w = 3 THEN avg(revisions) OVER w END, 6) AS rolling_mean
FROM months WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean_monthly(spark, sf_dir):
    rolled = series.rolling_mean(
        ad.monthly(spark, sf_dir), "revisions", 3, [F.asc("month")], rows_per_task=None
    )
    return rolled.withColumn("rolling_mean", F.round("rolling_mean", 6))


@query(
    "resample_weeks",
    f"""WITH {LINES},
d AS (SELECT date, sum(length(text)) AS s, count(DISTINCT to_id) AS c FROM lines GROUP BY date),
a AS (SELECT min(date) + CAST((7 - dayofweek(min(date))) % 7 AS INTEGER) AS a0 FROM d),
b AS (SELECT a0 + 21 * CAST(ceil((date - a0) / 21.0) AS INTEGER) AS label, sum(s) AS s, sum(c) AS c
      FROM d, a GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(a0, (SELECT max(label) FROM b), INTERVAL 21 DAY))
                      AS DATE) AS label FROM a)
SELECT spine.label, round(s / nullif(c, 0), 6) AS mean
FROM spine LEFT JOIN b ON b.label = spine.label""",
)
def resample_weeks(spark, sf_dir):
    chars = revisions.revision_chars(ad.content(spark, sf_dir))
    means = series.resample_weeks(chars, "date", "text_length", 3)
    return means.withColumn("mean", F.round("mean", 6))


@query(
    "milestone_means",
    """SELECT round_even(avg(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01'), 2)
         AS mean_before,
       round_even(avg(o_totalprice) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01'), 2)
         AS mean_after,
       count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS rows_before,
       count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS rows_after,
       CAST(min(o_orderdate) AS DATE) AS first_before,
       CAST(max(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS DATE)
         AS last_before,
       CAST(min(o_orderdate) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS DATE)
         AS first_after,
       CAST(max(o_orderdate) AS DATE) AS last_after
FROM orders""",
)
def milestone_means(spark, sf_dir):
    rows = ad.table(spark, sf_dir, "orders")
    return series.milestone_means(rows, "o_orderdate", "o_totalprice", "1998-01-01")


@query(
    "date_histogram",
    """WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi
           FROM orders),
h AS (SELECT least((CAST(o_orderdate AS DATE) - lo) * 30 // (hi - lo), 29) AS bin, count(*) AS n
      FROM orders, b GROUP BY 1)
SELECT CAST(r.i AS INTEGER) AS bin, coalesce(n, 0) AS records
FROM range(30) r(i) LEFT JOIN h ON h.bin = r.i""",
)
def date_histogram(spark, sf_dir):
    return series.date_histogram(ad.metadata(spark, sf_dir), "timestamp")


@query(
    "series_summary",
    f"""WITH {MONTHS}
SELECT CAST(sum(revisions) AS BIGINT) AS total, round(avg(revisions), 6) AS mean,
       max(revisions) AS maximum,
       (SELECT month FROM months ORDER BY revisions DESC, month LIMIT 1) AS maximum_at
FROM months""",
)
def series_summary(spark, sf_dir):
    summary = series.series_summary(ad.monthly(spark, sf_dir), "month", "revisions")
    return summary.withColumn("mean", F.round("mean", 6))


@query(
    "series_summary_text",
    f"""WITH {MONTHS}
SELECT format('{{:,}}', CAST(sum(revisions) AS BIGINT)) AS total,
       format('{{:,}}', CAST(round_even(avg(revisions), 0) AS BIGINT)) AS mean,
       format('{{:,}}', max(revisions)) AS maximum,
       (SELECT strftime(month, '%B %Y') FROM months ORDER BY revisions DESC, month LIMIT 1)
         AS maximum_at
FROM months""",
)
def series_summary_text(spark, sf_dir):
    summary = series.series_summary(ad.monthly(spark, sf_dir), "month", "revisions")
    return series.summary_text(summary)


def _growth(spark, sf_dir):
    """Monthly misses as a dated series."""
    growth = lexicon.uncommon_growth(
        lexicon.lexicon_misses(
            ad.content(spark, sf_dir), ad.metadata(spark, sf_dir), ad.lexicon(spark, sf_dir)
        )
    )
    return growth.withColumn("date", dt.from_parts(F.col("year"), F.col("month")))


GROWTH = f"""{TALLY},
growth AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
                  CAST(sum(misses) AS BIGINT) AS total
           FROM tally JOIN orders ON o_orderkey = doc_id GROUP BY 1)"""


@query(
    "growth_trend",
    f"""WITH {GROWTH}
SELECT date, total AS total_uncommon_words,
       round(CASE WHEN count(*) OVER w = 3 THEN avg(total) OVER w END, 6) AS rolling_mean
FROM growth WHERE year(date) >= 1996
WINDOW w AS (ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def growth_trend(spark, sf_dir):
    recent = _growth(spark, sf_dir).where(F.col("year") >= 1996)
    rolled = series.rolling_mean(
        recent, "total_uncommon_words", 3, [F.asc("date")], rows_per_task=None
    )
    return rolled.select(
        "date", "total_uncommon_words", F.round("rolling_mean", 6).alias("rolling_mean")
    )


@query(
    "growth_milestone",
    f"""WITH {GROWTH}
SELECT round_even(avg(total) FILTER (WHERE date < DATE '1998-01-01'), 2) AS mean_before,
       round_even(avg(total) FILTER (WHERE date >= DATE '1998-01-01'), 2) AS mean_after,
       count(*) FILTER (WHERE date < DATE '1998-01-01') AS rows_before,
       count(*) FILTER (WHERE date >= DATE '1998-01-01') AS rows_after,
       min(date) AS first_before, max(date) FILTER (WHERE date < DATE '1998-01-01') AS last_before,
       min(date) FILTER (WHERE date >= DATE '1998-01-01') AS first_after, max(date) AS last_after
FROM growth""",
)
def growth_milestone(spark, sf_dir):
    return series.milestone_means(
        _growth(spark, sf_dir), "date", "total_uncommon_words", "1998-01-01"
    )


@query(
    "size_trend",
    f"""WITH {LINES},
d AS (SELECT date, sum(length(text)) AS s, count(DISTINCT to_id) AS c FROM lines GROUP BY date),
a AS (SELECT min(date) + CAST((7 - dayofweek(min(date))) % 7 AS INTEGER) AS a0 FROM d),
b AS (SELECT a0 + 21 * CAST(ceil((date - a0) / 21.0) AS INTEGER) AS label, sum(s) AS s, sum(c) AS c
      FROM d, a GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(a0, (SELECT max(label) FROM b), INTERVAL 21 DAY))
                      AS DATE) AS label FROM a),
m AS (SELECT spine.label, s / nullif(c, 0) AS v FROM spine LEFT JOIN b ON b.label = spine.label
      WHERE spine.label > DATE '1995-06-01')
SELECT label, round(v, 6) AS mean,
       round(CASE WHEN count(v) OVER w = 5 THEN avg(v) OVER w END, 6) AS rolling_mean
FROM m WINDOW w AS (ORDER BY label ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
)
def size_trend(spark, sf_dir):
    chars = revisions.revision_chars(ad.content(spark, sf_dir)).dropna()
    means = series.resample_weeks(chars, "date", "text_length", 3)
    recent = means.where(F.col("label") > F.lit("1995-06-01").cast("date"))
    rolled = series.rolling_mean(recent, "mean", 5, [F.asc("label")], rows_per_task=None)
    return rolled.withColumns(
        {"mean": F.round("mean", 6), "rolling_mean": F.round("rolling_mean", 6)}
    )


@query(
    "dft_spectrum",
    f"""WITH {SPECTRUM}
SELECT title, CAST(k AS INTEGER) AS k, CAST(n AS INTEGER) AS n, round(frequency, 9) AS frequency,
       round(magnitude, 4) AS magnitude FROM spectrum""",
)
def dft_spectrum(spark, sf_dir):
    found = series.dft_spectrum(
        ad.monthly_by_title(spark, sf_dir), ["title"], "month", "revisions"
    )
    return found.withColumns(
        {"frequency": F.round("frequency", 9), "magnitude": F.round("magnitude", 4)}
    )


@query(
    "dominant_period",
    f"""WITH {SPECTRUM}
SELECT title, CAST(k AS INTEGER) AS k, round(frequency, 9) AS frequency,
       round(magnitude, 4) AS magnitude, round(1 / frequency, 6) AS period
FROM spectrum WHERE k > 0
QUALIFY row_number() OVER (PARTITION BY title ORDER BY magnitude DESC, k) = 1""",
)
def dominant_period(spark, sf_dir):
    best = series.dominant_period(
        ad.monthly_by_title(spark, sf_dir), ["title"], "month", "revisions"
    )
    return best.withColumns(
        {
            "frequency": F.round("frequency", 9),
            "magnitude": F.round("magnitude", 4),
            "period": F.round("period", 6),
        }
    )


def _fourier_sql(points: str) -> str:
    return f"""WITH pts AS ({points}),
num AS (SELECT x, row_number() OVER (ORDER BY step) - 1 AS j, count(*) OVER () AS n FROM pts)
SELECT n, k, round(k / n, 9) AS frequency,
       round(sqrt(pow(sum(x * cos(2 * pi() * ((k * j) % n) / n)), 2) +
                  pow(sum(x * sin(2 * pi() * ((k * j) % n) / n)), 2)), 4) AS magnitude
FROM (SELECT *, unnest(generate_series(0, n // 2)) AS k FROM num) GROUP BY n, k"""


def _fourier(rows, step):
    counts = rows.groupBy(step.alias("step")).agg(F.count("*").alias("x"))
    found = spectrum.fourier(counts, [], [F.asc("step")], "x", rows_per_task=None)
    return found.withColumns(
        {"frequency": F.round("frequency", 9), "magnitude": F.round("magnitude", 4)}
    )


@query(
    "fourier_daily",
    _fourier_sql("SELECT CAST(o_orderdate AS DATE) AS step, count(*) AS x FROM orders GROUP BY 1"),
)
def fourier_daily(spark, sf_dir):
    return _fourier(ad.table(spark, sf_dir, "orders"), F.to_date("o_orderdate"))


@query(
    "fourier_hourly",
    _fourier_sql("SELECT date_trunc('hour', ts) AS step, count(*) AS x FROM events GROUP BY 1"),
)
def fourier_hourly(spark, sf_dir):
    return _fourier(ad.table(spark, sf_dir, "events"), F.date_trunc("hour", "ts"))


@query(
    "category_trend_period",
    """WITH pts AS (SELECT strftime(o_orderdate, '%Y%m') AS month,
                    sum(CAST(round(o_totalprice) AS BIGINT)) AS x
             FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
num AS (SELECT x, row_number() OVER (ORDER BY month) - 1 AS t, count(*) OVER () AS n FROM pts),
s AS (SELECT k, n, sqrt(pow(sum(x * cos(2 * pi() * k * t / n)), 2) +
                        pow(sum(x * sin(2 * pi() * k * t / n)), 2)) AS magnitude
      FROM (SELECT *, unnest(generate_series(1, n // 2)) AS k FROM num) GROUP BY k, n)
SELECT CAST(k AS INTEGER) AS k,
       round(CASE WHEN 2 * k = n THEN -0.5 ELSE k / n END, 9) AS frequency,
       round(magnitude, 2) AS magnitude,
       round(CASE WHEN 2 * k = n THEN -2.0 ELSE n / k END, 6) AS period
FROM s ORDER BY magnitude DESC, k LIMIT 1""",
)
def category_trend_period(spark, sf_dir):
    views = traffic.views_by_category_period(
        ad.members(spark, sf_dir), ad.order_views(spark, sf_dir)
    )
    combined = views.where(F.col("combined") == 1)
    best = series.dominant_period(combined, [], "period", "views")
    return best.withColumns(
        {
            "frequency": F.round("frequency", 9),
            "magnitude": F.round("magnitude", 2),
            "period": F.round("period", 6),
        }
    )


# Editors --------------------------------------------------------------------


@query(
    "new_users_monthly",
    """SELECT CAST(date_trunc('month', f) AS DATE) AS month, count(*) AS new_users
FROM (SELECT o_custkey, min(o_orderdate) AS f FROM orders GROUP BY 1) GROUP BY 1""",
)
def new_users_monthly(spark, sf_dir):
    return activity.new_users_monthly(ad.metadata(spark, sf_dir))


@query(
    "top_months",
    """SELECT CAST(date_trunc('month', f) AS DATE) AS month, count(*) AS new_users
FROM (SELECT o_custkey, min(o_orderdate) AS f FROM orders GROUP BY 1) GROUP BY 1
ORDER BY new_users DESC, month LIMIT 10""",
)
def top_months(spark, sf_dir):
    monthly = activity.new_users_monthly(ad.metadata(spark, sf_dir))
    return series.top_rows(monthly, "month", "new_users", 10)


@query(
    "edits_per_user",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS edits,
       count(DISTINCT o_custkey) AS users,
       round(count(*) / count(DISTINCT o_custkey), 6) AS edits_per_user,
       CASE WHEN year(o_orderdate) <= 1997 THEN 'baseline' ELSE 'later' END AS phase
FROM orders GROUP BY year(o_orderdate)""",
)
def edits_per_user(spark, sf_dir):
    edits = activity.edits_per_user(ad.metadata(spark, sf_dir), baseline_until=1997)
    return edits.withColumn("edits_per_user", F.round("edits_per_user", 6))


@query(
    "new_account_edits",
    """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day,
                  min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS f FROM orders)
SELECT CAST(date_trunc('month', day) AS DATE) AS month,
       count(*) FILTER (WHERE day - f <= 30) AS new_edits,
       count(*) FILTER (WHERE day - f > 30) AS old_edits,
       round(count(*) FILTER (WHERE day - f <= 30) / count(*), 6) AS new_share
FROM o GROUP BY 1""",
)
def new_account_edits(spark, sf_dir):
    edits = activity.new_account_edits(ad.metadata(spark, sf_dir), days=30)
    return edits.withColumn("new_share", F.round("new_share", 6))


@query(
    "low_activity_edits",
    """WITH o AS (SELECT o_custkey, o_orderdate, count(*) OVER (PARTITION BY o_custkey) AS n
           FROM orders)
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS edits,
       count(DISTINCT o_custkey) AS users
FROM o WHERE n <= 8 GROUP BY 1""",
)
def low_activity_edits(spark, sf_dir):
    return activity.low_activity_edits(ad.metadata(spark, sf_dir), at_most=8)


@query(
    "event_phase_counts",
    """WITH e AS (SELECT r_name AS event, DATE '1996-01-01' + r_regionkey * 400 AS start,
                  DATE '1996-01-01' + r_regionkey * 400 + 59 AS stop FROM region),
x AS (SELECT event, CASE WHEN CAST(o_orderdate AS DATE) < start THEN 'before'
                         WHEN CAST(o_orderdate AS DATE) > stop THEN 'after' ELSE 'during' END
             AS phase
      FROM orders JOIN e ON CAST(o_orderdate AS DATE) BETWEEN start - 90 AND stop + 90)
SELECT event, phase, count(*) AS revisions,
       CAST(CASE phase WHEN 'during' THEN 60 ELSE 90 END AS BIGINT) AS days,
       round(count(*) / CASE phase WHEN 'during' THEN 60 ELSE 90 END, 6) AS per_day
FROM x GROUP BY event, phase""",
)
def event_phase_counts(spark, sf_dir):
    counts = activity.event_phase_counts(ad.metadata(spark, sf_dir), ad.phases(spark, sf_dir))
    return counts.withColumn("per_day", F.round("per_day", 6))


@query(
    "size_growth",
    """SELECT CAST(conv_id AS VARCHAR) AS title, turn AS id, length(text) AS delta,
       CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS size_after
FROM conversations""",
)
def size_growth(spark, sf_dir):
    sized = ad.history(spark, sf_dir).select(
        "title", "id", F.length("text").cast("long").alias("delta")
    )
    return activity.size_growth(sized, [F.asc("id")], "delta")


@query(
    "reversals",
    """WITH o AS (
  SELECT CAST(o_custkey AS VARCHAR) AS title, o_orderkey AS id, o_orderstatus AS s0,
         lag(o_orderstatus) OVER w AS s1, lag(o_orderstatus, 2) OVER w AS s2,
         CAST(o_orderdate AS DATE) - CAST(lag(o_orderdate, 2) OVER w AS DATE) AS gap,
         abs(CAST(round(o_totalprice) AS BIGINT) -
             lag(CAST(round(o_totalprice) AS BIGINT)) OVER w) AS jump
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT title, id, coalesce(s0 = s2 AND s0 <> s1 AND gap <= 365, FALSE) AS is_reversal,
       coalesce(jump >= 250000, FALSE) AS is_large
FROM o""",
)
def reversals(spark, sf_dir):
    rows = ad.metadata(spark, sf_dir).withColumn("title", F.col("user").cast("string"))
    marked = activity.reversals(
        rows.select("title", "id", "timestamp", "state", "size"),
        [F.asc("timestamp"), F.asc("id")],
        state="state",
        size="size",
        within_days=365,
        large=250000,
    )
    return marked.select("title", "id", "is_reversal", "is_large")


@query(
    "reverts",
    """WITH o AS (
  SELECT CAST(o_custkey AS VARCHAR) AS title, o_orderkey AS id, o_orderdate AS ts,
         o_orderstatus AS state,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos
  FROM orders),
r AS (
  SELECT a.title, a.id, a.pos, max(b.pos) AS back
  FROM o a JOIN o b ON a.title = b.title AND a.state = b.state AND b.pos < a.pos
    AND epoch(a.ts) - epoch(b.ts) <= 365 * 86400
  GROUP BY ALL HAVING a.pos - max(b.pos) > 1),
u AS (SELECT DISTINCT o.title, o.pos FROM o
      JOIN r ON r.title = o.title AND r.back < o.pos AND o.pos < r.pos)
SELECT o.title, o.id, r.id IS NOT NULL AS is_revert, b.id AS reverted_to,
       CAST(coalesce(r.pos - r.back - 1, 0) AS INTEGER) AS undoes, u.pos IS NOT NULL AS is_undone
FROM o LEFT JOIN r ON r.title = o.title AND r.pos = o.pos
LEFT JOIN o b ON b.title = r.title AND b.pos = r.back
LEFT JOIN u ON u.title = o.title AND u.pos = o.pos""",
)
def reverts(spark, sf_dir):
    rows = ad.metadata(spark, sf_dir).select(
        F.col("user").cast("string").alias("title"), "id", "timestamp", "state"
    )
    return activity.reverts(rows, "state", 365).select(
        "title", "id", "is_revert", "reverted_to", "undoes", "is_undone"
    )


@query(
    "change_points",
    """WITH m AS (
  SELECT o_orderpriority AS title, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         count(*) AS x
  FROM orders GROUP BY ALL),
s AS (
  SELECT title, month, sum(x) OVER w AS prefix, row_number() OVER w AS step,
         sum(x) OVER (PARTITION BY title) AS total, count(*) OVER (PARTITION BY title) AS n
  FROM m WINDOW w AS (PARTITION BY title ORDER BY month)),
d AS (
  SELECT *, abs(n * prefix - step * total) AS dev,
         row_number() OVER (PARTITION BY title ORDER BY abs(n * prefix - step * total) DESC, step)
           AS pick
  FROM s)
SELECT title, month AS last_before, CAST(dev AS BIGINT) AS deviation, n AS steps,
       step AS steps_before, round(prefix / step, 6) AS mean_before,
       round((total - prefix) / (n - step), 6) AS mean_after
FROM d WHERE pick = 1 AND dev > 0""",
)
def change_points(spark, sf_dir):
    points = series.change_points(
        ad.monthly_by_title(spark, sf_dir), "month", "revisions", ["title"], rows_per_task=None
    )
    return points.withColumns(
        {c: F.round(c, 6) for c in ("mean_before", "mean_after")}
    )


@query(
    "peak_detection",
    f"""WITH {MONTHS},
z AS (SELECT month, revisions, CASE WHEN count(*) OVER w = 12 THEN
        (revisions - avg(revisions) OVER w) / nullif(stddev_samp(revisions) OVER w, 0) END AS z
      FROM months WINDOW w AS (ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
SELECT month, revisions, round(z, 6) AS z, coalesce(z >= 1.5, FALSE) AS is_peak FROM z""",
)
def peak_detection(spark, sf_dir):
    scored = series.peaks(ad.monthly(spark, sf_dir), "month", "revisions", 12, 1.5)
    return scored.withColumn("z", F.round("z", 6))


@query(
    "coerce_numeric",
    r"""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       TRY_CAST(event_type AS DOUBLE) AS kind FROM events""",
)
def coerce_numeric(spark, sf_dir):
    return ad.table(spark, sf_dir, "events").select(
        "event_id",
        dt.numeric(F.get_json_object("props", "$.k")).alias("k"),
        dt.numeric(F.col("event_type")).alias("kind"),
    )


# Token windows --------------------------------------------------------------

TURNS = f"""turns AS (
  SELECT conv_id || '-' || turn AS doc,
         list_filter(string_split_regex(lower(text), {SPACES}), lambda w: w <> '') AS w
  FROM conversations)"""
MODEL = f"""model AS (
  SELECT w[i] AS previous, w[i + 1] AS word, count(*) AS n
  FROM (SELECT w, unnest(generate_series(1, len(w) - 1)) AS i
        FROM (SELECT list_filter(string_split_regex(lower(text), {SPACES}), lambda w: w <> '') AS w
              FROM documents))
  GROUP BY ALL)"""


def _losses_sql(max_length: int, stride: int) -> str:
    return f"""{TURNS}, {MODEL},
ctx AS (SELECT previous, sum(n) AS total FROM model GROUP BY previous),
voc AS (SELECT count(*) AS v FROM (SELECT previous FROM model UNION SELECT word FROM model)),
pos AS (SELECT doc, w[p] AS previous, w[p + 1] AS word, p,
               CASE WHEN p < {max_length} THEN 0 ELSE (p - {max_length}) // {stride} + 1 END AS win
        FROM (SELECT doc, w, unnest(generate_series(1, len(w) - 1)) AS p FROM turns)),
nll AS (SELECT doc, win, ln(coalesce(total, 0) + v) - ln(coalesce(n, 0) + 1) AS l
        FROM pos CROSS JOIN voc
        LEFT JOIN model m ON m.previous = pos.previous AND m.word = pos.word
        LEFT JOIN ctx c ON c.previous = pos.previous
        WHERE {max_length} <> {stride} OR p <> win * {stride}),
losses AS (SELECT doc, win, count(*) AS scored, sum(l) AS loss FROM nll GROUP BY doc, win)"""


def _perplexity_sql(max_length: int, stride: int) -> str:
    return f"""WITH {_losses_sql(max_length, stride)}
SELECT doc, count(win) AS windows, CAST(coalesce(sum(scored), 0) AS BIGINT) AS scored,
       round(exp(avg(loss / scored)), 4) AS perplexity
FROM (SELECT DISTINCT doc FROM turns) LEFT JOIN losses USING (doc) GROUP BY doc"""


@query(
    "sliding_chunks",
    f"""WITH {TURNS},
c AS (SELECT doc, w, unnest(generate_series(0, CASE WHEN len(w) <= 64 THEN 0
        ELSE CAST(ceil((len(w) - 64) / 32.0) AS INTEGER) END)) AS i FROM turns WHERE len(w) > 0)
SELECT doc, CAST(i AS INTEGER) AS "window", CAST(i * 32 AS INTEGER) AS "begin",
       CAST(least(i * 32 + 64, len(w)) AS INTEGER) AS "end",
       CAST(least(i * 32 + 64, len(w)) - CASE WHEN i = 0 THEN 0 ELSE i * 32 + 32 END AS INTEGER)
         AS target_length,
       array_to_string(w[i * 32 + 1 : i * 32 + 64], ' ') AS tokens
FROM c""",
)
def sliding_chunks(spark, sf_dir):
    chunks = perplexity.sliding_chunks(ad.turn_tokens(spark, sf_dir), "doc", 64, 32)
    return chunks.withColumn("tokens", F.array_join("tokens", " "))


def _training(spark, sf_dir):
    return perplexity.tokens_of(ad.documents(spark, sf_dir), "doc_id")


@query("ngram_model", f"WITH {MODEL} SELECT previous, word, n FROM model")
def ngram_model(spark, sf_dir):
    return perplexity.ngram_model(_training(spark, sf_dir))


@query(
    "kneser_ney_perplexity",
    f"""WITH {TURNS}, {MODEL},
k AS (SELECT count(*) AS kinds,
             count(*) FILTER (WHERE n = 1)::DOUBLE
               / (count(*) FILTER (WHERE n = 1) + 2 * count(*) FILTER (WHERE n = 2)) AS d
      FROM model),
ctx AS (SELECT previous, sum(n) AS total, count(*) AS after FROM model GROUP BY previous),
voc AS (SELECT word, sum(c) AS before FROM
          (SELECT word, 1 AS c FROM model UNION ALL SELECT previous, 0 FROM model) GROUP BY word),
spare AS (SELECT d * (SELECT count(*) FROM voc WHERE before > 0) / kinds
                 / ((SELECT count(*) FROM voc) + 1) AS spare FROM k),
pos AS (SELECT doc, w[p] AS previous, w[p + 1] AS word
        FROM (SELECT doc, w, unnest(generate_series(1, len(w) - 1)) AS p FROM turns)),
l AS (
  SELECT doc, -ln(coalesce((n - d) / total, 0) + coalesce(d * after / total, 1) *
           (coalesce(greatest(before - d, 0) / kinds, 0) + spare)) AS l
  FROM pos CROSS JOIN k CROSS JOIN spare
  LEFT JOIN model m ON m.previous = pos.previous AND m.word = pos.word
  LEFT JOIN ctx c ON c.previous = pos.previous
  LEFT JOIN voc v ON v.word = pos.word)
SELECT doc, count(*) AS scored, round(exp(sum(l) / count(*)), 4) AS perplexity
FROM l GROUP BY doc""",
)
def kneser_ney_perplexity(spark, sf_dir):
    turns, training = ad.turn_tokens(spark, sf_dir), _training(spark, sf_dir)
    losses = perplexity.trained_kneser_ney_losses(turns, training, "doc")
    return losses.select(
        "doc", "scored", F.round(F.exp(F.col("loss") / F.col("scored")), 4).alias("perplexity")
    )


def _perplexity(spark, sf_dir, max_length, stride, weighted=False):
    turns, training = ad.turn_tokens(spark, sf_dir), _training(spark, sf_dir)
    losses = perplexity.trained_window_losses(turns, training, "doc", max_length, stride)
    scored = perplexity.perplexity(losses, "doc", weighted, turns)
    return scored.withColumn("perplexity", F.round("perplexity", 4))


@query("perplexity", _perplexity_sql(64, 32))
def strided_perplexity(spark, sf_dir):
    return _perplexity(spark, sf_dir, 64, 32)


@query("perplexity_no_overlap", _perplexity_sql(64, 64))
def perplexity_no_overlap(spark, sf_dir):
    return _perplexity(spark, sf_dir, 64, 64)


@query(
    "perplexity_weighted",
    f"""WITH {_losses_sql(64, 32)}
SELECT doc, count(win) AS windows, CAST(coalesce(sum(scored), 0) AS BIGINT) AS scored,
       round(exp(sum(loss) / sum(scored)), 4) AS perplexity
FROM (SELECT DISTINCT doc FROM turns) LEFT JOIN losses USING (doc) GROUP BY doc""",
)
def perplexity_weighted(spark, sf_dir):
    return _perplexity(spark, sf_dir, 64, 32, weighted=True)
