"""Joining revision content to metadata, pairing revisions, line differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.operators.scale import (
    ROWS_PER_TASK,
    look_back,
    skew_join,
)

PIECES_PER_CHUNK = 65536


def revision_id(name: str = "to_id") -> Column:
    """Text ids of content rows as numbers; what is no number matches nothing."""
    return F.col(name).cast("string").try_cast("long")


def metadata_times(meta: DataFrame) -> DataFrame:
    """One ``id, timestamp`` row per revision; re-appended lines collapse."""
    return meta.where(F.col("id").isNotNull()).groupBy("id").agg(
        F.max("timestamp").alias("timestamp")
    )


def known_ids(meta: DataFrame) -> DataFrame:
    """The ``id`` of every metadata record; repeated ones do no harm to a semi-join."""
    return meta.select("id").where(F.col("id").isNotNull())


def revision_content(
    content: DataFrame, meta: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """Content pieces with the timestamp of their revision (inner join)."""
    keyed = content.withColumn("id", revision_id()).where(F.col("id").isNotNull())
    extra = {} if hot_rows is None else {"hot_rows": hot_rows}
    return skew_join(keyed, metadata_times(meta), ["id"], "inner", spread_by=["piece"], **extra)


def assemble(pieces: DataFrame, keys: Sequence[str], chunked: bool = False) -> DataFrame:
    """``keys, full_text``: pieces in ``piece`` order, joined with a space.

    The text is one value and has to fit a row. ``chunked`` first joins runs of
    pieces by many tasks, for revisions of millions of pieces; it moves the text
    twice.
    """
    joined = F.expr("listagg(text, ' ') within group (order by piece)")
    if chunked:
        chunk = F.floor(F.col("piece") / F.lit(PIECES_PER_CHUNK)).cast("long")
        parts = pieces.groupBy(*keys, chunk.alias("_chunk")).agg(joined.alias("text"))
        pieces = parts.withColumnRenamed("_chunk", "piece")
    return pieces.groupBy(*keys).agg(F.coalesce(joined, F.lit("")).alias("full_text"))


def revision_text(content: DataFrame, meta: DataFrame) -> DataFrame:
    """``to_id, timestamp, full_text``; pieces are assembled before the join."""
    keyed = content.withColumn("id", revision_id()).where(F.col("id").isNotNull())
    return (
        assemble(keyed, ["id"])
        .join(metadata_times(meta), "id")
        .select(F.col("id").alias("to_id"), "timestamp", "full_text")
    )


def revision_chars(records: DataFrame) -> DataFrame:
    """Characters per revision and date; records without a revision are left out."""
    return (
        records.where(F.col("to_id").isNotNull() & F.col("date").isNotNull())
        .groupBy("to_id", "date")
        .agg(F.sum(F.length("text")).alias("text_length"))
    )


def revisions_since(meta: DataFrame, floor: str) -> DataFrame:
    """Revisions later than ``floor``; the comparison reaches the scan."""
    return meta.where(F.col("timestamp") > F.lit(floor).cast("timestamp_ntz"))


def revisions_per_title(meta: DataFrame) -> DataFrame:
    return meta.groupBy("title").agg(F.count("*").alias("revisions"))


def _newest_first() -> list[Column]:
    return [F.desc("timestamp"), F.desc("id")]


def _oldest_first() -> list[Column]:
    return [F.asc("timestamp"), F.asc("id")]


def revision_pairs(meta: DataFrame, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """Neighbours in the newest-first list of each title.

    ``from_id`` is the newer and ``to_id`` the older revision of the pair; the
    pair carries the date of ``to_id``.
    """
    rows = meta.select("title", "id", "timestamp")
    paired = look_back(
        rows, ["title"], _newest_first(), 1, {"from_id": F.lag("id", 1)}, rows_per_task
    )
    return paired.where(F.col("from_id").isNotNull()).select(
        "title", "from_id", F.col("id").alias("to_id"), F.col("timestamp").alias("date")
    )


def previous_ids(history: DataFrame, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """``title, id, previous_id``; only ids take part in the ordering."""
    return look_back(
        history.select("title", "id", "timestamp"),
        ["title"], _oldest_first(), 1, {"previous_id": F.lag("id", 1)}, rows_per_task,
    ).drop("timestamp")


def revision_line_diff(history: DataFrame, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """Lines added (+n) and removed (-n) by each revision after the first.

    ``history`` has ``title, id, timestamp, text``. Each line counts +1 for its
    own revision and -1 for the next one; what does not cancel out has changed.
    Repeated lines are counted, not merged. Only ids take part in the ordering.
    """
    back = previous_ids(history, rows_per_task)
    later = back.where(F.col("previous_id").isNotNull()).select(
        "title", F.col("previous_id").alias("id"), F.col("id").alias("next_id")
    )
    linked = (
        history.select("title", "id", "text")
        .join(back, ["title", "id"])
        .join(later, ["title", "id"], "left")
    )
    own = F.when(
        F.col("previous_id").isNotNull(),
        F.struct(F.col("previous_id").alias("f"), F.col("id").alias("t"), F.lit(1).alias("d")),
    )
    gone = F.when(
        F.col("next_id").isNotNull(),
        F.struct(F.col("id").alias("f"), F.col("next_id").alias("t"), F.lit(-1).alias("d")),
    )
    sides = F.filter(F.array(own, gone), lambda s: s.isNotNull())
    lines = (
        linked.select("title", sides.alias("sides"), F.split("text", "\n").alias("_l"))
        .select("title", "sides", F.explode("_l").alias("line"))
        .select("title", "line", F.inline("sides"))
    )
    return (
        lines.groupBy("title", F.col("f").alias("from_id"), F.col("t").alias("to_id"), "line")
        .agg(F.sum("d").alias("change"))
        .where(F.col("change") != 0)
    )


def outstanding(titles: DataFrame, finished: DataFrame) -> DataFrame:
    """Titles not yet finished, by exact match."""
    return titles.select("title").distinct().join(
        finished.select("title").distinct(), "title", "left_anti"
    )
