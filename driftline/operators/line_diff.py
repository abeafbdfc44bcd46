"""Ordered line differences between neighbouring revisions.

Two texts are aligned by patience: equal lines at both ends are kept, then lines
that occur once on either side become anchors, the longest run of anchors that rise
on both sides is kept, and what lies between two anchors is aligned the same way.
Lines that are not kept were removed from the old or added to the new text.

A pair of revisions is one row with both texts, so a text is shuffled twice, and no
title is held in one place. Null text counts as empty; an empty text is one line.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.revisions import previous_ids
from driftline.operators.scale import ROWS_PER_TASK

# The types by which landed hunks tell added and removed lines.
ADDED, REMOVED = 1, 2


def rising(values: Sequence[int]) -> list[int]:
    """Places of a longest strictly rising subsequence of distinct ``values``."""
    ends: list[int] = []
    places: list[int] = []
    before = [-1] * len(values)
    for place, value in enumerate(values):
        at = bisect_left(ends, value)
        if at:
            before[place] = places[at - 1]
        ends[at : at + 1] = [value]
        places[at : at + 1] = [place]
    run, place = [], places[-1] if places else -1
    while place >= 0:
        run.append(place)
        place = before[place]
    return run[::-1]


def kept_lines(old: Sequence[str], new: Sequence[str]) -> tuple[set[int], set[int]]:
    """Places of the lines that stay, in the old and in the new text."""
    kept_old: set[int] = set()
    kept_new: set[int] = set()
    spans = [(0, len(old), 0, len(new))]
    while spans:
        a, a_end, b, b_end = spans.pop()
        while a < a_end and b < b_end and old[a] == new[b]:
            kept_old.add(a)
            kept_new.add(b)
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and old[a_end - 1] == new[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            kept_old.add(a_end)
            kept_new.add(b_end)
        if a == a_end or b == b_end:
            continue
        count_old, count_new = Counter(old[a:a_end]), Counter(new[b:b_end])
        place_of = {new[j]: j for j in range(b, b_end) if count_new[new[j]] == 1}
        anchors = [
            (i, place_of[old[i]])
            for i in range(a, a_end)
            if count_old[old[i]] == 1 and old[i] in place_of
        ]
        for i, j in (anchors[at] for at in rising([j for _, j in anchors])):
            kept_old.add(i)
            kept_new.add(j)
            spans.append((a, i, b, j))
            a, b = i + 1, j + 1
        if anchors:
            spans.append((a, a_end, b, b_end))
    return kept_old, kept_new


def revision_hunks(history: DataFrame, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """``title, from_id, to_id, type, line, text``: the lines each revision removed
    from the one before it and added to it.

    ``history`` has ``title, id, timestamp, text``. ``line`` counts from 1, in the
    older text for removed lines and in the newer one for added lines.
    """
    ids = previous_ids(history, rows_per_task)
    later = ids.where(F.col("previous_id").isNotNull()).select(
        "title", F.col("previous_id").alias("id"), F.col("id").alias("next_id")
    )
    linked = (
        history.select("title", "id", F.coalesce("text", F.lit("")).alias("text"))
        .join(ids, ["title", "id"])
        .join(later, ["title", "id"], "left")
    )
    side = lambda f, t, new: F.when(
        F.col(f).isNotNull() & F.col(t).isNotNull(),
        F.struct(F.col(f).alias("from_id"), F.col(t).alias("to_id"), F.lit(new).alias("is_new")),
    )
    sides = F.array(side("previous_id", "id", True), side("id", "next_id", False))
    pairs = (
        linked.select("title", "text", F.inline(F.filter(sides, lambda s: s.isNotNull())))
        .groupBy("title", "from_id", "to_id")
        .agg(
            F.max(F.when(~F.col("is_new"), F.col("text"))).alias("old"),
            F.max(F.when(F.col("is_new"), F.col("text"))).alias("new"),
        )
    )
    keys = {f.name: f.dataType.simpleString() for f in pairs.schema.fields[:3]}

    def aligned(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                old = one.column("old")[0].as_py().split("\n")
                new = one.column("new")[0].as_py().split("\n")
                kept_old, kept_new = kept_lines(old, new)
                hunks = [(REMOVED, i + 1, t) for i, t in enumerate(old) if i not in kept_old]
                hunks += [(ADDED, j + 1, t) for j, t in enumerate(new) if j not in kept_new]
                kinds, lines, texts = zip(*hunks, strict=True) if hunks else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.repeat(one.column(k)[0], len(hunks)) for k in keys],
                        pa.array(kinds, pa.int32()),
                        pa.array(lines, pa.int32()),
                        pa.array(texts, pa.string()),
                    ],
                    names=[*keys, "type", "line", "text"],
                )

    named = ", ".join(f"{name} {kind}" for name, kind in keys.items())
    return pairs.mapInArrow(aligned, f"{named}, type int, line int, text string")


def rebuilt_texts(
    history: DataFrame, hunks: DataFrame, rows_per_task: int | None = ROWS_PER_TASK
) -> DataFrame:
    """``title, id, text`` of every revision after the first, from the text of the
    revision before it and the hunks between them."""
    pairs = previous_ids(history, rows_per_task).where(F.col("previous_id").isNotNull())
    of = lambda kind: F.filter(
        F.col("hunks"), lambda h: h["type"] == kind
    )
    gathered = hunks.groupBy("title", F.col("to_id").alias("id")).agg(
        F.collect_list(F.struct("type", "line", "text")).alias("hunks")
    )
    before = history.select(
        "title", F.col("id").alias("previous_id"),
        F.split(F.coalesce("text", F.lit("")), "\n").alias("old"),
    )
    joined = pairs.join(before, ["title", "previous_id"]).join(gathered, ["title", "id"], "left")
    removed = F.coalesce(F.transform(of(REMOVED), lambda h: h["line"]), F.array().cast("array<int>"))
    added = F.coalesce(of(ADDED), F.array().cast("array<struct<type:int,line:int,text:string>>"))
    marked = joined.select("title", "id", "old", removed.alias("removed"), added.alias("added"))
    numbered = F.arrays_zip(
        F.sequence(F.lit(1), F.size("old")).alias("line"), F.col("old").alias("text")
    )
    lost = F.map_from_arrays("removed", F.transform("removed", lambda _: F.lit(True)))
    kept = F.filter(numbered, lambda x: ~F.map_contains_key("lost", x["line"]))
    marked = marked.withColumn("lost", lost).withColumn("kept", kept)
    # Kept lines fill, in their order, the places that no added line takes.
    total = F.size("kept") + F.size("added")
    every = F.when(total > 0, F.sequence(F.lit(1), total)).otherwise(F.array().cast("array<int>"))
    free = F.array_except(every, F.transform("added", lambda h: h["line"]))
    moved = F.transform(
        F.arrays_zip(free.alias("line"), F.col("kept").alias("k")),
        lambda x: F.struct(x["line"].alias("line"), x["k"]["text"].alias("text")),
    )
    fresh = F.transform("added", lambda h: F.struct(h["line"].alias("line"), h["text"].alias("text")))
    text = F.array_join(
        F.transform(F.sort_array(F.concat(moved, fresh)), lambda x: x["text"]), "\n"
    )
    return marked.select("title", "id", text.alias("text"))
