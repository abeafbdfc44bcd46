import random

import pytest
from pyspark.sql import functions as F

from driftline.operators import line_diff

HISTORY = "title string, id long, timestamp string, text string"


def edited(rng, lines):
    out = list(lines)
    for _ in range(rng.randint(0, 6)):
        at = rng.randint(0, len(out))
        kind = rng.choice(["add", "cut", "move", "repeat"])
        if kind == "add":
            out.insert(at, f"line {rng.randint(0, 40)}")
        elif out and kind == "cut":
            del out[at - 1 : at + rng.randint(0, 3)]
        elif out and kind == "move":
            out.insert(rng.randint(0, len(out) - 1), out.pop(at - 1))
        else:
            out.insert(at, "")
    return out


def made(seed):
    rng = random.Random(seed)
    rows = []
    for title in "abc":
        lines = [f"line {rng.randint(0, 40)}" for _ in range(30)]
        for i in range(25):
            rows.append((title, i, f"2020-01-{i + 1:02d}", "\n".join(lines)))
            lines = edited(rng, lines)
    return [*rows, ("n", 1, "2020-01-01", None), ("n", 2, "2020-01-02", "x\n"),
            ("n", 3, "2020-01-03", ""), ("n", 4, "2020-01-04", None), ("one", 1, None, "alone")]


def frame(spark, data):
    return spark.createDataFrame(data, HISTORY).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


@pytest.mark.parametrize("rows_per_task", [1000, 10])
def test_hunks_lead_from_each_revision_to_the_next(spark, rows_per_task):
    data = made(1)
    history = frame(spark, data)
    hunks = line_diff.revision_hunks(history, rows_per_task)
    texts = {(t, i): text or "" for t, i, _, text in data}
    pairs = {}
    for r in hunks.collect():
        old, new = texts[r["title"], r["from_id"]].split("\n"), texts[r["title"], r["to_id"]].split("\n")
        assert (new if r["type"] == line_diff.ADDED else old)[r["line"] - 1] == r["text"]
        pairs.setdefault((r["title"], r["from_id"], r["to_id"]), []).append(r)
    for (title, a, b), found in pairs.items():
        old, new = texts[title, a].split("\n"), texts[title, b].split("\n")
        gone = {r["line"] for r in found if r["type"] == line_diff.REMOVED}
        come = {r["line"] for r in found if r["type"] == line_diff.ADDED}
        stay = [t for i, t in enumerate(old, 1) if i not in gone]
        assert stay == [t for i, t in enumerate(new, 1) if i not in come]
    got = {(r["title"], r["id"]): r["text"] for r in line_diff.rebuilt_texts(history, hunks).collect()}
    first = {("a", 0), ("b", 0), ("c", 0), ("n", 1), ("one", 1)}
    assert got == {k: t for k, t in texts.items() if k not in first}


def test_lines_that_stay():
    assert line_diff.kept_lines([], []) == (set(), set())
    old, new = "a b c d e".split(), "a x c d y e".split()
    assert line_diff.kept_lines(old, new) == ({0, 2, 3, 4}, {0, 2, 3, 5})
    # A moved line counts once, repeated lines are matched between anchors.
    old, new = "a - b - c - d".split(), "d - a - b - c".split()
    kept_old, kept_new = line_diff.kept_lines(old, new)
    assert [old[i] for i in sorted(kept_old)] == [new[j] for j in sorted(kept_new)] == "a - b - c".split()


def test_rising_is_longest():
    rng = random.Random(2)
    for _ in range(300):
        values = rng.sample(range(30), rng.randint(0, 9))
        best = 0
        for mask in range(1 << len(values)):
            chosen = [v for i, v in enumerate(values) if mask >> i & 1]
            if chosen == sorted(chosen):
                best = max(best, len(chosen))
        run = [values[i] for i in line_diff.rising(values)]
        assert len(run) == best and run == sorted(run)


def test_empty_history(spark):
    history = frame(spark, [])
    assert line_diff.revision_hunks(history).count() == 0
