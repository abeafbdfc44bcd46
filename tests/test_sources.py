import json
import os
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators import lexicon, revisions
from driftline.session import scratch_path, shared_dir
from driftline.sources import landed, schemas, sinks
from driftline.streaming import ingest


def lines(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as out:
        for record in records:
            out.write((record if isinstance(record, str) else json.dumps(record)) + "\n")


@pytest.fixture()
def folder(tmp_path):
    base = str(tmp_path / "rev")
    lines(f"{base}/US_election+x_revisions.json", [
        {"id": 2, "timestamp": "2022-12-01T00:00:00Z", "user": {"id": 1, "name": "n"}, "size": 9},
        {"id": 1, "timestamp": "bad"},
        {"id": 2, "timestamp": "2022-12-01T00:00:00Z"},
    ])
    lines(f"{base}/US_election+x_revision_content.json", [
        {"from_id": "2", "to_id": "1", "title": "x", "date": "2022", "text": "ab", "type": 1},
        {"from_id": "2", "to_id": "1", "title": "x", "date": "2022", "text": None},
    ])
    lines(f"{base}/Only meta_revisions.json", [{"id": 7, "timestamp": "2020-01-01T00:00:00Z"}])
    return base


def test_reads_by_name(spark, folder, rows):
    meta = landed.read_metadata(spark, f"{folder}/*_revisions.json")
    assert {(r["title"], r["id"]) for r in meta.collect()} == {
        ("US_election+x", 1), ("US_election+x", 2), ("Only meta", 7),
    }
    assert meta.where("id = 1 AND timestamp IS NULL").count() == 1
    assert rows(landed.revision_ids(meta)) == [(1,), (2,), (7,)]
    content = landed.read_content(spark, f"{folder}/*_revision_content.json")
    assert rows(content, "to_id", "text") == [("1", "ab"), ("1", None)]
    listing = landed.listed_titles(spark, folder)
    assert rows(listing) == [("Only meta", True, False), ("US_election+x", True, True)]
    assert rows(landed.complete_titles(listing)) == [("US_election+x",)]


ODD_TITLES = [
    "Star Wars: Part 4", "A%B", "AC/DC?", "C++", "a=b", "100% proof", "Zoë ☃", "plain", "50%25", "x#y",
]


def test_titles_through_folders(spark, tmp_path, rows):
    path = str(tmp_path / "folders")
    data = [(t + end, i) for i, t in enumerate(ODD_TITLES) for end in ("_revisions.json", "_revision_content.json")]
    sinks.write_by(spark.createDataFrame(data, "file string, id long"), path, "file")
    meta = landed.read_metadata(spark, path).where("title IS NOT NULL AND title <> ''")
    assert {(r["title"], r["id"]) for r in meta.collect()} == {(t, i) for i, t in enumerate(ODD_TITLES)}
    assert rows(landed.listed_titles(spark, path)) == sorted(
        [(t, True, True) for t in ODD_TITLES], key=repr
    )


def test_titles_of_plain_files(spark, tmp_path, rows):
    path = str(tmp_path / "files")
    # Neither of these can be a plain file's name in Spark's file systems.
    titles = [t for t in ODD_TITLES if "/" not in t and ":" not in t]
    for i, title in enumerate(titles):
        lines(f"{path}/{title}_revisions.json", [{"id": i}])
    got = {(r["title"], r["id"]) for r in landed.read_metadata(spark, path).collect()}
    assert got == {(t, i) for i, t in enumerate(titles)}
    assert rows(landed.listed_titles(spark, path)) == sorted([(t, True, False) for t in titles], key=repr)


def test_mixed_scan_has_no_empty_key(spark, folder, rows):
    mixed = landed.read_mixed(spark, folder)
    assert mixed.count() == 6
    assert rows(revisions.revision_chars(mixed)) == [("1", "2022", 2)]


def payload_frame(spark, *payloads, **columns):
    data = [(*columns.values(), json.dumps(p)) for p in payloads]
    kinds = ", ".join([f"{c} string" for c in columns] + ["payload string"])
    return spark.createDataFrame(data, kinds)


def test_payloads(spark, rows):
    top = payload_frame(
        spark,
        {"items": [{"articles": [{"article": "A", "views": 3, "rank": 1}]},
                   {"articles": [{"article": "later item", "views": 1}]}]},
        {"items": []},
        {"error": "x"},
    )
    assert rows(landed.top_views(top)) == [("A", 3)]
    pages = payload_frame(spark, {"query": {"pages": {
        "1": {"title": "T", "revisions": [{"slots": {"main": {"content": "text"}}}]},
        "-1": {"title": "M", "missing": ""},
        "3": {"title": "E", "revisions": []},
    }}})
    assert rows(landed.page_texts(pages)) == [
        ("-1", "M", landed.NO_CONTENT), ("1", "T", "text"), ("3", "E", landed.NO_CONTENT),
    ]
    assert rows(landed.page_summaries(pages, 2)) == [("E", "No"), ("M", "No"), ("T", "te")]
    views = payload_frame(spark, {"items": [{"article": "A", "timestamp": "2022010100", "views": 4}]})
    assert rows(landed.page_views(views)) == [("A", "2022010100", 4)]
    new = payload_frame(spark, {"items": [{"results": [
        {"timestamp": "2022-01-01T00:00:00.000Z", "new_registered_users": 5}]}]})
    assert [(str(t), n) for t, n in landed.registrations(new).collect()] == [
        ("2022-01-01 00:00:00", 5)
    ]
    members = payload_frame(
        spark, {"query": {"categorymembers": [{"title": "P"}, {"title": "Category:S"}]}}, category="C"
    )
    assert rows(landed.category_members(members)) == [("C", "Category:S", True), ("C", "P", False)]


def test_diffs(spark, rows):
    stamp = dict(from_id="2", to_id="1", title="t", date="d")
    diffs = payload_frame(spark, {"diff": [{"type": 1, "text": "a"}, {"type": 2}]}, **stamp)
    broken = payload_frame(spark, {"message": "not found"}, **stamp)
    both = diffs.unionByName(broken)
    assert rows(landed.diff_pieces(both)) == [
        ("2", "1", "t", "d", 0, "a"), ("2", "1", "t", "d", 1, None),
    ]
    assert landed.diffless(both).count() == 1


def test_listing_defaults(spark, tmp_path):
    path = str(tmp_path / "l" / "a.json")
    lines(path, [{"title": "t", "revisions": [{"id": 1, "timestamp": "2020-01-01T00:00:00Z"}]}])
    row = landed.revision_listing(landed.read_json(spark, path, schemas.REVISION_LISTING)).first()
    assert (row["comment"], row["content"], str(row["timestamp"])) == ("", "", "2020-01-01 00:00:00")


def test_partitioned_write_replaces_only_what_it_brings(spark, rows):
    path = scratch_path(spark, "t")
    first = spark.createDataFrame([("a/b", 1), ("c", 2)], "title string, v int")
    sinks.write_by(first, path, "title")
    sinks.write_by(spark.createDataFrame([("c", 3)], "title string, v int"), path, "title")
    back = spark.read.schema("v int, title string").json(path)
    assert rows(back, "title", "v") == [("a/b", 1), ("c", 3)]


def test_csv_keeps_empty_text_and_header(spark, rows):
    path = scratch_path(spark, "c")
    df = spark.createDataFrame([("a,b", 1), ("", 2), (None, 3), ('q"x', 4)], "s string, v int")
    sinks.write_csv(df, path)
    assert rows(landed.read_csv(spark, path, "s string, v int")) == rows(df)


def test_append_counts_what_it_saves(spark, rows):
    path = scratch_path(spark, "a")
    df = spark.createDataFrame([(1,), (2,)], "id long")
    sinks.append_json(df, path)
    assert sinks.append_counted(df, path) == 2
    again = spark.read.schema("id long").json(path)
    assert again.count() == 4 and rows(landed.revision_ids(again)) == [(1,), (2,)]


def test_lexicon_file(spark, rows):
    path = scratch_path(spark, "w")
    sinks.write_lexicon(spark.createDataFrame([("word",), ("ai",)], "word string"), path)
    assert rows(landed.read_lexicon(spark, path)) == [("ai",), ("word",)]
    assert path.startswith(shared_dir(spark))


# Incremental landing --------------------------------------------------------


def test_only_new_files_are_taken(spark, tmp_path, rows):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for n in (1, 2):
        lines(f"{inbox}/f{n}.json", [{"id": n, "timestamp": f"2022-01-0{n}T00:00:00Z"}])
        stream = ingest.arriving(spark, inbox, schemas.REVISION_META)
        ingest.land_new_files(stream.select("id"), out, mark)
    assert rows(spark.read.parquet(out)) == [(1,), (2,)]


def test_repeats_are_dropped_across_runs(spark, tmp_path, rows):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for n in (1, 2):
        lines(f"{inbox}/f{n}.json", [
            {"id": 1, "timestamp": "2022-01-01T00:00:00Z"},
            {"id": n + 5, "timestamp": "2022-01-01T01:00:00Z"},
        ])
        stream = ingest.arriving(spark, inbox, schemas.REVISION_META).select("id", "timestamp")
        ingest.without_repeats(stream, "id", "timestamp", "2 days", out, mark)
    assert rows(spark.read.parquet(out), "id") == [(1,), (6,), (7,)]


def test_counts_grow_and_late_rows_are_dropped(spark, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    arrivals = [
        ["2022-01-01T00:10:00Z", "2022-01-01T00:20:00Z"],
        ["2022-01-01T00:30:00Z", "2022-01-09T00:00:00Z"],
        ["2022-01-01T00:40:00Z"],
    ]
    seen = []
    for n, stamps in enumerate(arrivals):
        lines(f"{inbox}/f{n}.json", [{"id": i, "timestamp": t} for i, t in enumerate(stamps)])
        stream = ingest.arriving(spark, inbox, schemas.REVISION_META).select("timestamp")
        ingest.windowed_counts(stream, "timestamp", "1 hour", "1 day", out, mark)
        latest = ingest.latest_counts(spark, out).orderBy(F.col("start"))
        seen.append([r["n"] for r in latest.collect()])
    assert seen == [[2], [3, 1], [3, 1]]


def test_content_without_pieces_keeps_the_order_of_its_file(spark, tmp_path):
    """Also where a file is read by several tasks, and where edges are blank."""
    rng = random.Random(8)
    texts = {}
    with open(tmp_path / f"a{landed.CONTENT_SUFFIX}", "w") as out:
        for rev in rng.sample(range(300), 300):
            hunks = [" ".join(rng.choices(["a", "b", " c", ""], k=40)) for _ in range(rng.randint(1, 30))]
            texts[rev] = hunks
            for line, text in enumerate(hunks):
                record = {"from_id": "0", "to_id": str(rev), "title": "a", "type": 1,
                          "lineNumber": line, "text": text}
                out.write(json.dumps(record) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 65536)
    try:
        content = landed.read_content(spark, str(tmp_path))
        assert content.rdd.getNumPartitions() > 5
        meta = spark.range(300).selectExpr("id", "timestamp_ntz'2020-01-01' AS timestamp")
        got = {r["to_id"]: r["full_text"] for r in revisions.revision_text(content, meta).collect()}
        assert got == {rev: " ".join(hunks) for rev, hunks in texts.items()}
        counts = {r["word"]: r["count"] for r in lexicon.word_counts(content).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = Counter(w for hunks in texts.values() for w in re.split(r"\s+", " ".join(hunks)))
    assert counts == want
    assert {"type", "lineNumber"} <= set(content.columns)


def test_closed_windows_once_and_late_rows_counted(spark, tmp_path):
    """A window comes once, when it is closed; late rows don't change it."""
    out, at = str(tmp_path / "out"), str(tmp_path / "at")

    def run(*days):
        spark.createDataFrame([(f"2020-01-{d:02d} 12:00:00",) for d in days], "ts string").select(
            F.col("ts").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = ingest.arriving(spark, str(tmp_path / "in"), T.StructType([T.StructField('ts', T.TimestampType())]), "parquet")
        return ingest.closed_windows(stream, "ts", "1 day", "2 days", out, at)

    def closed():
        return {(r["start"].day, r["n"]) for r in spark.read.parquet(out).collect()}

    assert run(1, 1, 2, 5) == 0
    assert closed() == {(1, 2), (2, 1)}
    assert run(2, 6, 4) == 1  # the second of January is closed, the fourth is not
    assert closed() == {(1, 2), (2, 1)}
    assert run(9) == 0
    assert closed() == {(1, 2), (2, 1), (4, 1), (5, 1), (6, 1)}
    assert spark.read.parquet(out).count() == 5


@pytest.mark.parametrize("parts", [1, 3])
def test_title_list_as_json(spark, tmp_path, parts):
    titles = ['a "b"', "c,d", "e\nf", "", "[g]", "a \"b\"", None]
    df = spark.createDataFrame([(t, 1) for t in titles], "title string, value int")
    path = str(tmp_path / "titles")
    sinks.write_json_list(df.repartition(parts), "title", path)
    told = []
    for name in os.listdir(path):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf8") as file:
                told += json.load(file)
    assert Counter(told) == Counter(titles[:-1])
    assert Counter(r.title for r in landed.read_json_list(spark, path).collect()) == Counter(told)
    sinks.write_json_list(df.limit(0), "title", path)
    assert landed.read_json_list(spark, path).count() == 0


def test_titles_of_long_paths_take_time_by_their_length(spark):
    ending = landed.META_SUFFIX
    want = {
        f"file:/a/x{ending}": "x",
        f"file:/a/file=x%2520y+z{ending}/part-0.json": "x y+z",
        f"file:/a/100%{ending}/part-0.json": "100%",
        f"file:/q{ending}/r{ending}/s": "r",
        f"a/{ending}/p": "",
        "a": "",
        "file:/" + "b" * 30_000 + "/" + "c" * 30_000: "",
    }
    paths = spark.createDataFrame([(p,) for p in want] + [(None,)], "p string")
    many = paths.crossJoin(spark.range(20)).select("p", landed.title_of(F.col("p")).alias("t"))
    begun = time.monotonic()
    got = many.distinct().collect()
    assert {r["p"]: r["t"] for r in got} == {**want, None: None}
    assert time.monotonic() - begun < 20
