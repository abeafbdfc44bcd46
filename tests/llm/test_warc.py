import base64
import glob
import gzip
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftline.llm import warc

ROWS = [
    (1, "http://a/", b"same"),
    (2, "http://b/", b"same"),
    (3, None, b"same"),
    (4, "http://c/\r\nX: y", b""),
    (5, "http://d/", None),
    (6, "http://e/", bytes(range(256)) * 40 + b"\r\n\r\nWARC/1.1\r\n"),
    (7, "http://f/", b"\r\n0\r\n\r\n"),
    (None, "http://g/", b"same"),
    (None, "http://h/", b"alone"),
    (8, "http://i/", b"twice"),
    (8, "http://i/", b"twice"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(
        [(i, u, None if p is None else bytearray(p)) for i, u, p in rows],
        "id long, url string, payload binary",
    )


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.mark.parametrize("least", [0, 5, 10_000])
def test_round_trip(spark, tmp_path, least):
    path = str(tmp_path / "out")
    warc.write_archives(frame(spark), path, least, segment_bytes=100, records_per_file=7)
    got = warc.read_payloads(spark, path).collect()
    assert len(got) == len(ROWS) and not any(r.problem for r in got)
    ids = Counter(r.record_id.split(":")[-3] for r in got)
    assert ids == Counter("null" if i is None else str(i) for i, _, _ in ROWS)
    by_record = {r.record_id: r for r in got}
    for r in got:
        held = r if r.warc_type == "response" else by_record[r.refers_to]
        assert held.warc_type == "response" and digest(bytes(held.payload)) == r.digest
    payloads = {}
    for i, _, p in ROWS:
        payloads.setdefault(p or b"", []).append(i)
    for payload, ids in payloads.items():
        mine = [r for r in got if r.digest == digest(payload)]
        if len(payload) < least:
            assert all(r.warc_type == "response" for r in mine)
            continue
        (response,) = [r for r in mine if r.warc_type == "response"]
        largest = max((i for i in ids if i is not None), default="null")
        assert response.record_id.split(":")[-3] == str(largest)
        assert {r.refers_to for r in mine if r is not response} <= {response.record_id}


def test_archives_follow_the_format(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_archives(frame(spark), path, segment_bytes=1000)
    seen = Counter()
    for name in glob.glob(path + "/*.gz"):
        data = gzip.open(name).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            fields = dict(line.split(b": ", 1) for line in lines[1:])
            size = int(fields[b"Content-Length"])
            assert size <= 1000 and rest[size : size + 4] == b"\r\n\r\n"
            seen[fields[b"WARC-Type"]] += 1
            data = rest[size + 4 :]
    assert seen[b"continuation"] >= 10 and seen[b"revisit"] == 5


def test_segments():
    part = lambda n, total, block: {"segment": n, "total": total, "block": block}
    a, b, c = part(1, None, b"ab"), part(2, None, b"cd"), part(3, 5, b"e")
    assert warc.assemble([c, a, b, b]) == b"abcde"
    assert warc.assemble([part(None, None, b"x")]) == b"x"
    for broken in ([a, c], [a, b], [b, c], [a, b, part(3, 6, b"e")]):
        with pytest.raises(ValueError):
            warc.assemble(broken)


def test_chunked():
    assert warc.decode_chunked(b"3\r\nabc\r\n2;x=y\r\n\r\n\r\n0\r\n\r\n") == b"abc\r\n"
    for broken in (b"", b"3\r\nab", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n", b"1\r\na\r\n"):
        with pytest.raises(ValueError):
            warc.decode_chunked(broken)


def test_broken_payloads_are_named(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:driftline:record:{0}:1>\r\n{1}Content-Length: {2}\r\n\r\n{3}\r\n\r\n"
    short = "HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab"
    lone = "HTTP/1.1 200 OK\r\n\r\nabc"
    text = record.format(1, "", len(short), short)
    text += record.format(2, "WARC-Segment-Number: 1\r\n", len(lone), lone)
    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.warc.gz", "wb") as out:
        out.write(text.encode())
    got = {r.record_id[-3]: r for r in warc.read_payloads(spark, str(tmp_path / "in")).collect()}
    assert got["1"].payload is None and "chunk" in got["1"].problem
    assert got["2"].payload is None and "segment" in got["2"].problem


def test_digest_and_empty(spark, tmp_path):
    df = frame(spark)
    for r in df.select("payload", warc.payload_digest(F.col("payload")).alias("d")).collect():
        assert r.d == (None if r.payload is None else digest(bytes(r.payload)))
    warc.write_archives(df.limit(0), str(tmp_path / "out"))
    assert warc.read_payloads(spark, str(tmp_path / "out")).count() == 0


def test_a_member_for_each_record():
    def record(i):
        head = f"WARC/1.1\r\nWARC-Record-ID: <r{i}>\r\nContent-Length: 5\r\n\r\n"
        return gzip.compress(f"{head}{i:05}\r\n\r\n".encode())

    for count in (1, 3, 2000):
        data = b"".join(map(record, range(count)))
        for padding in (b"", bytes(512)):
            got = list(warc.parse(data + padding))
            assert [block for _, block in got] == [b"%05d" % i for i in range(count)]


def written(i, block, extra="", length=None):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r{i}>\r\n{extra}"
    stated = len(block) if length is None else length
    return f"{head}Content-Length: {stated}\r\n\r\n".encode() + block + b"\r\n\r\n"


PAGE = b"HTTP/1.1 200 OK\r\n\r\n" + b"page " * 100


def test_broken_archives_are_named_and_end_no_job(spark, tmp_path):
    good = gzip.compress(written(1, PAGE))
    flipped = bytearray(gzip.compress(written(2, PAGE)))
    flipped[len(flipped) // 2] ^= 255
    files = {
        "cut.gz": gzip.compress(written(1, PAGE)[:300]),
        "length.gz": gzip.compress(written(1, PAGE) + written(2, PAGE, length="many") + written(3, PAGE)),
        "none.gz": gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r1>\r\n\r\n"),
        "no-gzip.gz": b"<html>not an archive</html>\r\n\r\n",
        "corrupt.gz": good + bytes(flipped),
        "truncated.gz": good + gzip.compress(written(2, PAGE))[:-20],
        "header.gz": gzip.compress(written(1, PAGE) + b"WARC/1.1\r\nWARC-Ty"),
        "foreign.gz": gzip.compress(written(1, PAGE) + b"something else\r\n\r\n"),
        "number.gz": gzip.compress(written(1, PAGE, "WARC-Segment-Number: first\r\n")),
        "plain.warc": written(1, PAGE) + written(2, PAGE),
        "empty.gz": b"",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = {}
    for r in warc.read_payloads(spark, str(tmp_path)).collect():
        got.setdefault(r.archive.rsplit("/", 1)[1], []).append(r)
        assert (r.payload is None) == (r.problem is not None)
        assert r.payload is None or bytes(r.payload) == b"page " * 100
    problems = lambda name: {r.record_id: r.problem for r in got[name] if r.problem}
    whole = lambda name: sorted(r.record_id for r in got[name] if not r.problem)
    assert problems("cut.gz") == {"r1": "the block is cut short"}
    assert set(problems("length.gz")) == {"r2", None} and whole("length.gz") == ["r1"]
    assert set(problems("none.gz").values()) >= {"the record states no length"}
    assert problems("no-gzip.gz") == {None: "the compressed data is corrupt"}
    assert whole("corrupt.gz") == ["r1"] and None in problems("corrupt.gz")
    assert "r1" in whole("truncated.gz")
    assert problems("truncated.gz")[None] == "the compressed data ends early"
    assert whole("header.gz") == ["r1"] and problems("header.gz") == {None: "a header is cut short"}
    assert whole("foreign.gz") == ["r1"] and "version" in problems("foreign.gz")[None]
    assert "no number" in problems("number.gz")["r1"]
    assert whole("plain.warc") == ["r1", "r2"] and not problems("plain.warc")
    assert "empty.gz" not in got


def test_segments_that_contradict_each_other():
    part = lambda n, total, block, **more: {"segment": n, "total": total, "block": block, **more}
    for broken in (
        [part(1, None, b"ab"), part(1, None, b"xy"), part(2, 4, b"cd")],
        [part(1, None, b"ab"), part(2, 4, b"cd", problem="the block is cut short")],
    ):
        with pytest.raises(ValueError):
            warc.assemble(broken)
    for size in (b"-2", b"+1", b"1_0", b""):
        with pytest.raises(ValueError):
            warc.decode_chunked(size + b"\r\nab\r\n0\r\n\r\n")
