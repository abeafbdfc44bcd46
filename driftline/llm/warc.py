"""WARC archives: writing with segments and revisits, and reassembly on reading.

Writing. Each row becomes one record, or several: a block longer than
``segment_bytes`` is cut into a first segment and continuation records that name
it as their origin. Of rows with equal payloads of at least ``least`` bytes the
one with the largest id is written as a response; the others are revisits that
refer to it and carry no payload. Payloads travel in chunked transfer framing.

Reading. Archives are read file by file and record by record. Continuation
records are grouped by origin, put in the order of their segment numbers, their
length is held against the total in the last segment, and the chunked framing is
decoded. Only payloads that were cut are shuffled for this.

Defined cases: a null payload is empty. Rows with a null id are written, with
the id ``null``; they are revisits of any equal payload that has an id. Of
repeated rows with the same id and payload one is a response and the others
revisit it. Line ends in a URL are percent-encoded. A payload whose segments are
missing, contradict each other or differ in length from the stated total, whose
block is cut short, or whose framing is broken is returned with a null payload and
the reason in ``problem``. Archives may be gzipped, by record or whole, or plain.
Where a file can't be read on (corrupt or cut data, a record without a valid length)
what came before is returned, and a row without a type names the file and the reason.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import ship, stored

SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 16 * 1024
#: Bounds a file: at most this many records of one segment each.
RECORDS_PER_FILE = 4096
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 and HTTP/1.1 formats.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (
    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    "Transfer-Encoding: chunked\r\n\r\n"
)
RECORD_ID = "urn:driftline:record:"


def base32(hex40: Column) -> Column:
    """Base 32 of a 160-bit value given as 40 hexadecimal digits."""
    parts = [
        F.lpad(F.conv(F.substring(hex40, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def payload_digest(payload: Column) -> Column:
    return base32(F.sha1(payload))


def _pieces(value: Column, size: int, least: int) -> Column:
    count = F.greatest(F.ceil(F.octet_length(value) / size), F.lit(least)).cast("int")
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(
        F.array().cast("array<int>")
    )


def _cut(value: Column, number: Column, size: int) -> Column:
    return F.substring(value, (number - 1) * size + 1, F.lit(size))


def chunked(payload: Column, size: int = CHUNK_BYTES) -> Column:
    """Chunked transfer framing of a binary column, as binary."""

    def chunk(number: Column) -> Column:
        piece = _cut(payload, number, size)
        return F.concat(
            F.lower(F.hex(F.octet_length(piece))), F.lit("\r\n"), piece.cast("string"),
            F.lit("\r\n"),
        )

    # As strings, which Spark joins byte by byte without looking at the encoding.
    body = F.array_join(F.transform(_pieces(payload, size, 0), chunk), "")
    return F.concat(body, F.lit("0\r\n\r\n")).cast("binary")


def plan_records(rows: DataFrame, least: int = 0) -> DataFrame:
    """Which (``id``, ``digest``) is a response and what the others refer to.

    ``rows`` has ``id``, ``url``, ``payload``. Returns ``id``, ``digest``,
    ``bytes``, ``copy`` (1 for the first of repeated rows), ``url``,
    ``response``, ``refers_to``; only hashes and ids are shuffled.
    """
    narrow = stored(
        rows.select(
            "id",
            "url",
            payload_digest(F.col("payload")).alias("digest"),
            F.octet_length("payload").alias("bytes"),
        )
        .groupBy("id", "digest", "bytes")
        .agg(F.count("*").alias("copies"), F.max("url").alias("url")),
        "warc-plan",
    )
    holders = stored(
        narrow.where(F.col("bytes") >= least)
        .groupBy("digest", "bytes")
        .agg(F.max("id").alias("holder")),
        "warc-holders",
    )
    large = F.col("bytes") >= least
    planned = narrow.join(holders, ["digest", "bytes"], "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    response = ~large | (F.col("id").eqNullSafe(F.col("holder")) & (F.col("copy") == 1))
    return planned.select(
        "id",
        "digest",
        "bytes",
        "copy",
        "url",
        response.alias("response"),
        F.when(~response, F.col("holder")).alias("refers_to"),
    )


def _record_id(row_id: Column, copy: Column) -> Column:
    """Names a record by its row's id, payload and place among repeated rows."""
    named = F.coalesce(row_id.cast("string"), F.lit("null"))
    return F.concat(F.lit(RECORD_ID), named, F.lit(":"), F.col("digest"), F.lit(":"), copy)


def row_id(record_id: Column) -> Column:
    """The id, as text, of the row that a record was written for; null for none."""
    found = F.regexp_extract(record_id, f"^{RECORD_ID}(.*):[A-Z2-7]+:[0-9]+$", 1)
    return F.nullif(F.nullif(found, F.lit("null")), F.lit(""))


def _head(kind: Column, record_id: Column, url: Column, *more: tuple[str, Column]) -> Column:
    safe = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <"), record_id, F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), safe),
        *[F.concat(F.lit(f"{name}: "), value) for name, value in more],
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def _bracketed(value: Column) -> Column:
    return F.concat(F.lit("<"), value, F.lit(">"))


def records(rows: DataFrame, least: int = 0, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One ``value`` per WARC record, header and block, without the closing lines."""
    planned = stored(plan_records(rows, least), "warc-records")
    key = ["id", "digest"]
    revisits = planned.where("NOT response").select(
        _head(
            F.lit("revisit"),
            _record_id(F.col("id"), F.col("copy")),
            F.col("url"),
            ("WARC-Profile", F.lit(REVISIT_PROFILE)),
            ("WARC-Refers-To", _bracketed(_record_id(F.col("refers_to"), F.lit(1)))),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("Content-Length", F.lit("0")),
        ).alias("value")
    )
    # Payloads go to their response by id, which no two large groups share.
    payloads = rows.select(
        F.col("id"), payload_digest(F.col("payload")).alias("digest"), "payload"
    )
    repeated = not planned.where("copy > 1").isEmpty()
    wanted = planned.where("response").alias("w")
    given = (payloads.dropDuplicates(key) if repeated else payloads).alias("p")
    blocks = wanted.join(
        given,
        F.col("w.id").eqNullSafe(F.col("p.id")) & (F.col("w.digest") == F.col("p.digest")),
    ).select(
        "w.id",
        "w.copy",
        "w.url",
        "w.digest",
        F.concat(F.lit(HTTP_HEAD).cast("binary"), chunked(F.col("p.payload"))).alias("block"),
    )
    size = F.octet_length("block")
    cut = (
        blocks.withColumn("size", size)
        .withColumn("parts", F.size(_pieces(F.col("block"), segment_bytes, 1)))
        .withColumn("number", F.explode(_pieces(F.col("block"), segment_bytes, 1)))
        .withColumn("piece", _cut(F.col("block"), F.col("number"), segment_bytes))
        .drop("block")
    )
    first, several = F.col("number") == 1, F.col("parts") > 1
    origin = _record_id(F.col("id"), F.col("copy"))
    head = _head(
        F.when(first, "response").otherwise("continuation"),
        F.when(first, origin).otherwise(F.concat(origin, F.lit(":"), F.col("number"))),
        F.col("url"),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        ("WARC-Segment-Number", F.when(several, F.col("number").cast("string"))),
        ("WARC-Segment-Origin-ID", F.when(~first, _bracketed(origin))),
        (
            "WARC-Segment-Total-Length",
            F.when(several & (F.col("number") == F.col("parts")), F.col("size").cast("string")),
        ),
        ("Content-Type", F.when(first, "application/http;msgtype=response")),
        ("Content-Length", F.octet_length("piece").cast("string")),
    )
    responses = cut.select(F.concat(head, F.col("piece").cast("string")).alias("value"))
    return responses.unionByName(revisits)


def write_archives(
    rows: DataFrame,
    path: str,
    least: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write ``rows`` (``id``, ``url``, binary ``payload``) as gzipped WARC files."""
    rows = rows.withColumn("payload", F.coalesce("payload", F.lit(b"")))
    (
        records(rows, least, segment_bytes)
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


class _Source:
    """Reads lines and spans from an archive held as bytes, piece by piece.

    ``broken`` says why nothing more can be had before the data's proper end.
    """

    STEP = 1 << 16

    def __init__(self, data):
        self.data, self.at = memoryview(data), 0
        self.ready, self.used = b"", 0
        self.inflate = zlib.decompressobj(31)
        self.plain = bytes(self.data[:5]) == b"WARC/"
        self.broken: str | None = None

    def _more(self) -> bool:
        try:
            got = self._raw() if self.plain else self._inflated()
        except zlib.error:
            got, self.broken = b"", "the compressed data is corrupt"
            self.at, self.plain = len(self.data), True
        if got:
            self.ready, self.used = self.ready[self.used :] + got, 0
        return bool(got)

    def _inflated(self) -> bytes:
        while (
            self.at < len(self.data)
            or self.inflate.unconsumed_tail
            or (self.inflate.eof and self.inflate.unused_data.strip(b"\0"))
        ):
            if self.inflate.eof:  # the next member of the file
                raw = self.inflate.unused_data.lstrip(b"\0") or self._raw().lstrip(b"\0")
                if not raw:
                    continue
                self.inflate = zlib.decompressobj(31)
            else:
                raw = self.inflate.unconsumed_tail or self._raw()
            if got := self.inflate.decompress(raw, 1 << 20):
                return got
        if len(self.data) and not self.inflate.eof:
            self.broken = "the compressed data ends early"
        return b""

    def _raw(self) -> bytes:
        piece = bytes(self.data[self.at : self.at + self.STEP])
        self.at += len(piece)
        return piece

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``; None, and nothing used, if it doesn't come."""
        while (end := self.ready.find(mark, self.used)) < 0:
            if not self._more():
                return None
        got = self.ready[self.used : end]
        self.used = end + len(mark)
        return got

    def take(self, size: int) -> bytes:
        while len(self.ready) - self.used < size and self._more():
            pass
        got = self.ready[self.used : self.used + size]
        self.used += len(got)
        return got


def _number(text: str | None, below: int) -> int | None:
    """A count as headers state it; None if it is none."""
    if text is None or not re.fullmatch("[0-9]{1,19}", text):
        return None
    return int(text) if int(text) < below else None


def read_file(data) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Headers, with lower-case names, block and problem of each record of a file.

    Where reading can't go on, the last item says why and has no headers.
    """
    source = _Source(data)
    while (head := source.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").split("\r\n")
        while lines and not lines[0]:
            lines.pop(0)
        if not lines:
            continue
        if not lines[0].startswith("WARC/"):
            yield {}, b"", "a record does not begin with its version"
            return
        headers = {
            name.strip().lower(): value.strip()
            for name, _, value in (line.partition(":") for line in lines[1:])
        }
        size = _number(headers.get("content-length"), 1 << 63)
        if size is None:
            yield headers, b"", "the record states no length"
            yield {}, b"", "after a record without a length nothing can be read"
            return
        block, problem = source.take(size), None
        if len(block) < size:
            problem = "the block is cut short"
        for name, below in (("warc-segment-number", 1 << 31), ("warc-segment-total-length", 1 << 63)):
            if name in headers and _number(headers[name], below) is None:
                problem = problem or f"{name} is no number"
        yield headers, block, problem
    if source.broken:
        yield {}, b"", source.broken
    elif source.ready[source.used :].strip(b"\r\n\0"):
        yield {}, b"", "a header is cut short"


def parse(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record that a file holds whole."""
    return ((headers, block) for headers, block, problem in read_file(data) if problem is None)


RECORD_SCHEMA = (
    "warc_type string, record_id string, origin_id string, segment int, total long,"
    " refers_to string, digest string, uri string, block binary, problem string, archive string"
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, one row each.

    ``problem`` says what is wrong with a record, and in rows without a type why the
    rest of the file ``archive`` could not be read.
    """
    ship(spark)

    def rows_of(batches):
        schema = pa.schema(
            [("warc_type", pa.string()), ("record_id", pa.string()), ("origin_id", pa.string()),
             ("segment", pa.int32()), ("total", pa.int64()), ("refers_to", pa.string()),
             ("digest", pa.string()), ("uri", pa.string()), ("block", pa.binary()),
             ("problem", pa.string()), ("archive", pa.string())]
        )

        def row(h, block, problem, name):
            named = lambda key: h.get(key, "").strip("<>") or None
            return (
                h.get("warc-type"),
                named("warc-record-id"),
                named("warc-segment-origin-id"),
                _number(h.get("warc-segment-number"), 1 << 31),
                _number(h.get("warc-segment-total-length"), 1 << 63),
                named("warc-refers-to"),
                h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                h.get("warc-target-uri"),
                block,
                problem,
                name,
            )

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema
            )

        for batch in batches:
            for data, name in zip(batch.column(0), batch.column(1).to_pylist()):
                rows, size = [], 0
                for h, block, problem in read_file(data.as_buffer()):
                    rows.append(row(h, block, problem, name))
                    size += len(block)
                    if size > 4_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content", "path").mapInArrow(rows_of, RECORD_SCHEMA)


def decode_chunked(body: bytes) -> bytes:
    """The payload in a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk size is missing")
        stated = bytes(body[at:end]).split(b";")[0].strip()
        if not re.fullmatch(b"[0-9A-Fa-f]+", stated):
            raise ValueError("a chunk size is no number")
        size = int(stated, 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response, its transfer framing removed."""
    head, mark, body = bytes(block).partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("the HTTP header does not end")
    coded = any(
        name.strip().lower() == b"transfer-encoding" and b"chunked" in value.lower()
        for name, _, value in (line.partition(b":") for line in head.split(b"\r\n"))
    )
    return decode_chunked(body) if coded else body


def assemble(segments) -> bytes:
    """The block whose segments are given as dicts of ``segment``, ``total``,
    ``block``, in any order; the same segment may come twice. ValueError if they
    make no whole block, or if one has a ``problem``."""
    if problems := sorted({s["problem"] for s in segments if s.get("problem")}):
        raise ValueError("; ".join(problems))
    if segments[0]["segment"] is None:
        return segments[0]["block"]
    by_number = {s["segment"]: s for s in segments}
    if any(s["block"] != by_number[s["segment"]]["block"] for s in segments):
        raise ValueError("two segments of one number differ")
    last = by_number[max(by_number)]
    if sorted(by_number) != list(range(1, len(by_number) + 1)) or last["total"] is None:
        raise ValueError("a segment is missing")
    block = b"".join(by_number[n]["block"] for n in sorted(by_number))
    if len(block) != last["total"]:
        raise ValueError("the total length differs")
    return block


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit: ``record_id``, ``warc_type``, ``uri``,
    ``refers_to``, ``digest``, ``payload`` (null for revisits), ``problem`` and
    ``archive``; and one without a type for each file that could not be read on."""

    @F.pandas_udf("payload binary, problem string")
    def decoded(groups: pd.Series) -> pd.DataFrame:
        rows = []
        for segments in groups:
            try:
                rows.append((http_payload(assemble(list(segments))), None))
            except ValueError as error:
                rows.append((None, str(error)))
        return pd.DataFrame(rows, columns=["payload", "problem"])

    every = read_records(spark, path)
    one = F.struct("segment", "total", "block", "problem")
    whole = every.where("segment IS NULL AND warc_type = 'response'").select(
        "record_id", "uri", "digest", "archive", F.array(one).alias("segments")
    )
    first = F.col("warc_type") == "response"
    parts = (
        every.where("segment IS NOT NULL")
        .groupBy(F.coalesce("origin_id", "record_id").alias("record_id"))
        .agg(
            F.max(F.when(first, F.col("uri"))).alias("uri"),
            F.max(F.when(first, F.col("digest"))).alias("digest"),
            F.max("archive").alias("archive"),
            F.collect_list(one).alias("segments"),
        )
    )
    responses = (
        whole.unionByName(parts)
        .withColumn("got", decoded("segments"))
        .select(
            "record_id",
            F.lit("response").alias("warc_type"),
            "uri",
            F.lit(None).cast("string").alias("refers_to"),
            "digest",
            "got.payload",
            "got.problem",
            "archive",
        )
    )
    revisits = every.where(
        "segment IS NULL AND warc_type = 'revisit' OR warc_type IS NULL AND problem IS NOT NULL"
    ).select(
        "record_id",
        "warc_type",
        "uri",
        "refers_to",
        "digest",
        F.lit(None).cast("binary").alias("payload"),
        "problem",
        "archive",
    )
    return responses.unionByName(revisits)
