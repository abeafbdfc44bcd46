"""Best-fit packing of tokenised documents into sequences of a fixed length.

Every document becomes its token ids and one end id; only a document longer than
a sequence is cut, into full pieces and a shorter last one. Large pieces (above a
third of the capacity) are matched greedily, the largest with the largest that
still fits, so at most two share a sequence; smaller ones then go, in falling
size, into the smallest gap that holds them.

Pieces of the same length can stand for each other, so the packing is found on
the counts by length alone. That table and the plan made from it are bounded by
the capacity, not by the data: the driver and the tasks never hold the pieces.
A piece finds its place by its number among the pieces of its length, which is
counted inside each task and then offset by the tasks before it.

Defined cases: a null or empty text is one piece that holds the end id. Repeated
rows and null ids are packed like any other row. Ties need no rule: pieces of
equal length are placed in the order in which tasks read them. An empty table
gives an empty result. Columns other than id and text are not looked at. Memory
grows with the longest text, not with the number of rows.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import in_batches, ship, small_batches, stored, worker_memory

CAPACITY = 2048
END_ID = 0


# The parts of a tokenizer file by which a chunk of printable ASCII and
# Latin-1 letters is lower-cased and split before the model sees it, and that split.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SIMPLE = rb"(?:(?!<\|)[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
SIMPLE_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+"


def byte_symbols() -> dict[int, int]:
    """The character by which a byte-level tokenizer writes each byte: itself if it
    is printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: 256 + i for i, b in enumerate(hidden)}


class Recent(dict):
    """``make(key)`` of keys met lately, two generations of about ``entries`` each.
    Keys above ``longest`` are made anew each time."""

    def __init__(self, make, entries: int, longest: int):
        super().__init__()
        self.make, self.entries, self.longest = make, entries, longest
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self[key] = value
        return value

    def age(self) -> None:
        if len(self) > self.entries:
            self.old = dict(self)
            self.clear()


class ChunkEncoder:
    """Token ids of whole texts, through a bounded memory of chunks.

    The tokenizer drops white space, so a text's ids are those of the chunks
    between ASCII white space, one after another. Chunks of printable ASCII and
    Latin-1 letters go to the tokenizer's model directly, word by word, where its
    file says that they are only lower-cased and split.
    """

    LONGEST = 200  # longer chunks are not remembered

    def __init__(self, path: str, entries: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young = Recent(self._chunk, entries, self.LONGEST)
        self.model = self.tokenizer.model.tokenize
        self.symbols = byte_symbols()
        parts = json.loads(self.tokenizer.to_str())
        normalizers = (parts["normalizer"] or {}).get("normalizers", [])
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.simple = (
            [n["type"] for n in normalizers] == NORMALIZERS
            and [s["type"] for s in splits] == ["Split", "ByteLevel"]
            and splits[0]["pattern"] == {"Regex": SPLIT}
            and not splits[1]["add_prefix_space"]
            and not splits[1]["use_regex"]
            and all(t["content"].startswith("<|") for t in parts["added_tokens"])
        )
        self.is_simple = re.compile(SIMPLE).fullmatch
        self.split = re.compile(SIMPLE_SPLIT).findall

    @property
    def old(self) -> dict[bytes, bytes]:
        return self.young.old

    def _chunk(self, chunk: bytes) -> bytes:
        if self.simple and self.is_simple(chunk):
            lower = chunk.decode().lower()
            words = self.split(lower)
            if not lower.isascii():
                words = [w.encode().decode("latin-1").translate(self.symbols) for w in words]
            return pack_ids([token.id for word in words for token in self.model(word)])
        text = chunk.decode("utf-8", "replace")
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        found = self.young.__getitem__
        ids = [b"".join(map(found, text.split())) for text in texts]
        self.young.age()
        return ids


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Placement(NamedTuple):
    """Pieces ``first`` to ``first + count`` of a length lie ``each`` to a
    sequence, from sequence ``sequence`` and from ``offset`` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


class _Packer:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(counts)
        self.used: dict[int, int] = defaultdict(int)
        self.plan: list[Placement] = []
        self.sequences = 0
        self.gaps: list[int] = []
        self.groups: dict[int, list[tuple[int, int]]] = {}

    def place(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.plan.append(Placement(length, self.used[length], count, sequence, each, offset))
        self.used[length] += count
        self.left[length] -= count

    def leave(self, gap: int, sequence: int, count: int) -> None:
        """``count`` sequences from ``sequence`` on have ``gap`` places free."""
        if gap and count:
            if gap not in self.groups:
                insort(self.gaps, gap)
                self.groups[gap] = []
            self.groups[gap].append((sequence, count))

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def match_large(self) -> None:
        sizes = sorted(s for s in self.left if 3 * s > self.capacity)
        while sizes:
            size = sizes[-1]
            n = self.left[size]
            if not n:
                sizes.pop()
                continue
            at = bisect_left(sizes, self.capacity - size + 1) - 1
            while at >= 0 and self.left[sizes[at]] <= (sizes[at] == size):
                if not self.left[sizes[at]]:
                    del sizes[at]
                at -= 1
            if at < 0:
                start = self.open(n)
                self.place(size, n, start, 1, 0)
                self.leave(self.capacity - size, start, n)
            elif sizes[at] == size:
                start = self.open(n // 2)
                self.place(size, n // 2 * 2, start, 2, 0)
                self.leave(self.capacity - 2 * size, start, n // 2)
            else:
                mate = sizes[at]
                m = min(n, self.left[mate])
                start = self.open(m)
                self.place(size, m, start, 1, 0)
                self.place(mate, m, start, 1, size)
                self.leave(self.capacity - size - mate, start, m)

    def fill(self, size: int, gap: int, sequence: int, count: int) -> None:
        """Put pieces into ``count`` sequences with ``gap`` places free."""
        each = gap // size
        n = min(self.left[size], each * count)
        whole, rest = divmod(n, each)
        offset = self.capacity - gap
        if whole:
            self.place(size, whole * each, sequence, each, offset)
            self.leave(gap - each * size, sequence, whole)
        if rest:
            self.place(size, rest, sequence + whole, rest, offset)
            self.leave(gap - rest * size, sequence + whole, 1)
        taken = whole + bool(rest)
        self.leave(gap, sequence + taken, count - taken)

    def fit_small(self) -> None:
        for size in sorted((s for s in self.left if 3 * s <= self.capacity), reverse=True):
            while self.left[size]:
                at = bisect_left(self.gaps, size)
                if at < len(self.gaps):
                    gap = self.gaps[at]
                    sequence, count = self.groups[gap].pop()
                    if not self.groups[gap]:
                        del self.groups[gap], self.gaps[at]
                else:
                    gap = self.capacity
                    count = -(-self.left[size] // (gap // size))
                    sequence = self.open(count)
                self.fill(size, gap, sequence, count)


def pack_counts(counts: dict[int, int], capacity: int) -> tuple[list[Placement], int]:
    """Where the pieces go, given how many there are of each length, and the
    number of sequences."""
    packer = _Packer(counts, capacity)
    packer.match_large()
    packer.fit_small()
    return packer.plan, packer.sequences


def numbered_by_size(sizes: np.ndarray, met: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its size; ``met`` counts those before
    and is moved on."""
    order = np.argsort(sizes, kind="stable")
    ranked = sizes[order]
    places = np.empty(len(sizes), np.int64)
    places[order] = np.arange(len(sizes)) - np.searchsorted(ranked, ranked) + met[ranked]
    met += np.bincount(sizes, minlength=len(met))
    return places


def tokenised_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, the task ``part`` and the number ``place`` among the pieces of
    the same length in it; with ``with_ids`` also ``ids``, 32-bit little-endian."""
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, piece int, start long,"
    schema += " length long, ids_crc32 long, part int, place long"
    schema += ", ids binary" if with_ids else ""

    def cut(batches):
        coder = worker_memory(("chunks", path), lambda: ChunkEncoder(path))
        part = TaskContext.get().partitionId()
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
        names += ["ids"] * with_ids
        met = np.zeros(capacity + 1, np.int64)
        for batch in small_batches(batches):
            every = [t or b"" for t in batch.column("body").to_pylist()]
            for a, b in in_batches(every, 2_000_000):
                coded = coder.encode(every[a:b])
                ids = memoryview(end.join([*coded, b""]))
                sizes = np.fromiter(map(len, coded), np.int64, b - a) // 4 + 1
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                # Pieces fill the ids without gaps, so they end where the next begins.
                ends = np.cumsum(length) * 4
                crcs = [zlib.crc32(ids[i:j]) for i, j in zip(ends - 4 * length, ends)]
                columns = [
                    batch.column("doc_id").take(pa.array(row + a)),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crcs, pa.int64()),
                    pa.array(np.full(len(row), part, np.int32)),
                    pa.array(numbered_by_size(length, met)),
                ]
                if with_ids:
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    parts = [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
                    columns.append(pa.Array.from_buffers(pa.binary(), len(row), parts))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("body")
    )
    return rows.mapInArrow(cut, schema)


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset`` and, if asked for, ``ids``."""
    spark = docs.sparkSession
    pieces = stored(
        tokenised_pieces(docs, path, capacity, end_id, id_col, text_col, with_ids), "pieces"
    )
    by_task = stored(
        pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts"
    )
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = pack_counts(counts, capacity)
    # Sorted by length and first piece, so that a piece finds its placement by search.
    ordered = np.array(sorted(plan), np.int64).reshape(-1, len(Placement._fields))
    shared = spark.sparkContext.broadcast(ordered)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = by_task.select(
        "length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    numbered = pieces.join(offsets, ["length", "part"]).withColumn(
        "number", F.col("before") + F.col("place")
    )

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length, number):
        import pandas as pd

        plan = shared.value
        lengths, numbers = length.to_numpy(), number.to_numpy()
        # Length and number in one value: no length has 2**50 pieces.
        at = np.searchsorted((plan[:, 0] << 50) | plan[:, 1], (lengths << 50) | numbers, "right")
        row = plan[at - 1]
        along, inside = np.divmod(numbers - row[:, 1], row[:, 4])
        return pd.DataFrame(
            {"sequence_id": row[:, 3] + along, "offset": row[:, 5] + inside * lengths}
        )

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return numbered.select(*columns, *["ids"] * with_ids, placed("length", "number").alias("at")).select(
        *columns, "at.sequence_id", "at.offset", *["ids"] * with_ids
    )
