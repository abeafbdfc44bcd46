"""Byte-level BPE: encoding whole texts by a rank file, and decoding.

Two tiers resolve a pre-token. A minimal perfect hash over the vocabulary finds
it whole; what is not in the vocabulary is merged from its bytes, the pair of the
lowest rank first and the leftmost of equals, with a heap over a linked list of
the parts, so a pre-token of n bytes takes n log n steps.

In front of both stands a bounded memory of units. A unit is cut off where a
single space lies between two characters that are not white space: a pre-token
always ends there, so units can be split and encoded on their own.

Defined cases: a null text counts as empty, an empty text has no ids. Rows are
encoded one by one, so repeated rows, null ids and ties need no rule; an empty
table gives an empty result. Columns other than id and text are not looked at.
Memory grows with the longest text, not with the number of rows.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import ship, small_batches, worker_memory


class MinimalPerfectHash:
    """Maps each of n keys to its own slot of n, by hashing and displacing.

    Keys are hashed to buckets. Buckets are placed from the largest on, each
    with the first displacement that takes all its keys to free slots; a bucket
    of one key is given a free slot outright, written as a negative number.
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, self.size // 2)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in keys:
            groups[xxhash.xxh64_intdigest(key) % self.buckets].append(key)
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        free = None
        for bucket in order:
            group = groups[bucket]
            if len(group) > 1:
                by = 0
                while not self._fits(group, by):
                    by += 1
                self.shift[bucket] = by
                for key in group:
                    self.keys[self._slot(key, by)] = key
            elif group:
                if free is None:  # from here on, every bucket has one key
                    free = iter([i for i, k in enumerate(self.keys) if k is None])
                slot = next(free)
                self.shift[bucket] = -slot - 1
                self.keys[slot] = group[0]

    def _slot(self, key: bytes, by: int) -> int:
        return xxhash.xxh64_intdigest(key, by + 1) % self.size

    def _fits(self, group: list[bytes], by: int) -> bool:
        slots = {self._slot(key, by) for key in group}
        return len(slots) == len(group) and all(self.keys[s] is None for s in slots)

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 if it isn't one of the keys."""
        by = self.shift[xxhash.xxh64_intdigest(key) % self.buckets]
        at = -by - 1 if by < 0 else self._slot(key, by)
        return at if self.keys[at] == key else -1


def merged(piece: bytes, rank) -> list[bytes]:
    """The parts of ``piece`` after all merges; ``rank(part)`` is None if unknown."""
    n = len(piece)
    after = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n))
    ranks = [-1] * n  # of the pair that starts here
    heap = []  # rank and place in one number
    for i in range(n - 1):
        if (r := rank(piece[i : i + 2])) is not None:
            ranks[i] = r
            heap.append(r * n + i)
    heapify(heap)
    while heap:
        r, i = divmod(heappop(heap), n)
        if ranks[i] != r:
            continue  # one of its parts has been merged since
        middle = after[i]
        end = after[i] = after[middle]
        ranks[middle] = ranks[i] = -1
        before[end] = i
        if end < n and (r := rank(piece[i : after[end]])) is not None:
            ranks[i] = r
            heappush(heap, r * n + i)
        if (left := before[i]) >= 0:
            if (r := rank(piece[left:end])) is not None:
                ranks[left] = r
                heappush(heap, r * n + left)
            else:
                ranks[left] = -1
    parts, i = [], 0
    while i < n:
        parts.append(piece[i : after[i]])
        i = after[i]
    return parts


class _Memory(dict):
    """Remembers what ``make`` returns for a key, for 2 * ``entries`` keys at most
    and none that is longer than ``LONGEST``."""

    LONGEST = 200

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.make(key)
        if len(key) <= self.LONGEST:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Codec:
    def __init__(self, path: str, pattern: str, entries: int = 300_000):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.hash = MinimalPerfectHash(list(self.ranks))
        self.id_of_slot = [self.ranks[key] for key in self.hash.keys]
        self.bytes_of_id = {rank: key for key, rank in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.tokens = _Memory(self.encode_token, entries)
        self.units = _Memory(self._encode_unit, entries)

    def encode_token(self, token: str) -> tuple[int, ...]:
        """Ids of one pre-token: whole if the hash has it, else merged."""
        raw = token.encode()
        slot = self.hash.slot(raw)
        if slot >= 0:
            return (self.id_of_slot[slot],)
        return tuple(self.ranks[part] for part in merged(raw, self.ranks.get))

    def _encode_unit(self, part: str) -> tuple[int, ...] | None:
        """Ids of a space and ``part``; None where these can't stand alone."""
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        return self.encode_plain(" " + part)

    def encode_plain(self, text: str) -> tuple[int, ...]:
        found = list(map(self.tokens.__getitem__, self.find(text)))
        return found[0] if len(found) == 1 else tuple(chain.from_iterable(found))

    def encode(self, text: str) -> list[int]:
        parts = text.split(" ")
        ids = list(map(self.units.__getitem__, parts[1:]))
        first = parts[0]
        if None in ids or not first or first[-1].isspace():
            return self._encode_joined(parts)
        return list(chain(self.encode_plain(first), chain.from_iterable(ids)))

    def _encode_joined(self, parts: list[str]) -> list[int]:
        """Keeps parts together that white space other than one space separates."""
        ids: list[int] = []
        open_unit = [parts[0]]
        for part in parts[1:]:
            last = open_unit[-1]
            if last and part and not last[-1].isspace() and not part[0].isspace():
                ids += self._closed(open_unit, not ids)
                open_unit = [part]
            else:
                open_unit.append(part)
        return [*ids, *self._closed(open_unit, not ids)]

    def _closed(self, unit: list[str], first: bool) -> tuple[int, ...]:
        if not first and len(unit) == 1 and (ids := self.units[unit[0]]) is not None:
            return ids
        return self.encode_plain(("" if first else " ") + " ".join(unit))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of_id.__getitem__, ids))


def codec(path: str, pattern: str) -> Codec:
    """The codec of this Python worker."""
    return worker_memory(("codec", path, pattern), lambda: Codec(path, pattern))


def _mapped(docs: DataFrame, id_col: str, value: str, as_type: str, names: str, kinds, convert):
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in small_batches(batches, 256):
            rows = [convert(v) for v in batch.column("value").to_pylist()]
            columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                names=["doc_id", *(name for name, _ in kinds)],
            )

    chosen = docs.select(
        F.col(id_col).alias("doc_id"), F.col(value).cast(as_type).alias("value")
    )
    return chosen.mapInArrow(run, f"doc_id {id_type}, {names}")


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row's whole text."""
    return _mapped(
        docs, id_col, text_col, "string", "ids array<int>", [("ids", pa.list_(pa.int32()))],
        lambda text: (codec(path, pattern).encode(text or ""),),
    )


def decode_documents(
    coded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``doc_id`` and the ``bytes`` that every row's ids stand for; null is empty."""
    return _mapped(
        coded, id_col, ids_col, "array<int>", "bytes binary", [("bytes", pa.binary())],
        lambda ids: (codec(path, pattern).decode(ids or []),),
    )


def round_trip_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_tokens``, and SHA-256 of the decimal ids and of the bytes
    decoded from them, without moving the ids between Python and Spark."""

    def digests(text):
        coder = codec(path, pattern)
        ids = coder.encode(text or "")
        written = " ".join(map(str, ids)).encode()
        return (
            len(ids),
            hashlib.sha256(written).hexdigest(),
            hashlib.sha256(coder.decode(ids)).hexdigest(),
        )

    return _mapped(
        docs, id_col, text_col, "string",
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
        [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())],
        digests,
    )
