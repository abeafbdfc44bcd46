"""Near duplicates by SimHash, found with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The binary Golay
code of length 23 has one codeword within three bits of every segment. Each
segment is decoded to the index of its nearest codeword; where that is exactly
three bits away, the codewords at four bits (five of them) are further keys. Two
segments that differ in at most one bit then always meet: the nearest codeword
of one is among the keys of the other.

If two fingerprints differ in at most three bits, at most one of the segments
differs in more than one (two such would make four bits). So for each of the
three pairs of segments fingerprints are stored under the nearest codewords and
looked up under all keys, and what meets is verified bit by bit. No link within
three bits is missed. Other distances are refused.

Only distinct fingerprints are joined, so copies cost nothing; a bucket holds
few of them, and both sides of the join can be split.

Defined cases: a null text counts as empty; texts without words have the
fingerprint zero and link like any other. Repeated rows are returned once each.
A component without any id has the id null. An empty table gives an empty
result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm import simhash
from driftline.llm.common import release_memory, ship, small_batches, stored, unused
from driftline.llm.components import component_roots

#: First bit and length of each segment.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
DISTANCE = 3
# Fixed value: the generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b110001110101


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    left = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        left ^= ((left >> bit) & 1) * (GENERATOR << (bit - 11))
    return left


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each syndrome the error of at most three bits, its number of bits,
    and, where it has three, the five errors of four bits."""
    near, bits = np.zeros(2048, np.int64), np.zeros(2048, np.int64)
    far: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        errors = np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)])
        for error, syndrome in zip(errors.tolist(), _syndromes(errors).tolist()):
            if weight < 4:
                near[syndrome], bits[syndrome] = error, weight
            else:
                far[syndrome].append(error)
    five = np.array([errors or [0] * 5 for errors in far])
    return near, bits, five


def segments(prints: np.ndarray) -> list[np.ndarray]:
    return [
        ((prints >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64)
        for at, size in SEGMENTS
    ]


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the nearby codewords, nearest first, and how many are keys."""
    near, bits, five = tables()
    syndromes = _syndromes(words)
    every = np.concatenate([near[syndromes][:, None], five[syndromes]], axis=1) ^ words[:, None]
    return every >> 11, np.where(bits[syndromes] == 3, 6, 1)


def bucket_keys(prints: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """Place in ``prints`` and key, for storing or for looking up (``probe``)."""
    places, keys = [], []
    decoded = [codewords(words) for words in segments(prints)]
    for number, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        (first, n), (second, m) = decoded[i], decoded[j]
        for a, b in product(range(6), range(6)) if probe else [(0, 0)]:
            at = np.flatnonzero((a < n) & (b < m))
            places.append(at)
            keys.append((number << 24) | (first[at, a] << 12) | second[at, b])
    return np.concatenate(places), np.concatenate(keys)


def with_keys(prints: DataFrame, probe: bool) -> DataFrame:
    """``key`` and ``fp`` for each bucket that a row of ``prints`` (``fp``) uses."""

    def keyed(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            at, keys = bucket_keys(fps.view(np.uint64), probe)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int32)), pa.array(fps[at])], names=["key", "fp"]
            )

    return prints.select("fp").mapInArrow(keyed, "key int, fp long")


def linked(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct ``fp`` that meet under a key and differ in at
    most ``distance`` bits: all there are, if that is three at most."""
    held = with_keys(prints, False).alias("h")
    asked = with_keys(prints, True).alias("q")
    differing = F.bit_count(F.col("h.fp").bitwiseXOR(F.col("q.fp")))
    met = held.hint("merge").join(
        asked,
        (F.col("h.key") == F.col("q.key"))
        & (F.col("h.fp") != F.col("q.fp"))
        & (differing <= distance),
    )
    return met.select(
        F.least("h.fp", "q.fp").alias("a"), F.greatest("h.fp", "q.fp").alias("b")
    ).distinct()


def fingerprinted(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3
) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, of every row."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def printed(batches):
        release_memory()
        for batch in small_batches(batches):
            texts = [t or b"" for t in batch.column("body").to_pylist()]
            fps = simhash.fingerprints(texts, width).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"]
            )

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("body")
    )
    return rows.mapInArrow(printed, f"doc_id {id_type}, fp long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``fp``, ``component_id`` (the smallest
    id that links reach, its own included)."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the keys find up to {DISTANCE} differing bits")
    rows = stored(fingerprinted(docs, id_col, text_col, width), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = stored(component_roots(linked(prints, distance)), "roots")
    placed = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    placed = stored(placed, "placed")
    ids = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    of_print = stored(placed.join(ids, "root").select("fp", "component_id"), "print-components")
    return rows.join(of_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    distance: int = DISTANCE,
) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id.

    Rows without an id stay only where no row of their component has one. Of rows
    with one id in one component, that of the smallest text digest stays, once.
    """
    key = unused(docs, "row")
    doc_id, sha = F.col(id_col), F.sha2(F.coalesce(text_col, F.lit("")).cast("binary"), 256)
    ordered = F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), sha.alias("sha"))
    named = lambda i, s: F.concat_ws(" ", i.cast("string"), s)
    rows = docs.select(ordered.alias("id"), F.col(text_col).alias("text"))
    groups = near_duplicates(rows, "id", "text", width, distance)
    kept = stored(
        groups.where("doc_id = component_id")
        .groupBy(named(F.col("doc_id.id"), F.col("doc_id.sha")).alias(key))
        .agg(F.count("*").alias("rows")),
        "kept",
    )
    left = docs.withColumn(key, named(doc_id, sha)).join(kept.select(key), key, "left_semi")
    if not kept.where(F.col("rows") > 1).isEmpty():  # the same row more than once
        left = left.dropDuplicates([key])
    return left.select(docs.columns)


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
