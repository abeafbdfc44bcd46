"""Nearest neighbours by cosine with a hash-prefix forest.

Every tree hashes a vector to a string of 64 bits, the sides of random planes on
which it lies, and keeps the strings of all vectors as a sorted array. A query
descends in each tree to its longest prefix match and then ascends in all trees
at once, one prefix length after another, so vectors that share ever shorter
prefixes become candidates. It stops when a vector as near as the last of the
best found so far would have shared a prefix of this length in some tree with
probability 1 - ``miss``. Prefixes of length zero hold every vector, so nothing
is cut off: hard queries look at more.

The index is dealt out over shards, each with a forest of its own that is built
in one task from at most about ``shard_rows`` vectors. Queries go to all shards
in blocks and return their best from each.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id. Of rows with the same id one
is used, the smallest by its components. Vectors are only compared with vectors
of the same length. Equal scores go to the smaller id. Fewer candidates than ``k``
give all of them; an empty table gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import ship, stored

TREES, SHARD_ROWS, MISS, LEAST = 24, 16_384, 0.05, 64
QUERY_BLOCK = 128


class Forest:
    """Sorted hash strings of a shard's vectors, one array for each tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int, seed: int = 7):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.unit = vectors / self.norms[:, None]
        planes = np.random.default_rng((seed, vectors.shape[1]))
        self.planes = [planes.standard_normal((vectors.shape[1], 64)) for _ in range(trees)]
        self.strings, self.order = [], []
        for tree in range(trees):
            strings = self.hashed(tree, self.unit)
            order = np.argsort(strings, kind="stable")
            self.strings.append(strings[order])
            self.order.append(order)

    def hashed(self, tree: int, unit: np.ndarray) -> np.ndarray:
        bits = np.packbits(unit @ self.planes[tree] > 0, axis=1)
        return bits.view(">u8").ravel().astype(np.uint64)

    def ranges(self, strings: np.ndarray, level: int) -> np.ndarray:
        """First and last place in each tree of what shares ``level`` bits with
        each query: trees x 2 x queries."""
        rest = np.uint64((1 << (64 - level)) - 1)
        return np.array(
            [
                (
                    np.searchsorted(have, asked & ~rest, "left"),
                    np.searchsorted(have, asked | rest, "right"),
                )
                for have, asked in zip(self.strings, strings)
            ]
        )

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, miss: float):
        """Query id, neighbour id and score of the ``k`` nearest found."""
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        strings = [self.hashed(t, unit) for t in range(len(self.planes))]
        # Descend: the longest prefix at which all trees together hold enough.
        level = np.zeros(len(ids), int)
        spans: dict[int, np.ndarray] = {0: self.ranges(strings, 0)}
        enough = max(LEAST, k + 1)
        for at in range(1, 64):
            spans[at] = self.ranges(strings, at)
            held = (spans[at][:, 1] - spans[at][:, 0]).sum(axis=0)
            if not (held >= enough).any():
                break
            level[held >= enough] = at
        products = None
        for q in range(len(ids)):
            at = int(level[q])
            while True:
                met = self._met(spans[at][:, :, q])
                if len(met) * 8 < len(self.ids):
                    score = self.unit[met] @ unit[q]
                else:  # cheaper for the whole block at once
                    if products is None:
                        products = unit @ self.unit.T
                    score = products[q][met]
                score = np.where(self.ids[met] == ids[q], -np.inf, score)
                last = np.partition(score, -k)[-k] if len(score) >= k else -np.inf
                goal = self._goal(last, miss)
                if goal >= at:
                    break
                at = goal
            # Ties are decided on exact scores, so those next to the last are kept.
            near = met[(score >= last - 1e-9) & np.isfinite(score)]
            length = math.sqrt((vectors[q] * vectors[q]).sum())
            exact = (self.vectors[near] * vectors[q]).sum(axis=1) / (self.norms[near] * length)
            for i in np.lexsort((self.ids[near], -exact))[:k]:
                yield int(ids[q]), int(self.ids[near[i]]), float(exact[i])

    def _met(self, spans: np.ndarray) -> np.ndarray:
        """Places of the vectors that any tree has in its span."""
        met = np.zeros(len(self.ids), bool)
        for order, (low, high) in zip(self.order, spans):
            met[order[low:high]] = True
        return np.flatnonzero(met)

    def _goal(self, last: float, miss: float) -> int:
        """The prefix length down to which to ascend, given the last score."""
        if not np.isfinite(last):
            return 0
        same = 1 - math.acos(max(-1.0, min(1.0, last))) / math.pi
        if not 0 < same < 1:
            return 63 if same >= 1 else 0
        # A vector this near is missed by every tree: (1 - same ** level) ** trees.
        wanted = 1 - miss ** (1 / len(self.planes))
        return min(63, int(math.log(wanted) / math.log(same)))


def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(
        (F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def nearest(
    df: DataFrame,
    queries: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    shard_rows: int = SHARD_ROWS,
    miss: float = MISS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows that ``queries``
    (a condition on ``vec_id``) selects, searched among all rows."""
    ship(df.sparkSession)
    vectors = stored(
        df.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        .where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector")),
        "vectors",
    )
    shards = max(1, -(-vectors.count() // shard_rows))
    asked = vectors.where(queries)
    dealt = vectors.select(
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
        F.lit(0).alias("asks"),
        "vec_id",
        "vector",
    ).unionByName(
        asked.select(
            F.size("vector").alias("dim"),
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
            F.lit(1).alias("asks"),
            "vec_id",
            "vector",
        )
    )

    def searched(batches):
        group, held, forest = None, [], None
        for batch in batches:
            dim, shard, asks, ids = (
                batch.column(c).to_numpy() for c in ("dim", "shard", "asks", "vec_id")
            )
            change = (np.diff(dim) != 0) | (np.diff(shard) != 0) | (np.diff(asks) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if group != (dim[a], shard[a]):
                    group, held, forest = (dim[a], shard[a]), [], None
                column = batch.column("vector").slice(a, b - a)
                rows = column.flatten().to_numpy().reshape(b - a, dim[a])
                if not asks[a]:
                    held.append((ids[a:b], rows.copy()))
                    continue
                if forest is None:
                    if not held:
                        continue
                    forest = Forest(*(np.concatenate(x) for x in zip(*held)), trees)
                    held = []
                for low in range(0, b - a, QUERY_BLOCK):
                    block = slice(low, low + QUERY_BLOCK)
                    found = list(forest.search(ids[a:b][block], rows[block], k, miss))
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c) for c in zip(*found)], names=["query_id", "vec_id", "score"]
                        )

    found = (
        dealt.repartition(shards, "dim", "shard")
        .sortWithinPartitions("dim", "shard", "asks", "vec_id")
        .mapInArrow(searched, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
