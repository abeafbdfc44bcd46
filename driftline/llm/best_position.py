"""Ranked lexical search by the Best Position Algorithm.

Every term of a query has an impact list: the documents that hold it, by falling
gain. A round reads the next places of all lists in parallel; a document met for
the first time is looked up in all other lists (direct access), so its whole score
is known and its place counts as seen in every list. The best position of a list
is the last place up to which all are seen, however they were. No unseen document
can score more than the gains at the best positions add up to, and a query stops
once this is strictly below its k-th best score; equal scores thus never get lost.

Documents are counted once (terms, documents and occurrences over the whole
table), and what they hold of the queried terms is written as one row a document.
Tasks then cut their rows into blocks of bounded size, build the lists of each
block, and carry a query's best k from block to block, which lets later blocks stop
sooner. A task hands on k rows a query at most, and these are merged by Spark.
Nothing is shuffled by term or document, so no term, source or group of copies can
be hot. Queries are taken in blocks of ``TERMS`` distinct terms: only such a block
is ever held by the driver or sent to the tasks, and each is asked of all rows.

Scores are whole numbers: a term's weight floor(1000 ln((2N+2)/(2df+1))), times
(10^9 tf) div (1000 tf + 8 m), m = 25 + (75 n N) div L, summed over the terms of
the query, repeats included.

Defined cases: null and empty texts, and texts without a term, are no documents of
N and match nothing. A query without a term, or with terms no document holds, has
no row. Rows are documents each on its own, so repeated rows rank side by side, and
equal scores go by ascending document id, a null id last. Two queries of the same
id are ranked apart. An empty table on either side gives an empty result. Columns
other than the ids and texts are not looked at. Memory grows with the longest text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import ship, small_batches, stored

#: Distinct terms of one block of queries.
TERMS = 8192
#: Cells of a block's table of terms by documents.
CELLS = 8_000_000
#: Places of each list that the first round reads; each later round reads twice as many.
FIRST_PLACES = 16
NO_ID = np.iinfo(np.int64).max

_LETTERS = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
).lower()


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters; A-Z lowered."""
    return (text or "").encode().translate(_LETTERS).split()


class Query(NamedTuple):
    number: int
    #: Numbers of its distinct terms and how often it has each.
    terms: np.ndarray
    repeats: np.ndarray


def _query_blocks(
    queries: DataFrame, id_col: str, text_col: str, most: int
) -> Iterator[tuple[list[bytes], list[Query], list]]:
    """Blocks of queries with their term list and their ids, of ``most`` terms or of
    one longer query. Rows come one by one, so the driver holds one block."""
    number_of: dict[bytes, int] = {}
    block: list[Query] = []
    ids: list = []
    for row in queries.select(id_col, text_col).toLocalIterator():
        counted = Counter(terms_of(row[1]))
        if not counted:
            continue
        if block and len(number_of.keys() | counted.keys()) > most:
            yield list(number_of), block, ids
            number_of, block, ids = {}, [], []
        numbers = [number_of.setdefault(term, len(number_of)) for term in counted]
        block.append(Query(len(ids), np.array(numbers), np.array(list(counted.values()))))
        ids.append(row[0])
    if block:
        yield list(number_of), block, ids


def _held(docs: DataFrame, terms: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: what each document has of ``terms``; n counts all."""
    ship(docs.sparkSession)
    wanted = {term: i for i, term in enumerate(terms)}

    def run(batches):
        for batch in small_batches(batches, 256):
            sizes, numbers, counts, at = [], [], [], []
            for text in batch.column("text"):
                found = terms_of(text.as_py())
                sizes.append(len(found))
                at.append(len(numbers))
                for term, tf in Counter(found).items():
                    if (i := wanted.get(term)) is not None:
                        numbers.append(i)
                        counts.append(tf)
            ends = pa.array([*at, len(numbers)], pa.int32())
            held = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )
            yield held.filter(pa.array([n > 0 for n in sizes], pa.bool_()))

    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return chosen.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Lists:
    """Impact lists of a block of documents, with direct access to every cell.

    ``gain[t, d]`` is what document d gains from term t, before the term's weight;
    ``order[t]`` names the documents of term t's list by falling gain, and
    ``length[t]`` says how many hold the term.
    """

    def __init__(self, n_terms, docs, terms, tfs, damping, ids):
        self.ids = ids
        self.gain = np.zeros((n_terms, len(ids)), np.int32)
        self.gain[terms, docs] = (10**9 * tfs) // (1000 * tfs + 8 * damping[docs])
        self.order = np.argsort(-self.gain, axis=1, kind="stable").astype(np.uint16)
        self.length = np.count_nonzero(self.gain, axis=1)


class Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.key = np.empty(0, np.int64), np.empty(0, np.int64)

    def kth(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, key: np.ndarray) -> None:
        good = score > 0 if len(self.score) < self.k else score >= self.score[-1]
        if good.any():
            score = np.concatenate([self.score, score[good]])
            key = np.concatenate([self.key, key[good]])
            first = np.lexsort((key, -score))[: self.k]
            self.score, self.key = score[first], key[first]


def search(lists: Lists, rows: np.ndarray, worth: np.ndarray, best: Best) -> int:
    """Puts the best documents of a block into ``best``; how many were looked at.

    ``rows`` are the query's terms and ``worth`` their weights times repeats.
    """
    held = lists.length[rows] > 0
    rows, worth = rows[held], worth[held]
    if not len(rows):
        return 0
    gain, order, length = lists.gain[rows], lists.order[rows], lists.length[rows]
    each = np.arange(len(rows))
    seen = np.zeros(gain.shape[1], bool)
    read, step, looked = 0, FIRST_PLACES, 0
    while read < length.max():
        places = np.arange(read, min(read + step, int(length.max())))
        met = order[:, places][places < length[:, None]]
        new = np.unique(met[~seen[met]])
        seen[new] = True
        looked += len(new)
        best.add(worth @ gain[:, new].astype(np.int64), lists.ids[new])
        read, step = read + step, 2 * step
        # The best position: places from the top that are all seen, met in this
        # list or by direct access from another one.
        gap = ~seen[order]
        gap[np.arange(gap.shape[1]) >= length[:, None]] = True
        run = np.where(gap.any(axis=1), gap.argmax(axis=1), gap.shape[1])
        at_best = np.where(run >= length, 0, gain[each, order[each, run - 1]])
        if int(worth @ at_best) < best.kth():
            break
    return looked


def _blocks(batches, docs_a_block: int):
    """Arrow batches joined or cut to ``docs_a_block`` rows; the last may be shorter."""
    waiting, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, docs_a_block - rows)
            waiting.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == docs_a_block:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, rows = [], 0
    if rows:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _found(
    held: DataFrame, queries: list[Query], weights: np.ndarray, total: int, words: int,
    k: int, cells: int,
) -> DataFrame:
    """``query, doc_id, score``: the k best of every query among each task's rows."""
    docs_a_block = max(1, min(60_000, cells // len(weights)))

    def run(batches):
        best = [Best(k) for _ in queries]
        for block in _blocks(batches, docs_a_block):
            ids = block["doc_id"].fill_null(NO_ID).to_numpy()
            if words * 75 < 2**31 and total < 2**31:
                damping = 25 + (75 * block["n"].to_numpy() * total) // words
            else:  # the product may need more than 64 bits
                damping = np.array([25 + 75 * n * total // words for n in block["n"].to_pylist()])
            listed = block["terms"].chunk(0), block["tfs"].chunk(0)
            docs = np.repeat(np.arange(len(ids)), listed[0].value_lengths().to_numpy())
            terms, tfs = (a.flatten().to_numpy() for a in listed)
            lists = Lists(len(weights), docs, terms, tfs, damping, ids)
            for query, found in zip(queries, best, strict=True):
                search(lists, query.terms, weights[query.terms] * query.repeats, found)
        size = [len(b.score) for b in best]
        keys = np.concatenate([b.key for b in best])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([q.number for q in queries], size), pa.int32()),
                pa.array(keys, pa.int64(), mask=keys == NO_ID),
                pa.array(np.concatenate([b.score for b in best]), pa.int64()),
            ],
            names=["query", "doc_id", "score"],
        )

    return held.where(F.size("terms") > 0).mapInArrow(run, "query int, doc_id long, score long")


def ranked(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    terms: int = TERMS,
    cells: int = CELLS,
) -> DataFrame:
    """``query_id, rank, doc_id, score``: the ``k`` best documents of every query."""
    spark = docs.sparkSession
    answers = []
    for known, block, ids in _query_blocks(queries, query_id, query_text, terms):
        held = stored(_held(docs, known, doc_id, doc_text), "held-terms")
        total, words = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # At most as many rows as the block of queries has terms.
        df = dict(
            held.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
        )
        weights = np.array(
            [
                math.floor(1000 * math.log((2 * total + 2) / (2 * df.get(t, 0) + 1)))
                for t in range(len(known))
            ],
            np.int64,
        )
        found = _found(held, block, weights, total, max(1, words), k, cells)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = spark.createDataFrame(
            list(enumerate(ids)),
            f"query int, {query_id} {queries.schema[query_id].dataType.simpleString()}",
        )
        answer = first.join(F.broadcast(named), "query").select(
            query_id, "rank", F.col("doc_id").alias("doc_id"), "score"
        )
        # Answers are written block by block, so that no plan holds all the queries.
        answers.append(stored(answer, "ranked"))
    if not answers:
        kind = queries.schema[query_id].dataType.simpleString()
        return spark.createDataFrame([], f"{query_id} {kind}, rank int, doc_id long, score long")
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    return every
