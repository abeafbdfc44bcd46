"""Perplexity under a class-based bigram model (Brown classes).

Words are put into classes by exchange clustering: a unit moves to the class that
raises the likelihood of the class bigrams most, round after round. A text's
probability is the product of class transitions and word emissions,
P(class | class before) * P(word | class), over its words and one end.

Exchange has two steps. First the ``head`` most frequent words, each on its own, and
for all other words the groups of those with the same hashed ending are exchanged one
by one; their bigrams are a table bounded by the number of units, so this runs on the
driver. Then each word past the head, of the ``local`` most frequent, gets its own class: whole
sweeps over the corpus count the classes before and after each word, tasks find the
class that gains most for every word, and all move at once. A sweep is kept only if
the likelihood of the whole corpus rises; ``sweeps`` bounds their number, and they end
earlier where nothing moves. Words beyond these keep their ending's group, which moves
like a word. Every word thus has a class, and every training token counts.

Counting, vocabulary and scoring are distributed and grow with the data. Classes and
counts of the ``local`` words are broadcast; all others are joined, once per document
and word. No key of that join is hot, because hot words never enter it. Words longer
than ``WORD_BYTES`` are named by their SHA-256, so they are as short as any.

Defined cases: a null text counts as empty and has one token, its end. Words
that were never seen are known by the class of their ending. Without training
rows every probability falls back to the smoothing alone. Repeated rows and rows
without an id are scored each on its own. Columns other than id and text are not
looked at. Memory grows with the longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import in_batches, ship, stored

HEAD, ENDINGS, CLASSES, ROUNDS, SWEEPS = 1024, 256, 64, 6, 2
LOCAL, WORD_BYTES = 50_000, 64
#: Added to the counts of class transitions.
MOVE_SMOOTHING = 0.5
#: Words that a task counts before it hands its counts on.
HELD_WORDS = 400_000


def words(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space; long words as their names."""
    found = (text or b"").lower().split()
    if found and max(map(len, found)) > WORD_BYTES:
        # No UTF-8 text holds the byte FF, so a name is no word.
        name = lambda w: b"\xff" + hashlib.sha256(w).digest()
        found = [w if len(w) <= WORD_BYTES else name(w) for w in found]
    return found


class Units(dict):
    """Unit of a word: its own if it is in the head, else that of its ending."""

    def __init__(self, head: list[bytes], endings: int):
        super().__init__((word, i) for i, word in enumerate(head))
        self.first, self.endings = len(head), endings

    def __missing__(self, word: bytes) -> int:
        return self.first + zlib.crc32(word[-3:]) % self.endings

    @property
    def edge(self) -> int:
        """The unit before the first and after the last word."""
        return self.first + self.endings

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("binary").alias("body"))


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (binary) and ``n`` over all rows."""

    def counted(batches):
        counts: Counter[bytes] = Counter()

        def flush():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"],
            )
            counts.clear()

        for batch in batches:
            for body in batch.column("body").to_pylist():
                counts.update(words(body))
                if len(counts) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    rows = _texts(docs, text_col).mapInArrow(counted, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def unit_lines(docs: DataFrame, own: list[bytes], endings: int, text_col: str) -> DataFrame:
    """The texts as ``line``s of unit numbers, each text between two edges.

    Words are looked up once here; every later count reads the numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(own)

    def looked_up(batches):
        units = Units(shared.value, endings)
        edge, kind = np.array([units.edge], np.int32), _kind(units.edge)
        for batch in batches:
            bodies = [body or b"" for body in batch.column("body").to_pylist()]
            lines = []
            for a, b in in_batches(bodies, 2_000_000):
                parts = [edge]
                for body in bodies[a:b]:
                    parts += [units.of(words(body)), edge]
                lines.append(np.concatenate(parts).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["line"])

    return _texts(docs, text_col).mapInArrow(looked_up, "line binary")


def _kind(edge: int) -> np.dtype:
    return np.min_scalar_type(edge)


def _lines(batches, edge: int):
    for batch in batches:
        for line in batch.column("line"):
            yield np.frombuffer(line.as_buffer(), _kind(edge)).astype(np.int64)


def count_bigrams(lines: DataFrame, to: np.ndarray) -> np.ndarray:
    """Counts of bigrams as a square table, unit ``u`` counted as ``to[u]``.

    The last unit, the edge, is counted in the last row and column.
    """
    side = int(to[-1]) + 1
    shared = lines.sparkSession.sparkContext.broadcast(to)

    def counted(batches):
        to = shared.value
        sums = np.zeros(side * side, np.int64)
        for line in _lines(batches, len(to) - 1):
            line = to[line]
            pairs = line[:-1] * side + line[1:]
            if len(pairs) > len(sums):
                sums += np.bincount(pairs, minlength=side * side)
            else:
                np.add.at(sums, pairs, 1)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["pair", "n"])

    rows = lines.mapInArrow(counted, "pair long, n long")
    table = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(side * side, np.int64)
    counts[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    return counts.reshape(side, side)


def _weight(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _best(table, after, before, own, old, classes) -> tuple[int, float]:
    """Where a unit of class ``old`` raises the likelihood most, and by how much.

    ``after`` and ``before`` count the classes around the unit, itself left out;
    ``own`` counts it before itself; ``table`` is that of all other units.
    """
    here = np.arange(len(table))
    some = np.flatnonzero(after)
    rows = _weight(table[:, some] + after[some]) - _weight(table[:, some])
    gain = rows.sum(axis=1)
    gain[some] -= rows[some, np.arange(len(some))]
    some = np.flatnonzero(before)
    columns = _weight(table[some] + before[some, None]) - _weight(table[some])
    gain += columns.sum(axis=0)
    gain[some] -= columns[np.arange(len(some)), some]
    # The corner is counted once.
    corner = table[here, here]
    gain += _weight(corner + after + before + own) - _weight(corner)
    out, into = table.sum(axis=1) + before, table.sum(axis=0) + after
    gain -= _weight(out + after.sum() + own) - _weight(out)
    gain -= _weight(into + before.sum() + own) - _weight(into)
    best = int(np.argmax(gain[:classes]))
    if gain[best] <= gain[old] + 1e-9:
        best = old
    return best, float(gain[best] - gain[old])


def exchange(bigrams: np.ndarray, classes: int, rounds: int) -> np.ndarray:
    """The class of each unit; the last unit, the edge, keeps a class of its own.

    Maximises the likelihood of the class bigrams. Units are taken by falling
    frequency, ties by number, and stay where they are unless a move gains.
    """
    side = len(bigrams)
    bigrams = bigrams.astype(float)
    order = np.argsort(-bigrams[:-1].sum(axis=1), kind="stable")
    of = np.empty(side, np.int64)
    of[order] = np.arange(side - 1) % classes
    of[-1] = classes
    total = classes + 1
    member = np.zeros((side, total))
    member[np.arange(side), of] = 1
    table = member.T @ bigrams @ member
    for _ in range(rounds):
        moved = 0
        for unit in order:
            after = np.bincount(of, bigrams[unit], total)
            before = np.bincount(of, bigrams[:, unit], total)
            own, old = bigrams[unit, unit], of[unit]
            after[old] -= own
            before[old] -= own
            table[old] -= after
            table[:, old] -= before
            table[old, old] -= own
            best, _ = _best(table, after, before, own, old, classes)
            moved += best != old
            of[unit] = best
            table[best] += after
            table[:, best] += before
            table[best, best] += own
        if not moved:
            break
    return of


def likelihood(table: np.ndarray) -> float:
    """What of the log-likelihood of class bigrams depends on the classes."""
    sides = _weight(table.sum(axis=0)).sum() + _weight(table.sum(axis=1)).sum()
    return float(_weight(table).sum() - sides)


def best_moves(lines: DataFrame, of: np.ndarray, table: np.ndarray, first: int) -> DataFrame:
    """``unit``, the class ``best`` and the ``gain`` of each unit from ``first`` on
    that gains by a move while all others stay."""
    total = int(of[-1]) + 1
    width, kept = 2 * total + 1, len(of) - 1 - first
    shared = lines.sparkSession.sparkContext.broadcast((of, table))

    def counted(batches):
        classes_of, _ = shared.value
        cells = np.zeros(kept * width, np.int64)
        for line in _lines(batches, len(classes_of) - 1):
            near, unit = classes_of[line], line - first
            mine = (unit >= 0) & (unit < kept)
            left, right = mine[:-1], mine[1:]
            np.add.at(cells, unit[:-1][left] * width + near[1:][left], 1)
            np.add.at(cells, unit[1:][right] * width + total + near[:-1][right], 1)
            twice = left & (line[:-1] == line[1:])
            np.add.at(cells, unit[:-1][twice] * width + 2 * total, 1)
        every = np.flatnonzero(cells)
        for low in range(0, len(every), 500_000):
            at = every[low : low + 500_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((at // width).astype(np.int32)),
                    pa.array((at % width).astype(np.int32)),
                    pa.array(cells[at]),
                ],
                names=["unit", "cell", "n"],
            )

    def decided(batches):
        classes_of, table = shared.value
        cells = np.zeros(kept * width, np.int64)
        for batch in batches:
            unit, cell, n = (batch.column(i).to_numpy() for i in range(3))
            np.add.at(cells, unit.astype(np.int64) * width + cell, n)
        cells = cells.reshape(kept, width)
        rows = []
        for unit in np.flatnonzero(cells.any(axis=1)):
            old, said = int(classes_of[first + unit]), cells[unit].astype(float)
            after, before, own_n = said[:total].copy(), said[total:-1].copy(), said[-1]
            after[old] -= own_n
            before[old] -= own_n
            rest = table.astype(float)
            rest[old] -= after
            rest[:, old] -= before
            rest[old, old] -= own_n
            best, gain = _best(rest, after, before, own_n, old, total - 1)
            if best != old:
                rows.append((first + int(unit), best, gain))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64()))],
                names=["unit", "best", "gain"],
            )

    # A unit's counts, one row a task and cell, come together in one task.
    return (
        lines.mapInArrow(counted, "unit int, cell int, n long")
        .repartition("unit")
        .mapInArrow(decided, "unit int, best int, gain double")
    )


class Model(NamedTuple):
    """What tasks need: bounded by the parameters, not by the corpus."""

    head: list[bytes]  # words with a class of their own
    endings: int
    of: np.ndarray  # class of each unit
    moves: np.ndarray  # log10 P(class | class before)
    spread: np.ndarray  # log10 of the emission denominator of each class
    local: np.ndarray  # log10(count + 1) of these words
    ends: int  # training rows
    tokens: int  # training tokens, ends included
    kinds: int  # distinct training tokens, the end included


def train(
    docs: DataFrame,
    text_col: str = "text",
    head: int = HEAD,
    endings: int = ENDINGS,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
    local: int = LOCAL,
    sweeps: int = SWEEPS,
) -> tuple[Model, DataFrame]:
    """The model, and the stored counts of all words."""
    ship(docs.sparkSession)
    vocabulary = stored(count_words(docs, text_col), "vocabulary")
    ends = docs.count()
    frequent = [
        (bytes(r["word"]), r["n"])
        for r in vocabulary.orderBy(F.desc("n"), "word").limit(max(head, local)).collect()
    ]
    own = [word for word, _ in frequent]
    lines = stored(unit_lines(docs, own, endings, text_col), "unit-lines")
    # Words past the head begin in the group of their ending.
    seeds = Units(own[:head], endings)
    seed_of = np.concatenate([seeds.of(own), np.arange(seeds.first, seeds.edge + 1)])
    bigrams = count_bigrams(lines, seed_of)
    seeded = exchange(bigrams, classes, rounds)
    total = classes + 1
    table = np.zeros((total, total))
    np.add.at(table, (seeded[:, None], seeded[None, :]), bigrams)
    of = seeded[seed_of]
    for _ in range(sweeps):
        found = best_moves(lines, of, table, seeds.first).toArrow()
        if not found.num_rows:
            break
        moved = of.copy()
        moved[found.column("unit").to_numpy()] = found.column("best").to_numpy()
        after = count_bigrams(lines, moved)
        if likelihood(after) <= likelihood(table):
            break
        of, table = moved, after
    moves = np.log10(
        (table + MOVE_SMOOTHING) / (table.sum(axis=1, keepdims=True) + MOVE_SMOOTHING * total)
    )
    spark = docs.sparkSession
    known = spark.createDataFrame(
        [(bytearray(word), i) for i, word in enumerate(own)], "word binary, unit int"
    )
    ending = len(own) + F.crc32(F.substring("word", -3, 3)) % endings
    kinds_of = np.zeros(len(of), np.int64)
    per_unit = (
        vocabulary.join(F.broadcast(known), "word", "left")
        .groupBy(F.coalesce("unit", ending.cast("int")).alias("unit"))
        .agg(F.count("*").alias("kinds"))
    )
    for row in per_unit.collect():
        kinds_of[row["unit"]] = row["kinds"]
    said = table.sum(axis=0)
    different = np.bincount(of, kinds_of, total)
    spread = np.log10(said + different + 1)
    totals = vocabulary.agg(F.count("*").alias("kinds"), F.sum("n").alias("n")).first()
    return (
        Model(
            own,
            endings,
            of,
            moves,
            spread,
            np.log10(np.array([n for _, n in frequent], float) + 1),
            ends,
            (totals["n"] or 0) + ends,
            totals["kinds"] + (ends > 0),
        ),
        vocabulary,
    )


def _local_scores(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """What a row's text gives by itself: ``row``, ``doc_id``, ``n_tokens``,
    ``known``, ``logs`` (summed log10 of smoothed counts), ``context`` (class
    moves less the emission denominators), and its ``rare`` words with counts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def scored(batches):
        m = shared.value
        units, row = Units(m.head, m.endings), TaskContext.get().partitionId() << 33
        edge = int(m.of[units.edge])
        for batch in batches:
            bodies = [b or b"" for b in batch.column("body").to_pylist()]
            for a, b in in_batches(bodies, 2_000_000):
                rows = []
                for body in bodies[a:b]:
                    tokens = words(body)
                    line = units.of(tokens)
                    other = np.flatnonzero(line >= units.first)
                    rare = Counter(map(tokens.__getitem__, other.tolist()))
                    known = len(tokens) - len(other)
                    total = float(m.local[line[line < units.first]].sum())
                    line = np.concatenate([[edge], m.of[line], [edge]])
                    context = m.moves[line[:-1], line[1:]].sum() - m.spread[line[1:-1]].sum()
                    said = [{"word": w, "n": n} for w, n in rare.items()]
                    rows.append((row, len(tokens) + 1, known, total, float(context), said))
                    row += 1
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), rare_type]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a)]
                    + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["doc_id", "row", "n_tokens", "known", "logs", "context", "rare"],
                )

    chosen = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("body")
    )
    return chosen.mapInArrow(
        scored,
        f"doc_id {id_type}, row long, n_tokens long, known long, logs double, context double,"
        " rare array<struct<word: binary, n: bigint>>",
    )


def score(
    docs: DataFrame,
    model: Model,
    vocabulary: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (add-one unigrams), ``score`` (log10
    probability under the model) and ``perplexity``."""
    ship(docs.sparkSession)
    local = stored(_local_scores(docs, model, id_col, text_col), "local-scores")
    rare = local.select("row", F.inline("rare"))
    seen = vocabulary.select("word", F.col("n").alias("seen"))
    joined = (
        rare.join(seen.hint("merge"), "word")
        .groupBy("row")
        .agg(
            F.sum("n").alias("more_known"),
            F.sum(F.col("n") * F.log10(F.col("seen") + 1)).alias("more_logs"),
        )
    )
    known = F.col("known") + F.coalesce("more_known", F.lit(0))
    # One is added to every count, so a word that was never seen adds log10(1).
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    end = F.lit(float(np.log10(model.ends + 1)))
    base = float(np.log10(model.tokens + model.kinds + 1))
    return (
        local.drop("rare")
        .join(joined, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            (known + F.lit(int(model.ends > 0))).alias("n_known"),
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            (logs + end - F.col("n_tokens") * F.lit(base)).alias("base_score"),
            (logs + F.col("context")).alias("score"),
        )
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    )
