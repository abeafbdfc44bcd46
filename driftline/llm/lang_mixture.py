"""Language identification by multilingual mixture inference.

Every letter of a text gives one character trigram (itself and its neighbours,
with one mark for any run of other characters). A document is taken as a mixture
of languages: expectation-maximisation finds the proportions that make its
trigrams most likely. The set of languages is grown from the best single one, and
a language joins only if the likelihood rises by more than its penalty.

The model is a table of trigram counts by language, counted by Spark over all
training texts. Its size is bounded by the number of languages, not of documents.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as
is every text if nothing was learned. Ties go to the language that sorts first.
Rows are judged one by one, so repeated rows and null ids need no rule. Result
columns replace input columns of the same name. Rows without a language label
are not learned from. Memory grows with the longest text.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import ship

#: Trigrams are hashed to so many cells.
CELLS = 1 << 15
MAX_LANGUAGES = 400
#: Added to every count; EM steps at most; per added language, in units of log n.
SMOOTHING, STEPS, PENALTY = 0.1, 30, 0.5
#: Trigrams overlap: each letter is seen three times, so the likelihood is shared.
ORDER = 3
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def trigrams(text: str) -> np.ndarray:
    """The cell of each letter's trigram."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    points = np.where(_letters()[points], points, 0)
    kept = points != 0
    kept[1:] |= points[:-1] != 0
    kept[0] = True
    points = points[kept]
    middle = np.flatnonzero(points)
    # Odd multipliers; the high bits of the product are the best mixed.
    mixed = points[middle - 1] * np.uint32(2654435761)
    mixed ^= points[middle] * np.uint32(2246822519)
    mixed ^= points[middle + 1] * np.uint32(3266489917)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(668265263)
    return (mixed >> np.uint32(17)).astype(np.int64)


class Model(NamedTuple):
    languages: list[str]
    likelihood: np.ndarray  # of each cell (row) in each language (column)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count trigrams by language over every labelled row."""
    ship(docs.sparkSession)

    def counted(batches):
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(CELLS, np.int64))

        def flush():
            for name, cells in sums.items():
                at = np.flatnonzero(cells)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(cells[at])],
                    names=["lang", "cell", "n"],
                )
            sums.clear()

        for batch in batches:
            for words, name in zip(*(c.to_pylist() for c in batch.columns)):
                sums[name] += np.bincount(trigrams(words), minlength=CELLS)
                if len(sums) > 64:
                    yield from flush()
        yield from flush()

    labelled = docs.select(F.col(text), F.col(lang)).dropna()
    table = (
        labelled.mapInArrow(counted, "lang string, cell long, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
    )
    found = table.toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages are too many to broadcast")
    counts = np.full((CELLS, len(names)), SMOOTHING)
    column = np.searchsorted(np.array(names, object), np.array(found.column("lang").to_pylist(), object)) if names else []
    counts[found.column("cell").to_numpy(), column] += found.column("n").to_numpy()
    return Model(names, counts / counts.sum(axis=0))


def _mix(likelihood: np.ndarray, n: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions that EM reaches from ``shares``, and their log likelihood."""
    total = n.sum()
    for _ in range(STEPS):
        fresh = shares * ((n / (likelihood @ shares)) @ likelihood) / total
        moved = np.abs(fresh - shares).max()
        shares = fresh
        if moved < 1e-3:
            break
    return shares, float(n @ np.log(likelihood @ shares))


def infer(model: Model, text: str | None) -> tuple[str, float, list[str], list[float]]:
    """Main language and its proportion, all languages found and theirs."""
    return _fitted(model, text)[:4]


def evidence(model: Model, text: str | None) -> float:
    """By how much the text's mixture makes a trigram likelier, as a logarithm and
    on the mean, than trigrams spread evenly; below 0 for a text without a letter."""
    return _fitted(model, text)[4]


def _fitted(
    model: Model, text: str | None
) -> tuple[str, float, list[str], list[float], float]:
    cells = trigrams(text) if text else np.empty(0, np.int64)
    if not len(cells) or not model.languages:
        return UNKNOWN, 0.0, [], [], -math.inf
    counts = np.bincount(cells, minlength=CELLS)
    at = np.flatnonzero(counts)
    n, likelihood = counts[at].astype(float), model.likelihood[at]
    single = n @ np.log(likelihood)
    chosen = [int(np.argmax(single))]
    shares, reached = np.ones(1), float(single[chosen[0]])
    penalty = PENALTY * ORDER * math.log(len(cells) + 1)
    while len(chosen) < len(model.languages):
        # How fast the likelihood rises with the proportion of each language.
        rise = (n / (likelihood[:, chosen] @ shares)) @ likelihood / len(cells)
        rise[chosen] = 0
        best = int(np.argmax(rise))
        if rise[best] <= 1:
            break
        trial = [*chosen, best]
        start = np.append(shares * 0.8, 0.2)
        mixed, better = _mix(likelihood[:, trial], n, start)
        if better - reached <= penalty:
            break
        chosen, shares, reached = trial, mixed, better
    order = sorted(range(len(chosen)), key=lambda i: (-shares[i], chosen[i]))
    names = [model.languages[chosen[i]] for i in order]
    parts = [min(1.0, float(shares[i])) for i in order]
    return names[0], parts[0], names, parts, reached / len(cells) + math.log(CELLS)


def spoken(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Whether the mixture found explains the text better than no language does:
    its trigrams are likelier than if all were spread evenly."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def judged(texts: pd.Series) -> pd.Series:
        return pd.Series([evidence(shared.value, t) > 0 for t in texts], dtype=bool)

    return judged(F.col(text))


def predicted(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column of ``lang_pred``, ``score``, ``languages``, ``proportions``."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(
        "lang_pred string, score double, languages array<string>, proportions array<double>"
    )
    def judged(texts: pd.Series) -> pd.DataFrame:
        rows = [infer(shared.value, t) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "languages", "proportions"])

    return judged(F.col(text))
