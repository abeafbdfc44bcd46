"""Fourier transforms of series of any length, as joins and aggregates.

A series is rows of (group, step, value). A mixed-radix transform takes one radix a
round: every value goes to ``radix`` sums, and each sum has ``radix`` terms, so a
series of n steps makes n times the sum of its radices terms in all, and no task
holds a series. Lengths with a prime factor above ``LARGEST`` are turned into a
convolution of a padded length that is a power of two (chirp transform).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.operators.scale import ROWS_PER_TASK, running_total
from driftline.session import written

LARGEST = 31
#: Neighbouring factors are one radix up to this product.
RADIX = 16
PRIMES = [p for p in range(2, LARGEST + 1) if all(p % q for q in range(2, p))]


def _radices(n: Column) -> Column:
    """Radices of ``n``, and what is left of it: ``rest, done`` with their product n."""
    tried = [p for p in PRIMES for _ in range(int(40 / math.log2(p)))]
    start = F.struct(n.cast("long").alias("rest"), F.array(F.lit(1).cast("long")).alias("done"))

    def divide(state, p):
        last = F.element_at(state["done"], -1)
        grown = F.when(
            last * p <= RADIX,
            F.concat(F.slice(state["done"], 1, F.size(state["done"]) - 1), F.array(last * p)),
        ).otherwise(F.concat(state["done"], F.array(p)))
        return F.when(
            state["rest"] % p == 0,
            F.struct(
                F.floor(state["rest"] / p).cast("long").alias("rest"), grown.alias("done")
            ),
        ).otherwise(state)

    return F.aggregate(F.array(*[F.lit(p).cast("long") for p in tried]), start, divide)


def transform(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """``group, n, k, re, im`` from ``group, n, j, re, im`` with j and k in [0, n).

    Absent steps are zeros. The prime factors of every n are at most ``LARGEST``.
    """
    group = list(group)
    state = rows.select(
        *group, "n", _radices(F.col("n"))["done"].alias("radices"),
        F.lit(1).cast("long").alias("done"), "j", F.lit(0).cast("long").alias("k"), "re", "im",
    )
    state = written(state)
    rounds = state.agg(F.max(F.size("radices"))).first()[0] or 0
    for at in range(rounds):
        radix = F.coalesce(F.get("radices", F.lit(at)), F.lit(1).cast("long"))
        step = state.withColumn("_r", radix).withColumn("_after", F.col("done") * F.col("_r"))
        width = F.floor(F.col("n") / F.col("_after")).cast("long")
        spread = (
            step.withColumn("_w", width)
            .withColumn("_q", F.floor(F.col("j") / F.col("_w")).cast("long"))
            .withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_r") - 1)))
            .withColumn("_k", F.col("k") + F.col("_s") * F.col("done"))
        )
        turn = (F.col("_q") * F.col("_k")) % F.col("_after")
        angle = F.lit(-2 * math.pi) * turn / F.col("_after")
        state = spread.groupBy(
            *group, "n", "radices", F.col("_after").alias("done"),
            (F.col("j") % F.col("_w")).alias("j"), F.col("_k").alias("k"),
        ).agg(
            F.sum(F.col("re") * F.cos(angle) - F.col("im") * F.sin(angle)).alias("re"),
            F.sum(F.col("re") * F.sin(angle) + F.col("im") * F.cos(angle)).alias("im"),
        )
    return state.select(*group, "n", "k", "re", "im")


def _chirp(j: Column, n: Column, sign: int) -> tuple[Column, Column]:
    """Real and imaginary part of exp(sign * i pi j^2 / n)."""
    angle = F.lit(math.pi) * ((j * j) % (2 * n)) / n
    return F.cos(angle), sign * F.sin(angle)


def _times(a: tuple[Column, Column], b: tuple[Column, Column]) -> list[Column]:
    return [
        (a[0] * b[0] - a[1] * b[1]).alias("re"),
        (a[0] * b[1] + a[1] * b[0]).alias("im"),
    ]


def _convolved(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """The same transform for lengths without small factors."""
    group = list(group)
    j, n, here = F.col("j"), F.col("n"), (F.col("re"), F.col("im"))
    padded = F.pow(F.lit(2.0), F.ceil(F.log2((2 * n - 1).cast("double")))).cast("long")
    signal = transform(
        rows.select(
            *group, n.alias("_length"), padded.alias("n"), "j", *_times(here, _chirp(j, n, -1))
        ),
        [*group, "_length"],
    )
    # The other side of the convolution depends on the length alone.
    steps = rows.select(n.alias("_length"), padded.alias("n"), "j").distinct()
    wave = _chirp(j, F.col("_length"), 1)
    both = F.array_distinct(F.array(j, (n - j) % n))
    kernel = transform(
        steps.select(
            "_length", "n", F.explode(both).alias("j"), wave[0].alias("re"), wave[1].alias("im")
        ),
        ["_length"],
    ).select("_length", "k", F.col("re").alias("_re"), F.col("im").alias("_im"))
    product = signal.join(kernel, ["_length", "k"]).select(
        *group, "_length", "n", F.col("k").alias("j"),
        *_times(here, (F.col("_re"), F.col("_im"))),
    )
    # The way back is the same transform on conjugates.
    back = transform(product.withColumn("im", -F.col("im")), [*group, "_length"])
    length, k = F.col("_length"), F.col("k")
    result = (F.col("re") / n, -F.col("im") / n)
    return back.where(k < length).select(
        *group, length.alias("n"), "k", *_times(result, _chirp(k, length, -1))
    )


def fourier(
    series: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    value: str,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """``group, n, k, frequency, magnitude`` for k from 0 to n / 2.

    ``order`` must be total. Rows without a value are left out of their series.
    """
    keys = list(group) or ["_all"]
    every = series if group else series.withColumn("_all", F.lit(0))
    rows = every.where(F.col(value).isNotNull())
    placed = running_total(rows, keys, order, F.lit(1).cast("long"), "_at", rows_per_task)
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    points = written(
        placed.join(sizes, keys).select(
            *keys, "n", (F.col("_at") - 1).alias("j"), F.col(value).cast("double").alias("re"),
            F.lit(0.0).alias("im"), (_radices(F.col("n"))["rest"] == 1).alias("_small"),
        )
    )
    parts = [transform(points.where("_small").drop("_small"), keys)]
    if not points.where("NOT _small").isEmpty():
        parts.append(_convolved(points.where("NOT _small").drop("_small"), keys))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.where(F.col("k") <= F.floor(F.col("n") / 2)).select(
        *group, "n", "k", (F.col("k") / F.col("n")).alias("frequency"),
        F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("magnitude"),
    )
