"""Joins and ordered windows that hold when one key owns much of the data.

Every helper here only changes how rows are routed. No row is dropped, sampled
or capped, so results equal those of the plain join or window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.session import written

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
ROWS_PER_TASK = 2_000_000
# Numbers that one of Spark's bit maps covers, and its bytes with its row.
MAP_NUMBERS = 32_768
MAP_BYTES = MAP_NUMBERS // 8 + 64
WORD_BITS = 64


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core a share of a scan that has fewer splits than cores.

    Rows are dealt out by a hash of ``keys``, which should be unique. On data
    with at least as many splits as cores this returns ``df`` unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df`` by one distributed aggregate."""
    width = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16)
        else:
            width = width + F.lit(16)
    return df.agg(F.sum(width.cast("long")).alias("b")).first()["b"] or 0


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def bit_maps(df: DataFrame, number: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``_map, _bits``: the numbers of a long column, a bit each; written.

    None if they lie so far apart that their maps take more than ``max_bytes``.
    """
    named = df.select(F.bitmap_bucket_number(number).alias("_map"), F.col(number)).where(
        F.col(number).isNotNull()
    )
    if named.select("_map").distinct().count() * MAP_BYTES > max_bytes:
        return None
    at = F.bitmap_bit_position(number)
    return written(named.groupBy("_map").agg(F.bitmap_construct_agg(at).alias("_bits")))


def bit_is_set(at: Column) -> Column:
    """Whether ``_bits`` has the bit at that place."""
    byte = F.hex(F.substring("_bits", (at / 8).cast("int") + 1, 1))
    return F.bit_get(F.conv(byte, 16, 10).cast("int"), (at % 8).cast("int")) == 1


def sifted(
    rows: DataFrame, listed: DataFrame, h: str, max_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """Rows whose hash ``h`` is listed, and a few others, by a broadcast Bloom filter.

    For lists too long to broadcast: a hash takes 32 bits, fewer if ``max_bytes`` does
    not allow them, and has four of them set. A hash that is listed is never lost; the
    caller has to tell the others. None if not even one map may be broadcast.
    """
    allowed = max_bytes // MAP_BYTES
    if allowed == 0:
        return None
    maps = min(allowed, listed.count() * 32 // MAP_NUMBERS + 1)
    home = F.pmod(F.xxhash64(F.lit(maps), F.col(h)), F.lit(maps))
    mixed = F.xxhash64(h)
    places = [F.shiftright(mixed, 15 * i).bitwiseAND(F.lit(MAP_NUMBERS - 1)) for i in range(4)]
    # Words of 64 bits: a row each until they are put together, so that no task sends
    # whole maps, and in an array, which is looked into without being copied.
    laid = listed.select(home.alias("_map"), F.explode(F.array(*places)).alias("_at"))
    single = F.expr(f"shiftleft(1L, cast(_at & {WORD_BITS - 1} AS int))")
    each = MAP_NUMBERS // WORD_BITS
    blank = listed.sparkSession.range(maps * each).select(
        F.floor(F.col("id") / each).cast("long").alias("_map"),
        (F.col("id") % each).cast("int").alias("_i"),
        F.lit(0).cast("long").alias("_w"),
    )
    words = (
        laid.select("_map", F.shiftright("_at", 6).cast("int").alias("_i"), single.alias("_w"))
        .unionByName(blank)
        .groupBy("_map", "_i")
        .agg(F.bit_or("_w").alias("_w"))
    )
    inside = F.sort_array(F.collect_list(F.struct("_i", "_w")))
    bits = written(
        words.groupBy("_map").agg(F.transform(inside, lambda e: e["_w"]).alias("_words"))
    )
    hit = home == F.col("_map")
    for at in places:
        word = F.get("_words", F.shiftright(at, 6).cast("int"))
        hit = hit & (F.bit_get(word, at.bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")) == 1)
    return rows.join(F.broadcast(bits), hit, "left_semi")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    count_from: DataFrame | None = None,
    uses: str | None = None,
) -> DataFrame:
    """Shuffle join whose hot left keys are split over tasks.

    A key with at least ``hot_rows`` left rows is hot and gets one salt for each
    ``hot_rows`` rows, so no task holds much more than that, however large a key
    is. The list of hot keys is counted once and written; it is broadcast if its
    measured size allows and shuffled otherwise. ``spread_by`` names left columns
    that tell the rows of one key apart; the salt is a hash of them, so a re-run
    task routes its rows the same way. Keys are counted on ``count_from`` where
    that has the same keys as ``left`` and is cheaper to compute, or not at all where
    the column ``uses`` of ``right`` (one row a key) tells how many left rows each has.
    """
    on = list(on)
    if uses is None:
        counts = left if count_from is None else count_from
        counts = counts.groupBy(*on).agg(F.count("*").alias("_n"))
    else:
        counts = right.select(*on, F.col(uses).alias("_n"))
    hot = written(
        counts.where(F.col("_n") >= hot_rows)
        .select(*on, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_salts"))
    )
    listed = F.broadcast(hot) if fits_broadcast(hot, max_bytes) else hot.hint("merge")
    salt = F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int")
    every_salt = F.sequence(F.lit(0), F.col("_salts") - 1)
    salted = (
        left.join(listed, on, "left")
        .withColumn("_salt", F.when(F.col("_salts").isNotNull(), salt).otherwise(F.lit(0)))
        .drop("_salts")
    )
    copied = (
        right.join(listed, on, "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_salts").isNotNull(), every_salt).otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("_salts")
    )
    # A size estimate does not know how far texts were laid out into words, so the
    # planner is not left to broadcast this side on an estimate.
    return salted.join(copied.hint("merge"), [*on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
    count_from: DataFrame | None = None,
    uses: str | None = None,
) -> DataFrame:
    """Join to a dictionary-like table: broadcast if its measured size allows."""
    on = list(on)
    if fits_broadcast(lookup, max_bytes):
        return left.join(F.broadcast(lookup), on, how)
    return skew_join(left, lookup, on, how, spread_by, count_from=count_from, uses=uses)


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group, by one partial aggregate."""
    counts = df.groupBy(*group).agg(F.count("*").alias("n"))
    return counts.agg(F.max("n").alias("n")).first()["n"] or 0


def _groups_fit(df: DataFrame, group: Sequence[str], rows_per_task: int | None) -> bool:
    """Whether one task can hold any group.

    ``rows_per_task`` None stands for a series with one row per day or month,
    which fits by its nature and is not counted.
    """
    return rows_per_task is None or largest_group(df, group) <= rows_per_task


def _segments(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Range-partition by (group, order) and fix the partition as ``_seg``.

    The written checkpoint makes segment numbers stable for all later readers,
    also when executors are lost.
    """
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *order)
    return written(ranged.withColumn("_seg", F.spark_partition_id()))


def _segmented_total(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column, out: str
) -> DataFrame:
    group = list(group)
    seg = _segments(df.withColumn("_v", value), group, order)
    inside = Window.partitionBy("_seg", *group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    earlier = Window.partitionBy(*group).orderBy("_seg").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A segment continues at most one group, so this has one row per segment at most.
    carry = (
        seg.groupBy("_seg", *group)
        .agg(F.sum("_v").alias("_part"))
        .withColumn("_carry", F.sum("_part").over(earlier))
        .where(F.col("_carry").isNotNull())
        .select(F.col("_seg").alias("_cseg"), "_carry", *[F.col(g).alias(f"_c_{g}") for g in group])
    )
    match = F.col("_seg") == F.col("_cseg")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_c_{g}"))
    local = seg.withColumn("_local", F.sum("_v").over(inside))
    return (
        local.join(F.broadcast(carry), match, "left")
        .withColumn(
            out,
            # Null only as long as no value has come, as in a window over all rows.
            F.when(
                F.col("_local").isNotNull() | F.col("_carry").isNotNull(),
                F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0)),
            ),
        )
        .drop("_v", "_seg", "_local", "_carry", "_cseg", *[f"_c_{g}" for g in group])
    )


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    value: Column,
    out: str,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Running sum inside each group in a total order.

    Groups that fit one task use a window. If the largest does not, rows are
    range-partitioned and each segment adds the totals of the segments before.
    The rows are counted first, so pass a written frame if they are costly.
    """
    if _groups_fit(df, group, rows_per_task):
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w))
    return _segmented_total(df, group, order, value, out)


def in_blocks(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    back: int,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> tuple[DataFrame, list[str]]:
    """Prepare a window that looks at most ``back`` rows backwards.

    Returns the frame and the columns to partition the window by. Over-long
    groups are cut into blocks by exact rank, and each block is preceded by
    copies of the last ``back`` rows of the block before, marked ``_copy``;
    apply the window, then keep ``~_copy``. The rows are counted first, so pass
    a written frame if they are costly to derive.
    """
    group = list(group)
    if _groups_fit(df, group, rows_per_task):
        plain = df.withColumn("_block", F.lit(0).cast("long")).withColumn("_copy", F.lit(False))
        return plain, [*group, "_block"]
    size = max(rows_per_task, back)
    ranked = _segmented_total(df, group, order, F.lit(1).cast("long"), "_rank")
    at = F.col("_rank") - 1
    block = F.floor(at / F.lit(size)).cast("long")
    homes = F.when(
        at % F.lit(size) >= size - back,
        F.array(
            F.struct(block.alias("_block"), F.lit(False).alias("_copy")),
            F.struct((block + 1).alias("_block"), F.lit(True).alias("_copy")),
        ),
    ).otherwise(F.array(F.struct(block.alias("_block"), F.lit(False).alias("_copy"))))
    placed = ranked.select("*", F.inline(homes)).drop("_rank")
    return placed, [*group, "_block"]


def look_back(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    back: int,
    columns: dict[str, Column],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``columns``, each an expression evaluated over rows [-back, 0].

    Use ``lag`` for single earlier rows and ``framed`` values for aggregates:
    an entry may be a Column (for ``lag``-like functions) or a pair
    ``(Column, True)`` for an aggregate over the trailing frame.
    """
    placed, keys = in_blocks(df, group, order, back, rows_per_task)
    plain = Window.partitionBy(*keys).orderBy(*order)
    frame = plain.rowsBetween(-back, 0)
    for name, spec in columns.items():
        expr, framed = spec if isinstance(spec, tuple) else (spec, False)
        placed = placed.withColumn(name, expr.over(frame if framed else plain))
    return placed.where(~F.col("_copy")).drop("_copy", "_block")
