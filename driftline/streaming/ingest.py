"""Incremental landing: new files only, counts, bursts, duplicate removal.

Every query runs with ``availableNow``: it takes what has arrived since its last
run, resumes from its checkpoint, and stops. Checkpoints and results belong in
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.activity import edit_bursts


def arriving(spark: SparkSession, path: str, schema: T.StructType, kind: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(kind).load(path)


def _instant(stream: DataFrame, ts: str) -> DataFrame:
    """``ts`` as a point in time, as watermarks need; wall-clock times are UTC."""
    column = F.col(ts)
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        column = F.concat(column.cast("string"), F.lit("Z"))
    return stream.withColumn(ts, column.cast("timestamp"))


def land_new_files(stream: DataFrame, out: str, checkpoint: str) -> int:
    """Append what arrived to a table; a file already taken is not taken again.

    Returns how many rows came too late for the watermark, as the stateful operators
    of the stream count them: a windowed count meets late rows already summed up, so
    those of one window and task are one. 0 without a watermark.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )


def without_repeats(
    stream: DataFrame, key: str, ts: str, delay: str, out: str, checkpoint: str
) -> None:
    """Land rows whose ``key`` was not seen within ``delay``."""
    timed = _instant(stream, ts).withWatermark(ts, delay)
    land_new_files(timed.dropDuplicatesWithinWatermark([key]), out, checkpoint)


def closed_windows(
    stream: DataFrame, ts: str, window: str, delay: str, out: str, checkpoint: str
) -> int:
    """Append the count of each time window once, when it can't change any more.

    A window closes when the newest row is ``delay`` past its end; its state is then
    released, so state holds the open windows only. Later rows for it are dropped,
    and their number is returned. A run goes on where the last one stopped.
    """
    timed = _instant(stream, ts).withWatermark(ts, delay)
    counts = timed.groupBy(F.window(ts, window).alias("w")).agg(F.count("*").alias("n"))
    return land_new_files(counts.select("w.start", "w.end", "n"), out, checkpoint)


def closed_bursts(
    stream: DataFrame, gap: str, at_least: int, delay: str, out: str, checkpoint: str,
    user: str = "user", ts: str = "timestamp",
) -> int:
    """Append each burst of ``activity.edit_bursts`` once no edit can join it."""
    timed = _instant(stream, ts).withWatermark(ts, delay)
    return land_new_files(edit_bursts(timed, gap, at_least, user, ts), out, checkpoint)


def windowed_counts(
    stream: DataFrame, ts: str, window: str, delay: str, out: str, checkpoint: str
) -> None:
    """Keep counts per time window up to date in a table of updates.

    Rows later than ``delay`` behind the newest are dropped and old state is
    released. Each run appends the windows it changed; ``latest_counts`` reads
    the last value of each.
    """
    timed = _instant(stream, ts).withWatermark(ts, delay)
    counts = timed.groupBy(F.window(ts, window)).agg(F.count("*").alias("n"))

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("window.start", "window.end", "n", F.lit(batch_id).alias("batch"))
        # A batch replaces its own folder, so a repeated batch is not counted twice.
        rows.write.mode("overwrite").parquet(f"{out}/run={batch_id}")

    query = (
        counts.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    updates = spark.read.parquet(out)
    return updates.groupBy("start", "end").agg(F.max_by("n", "batch").alias("n"))
