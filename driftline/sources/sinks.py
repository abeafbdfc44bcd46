"""Writers. Output folders are always separate from input folders."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from driftline.sources.landed import CSV_FORM


def write_by(df: DataFrame, path: str, *columns: str, kind: str = "json") -> None:
    """One folder per value of ``columns``; only folders present are replaced.

    Rows are first rebalanced by these columns: small values share a task and a
    value that holds much of the data is split over several files.
    """
    rebalanced = df.hint("rebalance", *[F.col(c) for c in columns])
    (
        rebalanced.write.partitionBy(*columns)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .format(kind)
        .save(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_json(df: DataFrame, path: str) -> None:
    """Add records; readers collapse records that were added twice."""
    df.write.mode("append").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; empty text stays apart from null.

    For columns without line breaks. Text goes to JSON, which stays splittable.
    """
    df.write.mode("overwrite").options(**CSV_FORM).csv(path, header=True)


def write_lexicon(lexicon: DataFrame, path: str) -> None:
    """A sorted word list with a header, in as many files as its size calls for."""
    lexicon.orderBy("word").write.mode("overwrite").csv(path, header=True)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_json_list(df: DataFrame, column: str, path: str) -> None:
    """The values of ``column`` as a JSON array of strings, one array for each task.

    A task writes its values one after another, one to a line. Nulls are left out.
    """

    def framed(batches):
        begun = False
        for batch in batches:
            values = batch.column(0).to_pylist()
            marked = [("," if begun or i else "[") + v for i, v in enumerate(values)]
            begun = begun or bool(values)
            yield pa.RecordBatch.from_arrays([pa.array(marked, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if begun else "[]"])], names=["value"])

    listed = df.where(F.col(column).isNotNull()).select(F.to_json(F.array(column)).alias("value"))
    bare = listed.select(F.expr("substring(value, 2, length(value) - 2)").alias("value"))
    bare.mapInArrow(framed, "value string").write.mode("overwrite").text(path)


def append_counted(df: DataFrame, path: str) -> int:
    """Append and return how many records were saved, counted while writing."""
    seen = Observation("saved")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").json(path)
    return seen.get["rows"]
