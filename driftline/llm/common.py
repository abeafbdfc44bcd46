"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.session import scratch_path

#: The ASCII white space the text contracts name: space, tab, LF, VT, FF, CR.
WHITE = r"\x20\x09-\x0D"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    The sources are zipped once for each application and handed to Spark, which
    serves them to the executors.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    fd, name = tempfile.mkstemp(prefix="driftline-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Lineage is cut without tying the rows to one executor, and later readers
    take only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_memory: dict[object, object] = {}


def worker_memory(key: object, make):
    """What ``make`` returned for ``key`` in this Python worker, kept for its later
    tasks. One such memory is kept at a time, so stages don't add theirs up."""
    if key not in _memory:
        _memory.clear()
        _memory[key] = make()
    return _memory[key]


def release_memory() -> None:
    """Let go of what stages before this one have kept in this Python worker."""
    _memory.clear()


def small_batches(batches, rows: int = 512):
    """Arrow batches of at most ``rows`` rows."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}" in taken:
        name += "_"
    return f"_{name}"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def in_batches(texts: list[bytes], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Spans [a, b) of ``texts`` of at most ``most`` bytes, or of one longer text."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)
