"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. Equal blocks get equal
integer names by sorting the distinct blocks; then names of adjacent blocks are
paired and the distinct pairs named again, until one name is left per document.
Two documents have the same name exactly if their texts are equal, whatever the
hash functions do: a hash only routes blocks, and blocks that share a hash are
told apart by their bytes.

Text is shuffled once, after equal blocks of a task have been combined, so a
text that a third of the documents share costs one row per task. Everything
else moves hashes and names.

Defined cases: a null text counts as empty, an empty text has one empty block.
Rows with a null id take part; they stay only where no row of their group has
an id. Of repeated rows with the same id and text one stays. Columns other than
the id and the text are not looked at, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import WHITE, stored, unused

BLOCK_BYTES = 4096


def squeezed(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    # A single space needs no replacing, which spares most of the matches.
    return F.regexp_replace(
        F.coalesce(text, F.lit("")), rf"[{WHITE}]{{2,}}|[\x09-\x0D]", " "
    )


def _normal(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), squeezed(F.col(text_col)).cast("binary").alias("body")
    )


def _places(body: Column, size: int) -> Column:
    blocks = F.greatest(F.ceil(F.octet_length(body) / size), F.lit(1)).cast("int")
    return F.sequence(F.lit(0), blocks - 1)


def _block(body: Column, place: Column, size: int) -> Column:
    return F.substring(body, place * size + 1, F.lit(size))


def _hash(block: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(block), 64 - bits)


def _blocks(normal: DataFrame, size: int, bits: int) -> DataFrame:
    return (
        normal.withColumn("place", F.explode(_places(F.col("body"), size)))
        .withColumn("block", _block(F.col("body"), F.col("place"), size))
        .withColumn("h", _hash(F.col("block"), bits))
    )


def name_blocks(normal: DataFrame, size: int, bits: int) -> DataFrame:
    """``h``, ``name`` and, where several blocks share the hash, ``block``."""
    sets = (
        _blocks(normal, size, bits)
        .groupBy("h")
        .agg(F.collect_set("block").alias("blocks"))
        .sortWithinPartitions("h")
    )
    return stored(
        sets.select("h", "blocks", F.posexplode(F.sort_array("blocks")).alias("i", "block"))
        .select(
            "h",
            F.monotonically_increasing_id().alias("name"),
            F.when(F.size("blocks") > 1, F.col("block")).alias("block"),
        ),
        "block-names",
    )


def identities(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per distinct id and text: ``doc_id``, ``text_sha256``, ``copies``,
    and ``level`` and ``name``, which together are equal for equal texts only."""
    normal = _normal(docs, id_col, text_col)
    hashes = F.transform(
        _places(F.col("body"), block_bytes),
        lambda i: _hash(_block(F.col("body"), i, block_bytes), hash_bits),
    )
    sha = F.sha2("body", 256).alias("text_sha256")
    base = stored(
        normal.select("doc_id", sha, hashes.alias("hashes"))
        .groupBy("doc_id", "text_sha256")
        .agg(F.count("*").alias("copies"), F.first("hashes").alias("hashes")),
        "block-hashes",
    )
    names = name_blocks(normal, block_bytes, hash_bits)
    key = ["doc_id", "text_sha256", "copies", "parts"]
    places = base.select(
        "doc_id",
        "text_sha256",
        "copies",
        F.size("hashes").alias("parts"),
        F.posexplode("hashes").alias("place", "h"),
    )
    current = places.join(names.where("block IS NULL").drop("block"), "h").select(
        *key, "place", "name"
    )
    shared = names.where("block IS NOT NULL")
    if not shared.isEmpty():
        # Some blocks share a hash: theirs are joined by their bytes.
        named = (
            _blocks(normal, block_bytes, hash_bits)
            .join(shared, ["h", "block"])
            .select("doc_id", F.sha2("body", 256).alias("text_sha256"), "place", "name")
            .distinct()
            .alias("n")
        )
        b = base.select("doc_id", "text_sha256", "copies", F.size("hashes").alias("parts")).alias(
            "b"
        )
        more = named.join(
            b,
            F.col("n.doc_id").eqNullSafe(F.col("b.doc_id"))
            & (F.col("n.text_sha256") == F.col("b.text_sha256")),
        ).select(*[f"b.{c}" for c in key], "n.place", "n.name")
        current = current.unionByName(more)
    most = base.agg(F.max(F.size("hashes"))).first()[0] or 1
    done = [_finished(current, 0)]
    for level in range(1, (most - 1).bit_length() + 1):
        current = stored(_pair_up(current.where("parts > 1"), key), "block-pairs")
        done.append(_finished(current, level))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def _finished(current: DataFrame, level: int) -> DataFrame:
    return current.where("parts = 1").select(
        "doc_id", "text_sha256", "copies", F.lit(level).alias("level"), "name"
    )


def _pair_up(current: DataFrame, key: list[str]) -> DataFrame:
    """Name the pairs of adjacent names; a last single one is paired with -1."""
    even = F.col("place") % 2 == 0
    pairs = (
        current.groupBy(*key, F.floor(F.col("place") / 2).cast("int").alias("half"))
        .agg(
            F.max(F.when(even, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"),
        )
    )
    pairs = stored(pairs, "pairs")
    named = stored(
        pairs.select("left", "right")
        .distinct()
        .sortWithinPartitions("left", "right")
        .withColumn("name", F.monotonically_increasing_id()),
        "pair-names",
    )
    return pairs.join(named, ["left", "right"]).select(
        "doc_id",
        "text_sha256",
        "copies",
        F.ceil(F.col("parts") / 2).cast("int").alias("parts"),
        F.col("half").alias("place"),
        "name",
    )


def _decided(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, hash_bits: int):
    """``identities`` with the ``keep_id`` and ``group_size`` of each group."""
    ids = stored(identities(docs, id_col, text_col, block_bytes, hash_bits), "identities")
    groups = stored(
        ids.groupBy("level", "name").agg(
            F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
        ),
        "groups",
    )
    # The groups are read from storage, so both sides are dealt out for this join
    # and the rows of a large group can be split over tasks.
    return ids.join(groups, ["level", "name"])


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``
    and ``text_sha256`` of the normalised text."""
    rows = _decided(docs, id_col, text_col, block_bytes, hash_bits).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep."""
    decided = _decided(docs, id_col, text_col, BLOCK_BYTES, 64)
    kept = stored(decided.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))), "kept")
    key = unused(docs, "row")
    sha = F.sha2(squeezed(F.col(text_col)), 256)
    keyed = docs.withColumn(key, F.concat_ws(" ", F.col(id_col).cast("string"), sha))
    wanted = kept.select(
        F.concat_ws(" ", F.col("doc_id").cast("string"), F.col("text_sha256")).alias(key)
    )
    left = keyed.join(wanted, key, "left_semi")
    if not kept.where("copies > 1").isEmpty():  # the same row more than once
        left = left.dropDuplicates([key])
    return left.drop(key).select(docs.columns)
