"""A trie of conversation prefixes from adaptive radix trees.

Every conversation becomes a key: the fixed-width, big-endian ids of its turns, a
turn's id being the first 16 bytes of SHA-256 over its role and text. Tasks put
their keys into adaptive radix trees, whose inner nodes grow through layouts for 4,
16, 48 and 256 children and hold compressed paths. Bytes inside a turn can branch,
but only depths at whole turns are nodes of the result. A tree takes a bounded
number of keys; what it knows of a node (members, smallest member) is then handed on
and merged with the same node of other trees by Spark, so a first turn or a
conversation that a third of all rows share meets as one row from each tree.

A long conversation is cut into bands of ``BAND`` turns, each a key of its own after
the name of what precedes it. A prefix is named by the sum of the hashes of its
(depth, turn id) pairs, 96 bits each, which running totals give for any number of
turns in a conversation, also if one holds a third of all rows.

What a node says of its subtree is summed up from conversations. The smallest
member of a node is also that of the node's deeper nodes on its own path, so the
nodes a conversation owns, as their smallest member, are the end of its path. Every
owned node counts once: owners count leaves, and the turns before the owned part are
those that sharing saves.

Defined cases: a null role or text is empty; a null turn sorts first, and equal
turns are ordered by their ids. Rows without a conversation id are left out.
Repeated rows are turns each. An empty table gives an empty result, a conversation
without turns ends at the root. Other columns are not looked at. The text of a turn
is read once, never shuffled, and has to fit a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import ship, small_batches, stored
from driftline.operators.scale import running_total, skew_join

WIDTH = 16
#: Turns of one key.
BAND = 64
#: Keys of one tree.
KEYS = 5_000
#: Ids that are joined before they are hashed.
IDS_PER_CHUNK = 4096
ROOT = "0"


class Keyed:
    """Layout of up to 4 or 16 children: their bytes and nodes side by side."""

    def __init__(self, most: int, keys: bytes = b"", nodes=()):
        self.most, self.keys, self.nodes = most, bytearray(keys), list(nodes)

    def get(self, byte: int):
        at = self.keys.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node):
        at = self.keys.find(byte)
        if at >= 0:
            self.nodes[at] = node
            return self
        if len(self.nodes) < self.most:
            self.keys.append(byte)
            self.nodes.append(node)
            return self
        if self.most == 4:
            return Keyed(16, self.keys, self.nodes).put(byte, node)
        return Indexed(zip(self.keys, self.nodes, strict=True)).put(byte, node)

    def __iter__(self):
        return iter(self.nodes)


class Indexed:
    """Layout of up to 48 children: a table from byte to their place."""

    most = 48

    def __init__(self, children):
        self.place, self.nodes = bytearray(256), []
        for byte, node in children:
            self.put(byte, node)

    def get(self, byte: int):
        at = self.place[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node):
        if at := self.place[byte]:
            self.nodes[at - 1] = node
        elif len(self.nodes) == self.most:
            full = Direct()
            for b, at in enumerate(self.place):
                if at:
                    full.put(b, self.nodes[at - 1])
            return full.put(byte, node)
        else:
            self.nodes.append(node)
            self.place[byte] = len(self.nodes)
        return self

    def __iter__(self):
        return iter(self.nodes)


class Direct:
    """Layout of up to 256 children: one place for each byte."""

    most = 256

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return (node for node in self.nodes if node is not None)


class Inner:
    """A compressed path and what follows it.

    ``count`` and ``least`` cover the keys that end right here; ``any`` is what was
    stored with one of the keys that pass, enough to name every node on the path.
    """

    __slots__ = ("path", "children", "count", "least", "any")

    def __init__(self, path: bytes, children, any):
        self.path, self.children, self.any = path, children, any
        self.count, self.least = 0, None


def common(a: bytes, b: bytes) -> int:
    """Length of the common start."""
    if a == b or b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    def __init__(self):
        self.root = Inner(b"", Keyed(4), None)
        self.keys = 0

    def insert(self, key: bytes, member: int, stored) -> None:
        """Adds ``member`` under ``key``; ``stored`` has to serve all of the key."""
        self.keys += 1
        parent, node, at = None, self.root, 0
        while True:
            rest = key[at:]
            shared = common(node.path, rest)
            if shared < len(node.path):
                upper = Inner(node.path[:shared], Keyed(4), node.any)
                upper.children = upper.children.put(node.path[shared], node)
                node.path = node.path[shared + 1 :]
                parent.children = parent.children.put(key[at - 1], upper)
                node = upper
            at += shared
            if at == len(key):
                break
            child = node.children.get(key[at])
            if child is None:
                child = Inner(key[at + 1 :], Keyed(4), stored)
                node.children = node.children.put(key[at], child)
                node, at = child, len(key)
                break
            parent, node, at = node, child, at + 1
        node.count += 1
        node.least = member if node.least is None else min(node.least, member)

    def nodes(self, head: int, width: int) -> Iterator[tuple[int, object, int, int]]:
        """(turns, stored, members, least) of every depth of ``head`` bytes and whole
        turns; a path of several turns gives them all."""
        order, stack = [], [(self.root, 0)]
        while stack:
            node, begin = stack.pop()
            stop = begin + len(node.path)
            order.append((node, begin, stop))
            stack.extend((child, stop + 1) for child in node.children)
        total: dict[int, tuple[int, int | None]] = {}
        for node, begin, stop in reversed(order):
            count, least = node.count, node.least
            for child in node.children:
                more, smaller = total.pop(id(child))
                count += more
                least = smaller if least is None else min(least, smaller)
            total[id(node)] = count, least
            # Depths from just after the byte that led here to the end of the path.
            first = max(0, -(-(begin - head) // width))
            for turns in range(first, (stop - head) // width + 1):
                yield turns, node.any, count, least


def _turn_id(role: Column, text: Column) -> Column:
    """The id in hexadecimal; the role's length keeps role and text apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * WIDTH)


def _weight(depth: Column, turn_id: Column) -> Column:
    """96 bits of the hash of a turn in its place, as a whole number."""
    digest = F.sha2(F.concat_ws(":", depth.cast("string"), turn_id).cast("binary"), 256)
    half = lambda at: F.conv(F.substring(digest, at, 12), 16, 10).cast("decimal(15,0)")
    return (half(1) * F.lit(2**48).cast("decimal(15,0)") + half(13)).cast("decimal(29,0)")


def rebuilt(conversations: DataFrame, lend, most_lent: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one.

    ``lend(conv_id)`` gives two columns, the lender and the number h of turns it
    lends, ``most_lent`` at most: the first h turns of the lender (all, if it has fewer) come
    first, then the own turns after the first h. Returns the distinct ``conv_id``
    and the turns ``conv_id, part, pos, turn_id, bytes``, in order of (part, pos).
    """
    text = F.coalesce("text", F.lit(""))
    turns = stored(
        conversations.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            _turn_id(F.coalesce("role", F.lit("")), text).alias("turn_id"),
            F.octet_length(text).cast("long").alias("bytes"),
        ),
        "turns",
    )
    placed = stored(
        running_total(
            turns, ["conv_id"], [F.asc_nulls_first("turn"), F.asc("turn_id")],
            F.lit(1).cast("long"), "pos",
        ),
        "placed-turns",
    )
    lender, lent = lend(F.col("conv_id"))
    convs = turns.select("conv_id").distinct()
    heads = placed.where(F.col("pos") <= most_lent).select(
        F.col("conv_id").alias("lender"), "pos", "turn_id", "bytes"
    )
    begin = (
        convs.select("conv_id", lender.alias("lender"), lent.alias("lent"))
        .join(heads, "lender")
        .where(F.col("pos") <= F.col("lent"))
        .select("conv_id", F.lit(0).alias("part"), "pos", "turn_id", "bytes")
    )
    rest = placed.where(F.col("pos") > lent).select(
        "conv_id", F.lit(1).alias("part"), "pos", "turn_id", "bytes"
    )
    return convs, stored(begin.unionByName(rest), "rebuilt-turns")


def _paths(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, turn_id, bytes, name, parent, path_bytes`` of every turn:
    the names of the prefixes that end with it and before it, and their bytes."""
    deep = running_total(
        turns, ["conv_id"], [F.asc("part"), F.asc("pos")], F.lit(1).cast("long"), "depth"
    ).select(
        "conv_id", "depth", "turn_id", "bytes",
        _weight(F.col("depth"), F.col("turn_id")).alias("weight"),
    )
    # Both totals share their rows and order, and the groups were counted before.
    deep = stored(deep, "deep-turns")
    order = [F.asc("depth")]
    summed = running_total(deep, ["conv_id"], order, F.col("bytes"), "path_bytes")
    summed = running_total(summed, ["conv_id"], order, F.col("weight"), "name")
    return stored(
        summed.select(
            "conv_id", "depth", "turn_id", "bytes", F.col("name").cast("string").alias("name"),
            (F.col("name") - F.col("weight")).cast("string").alias("parent"), "path_bytes",
        ),
        "paths",
    )


NODE = "name string, parent string, depth long, conv_id long, n_convs long, bytes long, path_bytes long"


def _tree_nodes(keys: DataFrame, most: int) -> DataFrame:
    """What the radix trees of each task, of ``most`` keys each, know of their nodes."""
    ship(keys.sparkSession)

    def flushed(tree):
        rows = []
        for turns, (band, at), count, least in tree.nodes(WIDTH, WIDTH):
            if turns:
                step = at[turns - 1]
                rows.append((
                    step["name"], step["parent"], band * BAND + turns, least, count,
                    step["bytes"], step["path_bytes"],
                ))
            elif band == 0:
                rows.append((ROOT, None, 0, least, count, 0, 0))
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            names=["name", "parent", "depth", "conv_id", "n_convs", "bytes", "path_bytes"],
        )

    def run(batches):
        tree = RadixTree()
        for batch in small_batches(batches, 128):
            for row in batch.to_pylist():
                steps = row["steps"]
                head = int(steps[0]["parent"]) if steps else 0
                key = head.to_bytes(WIDTH) + bytes.fromhex("".join(s["turn_id"] for s in steps))
                tree.insert(key, row["conv_id"], (row["band"], steps))
            if tree.keys >= most:
                yield flushed(tree)
                tree = RadixTree()
        yield flushed(tree)

    return keys.mapInArrow(run, NODE)


def _digests(ends: DataFrame) -> DataFrame:
    """``name, ends_sha256`` over the sorted, comma-joined ``conv_id`` of each name.

    The ids are sorted and joined in chunks by many tasks; one task passes the chunks
    of a name through the hash, which can only be computed from front to back, and
    keeps none of them.
    """
    ship(ends.sparkSession)

    def chunks(batches):
        name, ids = None, []
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if ids and (row["name"] != name or len(ids) >= IDS_PER_CHUNK):
                    rows.append((name, ids[0], ",".join(map(str, ids))))
                    ids = []
                name = row["name"]
                ids.append(row["conv_id"])
            yield batch_of(rows)
        yield batch_of([(name, ids[0], ",".join(map(str, ids)))] if ids else [])

    def batch_of(rows):
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)],
            names=["name", "first", "ids"],
        )

    def hashed(batches):
        name, digest = None, None
        for batch in small_batches(batches, 256):
            done = []
            for row in batch.to_pylist():
                if digest is not None and row["name"] == name:
                    digest.update(b",")
                else:
                    if digest is not None:
                        done.append((name, digest.hexdigest()))
                    name, digest = row["name"], hashlib.sha256()
                digest.update(row["ids"].encode())
            yield pairs(done)
        yield pairs([(name, digest.hexdigest())] if digest is not None else [])

    def pairs(rows):
        columns = list(zip(*rows, strict=True)) or [[], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string()) for c in columns], names=["name", "ends_sha256"]
        )

    order = ["name", "conv_id"]
    joined = (
        ends.select(*order)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(chunks, "name string, first long, ids string")
    )
    return (
        joined.repartition("name")
        .sortWithinPartitions("name", "first")
        .mapInArrow(hashed, "name string, ends_sha256 string")
    )


def prefix_nodes(convs: DataFrame, turns: DataFrame, keys: int = KEYS) -> DataFrame:
    """The nodes of the trie over conversations as ``rebuilt`` returns them.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``; see the module for what they count.
    """
    paths = _paths(turns)
    band = F.floor((F.col("depth") - 1) / F.lit(BAND)).cast("long")
    steps = F.sort_array(
        F.collect_list(F.struct("depth", "turn_id", "bytes", "name", "parent", "path_bytes"))
    )
    banded = paths.groupBy("conv_id", band.alias("band")).agg(steps.alias("steps"))
    turnless = convs.join(paths.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("band"),
        F.array().cast(banded.schema["steps"].dataType).alias("steps"),
    )
    nodes = stored(
        _tree_nodes(banded.unionByName(turnless), keys)
        .groupBy("name")
        .agg(
            F.min("parent").alias("parent"), F.min("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.min("bytes").alias("bytes"), F.min("path_bytes").alias("path_bytes"),
        ),
        "trie-nodes",
    )
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("name")).agg(
        F.count("*").alias("n_children")
    )
    nodes = stored(
        nodes.join(children, "name", "left").fillna(0, ["n_children"]), "trie-nodes"
    )
    # What the path of an owner holds before the nodes it owns, and if it has a leaf.
    owners = nodes.groupBy("conv_id").agg(
        F.min_by(F.col("path_bytes") - F.col("bytes"), "depth").alias("spared"),
        F.max((F.col("n_children") == 0).cast("long")).alias("leaf"),
    )
    ended = paths.groupBy("conv_id").agg(
        F.max_by("name", "depth").alias("name"), F.max("path_bytes").alias("total")
    )
    facts = stored(
        convs.join(ended, "conv_id", "left")
        .join(owners, "conv_id", "left")
        .select(
            "conv_id",
            F.coalesce("name", F.lit(ROOT)).alias("end"),
            F.coalesce("spared", "total", F.lit(0)).cast("long").alias("spared"),
            F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"),
        ),
        "conversations",
    )
    before = F.col("path_bytes") - F.col("bytes")
    below = skew_join(
        paths.select("conv_id", "depth", "name", before.alias("before")),
        facts.select("conv_id", "spared", "leaf"),
        ["conv_id"], "inner", spread_by=["depth"],
    ).select(
        "name", F.greatest(F.col("spared") - F.col("before"), F.lit(0)).alias("saved"), "leaf"
    )
    at_root = facts.select(F.lit(ROOT).alias("name"), F.col("spared").alias("saved"), "leaf")
    sums = below.unionByName(at_root).groupBy("name").agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves")
    )
    digests = _digests(facts.select(F.col("end").alias("name"), "conv_id"))
    # One row of each kind a node; they meet in one aggregate.
    whole = stored(
        nodes.unionByName(sums, allowMissingColumns=True)
        .unionByName(digests, allowMissingColumns=True)
        .groupBy("name")
        .agg(*[
            F.max(c).alias(c)
            for c in ("parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves",
                      "saved_tokens", "ends_sha256")
        ]),
        "trie-nodes",
    )
    parents = whole.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = skew_join(whole, parents, ["parent"], "left", spread_by=["name"])
    return named.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
