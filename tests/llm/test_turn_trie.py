import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from driftline.llm import turn_trie
from driftline.llm.common import crc32_of_id

COLUMNS = "conv_id long, turn long, role string, text string"


def lend(c):
    return c - c % 5, crc32_of_id(c) % 9


def nodes_of(spark, rows, keys=turn_trie.KEYS):
    conversations = spark.createDataFrame(rows, COLUMNS)
    convs, turns = turn_trie.rebuilt(conversations, lend)
    got = turn_trie.prefix_nodes(convs, turns, keys=keys).collect()
    return sorted((tuple(r) for r in got), key=repr)


def brute_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turn_id = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode())
            own[conv].append(
                ((turn is not None, turn or 0, turn_id.hexdigest()), (role or "", text or ""))
            )
    ordered = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, turns in ordered.items():
        h = zlib.crc32(str(c).encode()) % 9
        # The remainder of a negative id is negative, as in SQL.
        whole = (*ordered.get(c - int(math.fmod(c, 5)), [])[:h], *turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, convs in members.items():
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += children[prefix] == 0
            if prefix:
                saved[prefix[:d]] += (len(convs) - 1) * len(prefix[-1][1].encode())
    return sorted(
        (
            (
                min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p],
                leaves[p], saved[p],
                hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
            )
            for p, convs in members.items()
        ),
        key=repr,
    )


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(400), 120):
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice("ab") * (turn % 3)))
    assert nodes_of(spark, rows, keys=7) == brute_force(rows)


def test_long_conversations_and_copies(spark):
    """Bands meet, and a conversation that many repeat is one path."""
    long = [(turn, "user", f"line {turn}") for turn in range(300)]
    rows = [(conv, *step) for conv in (0, 1, 2, 7) for step in long]
    rows += [(9, *step) for step in long[:200]] + [(9, 200, "user", "else")]
    rows += [(conv, turn, "user", "hello") for conv in range(100, 190) for turn in range(9)]
    assert nodes_of(spark, rows, keys=11) == brute_force(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no id"), (5, None, "user", None), (5, 1, None, "ä" * 70_000),
        (5, 1, "x", "same turn"), (5, 1, "x", "same turn"), (6, 0, "user", "never reached"),
        (11, 3, "a:", "b"), (12, 3, "a", ":b"), *[(-7, t, "", "") for t in range(10)], (-7, 10, None, None),
    ]
    assert nodes_of(spark, rows) == brute_force(rows)
    assert nodes_of(spark, []) == []


def test_extra_columns_and_turnless(spark):
    # 3 has fewer turns than it borrows and its lender is absent, so none are left.
    h = zlib.crc32(b"3") % 9
    assert h > 1
    frame = spark.createDataFrame([(3, 0, "user", "x")], COLUMNS).withColumn("name", F.lit(1))
    convs, turns = turn_trie.rebuilt(frame.withColumn("depth", F.lit(2)), lend)
    (root,) = turn_trie.prefix_nodes(convs, turns).collect()
    assert tuple(root)[:7] == (3, 0, None, 1, 0, 1, 0)
    assert root["ends_sha256"] == hashlib.sha256(b"3").hexdigest()


@pytest.mark.parametrize("kinds", [3, 12, 40, 256])
def test_tree_layouts(kinds):
    """Nodes grow through their layouts and the tree finds every prefix."""
    rng = random.Random(kinds)
    tree, want = turn_trie.RadixTree(), defaultdict(list)
    for member in range(1500):
        turns = [bytes([rng.randrange(kinds), 0, 7]) for _ in range(rng.randint(0, 4))]
        key = b"hd" + b"".join(turns)
        tree.insert(key, member, key)
        for d in range(len(turns) + 1):
            want[key[: 2 + 3 * d]].append(member)
    got = {}
    for turns, stored, count, least in tree.nodes(2, 3):
        assert stored[: 2 + 3 * turns] not in got
        got[stored[: 2 + 3 * turns]] = (count, least)
    assert got == {k: (len(v), min(v)) for k, v in want.items()}
    widest = {3: 4, 12: 16, 40: 48, 256: 256}[kinds]
    assert max(n.children.most for n in every_inner(tree)) == widest


def every_inner(tree):
    stack = [tree.root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(node.children)


def test_paths_are_compressed():
    tree = turn_trie.RadixTree()
    tree.insert(b"a" * 600, 1, None)
    tree.insert(b"a" * 500 + b"b" * 100, 2, None)
    assert len(list(every_inner(tree))) == 4
