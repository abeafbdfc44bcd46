import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from driftline.llm import best_position as bp

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found_in(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, queries, k):
    held = [(i, Counter(found_in(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, words = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = set()
    for item, text in queries:
        scored = []
        for place, (doc, counts) in enumerate(held):
            m = 100 - 75 + (75 * sum(counts.values()) * n_docs) // words
            score = 0
            for term in found_in(text):
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc, place))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        rows |= {(item, rank, r[2], -r[0]) for rank, r in enumerate(scored[:k], 1)}
    return rows


def frames(spark, docs, queries):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(queries, "item_id long, text string"),
    )


def made(seed, n_docs, n_queries):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(3000)] + ["É", "ß1", "a-b"]
    text = lambda most: " ".join(rng.choices(vocabulary, k=rng.randint(0, most)))
    docs = [(i, text(60)) for i in range(n_docs)]
    docs += [(n_docs + i, docs[i % 7][1]) for i in range(n_docs // 2)]  # copies: ties
    return docs, [(i, text(12)) for i in range(n_queries)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_in_blocks(spark, seed):
    docs, queries = made(seed, 400, 30)
    got = bp.ranked(*frames(spark, docs, queries), k=5, terms=40, cells=4000).collect()
    assert {tuple(r) for r in got} == brute_force(docs, queries, 5)
    assert len(got) == len({tuple(r) for r in got})


def test_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (3, "..."), (None, "Alpha beta"), (4, "alpha BETA"), (4, "alpha beta"),
        (-5, "alpha Ålpha"), (6, "x" * 300_000 + " alpha"), (7, "beta " * 50_000),
    ]
    queries = [(1, "alpha alpha beta"), (2, None), (3, "?"), (4, "nowhere"), (None, "beta"), (1, "ålpha")]
    got = bp.ranked(*frames(spark, docs, queries), k=4).collect()
    assert {(r[0], r[2], r[3]) for r in got} == {
        (i, d, s) for i, _, d, s in brute_force(docs, queries, 4)
    }
    first = [r for r in got if r["item_id"] is None]
    assert [r["doc_id"] for r in sorted(first, key=lambda r: r["rank"])] == [7, 4, 4, None]


def test_empty_tables_and_extra_columns(spark):
    docs, queries = frames(spark, [(1, "alpha")], [(1, "alpha")])
    assert bp.ranked(docs.limit(0), queries).count() == 0
    assert bp.ranked(docs, queries.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    more = docs.selectExpr("*", "7 AS score", "8 AS rank", "9 AS item_id", "'x' AS terms")
    assert bp.ranked(more, queries).count() == 1


def test_stops_before_the_end_of_the_lists():
    """With one strong document the lists need not be read to their ends."""
    rng = np.random.default_rng(0)
    n = 20_000
    docs = np.concatenate([np.arange(n), np.arange(n)])
    terms = np.repeat([0, 1], n)
    tfs = np.maximum(1, rng.zipf(1.8, 2 * n) % 500)
    tfs[:n][:12], tfs[n:][:12] = 900, 900
    lists = bp.Lists(2, docs, terms, tfs, np.full(n, 100), np.arange(n))
    best = bp.Best(10)
    looked = bp.search(lists, np.array([0, 1]), np.array([3, 5]), best)
    assert looked < n / 10
    full = 3 * lists.gain[0].astype(int) + 5 * lists.gain[1]
    order = np.lexsort((np.arange(n), -full))[:10]
    assert best.key.tolist() == order.tolist() and best.score.tolist() == full[order].tolist()


def test_equal_scores_at_the_threshold_are_kept():
    """A tie with the k-th best is not passed over: stopping is strict."""
    n = 5000
    lists = bp.Lists(
        1, np.arange(n), np.zeros(n, int), np.ones(n, int), np.full(n, 100), np.arange(n)[::-1].copy()
    )
    best = bp.Best(3)
    bp.search(lists, np.array([0]), np.array([7]), best)
    assert best.key.tolist() == [0, 1, 2]
