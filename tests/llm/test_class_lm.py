import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import class_lm as lm

ROWS = [
    (1, "The cat sat. The dog sat"),
    (2, "the\tdog  ran and the cat ran"),
    (3, None),
    (4, ""),
    (5, "a dog and a cat"),
    (None, "the end of the dog"),
    (1, "The cat sat. The dog sat"),
]
TEST = [(10, "the cat ran"), (11, "Zebra ÜBER the"), (12, None), (None, "dog"), (10, "the cat ran"), (13, "sat " * 3000)]
SMALL = {"head": 4, "endings": 3, "classes": 3, "rounds": 5, "local": 3}


def words(text):
    return (text or "").encode().lower().split()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, word string, n int")


@pytest.fixture(scope="module")
def trained(spark):
    return lm.train(frame(spark, ROWS).repartition(3), **SMALL)


def test_counts(trained):
    model, vocabulary = trained
    counts = Counter(w for _, t in ROWS for w in words(t))
    assert {bytes(r.word): r.n for r in vocabulary.collect()} == counts
    assert model.tokens == sum(counts.values()) + len(ROWS) and model.ends == len(ROWS)
    assert model.kinds == len(counts) + 1
    assert model.head == sorted(counts, key=lambda w: (-counts[w], w))[:4]


def test_every_distribution_sums_to_one(trained):
    model, vocabulary = trained
    assert np.allclose((10**model.moves).sum(axis=1), 1)
    units = lm.Units(model.head, model.endings)
    total = Counter()
    for r in vocabulary.collect():
        total[int(model.of[units[bytes(r.word)]])] += r.n + 1
    for c, n in total.items():  # the known words of a class and one unknown word
        assert math.isclose((n + 1) / 10 ** model.spread[c], 1)


def expected(trained, text):
    model, vocabulary = trained
    counts = {bytes(r.word): r.n for r in vocabulary.collect()}
    units, edge = lm.Units(model.head, model.endings), int(model.of[-1])
    line, score, base, known, before = words(text), 0.0, 0.0, 0, edge
    for w in line:
        c = int(model.of[units[w]])
        n = counts.get(w, 0)
        score += model.moves[before, c] + math.log10(n + 1) - model.spread[c]
        base += math.log10((n + 1) / (model.tokens + model.kinds + 1))
        known, before = known + (n > 0), c
    score += model.moves[before, edge]
    base += math.log10((model.ends + 1) / (model.tokens + model.kinds + 1))
    return len(line) + 1, known + 1, base, score


def test_scores_equal_word_by_word(spark, trained):
    got = lm.score(frame(spark, TEST), *trained).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in TEST)
    texts = {str(i): t for i, t in TEST}
    for r in got:
        n, known, base, score = expected(trained, texts[str(r.doc_id)])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, trained[0].tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=1e-9)
        assert math.isclose(r.perplexity, 10 ** (-score / n), rel_tol=1e-6)


def value(bigrams, of):
    total = of.max() + 1
    table = np.zeros((total, total))
    np.add.at(table, (of[:, None], of[None, :]), bigrams)
    h = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return h(table) - h(table.sum(axis=0)) - h(table.sum(axis=1))


def test_exchange_ends_where_no_move_gains():
    rng = np.random.default_rng(0)
    for _ in range(5):
        bigrams = rng.poisson(3, (9, 9)) * rng.integers(0, 2, (9, 9))
        of = lm.exchange(bigrams, 3, 50)
        assert of[-1] == 3 and of[:-1].max() < 3
        for unit, to in itertools.product(range(8), range(3)):
            moved = of.copy()
            moved[unit] = to
            assert value(bigrams, moved) <= value(bigrams, of) + 1e-6


def test_classes_help_on_held_out_text(spark):
    """Nouns follow articles here, so classes predict better than single words."""
    rng = random.Random(0)
    kinds = [["the", "a", "one"], ["cat", "dog", "cow", "hen"], ["ran", "sat", "ate"]]
    line = lambda: " ".join(rng.choice(kinds[i % 3]) for i in range(30))
    trained = lm.train(frame(spark, [(i, line()) for i in range(30)]), **{**SMALL, "head": 10})
    for r in lm.score(frame(spark, [(i, line()) for i in range(5)]), *trained).collect():
        assert r.score > r.base_score + 5


def test_nothing_to_learn_or_score(spark):
    empty = frame(spark, ROWS).limit(0)
    trained = lm.train(empty, **SMALL)
    (row,) = lm.score(frame(spark, [(1, "x y")]), *trained).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert math.isfinite(row.score)
    assert lm.score(empty, *trained).count() == 0


def test_best_moves_are_those_of_all_trials(spark):
    """Counts by sweep and gains, against the likelihood of each move tried."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 12)))) for i in range(60)]
    docs = frame(spark, rows).repartition(4)
    own, endings = [c.encode() for c in "abcdef"], 2
    units = lm.Units(own, endings)
    lines = lm.unit_lines(docs, own, endings, "text")
    bigrams = lm.count_bigrams(lines, np.arange(units.edge + 1))
    of = np.array([i % 3 for i in range(len(own) + endings)] + [3])
    table = np.zeros((4, 4))
    np.add.at(table, (of[:, None], of[None, :]), bigrams)
    assert np.array_equal(lm.count_bigrams(lines, of), table)
    assert math.isclose(lm.likelihood(table), value(bigrams, of))
    found = {r.unit: r for r in lm.best_moves(lines, of, table, 2).collect()}
    for unit in range(2, units.edge):
        trials = []
        for to in range(3):
            moved = of.copy()
            moved[unit] = to
            trials.append(value(bigrams, moved) - value(bigrams, of))
        if max(trials) > 1e-6:
            assert math.isclose(found[unit].gain, max(trials), rel_tol=1e-6)
            assert math.isclose(trials[found[unit].best], max(trials), rel_tol=1e-6)
        else:
            assert unit not in found
    assert not set(found) & {0, 1}


def test_sweeps_raise_the_likelihood_and_give_words_their_own_class(spark):
    rng = random.Random(0)
    kinds = [[f"{c}{i}x" for i in range(8)] for c in "abc"]  # all of one ending
    line = lambda: " ".join(rng.choice(kinds[i % 3]) for i in range(30))
    docs = frame(spark, [(i, line()) for i in range(60)])
    few = {**SMALL, "head": 6, "endings": 2, "local": 24}
    values, scores = [], []
    for sweeps in (0, 3):
        model, vocabulary = lm.train(docs, **few, sweeps=sweeps)
        lines = lm.unit_lines(docs, model.head, 2, "text")
        values.append(lm.likelihood(lm.count_bigrams(lines, model.of)))
        scores.append(lm.score(docs, model, vocabulary).agg(F.sum("score")).first()[0])
    assert values[1] > values[0] and scores[1] > scores[0]


def test_long_words_are_counted_like_others(spark):
    long = "=" * 5000
    model, vocabulary = lm.train(frame(spark, [(1, f"{long} a {long}"), (2, long.upper())]), **SMALL)
    assert model.head[0] == lm.words(long.encode())[0] and len(model.head[0]) == 33
    (row,) = lm.score(frame(spark, [(1, long)]), model, vocabulary).collect()
    assert (row.n_tokens, row.n_known) == (2, 2) and model.kinds == 3
