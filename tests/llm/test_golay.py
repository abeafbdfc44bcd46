import random

import numpy as np
import pytest
import xxhash

from driftline.llm import golay, simhash
from driftline.llm.components import component_roots

TEXTS = [
    b"", b" \t", b"A", b"a b", b"a  B\tc\n d", b"x" * 300 + b" y z w", b"  lead trail  ",
    "Ünï cödé ß É".encode(), b"a " * 1000, b"q" * 31 + b" r s", b"1 2 3 " * 300,
]


def shingles(text, width):
    words = text.lower().split()
    return [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or (
        [b" ".join(words)] if words else []
    )


def brute_print(text, width=3):
    found = shingles(text, width)
    counts = [0] * 64
    for s in found:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(found))


@pytest.mark.parametrize("width", [1, 3, 5])
def test_fingerprints(width):
    rng = random.Random(1)
    texts = TEXTS + [
        " ".join("".join(rng.choice("abcÄß.") for _ in range(rng.randint(1, 40))) for _ in range(n)).encode()
        for n in (1, 2, 3, 50, 400, 3000)
    ]
    assert [int(x) for x in simhash.fingerprints(texts, width)] == [brute_print(t, width) for t in texts]


def test_slices_make_no_difference(monkeypatch):
    want = simhash.fingerprints(TEXTS).tolist()
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprints(TEXTS).tolist() == want
    assert simhash.fingerprints([]).tolist() == []


def test_golay_code():
    near, bits, five = golay.tables()
    assert np.bincount(bits).tolist() == [1, 23, 253, 1771]  # a perfect code
    assert all(len(set(row)) == 5 for row in five[bits == 3].tolist())
    words = np.arange(1 << 23, step=997)
    indices, n = golay.codewords(words)
    assert ((n == 1) | (n == 6)).all() and indices.max() < 4096


def test_three_bits_always_meet():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    for flips in range(4):
        b = a.copy()
        for _ in range(flips):
            b ^= np.uint64(1) << rng.integers(0, 64, len(a), dtype=np.uint64)
        at, keys = golay.bucket_keys(a, False)
        held = set(zip(at.tolist(), keys.tolist()))
        asked, wanted = golay.bucket_keys(b, True)
        met = {x for x, key in zip(asked.tolist(), wanted.tolist()) if (x, key) in held}
        assert len(met) == len(a)


def brute_components(prints):
    """Smallest id that links of three bits reach, for (id, fingerprint) pairs."""
    group = list(range(len(prints)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, x) in enumerate(prints):
        for j, (_, y) in enumerate(prints[:i]):
            if (x ^ y).bit_count() <= 3:
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(prints))]


def near_texts():
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randint(0, 500)}" for _ in range(120)) for _ in range(12)]
    for text in texts[:8]:
        words = text.split()
        for _ in range(15):
            words = list(words)
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 99)}"
            texts.append(" ".join(words))
    return texts + ["", None, " \n", "one", "One", "one two", texts[0], texts[0]]


def test_components_equal_all_pairs(spark):
    rows = [(i, t) for i, t in enumerate(near_texts())][::-1] + [(None, "one"), (None, "lonely"), (3, "one")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = golay.near_duplicates(df).select(
        "doc_id", golay.hex_print(golay.F.col("fp")).alias("hex"), "component_id"
    )
    prints = [(i, brute_print((t or "").encode())) for i, t in rows]
    want = [(i, f"{fp:016x}", c) for (i, fp), c in zip(prints, brute_components(prints))]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert len(set(brute_components(prints))) > 10
    assert golay.near_duplicates(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        golay.near_duplicates(df, distance=4)


def test_one_of_each_component_stays(spark):
    rows = [(i, t) for i, t in enumerate(near_texts())][::-1]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    prints = [(i, brute_print((t or "").encode())) for i, t in rows]
    left = golay.keep_one(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(brute_components(prints)))
    assert golay.keep_one(df.limit(0)).count() == 0


def test_rows_without_an_id_or_with_the_same_one(spark):
    rng = random.Random(3)
    one, two, three = (" ".join(f"w{rng.randint(0, 3000)}" for _ in range(200)) for _ in range(3))
    rows = [(None, one), (None, two), (5, three), (5, one.upper()), (None, None), (5, three)]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, _row string")
    left = golay.keep_one(df)
    assert left.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    assert got == sorted([(None, two), (5, three), (5, one.upper()), (None, None)], key=repr)


def test_component_roots(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 9), (9, 7), (500, 501)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in component_roots(df).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {7: 3, 9: 3, 501: 500}
    assert component_roots(df.limit(0)).count() == 0
