import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from driftline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [*"ab e'stmdvrl \n\t\r\x0b\x0c!?.,12äß☃😀\x1c\x85　中文²½_<|>", "<|endoftext|>", "É", "́", "İ", "ﬁ", "Σ"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_chunks_give_the_tokenizers_ids(tokenizer):
    rng = random.Random(2)
    coder = packing.ChunkEncoder(PATH, entries=50)
    for _ in range(60):
        texts = ["".join(rng.choices(ODD, k=rng.randint(0, 25))) for _ in range(25)]
        texts += ["x" * 300 + " y", ""]
        for text, ids in zip(texts, coder.encode([t.encode() for t in texts])):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want
    assert len(coder.young) + len(coder.old) < 1000 and not any(len(c) > 200 for c in coder.young)


def check_packing(rows, capacity):
    """Places don't overlap, have no gaps and start at 0."""
    by_sequence = defaultdict(list)
    for sequence, offset, length in rows:
        by_sequence[sequence].append((offset, length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def spread(plan):
    for p in plan:
        for i in range(p.count):
            along, inside = divmod(i, p.each)
            yield p.sequence + along, p.offset + inside * p.length, p.length


def best_fit(sizes, capacity):
    """Sequences that plain best-fit decreasing opens, piece by piece."""
    gaps = []
    for size in sorted(sizes, reverse=True):
        fitting = [g for g in gaps if g >= size]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - size)
        else:
            gaps.append(capacity - size)
    return len(gaps)


def test_counts_are_packed_as_well_as_pieces():
    rng = random.Random(7)
    for trial in range(150):
        capacity = rng.choice([7, 20, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        plan, sequences = packing.pack_counts(dict(Counter(sizes)), capacity)
        rows = list(spread(plan))
        assert Counter(length for *_, length in rows) == Counter(sizes)
        firsts = defaultdict(set)
        for p in plan:
            firsts[p.length] |= set(range(p.first, p.first + p.count))
        assert all(firsts[n] == set(range(c)) for n, c in Counter(sizes).items())
        assert check_packing(rows, capacity) == sequences
        large = Counter(s for s, _, length in rows if 3 * length > capacity)
        assert max(large.values(), default=0) <= 2
        assert -(-sum(sizes) // capacity) <= sequences <= best_fit(sizes, capacity) * 1.02 + 1


def test_plan_does_not_grow_with_the_data():
    counts = {n: 10 for n in range(1, 2049)}
    small, _ = packing.pack_counts(counts, 2048)
    large, sequences = packing.pack_counts({n: c * 100_000 for n, c in counts.items()}, 2048)
    assert len(large) < 2 * len(small) + 4096
    total = sum(n * c for n, c in counts.items()) * 100_000
    assert sequences <= 1.01 * -(-total // 2048)


def test_pack(spark, tokenizer):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["alpha", "beta,", "Gamma's", "δέλτα", "7"], k=rng.randint(0, 40)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "word " * 500), (None, "lost"), (3, "again"), (3, "again")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, length int")
    got = packing.pack(df.repartition(3), PATH, capacity=64, with_ids=True).collect()
    assert check_packing([(r.sequence_id, r.offset, r.length) for r in got], 64) == len({r.sequence_id for r in got})
    want = Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, low in enumerate(range(0, len(ids), 64)):
            span = ids[low : low + 64]
            raw = np.array(span, "<u4").tobytes()
            want[i, piece, low, len(span), zlib.crc32(raw), raw] += 1
    assert want == Counter(
        (r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got
    )
    assert packing.pack(df.limit(0), PATH).count() == 0
