import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import bpe_codec

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ODD = list("ab e'stmdvrl  \n\t\r!?.,12äß☃😀 \x1c\x1d\x85　中文̈²½_<|>")


@pytest.fixture(scope="module")
def coder():
    return bpe_codec.Codec(PATH, PATTERN, entries=500)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_hash_is_minimal_and_perfect(coder):
    slots = [coder.hash.slot(key) for key in coder.ranks]
    assert sorted(slots) == list(range(len(coder.ranks)))
    assert coder.hash.slot(b"not a token of this vocabulary") == -1
    for keys in ([b"a"], [b"", b"a", b"b"], [str(i).encode() for i in range(1000)]):
        small = bpe_codec.MinimalPerfectHash(keys)
        assert sorted(small.slot(k) for k in keys) == list(range(len(keys)))


def test_odd_texts(coder, reference):
    rng = random.Random(1)
    for _ in range(8000):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 25)))
        ids = coder.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
    assert len(coder.units) + len(coder.units.old) <= 1001


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=40))
def test_any_text(coder, reference, text):
    assert coder.encode(text) == reference.encode_ordinary(text)


def test_long_runs(coder, reference):
    for text in ("a" * 20_000, " " * 5000 + "x", "ab" * 9000 + "?!" * 3000, "😀" * 3000, "\n" * 999):
        ids = coder.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_merges_take_the_leftmost_of_equals():
    ranks = {b"aa": 0, b"aaa": 1, b"ab": 2}
    assert bpe_codec.merged(b"aaab", ranks.get) == [b"aaa", b"b"]
    assert bpe_codec.merged(b"aaa", {b"aa": 0}.get) == [b"aa", b"a"]
    assert bpe_codec.merged(b"baab", {b"ab": 0, b"ba": 0}.get) == [b"ba", b"ab"]
    assert bpe_codec.merged(b"", ranks.get) == []


def test_documents(spark, reference):
    rows = [(1, "Hello  world\n it's"), (2, None), (3, ""), (None, "x"), (1, "Hello  world\n it's"), (4, "long " * 5000)]
    df = spark.createDataFrame([(i, t, "v") for i, t in rows], "doc_id long, text string, value string")
    coded = bpe_codec.encode_documents(df, PATH, PATTERN)
    want = [(i, reference.encode_ordinary(t or "")) for i, t in rows]
    assert [(r.doc_id, list(r.ids)) for r in coded.collect()] == want
    back = bpe_codec.decode_documents(coded, PATH, PATTERN).collect()
    assert [(r.doc_id, bytes(r.bytes)) for r in back] == [(i, (t or "").encode()) for i, t in rows]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    digests = bpe_codec.round_trip_digests(df, PATH, PATTERN)
    assert [tuple(r) for r in digests.collect()] == [
        (i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))
        for (i, ids), (_, t) in zip(want, rows)
    ]
    assert bpe_codec.round_trip_digests(df.limit(0), PATH, PATTERN).count() == 0
