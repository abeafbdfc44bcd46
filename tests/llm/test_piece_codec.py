import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import piece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = list("ab e'stmdvrl  \n\t\r!?.,12äß☃😀 \x1c\x1d\x85　中文̈²½_<|>▁▁\x00")


@pytest.fixture(scope="module")
def coder():
    return piece_codec.PieceCodec(PATH, entries=500)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def agree(coder, library, text):
    ids = coder.encode(text)
    assert ids == library.encode(text)
    assert coder.decode([*ids, coder.end]) == library.decode([*ids, coder.end])


def test_odd_texts(coder, library):
    rng = random.Random(1)
    for _ in range(8000):
        agree(coder, library, "".join(rng.choices(ODD, k=rng.randint(0, 25))))
    assert len(coder.units) + len(coder.units.old) <= 500


def test_texts_of_pieces(coder, library):
    rng = random.Random(2)
    pieces = coder.text[259 : coder.size]
    for _ in range(8000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 6)))
        agree(coder, library, text.replace("▁", " ") if rng.random() < 0.8 else text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=40))
def test_any_text(coder, library, text):
    agree(coder, library, text)


def test_long_runs(coder, library):
    for text in ("a" * 20_000, " " * 5000 + "x", "ab" * 9000 + "?!" * 3000, "😀" * 3000, "\n" * 999):
        agree(coder, library, text)


def test_compatible_neighbours_are_those_the_library_keeps(coder, library):
    """A pair is compatible exactly if its joined text has these two as its ids."""
    rng = random.Random(3)
    for _ in range(4000):
        a, b = rng.randrange(259, coder.size), rng.randrange(259, coder.size)
        run = coder.text[a] + coder.text[b]
        if "\n" not in run:
            kept = coder.encode_run(run) == (a, b)
            assert coder.pairs[a * len(coder.text) + b] == kept


def test_any_ids_are_decoded_as_the_library_does(coder, library):
    rng = random.Random(4)
    for _ in range(4000):
        ids = [
            rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(coder.size)])
            for _ in range(rng.randrange(8))
        ]
        assert coder.decode(ids) == library.decode(ids)


def test_frames(spark, library):
    texts = [(1, "Hello  you\n", "x"), (2, None, "y"), (3, "", "z"), (None, "<s>▁", "x"), (1, "Ää", "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, ids string")
    coded = piece_codec.encode_documents(docs, PATH)
    got = {(r["doc_id"], tuple(r["ids"])) for r in coded.collect()}
    assert got == {(i, (*library.encode(t or ""), 2)) for i, t, _ in texts}
    back = {(r["doc_id"], r["text"]) for r in piece_codec.decode_documents(coded, PATH).collect()}
    assert back == {(i, library.decode(library.encode(t or ""))) for i, t, _ in texts}
    for row in piece_codec.round_trip_digests(docs.where("doc_id = 2"), PATH).collect():
        assert row["n_tokens"] == 1
        assert row["ids_sha256"] == hashlib.sha256(b"2").hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert piece_codec.encode_documents(docs.limit(0), PATH).count() == 0


def test_query_equals_the_library_on_the_small_table(spark, library):
    import os

    from driftline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("tables are not there")
    want = {}
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = [*library.encode(row["text"] or ""), 2]
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[row["doc_id"]] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
    rows = QUERIES["op13_piece_prefix_table"](spark, folder).collect()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows}
    assert got == want and len(rows) == len(want)
