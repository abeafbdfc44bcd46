import hashlib
import random
import re
from collections import Counter

import pytest

from driftline.llm import block_naming as naming

SCHEMA = "doc_id long, text string, body string, n_chars long"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    out, kept = [], set()
    for doc_id, text in rows:
        key = normal(text)
        ids = [i for i in groups[key] if i is not None]
        keep = min(ids) if ids else None
        stays = doc_id == keep and key not in kept
        if stays:
            kept.add(key)
        sha = hashlib.sha256(key.encode()).hexdigest()
        out.append((doc_id, keep, len(groups[key]), stays, sha))
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def some_rows():
    rng = random.Random(5)
    texts = ["", None, " ", "a b", "a  b", "a\tb", "a\u00a0b", "ab" * 40, "ab" * 40 + "c", "ab" * 41]
    texts += ["".join(rng.choice("xy ") for _ in range(n)) for n in (7, 8, 9, 31, 33, 200)]
    rows = [(rng.randint(0, 400), rng.choice(texts)) for _ in range(120)]
    return rows + [(None, "a b"), (None, "only"), (None, "only"), (7, "twice"), (7, "twice")]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_equals_grouping_by_text(spark, bits):
    """Also where many blocks share a hash."""
    rows = some_rows()
    out = naming.exact_duplicates(frame(spark, rows), block_bytes=8, hash_bits=bits)
    assert Counter(tuple(r) for r in out.collect()) == expected(rows)


def test_large_group_and_long_text(spark):
    rows = [(i, "same text " * 3) for i in range(500)] + [(900, "z" * 300_000), (901, "z" * 300_001)]
    out = naming.exact_duplicates(frame(spark, rows), block_bytes=1024)
    assert Counter(tuple(r) for r in out.collect()) == expected(rows)


def test_keep_first_keeps_columns_and_one_row_each(spark):
    rows = some_rows()
    left = naming.keep_first(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "body", "n_chars"]
    got = Counter((r.doc_id, normal(r.text)) for r in left.collect())
    want = {(d, k) for d, k in ((i, normal(t)) for i, t in rows)}
    least = {}
    for d, k in want:
        if k not in least or (d is not None and (least[k] is None or d < least[k])):
            least[k] = d
    assert got == Counter((d, k) for k, d in least.items())


def test_empty(spark):
    df = frame(spark, [(1, "a")]).limit(0)
    assert naming.exact_duplicates(df).count() == 0
    assert naming.keep_first(df).count() == 0
