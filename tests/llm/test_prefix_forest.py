import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import prefix_forest as pf
from driftline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, vector string"


def brute(ids, vectors, asked, k):
    """Exact nearest by cosine in double precision, ties to the smaller id."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    out = {}
    for q in np.flatnonzero(asked):
        score = (unit * unit[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score.round(12))) if ids[i] != ids[q]]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order[:k]]
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want)
    return hits / sum(map(len, want.values()))


def collected(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("shard_rows", [10_000, 400])
def test_recall_and_scores(spark, shard_rows):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((1500, 24)).astype(np.float32)
    vectors[1000:1100] = vectors[:100] + 0.05 * rng.standard_normal((100, 24))
    ids = np.arange(1500)
    df = frame(spark, zip(ids.tolist(), vectors.tolist()))
    got = collected(pf.nearest(df, F.col("vec_id") % 10 == 0, shard_rows=shard_rows))
    want = brute(ids, vectors.astype(float), ids % 10 == 0, 5)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert recall(got, want) > 0.95
    for q, found in got.items():
        for i, score in found:
            a, b = vectors[q].astype(float), vectors[i].astype(float)
            assert math.isclose(score, a @ b / math.sqrt((a @ a) * (b @ b)), rel_tol=1e-12)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, [3.0, 0.0]), (10, [-1.0, 0.0]),
        (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]),
        (None, [1.0, 0.0]), (20, [1.0, 2.0, 3.0]), (30, [None, None]), (1, [2.0, 0.0]), (0, [1.0, 0.0]),
    ]
    got = collected(pf.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, k=3))
    half = 1 / math.sqrt(2)
    assert got.keys() == {0, 10}
    assert [i for i, _ in got[0]] == [1, 3, 2] and [i for i, _ in got[10]] == [2, 0, 1]
    assert [round(s, 12) for _, s in got[0]] == [1, 1, round(half, 12)]
    assert pf.nearest(frame(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_many_equal_vectors(spark):
    """Ties go to the smaller ids, whatever shard they are in."""
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(600)] + [(i, [1.0, -2.0, 0.5]) for i in range(600, 620)]
    got = collected(pf.nearest(frame(spark, rows), F.col("vec_id") % 100 == 0, shard_rows=100))
    for q in (0, 100, 500):
        assert [i for i, _ in got[q]] == [i for i in range(6) if i != q][:5]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="tables are not there")
def test_query_recall(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").toPandas()
    vectors = np.array(table.embedding.tolist(), float)
    ids = table.vec_id.to_numpy()
    got = collected(QUERIES["op2_prefix_forest"](spark, sf_dir))
    assert recall(got, brute(ids, vectors, ids % 50 == 0, 5)) >= 0.9
