import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import lang_mixture as lm
from driftline.llm.queries import QUERIES

DOCS = [
    ("the cat sat on the mat and then it went to the house with the other cats", "en"),
    ("there was nothing that they could have done about this thing", "en"),
    ("der hund und die katze sind nicht auf der strasse sondern in dem haus", "de"),
    ("ich habe das nicht gewusst und werde es auch nicht vergessen", "de"),
]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang) for t, lang in DOCS] + [(None, "en"), ("unlabelled words", None), ("", "en")]
    return lm.train(spark.createDataFrame(rows, "text string, lang string").repartition(3))


def test_counts_cover_all_labelled_rows(model):
    assert model.languages == ["de", "en"]
    for column, lang in enumerate(model.languages):
        counts = np.full(lm.CELLS, lm.SMOOTHING)
        for text, of in DOCS:
            if of == lang:
                counts += np.bincount(lm.trigrams(text), minlength=lm.CELLS)
        assert np.allclose(model.likelihood[:, column], counts / counts.sum())


def test_trigrams():
    assert len(lm.trigrams("ab, c")) == 3 and len(lm.trigrams("1 2 ...")) == 0
    assert lm.trigrams("Ab!!c").tolist() == lm.trigrams(" ab 12 C ").tolist()
    assert len(lm.trigrams("")) == 0


def test_proportions_are_the_best_mixture(model):
    text = DOCS[0][0] + " " + DOCS[2][0]
    name, score, names, shares = lm.infer(model, text)
    assert set(names) == {"de", "en"} and abs(sum(shares) - 1) < 1e-6 and score == shares[0]
    cells = lm.trigrams(text)
    likelihood = model.likelihood[cells]
    of = dict(zip(names, shares))
    reached = np.log(likelihood @ [of["de"], of["en"]]).sum()
    best = max(np.log(likelihood @ [x, 1 - x]).sum() for x in np.linspace(0.001, 0.999, 999))
    assert best - reached < 0.1
    assert lm.infer(model, DOCS[0][0])[2] == ["en"]


def test_rows(spark, model):
    rows = [(1, "the house and the cat"), (2, None), (3, ""), (4, "1234 !?"), (None, "der hund"), (1, "the house and the cat"), (5, "haus " * 20_000)]
    df = spark.createDataFrame([(i, t, "zz") for i, t in rows], "doc_id long, text string, lang string")
    got = df.select("doc_id", lm.predicted(df, model).alias("p")).select("doc_id", "p.*").collect()
    assert [(r.doc_id, r.lang_pred) for r in got] == [
        (1, "en"), (2, "und"), (3, "und"), (4, "und"), (None, "de"), (1, "en"), (5, "de")
    ]
    assert all(0 <= r.score <= 1 for r in got) and got[1].score == 0 and got[0] == got[5]


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert lm.infer(lm.train(empty), "the house") == ("und", 0.0, [], [])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="tables are not there")
def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    judged = QUERIES["op1_lang_mixture"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    right = judged.where("held_out").join(docs.where("text rlike '[a-z]' AND lang IS NOT NULL"), "doc_id")
    share = right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
