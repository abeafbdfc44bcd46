"""The pipeline, stage by stage, against brute force on small planted documents."""

import random
import re
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

WORDS = {
    "en": "the and of to that there with which would their other about house water people".split(),
    "de": "der und die das nicht mit sich auch nach werden ueber haus wasser leute strasse".split(),
}


def planted():
    rng = random.Random(11)
    rows, n = [], 0

    def add(text, lang):
        nonlocal n
        rows.append((n, text, lang, "s", len(text or "")))
        n += 1
        return n - 1

    def prose(lang):
        stem = [w + rng.choice(["", "er", "en"]) + str(rng.randint(0, 400)) for w in WORDS[lang] * 14]
        rng.shuffle(stem)
        return stem

    clean, exact, near, junk = [], [], [], []
    for lang in ("en", "de"):
        for _ in range(15):
            words = prose(lang)
            clean.append(add(" ".join(words), lang))
            if rng.random() < 0.5:
                exact.append(add("  ".join(words), lang))
            if rng.random() < 0.5:
                # White space is squeezed by the stage before, but case is not.
                near.append(add(" ".join(words).upper(), lang))
    for text in (None, "", "12 34 !!", "..."):
        junk.append(add(text, "en"))
    return rows, clean, exact, near, junk


@pytest.fixture(scope="module")
def case(spark):
    rows, *ids = planted()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema), *ids


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark, case):
    docs, clean, exact, near, junk = case
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language id"](spark, docs, "").cache()
    assert spoken.columns == docs.columns and ids(spoken) == sorted(clean + exact + near)
    single = stages["exact dedup"](spark, spoken, "").cache()
    assert single.columns == docs.columns and ids(single) == sorted(clean + near)
    squeezed = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text) for r in single.collect()]
    assert len(set(squeezed)) == len(squeezed)
    apart = stages["near dedup"](spark, single, "").cache()
    assert apart.columns == docs.columns and ids(apart) == sorted(clean)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in apart.collect()}
    pieces = stages["packing"](spark, apart, "").collect()
    held, filled = defaultdict(int), defaultdict(int)
    for r in pieces:
        held[r.doc_id] += r.length
        filled[r.sequence_id] += r.length
    assert dict(held) == sizes and max(filled.values()) <= 2048


def test_empty(spark, case):
    docs = case[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_run(spark, case, tmp_path):
    case[0].write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert ids(out.dropDuplicates(["doc_id"])) == sorted(case[1])
    assert out.agg(F.count_distinct("sequence_id")).first()[0] > 0


def test_noise_with_letters_goes(spark, case):
    docs, clean = case[0], case[1]
    noise = [(900, "x", None, "s", 1), (901, "12 q !! 34 x", None, "s", 12), (902, "zqj xkv qqz jjx", None, "s", 15)]
    kept = ids(dict(corpus_pipeline.STAGES)["language id"](spark, docs.union(spark.createDataFrame(noise, docs.schema)), ""))
    assert set(clean) <= set(kept) and max(kept) < 900


def test_nothing_learned_keeps_all(spark, case):
    docs = case[0].withColumn("lang", F.lit(None).cast("string"))
    assert ids(dict(corpus_pipeline.STAGES)["language id"](spark, docs, "")) == ids(docs)
