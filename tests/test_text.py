import random
import re

from pyspark.sql import functions as F

from driftline.functions import dates as dt
from driftline.functions import text as tx

SAMPLES = [
    "Hello there. Bye!  ",
    "Ever-Changing AI, café",
    "",
    " ",
    "a b c\u0085d\x1ce",
    "café naïve _x1 ٣² 中文",
    "one\ntwo.\n",
    "Ends well.\n\n",
    "no end",
    "?.!",
    "x. \n",
    "line\rwith return.",
    "tab\tand  spaces ",
]


def column(spark, texts, expr):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def noisy(count=300):
    rng = random.Random(7)
    alphabet = "abZ09_ .!?,\n\t-é  '"
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(count)]


def test_sentence_split_keeps_last_empty(spark):
    assert column(spark, ["Hello there. Bye!  "], tx.sentences) == [["Hello there.", "Bye!", ""]]


def test_letters_only(spark):
    texts = SAMPLES + noisy()
    want = [re.sub(r"[^a-z\s]", "", t.lower(), flags=re.ASCII) for t in texts]
    assert column(spark, texts, tx.letters_only) == want
    assert want[1] == "everchanging ai caf"


def test_punctuated_equals_negated_class(spark):
    texts = SAMPLES + noisy() + ["\U0001f600 x", "a b"]
    want = [re.sub(r"[^\w\s.,!?]", " ", t, flags=re.ASCII) for t in texts]
    assert column(spark, texts, tx.punctuated) == want


def test_word_notions(spark):
    texts = SAMPLES + noisy()
    assert column(spark, texts, tx.raw_words) == [t.split() for t in texts]
    cleaned = [re.sub(r"[^a-z\s]", "", t.lower(), flags=re.ASCII).split() for t in texts]
    assert column(spark, texts, tx.clean_words) == cleaned
    unicode_words = [re.findall(r"\b\w+\b", t.lower()) for t in texts]
    assert column(spark, texts, tx.unicode_words) == unicode_words
    assert column(spark, [" a B "], tx.spaced_words) == [["", "a", "b", ""]]


def test_is_sentence_equals_search(spark):
    texts = SAMPLES + noisy(1000)
    want = [bool(re.search(r"[a-zA-Z0-9]+.*[.!?]$", t)) for t in texts]
    assert column(spark, texts, tx.is_sentence) == want
    assert True in want and False in want
    assert column(spark, [None], tx.is_sentence) == [False]


def test_sentence_word_counts(spark):
    assert column(spark, ["One two. Three!  ", "", "a"], tx.sentence_word_counts) == [
        [2, 1, 0],
        [0],
        [1],
    ]


def test_titles_links_and_previews(spark):
    assert column(spark, ["Category:US elections ", " a b"], tx.normal_title) == [
        "US_elections",
        "a_b",
    ]
    marked = "[[Category:B|key]] {{x}} [[Category: A ]] [[Category:B]] [[Other:C]]"
    assert column(spark, [marked], tx.linked_names) == [["B", "A"]]
    assert column(spark, ["abcdef"], lambda c: tx.preview(c, 3)) == ["abc"]


def test_phrase_hits(spark):
    texts = ["AI, ai and said. election fraud; Election  fraud", "theé the"]
    assert column(spark, texts, lambda c: tx.phrase_hits(c, "ai")) == [2, 0]
    assert column(spark, texts, lambda c: tx.phrase_hits(c, "election fraud")) == [1, 0]
    assert column(spark, texts, lambda c: tx.phrase_hits(c, "the")) == [0, 1]


def test_dates(spark):
    stamps = ["2022-11-30T01:02:03Z", "2022-11-30", "nope", None]
    got = column(spark, stamps, dt.parse_utc)
    assert str(got[0]) == "2022-11-30 01:02:03" and got[2] is None and got[3] is None
    assert str(column(spark, ["2022113000", "bad"], dt.stamp_to_date)[0]) == "2022-11-30"
    assert column(spark, ["2022113000", "bad"], dt.stamp_to_date)[1] is None
    assert column(spark, ["1.5", "x"], dt.numeric) == [1.5, None]


def test_word_sequences_are_runs_of_words(spark):
    """Short and long runs alike; only long ones are cut out of the words each time."""
    data = [(["a"] * k + ["b", "c"],) for k in (0, 1, 7, 12)] + [([],), (None,)]
    df = spark.createDataFrame(data, "w array<string>")
    for n in (1, 2, 3, tx.NAMED_WORDS, tx.NAMED_WORDS + 1):
        got = df.select("w", tx.word_sequences(F.col("w"), n).alias("g"))
        for r in got.collect():
            w = r["w"] or []
            assert r["g"] == [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("array_join" in plan) == (n > tx.NAMED_WORDS)


def test_any_space_is_every_white_space_and_nothing_else(spark):
    """The quick test for printable ASCII must not change what counts as a space."""
    spaces = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    spaces += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    code = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    found = code.where(char.rlike(r"\A" + tx.ANY_SPACE + r"\z"))
    assert sorted(r["id"] for r in found.collect()) == spaces
