import datetime as d
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import sentences, series


def test_sentence_stats(spark):
    content = spark.createDataFrame(
        [
            ("1", "d", "One two. Three! "),
            ("1", "d", "Four five six."),
            ("2", "d", "Only one here"),
            ("3", "d", ""),
            ("3", "d", None),
            ("4", None, "!!! "),
        ],
        "to_id string, date string, text string",
    )
    got = {r["to_id"]: r for r in sentences.sentence_stats(content).collect()}
    lengths = [2, 1, 0, 3]
    assert got["1"]["avg_word_count"] == pytest.approx(statistics.mean(lengths))
    assert got["1"]["variance"] == pytest.approx(statistics.variance(lengths))
    assert got["1"]["relative_variance"] == pytest.approx(
        statistics.variance(lengths) / statistics.mean(lengths)
    )
    assert got["2"]["variance"] is None and "3" not in got
    full = {r["to_id"]: r for r in sentences.sentence_stats(content, drop_wordless=True).collect()}
    assert full["1"]["avg_word_count"] == pytest.approx(2.0)


def test_zero_mean_has_no_ratio(spark):
    content = spark.createDataFrame(
        [("1", "d", " "), ("1", "d", " ")], "to_id string, date string, text string"
    )
    row = sentences.sentence_stats(content).first()
    assert row["avg_word_count"] == 0 and row["relative_variance"] is None


def test_sentence_count_avg(spark, rows):
    content = spark.createDataFrame(
        [("1", "One two. Three!"), ("2", "no end"), ("3", "A (b) c.")], "to_id string, text string"
    )
    assert rows(sentences.sentence_count_avg(content)) == [("1", 2, 1.5), ("3", 1, 3.0)]


@pytest.fixture(scope="module")
def noisy():
    rng = random.Random(6)
    start = d.date(2024, 1, 1)
    days = sorted(rng.sample(range(400), 70))
    return [
        (i, start + d.timedelta(days=day), None if rng.random() < 0.1 else rng.uniform(0, 9))
        for i, day in enumerate(days)
    ]


@pytest.mark.parametrize("rows_per_task", [1000, 9])
def test_rolling_mean_equals_pandas(spark, noisy, rows_per_task):
    df = spark.createDataFrame(noisy, "i long, day date, v double")
    rolled = series.rolling_mean(
        df, "v", 5, [F.asc("day"), F.asc("i")], rows_per_task=rows_per_task
    )
    got = [r["rolling_mean"] for r in rolled.orderBy("i").collect()]
    want = pd.Series([v for _, _, v in noisy], dtype=float).rolling(5).mean()
    for g, w in zip(got, want, strict=True):
        assert (g is None) == bool(np.isnan(w)) and (g is None or g == pytest.approx(w))


@pytest.mark.parametrize("weeks", [2, 3])
def test_resample_equals_pandas(spark, noisy, weeks):
    df = spark.createDataFrame(noisy, "i long, day date, v double")
    got = {
        r["label"]: r["mean"] for r in series.resample_weeks(df, "day", "v", weeks).collect()
    }
    frame = pd.DataFrame({"day": pd.to_datetime([x[1] for x in noisy]), "v": [x[2] for x in noisy]})
    want = frame.resample(f"{weeks}W", on="day").mean()["v"].astype(float)
    assert sorted(got) == [label.date() for label in want.index]
    for label, w in want.items():
        g = got[label.date()]
        assert (g is None) == bool(np.isnan(w)) and (g is None or g == pytest.approx(w))
    assert any(v is None for v in got.values()) or weeks == 3


def test_resample_golden_labels(spark):
    df = spark.createDataFrame(
        [(d.date(2024, 1, 1), 1), (d.date(2024, 3, 1), 3)], "day date, v long"
    )
    got = [tuple(r) for r in series.resample_weeks(df, "day", "v", 2).orderBy("label").collect()]
    assert got == [
        (d.date(2024, 1, 7), 1.0),
        (d.date(2024, 1, 21), None),
        (d.date(2024, 2, 4), None),
        (d.date(2024, 2, 18), None),
        (d.date(2024, 3, 3), 3.0),
    ]


def test_resample_by_group(spark, rows):
    df = spark.createDataFrame(
        [("a", d.date(2024, 1, 1), 1), ("b", d.date(2024, 5, 1), 3)], "g string, day date, v long"
    )
    assert rows(series.resample_weeks(df, "day", "v", 2, ["g"])) == [
        ("a", d.date(2024, 1, 7), 1.0),
        ("b", d.date(2024, 5, 5), 3.0),
    ]


def test_milestones_round_half_to_even(spark):
    data = [("2022-11-01", 0.12), ("2022-11-19", 0.13), ("2022-11-20", 2.0), (None, 7.0)]
    df = spark.createDataFrame(data, "t string, v double").withColumn(
        "t", F.col("t").cast("timestamp_ntz")
    )
    row = series.milestone_means(df, "t", "v", "2022-11-20").first()
    assert (row["mean_before"], row["mean_after"]) == (0.12, 2.0)
    assert (row["rows_before"], row["rows_after"]) == (2, 1)
    assert str(row["last_before"]) == "2022-11-19" and str(row["first_after"]) == "2022-11-20"


def test_histogram_equals_numpy(spark, noisy):
    df = spark.createDataFrame(noisy, "i long, day date, v double")
    hist = series.date_histogram(df, "day", 30)
    got = [r["records"] for r in hist.orderBy("bin").collect()]
    numbers = [x[1].toordinal() for x in noisy]
    assert got == list(np.histogram(numbers, bins=30)[0])
    same = df.where("i = 0")
    single = {r["bin"]: r["records"] for r in series.date_histogram(same, "day", 30).collect()}
    assert single[15] == 1 and sum(single.values()) == 1


def test_summary_takes_the_first_maximum(spark):
    df = spark.createDataFrame(
        [(d.date(2020, 3, 1), 9000), (d.date(2020, 1, 1), 5), (d.date(2020, 2, 1), 9000)],
        "m date, v long",
    )
    summary = series.series_summary(df, "m", "v")
    assert tuple(summary.first())[::3] == (18005, d.date(2020, 2, 1))
    assert tuple(series.summary_text(summary).first()) == (
        "18,005",
        "6,002",
        "9,000",
        "February 2020",
    )
    assert [r["m"].month for r in series.top_rows(df, "m", "v", 2).collect()] == [2, 3]


@pytest.mark.parametrize("n", [1, 2, 9, 80])
def test_spectrum_equals_fft(spark, n):
    rng = np.random.default_rng(n)
    x = rng.uniform(0, 10, n) + 3 * np.sin(np.arange(n) * 2 * np.pi / 5)
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "g string, t int, v double")
    spectrum = series.dft_spectrum(df.repartition(3), ["g"], "t", "v").orderBy("k").collect()
    transformed, frequencies = np.abs(np.fft.fft(x)), np.fft.fftfreq(n)
    assert len(spectrum) == n // 2 + 1
    for row in spectrum:
        assert row["magnitude"] == pytest.approx(transformed[row["k"]], abs=1e-8)
        assert row["frequency"] == pytest.approx(frequencies[row["k"]])
    with_mean = series.dominant_period(df, ["g"], "t", "v", keep_mean=True).first()
    assert with_mean["k"] == int(np.argmax(transformed)) == 0 and with_mean["period"] is None
    if n == 80:
        assert series.dominant_period(df, ["g"], "t", "v").first()["period"] == pytest.approx(5)


def test_peaks(spark):
    values = [1, 2, 1, 2, 50, 1]
    df = spark.createDataFrame(list(enumerate(values)), "t int, v long")
    got = series.peaks(df, "t", "v", trailing=4, threshold=2.0).orderBy("t").collect()
    assert [r["is_peak"] for r in got] == [False, False, False, False, True, False]
    assert got[4]["z"] == pytest.approx((50 - 1.5) / statistics.stdev([1, 2, 1, 2]))
    flat = spark.createDataFrame([(i, 1) for i in range(6)], "t int, v long")
    assert series.peaks(flat, "t", "v", trailing=4).where("z is not null").count() == 0


def test_monthly(spark, rows):
    df = spark.createDataFrame([("2020-01-01",), ("2020-01-31",), ("2020-02-01",)], "t string")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert rows(series.monthly_counts(df, "t", since="2020-01-31")) == [
        (d.date(2020, 1, 1), 1),
        (d.date(2020, 2, 1), 1),
    ]
    assert rows(series.records_per_month(df, "t")) == [(2020, 1, 2), (2020, 2, 1)]
