import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.operators import spectrum


@pytest.mark.parametrize("rows_per_task", [None, 50])
def test_equals_numpy(spark, rows_per_task):
    """Lengths of small factors, primes above them, products of both, and 1."""
    rng = np.random.default_rng(3)
    lengths = [1, 2, 5, 12, 64, 80, 97, 210, 37 * 4, 128]
    values = {f"s{n}": rng.integers(-50, 50, n) for n in lengths}
    rows = [(s, i, int(v)) for s, x in values.items() for i, v in enumerate(x)] + [("s5", 9, None)]
    df = spark.createDataFrame(rows, "s string, step long, v long")
    got = {}
    for r in spectrum.fourier(df, ["s"], [F.asc("step")], "v", rows_per_task).collect():
        got[r["s"], r["k"]] = r
    want = {(s, k): a for s, x in values.items() for k, a in enumerate(np.abs(np.fft.rfft(x)))}
    assert got.keys() == want.keys()
    for key, magnitude in want.items():
        assert abs(got[key]["magnitude"] - magnitude) < 1e-8
        assert got[key]["frequency"] == key[1] / got[key]["n"]


def test_one_series_and_none(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "step long, v long")
    got = spectrum.fourier(df, [], [F.asc("step")], "v").orderBy("k").collect()
    assert np.allclose([r["magnitude"] for r in got], np.abs(np.fft.rfft([i % 3 for i in range(9)])))
    assert spectrum.fourier(df.limit(0), [], [F.asc("step")], "v").count() == 0


def test_terms_grow_with_the_factors_not_with_the_square(spark):
    n = F.explode(F.array(*[F.lit(x) for x in (80, 2 ** 20, 31 ** 3, 97, 6000)]))
    got = spark.range(1).select(n.alias("n")).select("n", spectrum._radices(F.col("n")).alias("r"))
    for r in got.collect():
        assert np.prod(r["r"]["done"]) * r["r"]["rest"] == r["n"]
        assert max(r["r"]["done"]) <= spectrum.LARGEST
        assert r["r"]["rest"] == (97 if r["n"] == 97 else 1)
