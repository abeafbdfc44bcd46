import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftline.operators import scale


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    keys = ["hot"] * 400 + [f"k{rng.randint(0, 40)}" for _ in range(300)]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i long")
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 60, 2)], "k string, v long"
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(sides, rows, how):
    left, right = sides
    salted = scale.skew_join(left, right, ["k"], how, ["i"], hot_rows=50)
    assert rows(salted) == rows(left.join(right, ["k"], how))


def test_skew_join_spreads_the_hot_key(sides):
    left, right = sides
    salted = scale.skew_join(left, right, ["k"], "inner", ["i"], hot_rows=50)
    assert salted.count() > 0
    salt = F.pmod(F.xxhash64("i"), F.lit(8))
    assert left.where("k = 'hot'").select(salt).distinct().count() == 8


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_with_a_long_list_of_hot_keys(sides, rows, how):
    left, right = sides
    salted = scale.skew_join(left, right, ["k"], how, ["i"], hot_rows=2, max_bytes=0)
    assert rows(salted) == rows(left.join(right, ["k"], how))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_beyond_the_size_limit(sides, rows, how):
    left, right = sides
    small = scale.lookup_join(left, right, ["k"], how, ["i"])
    large = scale.lookup_join(left, right, ["k"], how, ["i"], max_bytes=0)
    assert rows(small) == rows(large)


def test_measured_bytes_counts_text(spark):
    short = spark.createDataFrame([("a",)], "w string")
    long = spark.createDataFrame([("a" * 1000,)], "w string")
    assert scale.measured_bytes(long) - scale.measured_bytes(short) == 999
    assert scale.measured_bytes(short.limit(0)) == 0


@pytest.fixture(scope="module")
def ordered(spark):
    rng = random.Random(2)
    data = [("big", i, rng.randint(-5, 5)) for i in range(500)]
    data += [(f"g{i % 7}", i, i) for i in range(60)] + [(None, 1, 3), (None, 2, 4)]
    data += [("late", i, 1 if i > 150 and i % 3 else None) for i in range(200)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, t long, v long").repartition(5)


@pytest.mark.parametrize("group", [["g"], []])
def test_running_total_in_segments(ordered, rows, group):
    order = [F.asc("t"), F.asc("g")]
    plain = scale.running_total(ordered, group, order, F.col("v"), "s")
    cut = scale.running_total(ordered, group, order, F.col("v"), "s", rows_per_task=20)
    assert rows(cut, "g", "t", "v", "s") == rows(plain, "g", "t", "v", "s")
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    direct = ordered.withColumn("s", F.sum("v").over(w))
    assert rows(cut, "g", "t", "v", "s") == rows(direct, "g", "t", "v", "s")


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("size", [3, 20])
def test_look_back_in_blocks(ordered, rows, group, size):
    order = [F.desc("t"), F.asc("g")]
    columns = {
        "one": F.lag("t", 1),
        "three": F.lag("t", 3),
        "mean": (F.avg("v"), True),
        "rows": (F.count("v"), True),
    }
    plain = scale.look_back(ordered, group, order, 3, columns)
    cut = scale.look_back(ordered, group, order, 3, columns, rows_per_task=size)
    assert rows(cut, *plain.columns) == rows(plain)
    assert cut.count() == ordered.count()


def test_blocks_are_bounded(ordered):
    placed, keys = scale.in_blocks(ordered, ["g"], [F.asc("t")], 2, rows_per_task=20)
    assert scale.largest_group(placed, keys) <= 22


def test_bit_maps(spark):
    """Every number is found and no other, also at the edges of maps and of longs."""
    edges = [-(1 << 63), -32769, -32768, -32767, -1, 0, 1, 7, 8, 32767, 32768, 32769, (1 << 63) - 1]
    listed = spark.createDataFrame([(n,) for n in edges[::2]] + [(None,), (0,)], "n long")
    maps = scale.bit_maps(listed, "n")
    probes = sorted({max(-(1 << 63), min((1 << 63) - 1, e + d)) for e in edges for d in (-1, 0, 1)})
    asked = spark.createDataFrame([(n,) for n in probes] + [(None,)], "k long")
    found = (F.col("_map") == F.bitmap_bucket_number("k")) & scale.bit_is_set(F.bitmap_bit_position("k"))
    got = asked.join(F.broadcast(maps), found, "left_semi").collect()
    assert sorted(r["k"] for r in got) == sorted({0, *edges[::2]})
    assert scale.bit_maps(listed, "n", 4096) is None


def test_sifted(spark):
    """No listed hash is lost, few others stay, also with fewer bits than wanted."""
    listed = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    rows = spark.range(100_000).select("id", F.xxhash64("id").alias("h"))
    for max_bytes, most in ((1 << 26, 100), (1 << 14, 40_000)):
        got = scale.sifted(rows, listed, "h", max_bytes)
        assert got.where("id < 20000").count() == 20_000
        assert got.where("id >= 20000").count() < most
    assert scale.sifted(rows, listed, "h", 4096) is None
