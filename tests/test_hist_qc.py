import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from slideloom.operators import hist as H, qc as Q


def values(spark, v, key="a"):
    return spark.createDataFrame([(key, x) for x in v], "k string, v int")


def test_stats_of_a_small_histogram(spark):
    row = H.channel_stats(H.histogram(values(spark, [0, 0, 1, 5, 5, 5, 9, 255, None]), ["k"]), ["k"], bins=256).collect()[0]
    assert (row.p1, row.p50, row.p99, row.p99_9, row["max"], row.pct_zero, row.pct_saturated) == (0, 5, 255, 255, 255, 25.0, 12.5)


def test_percentile_zero_and_empty(spark):
    h = H.histogram(values(spark, [7, 9]), ["k"])
    assert H.percentiles(h, ["k"], (0, 50, 100)).collect()[0][1:] == (0, 7, 9)
    assert H.percentiles(h.limit(0), ["k"], (50,)).count() == 0


def test_percentiles_are_discrete_from_the_left(spark):
    rng = np.random.default_rng(0)
    v = rng.integers(0, 40, 200)
    h = H.histogram(values(spark, v.tolist()), ["k"])
    row = H.percentiles(h, ["k"], (1, 25, 50, 90, 99.9)).collect()[0]
    s = np.sort(v)
    assert list(row[1:]) == [s[max(0, math.ceil(q / 100 * len(v) - 1e-9) - 1)] for q in (1, 25, 50, 90, 99.9)]


def test_merged_parts_and_display_range(spark):
    a, b = values(spark, [1, 2, 2]), values(spark, [2, 3])
    both = H.merged(H.histogram(a, ["k"]), H.histogram(b, ["k"]))
    assert sorted(both.select("v", "n").collect()) == sorted(H.histogram(a.union(b), ["k"]).select("v", "n").collect())
    assert H.display_range(H.histogram(values(spark, [10] * 9), ["k"]), ["k"]).collect()[0][1:] == (10, 11)


def test_dtype_guard(spark):
    df = spark.createDataFrame([("uint8",), ("uint16",)], "d string")
    assert [r[0] for r in df.select(H.bins_of(F.col("d"))).collect()] == [256, 65536]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("float32",)], "d string").select(H.bins_of(F.col("d"))).collect()


def test_pooled_range_takes_the_first_depth(spark):
    rows = [("b", "m", 65536, 9, 5), ("a", "m", 256, 3, 5), ("c", "m", 256, 4, 1), ("a", " ", 256, 3, 5)]
    out = H.pooled_display_range(spark.createDataFrame(rows, "sample string, marker string, bins int, v int, n bigint")).collect()
    assert out == [("m", 3, 4)]


def test_otsu_splits_two_groups(spark):
    v = [10, 11, 12] * 20 + [100, 101, 102] * 20 + [0] * 500
    assert H.otsu(H.histogram(values(spark, v), ["k"]), ["k"]).collect() == [("a", 12)]


def test_robust_z(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4, 100)] + [("b", 5.0), ("b", 5.0), ("b", 9.0), ("b", None), ("a", float("nan"))], "k string, v double")
    z = {(r.k, r.v): r.z for r in Q.robust_z(df, ["k"], "v").collect()}
    assert [z["a", x] for x in (1.0, 2.0, 3.0, 4.0)] == [-1.348982, -0.674491, 0.0, 0.674491] and abs(z["a", 100.0] - 65.425604) < 1e-5
    assert (z["b", 5.0], z["b", 9.0], z["b", None]) == (0.0, 0.0, None)


def flags(spark, **given):
    base = {"t50": 100.0, "t99": 900.0, "t99_9": 1000.0, "b50": 10.0, "b99": 20.0, "zero": 0.0, "saturated": 0.0, "seam": None} | given
    schema = ", ".join(f"{k} double" for k in base)
    return spark.createDataFrame([tuple(base.values())], schema).select(Q.channel_flags()).collect()[0][0]


def test_channel_rules(spark):
    assert flags(spark) == ""
    assert flags(spark, t99_9=30.0, zero=99.0, b50=10.0, b99=20.0) == "no usable signal"
    assert flags(spark, zero=51.0, b50=0.0, b99=0.0) == "many zeros in tissue"
    assert flags(spark, b50=95.0, b99=100.0) == "bright off-tissue background"
    assert flags(spark, t99=19.0, t50=3.0, b50=10.0, b99=11.0) == "bright off-tissue background; weak (p99 < 2x background)"
    assert flags(spark, seam=201.0) == "uneven background (possible seams)" and flags(spark, seam=200.0) == ""
    assert flags(spark, saturated=0.2) == "saturated >0.1%"
    assert flags(spark, b50=None, b99=None, zero=99.0) == ""
    assert flags(spark, t50=None, t99=None, t99_9=None, seam=2.5) == "uneven background (possible seams)"


def test_focus_of_sharp_and_flat_tiles(spark):
    rows = [("i", 0, y, x, 200 if (x + y) % 2 else 0) for y in range(8) for x in range(8)] + [("i", 0, y, x, 50) for y in range(8) for x in range(8, 16)]
    out = {r.tx: r.focus for r in Q.tile_focus(spark.createDataFrame(rows, "img string, c int, y bigint, x bigint, v bigint"), 8, ["img", "c"]).collect()}
    assert out[0] > -6 and out[1] == -12.0


def test_display_helpers(spark):
    df = spark.createDataFrame([(5.0, 0.0, 10.0), (50.0, 0.0, 10.0), (5.0, 3.0, 3.0)], "v double, a double, b double")
    assert [r[0] for r in df.select(H.normalised(F.col("v"), F.col("a"), F.col("b"), gamma=2.0)).collect()] == [0.25, 1.0, None]
