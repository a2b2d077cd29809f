import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelwright.functions import nulls


@pytest.mark.parametrize(
    "a, b, total, diff",
    [(1.0, 2.0, 3.0, -1.0), (None, 2.0, 2.0, -2.0), (1.0, None, 1.0, 1.0), (None, None, None, None), (0.0, None, 0.0, 0.0), (-3.0, -4.0, -7.0, 1.0)],
)
def test_null_sums(spark, a, b, total, diff):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    r = df.select(nulls.sum_sas("a", "b").alias("s"), nulls.sub_sas("a", "b").alias("d")).first()
    assert (r.s, r.d) == (total, diff)


@pytest.mark.parametrize(
    "mode, num, den, want",
    [
        (1, 6.0, 3.0, 2.0), (1, 6.0, 0.0, None), (1, 6.0, -3.0, -2.0), (1, None, 3.0, None), (2, 6.0, -3.0, 2.0), (2, 6.0, 0.0, None),
        (3, 6.0, -3.0, None), (3, 6.0, 3.0, 2.0), (5, 6.0, 3.0, 4.0), (8, -6.0, 3.0, None), (8, 6.0, 3.0, 2.0), (8, 6.0, -3.0, None),
    ],
)
def test_safe_div_row_modes(spark, mode, num, den, want):
    df = spark.createDataFrame([(num, den, 2.0)], "num double, den double, fx double")
    assert df.select(nulls.safe_div("num", "den", mode).alias("x")).first().x == want


@pytest.mark.parametrize("mode, back, least", [(4, 12, 12), (6, 12, 0), (7, 12, 0), (9, 3, 3)])
def test_safe_div_lagged_modes_stay_inside_the_firm(spark, mode, back, least):
    rows = [(g, i, float(i * (1 if g == "a" else 10)), float(i + 1 if i != 2 else 0)) for g in "ab" for i in range(1, 27)]
    df = spark.createDataFrame(rows, "g string, count int, num double, den double")
    w = Window.partitionBy("g").orderBy("count")
    got = {(r.g, r["count"]): r.x for r in df.select("g", "count", nulls.safe_div("num", "den", mode, over=w).alias("x")).collect()}
    src = {(g, i): (n, d) for g, i, n, d in rows}
    for (g, i), x in got.items():
        old = src.get((g, i - back))
        if old is None or i <= least or old[1] == 0:
            assert x is None
        else:
            assert x == pytest.approx(old[0] / old[1] if mode == 7 else src[g, i][0] / old[1])


def test_lagged_mode_needs_a_window():
    with pytest.raises(ValueError):
        nulls.safe_div("a", "b", 4)


def test_finite_and_snap(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (1e-6,), (-5.0,), (None,)], "x double")
    assert [r.x for r in df.select(nulls.finite("x").alias("x")).collect()] == [None, None, None, 1e-6, -5.0, None]
    assert [r.x for r in df.filter("abs(x) < 10").select(nulls.snap_small("x").alias("x")).collect()] == [0.0, 0.0]
    assert [r.x for r in df.filter("abs(x) < 10").select(nulls.snap_small("x", signed=True).alias("x")).collect()] == [0.0, -5.0]


def test_mean_across_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (None, None, None)], "a double, b double, c double")
    assert [r.m for r in df.select(nulls.mean_across(["a", "b", "c"]).alias("m")).collect()] == [3.0, None]
