"""As-of and interval joins against brute force: ties, nulls, a hot group, bounds that are open or upside down."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import asof, joins

DAY0 = dt.date(2001, 1, 1)
rng = random.Random(2)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def sides():
    """A third of the rows in group 0; null groups and days; ties on both sides."""
    group = lambda: rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, None])
    when = lambda: rng.choice([None, *range(0, 400, 7), 5000, -900])
    left = [(i, group(), day(when())) for i in range(300)]
    right = [(group(), day(when()), rng.choice([1.5, 2.5, None]), i) for i in range(200)]
    return left + left[:5], right + right[:9]


LEFT, RIGHT = sides()


def order(row):
    return tuple((x is not None, x) if x is not None else (False,) for x in row)


def brute(direction, exact, tolerance):
    out = []
    for i, g, d in LEFT:
        best = None
        for h, e, v, j in RIGHT:
            if g is None or d is None or e is None or h != g:
                continue
            gap = (d - e).days
            if (gap == 0 and not exact) or (direction == "backward" and gap < 0) or (direction == "forward" and gap > 0):
                continue
            rank = (-abs(gap), gap > 0, order((v, j)))
            if best is None or rank > best[0]:
                best = (rank, abs(gap), (e, v, j))
        hit = best[2] if best and (tolerance is None or best[1] <= tolerance) else (None, None, None)
        out.append((i, g, d, *hit))
    return sorted(out, key=order)


@pytest.mark.parametrize("slices", [1, 5, 512])
@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("exact,tolerance", [(True, None), (False, 30)])
def test_asof(spark, direction, exact, tolerance, slices):
    left = spark.createDataFrame(LEFT, "i int, g int, d date").repartition(3)
    right = spark.createDataFrame(RIGHT, "g int, d date, v double, i int").repartition(3)
    got = asof.asof_join(left, right, ["g"], "d", direction, tolerance, exact=exact, slices=slices)
    assert got.columns == ["i", "g", "d", "d_right", "v", "i_right"]
    assert sorted(map(tuple, got.collect()), key=order) == brute(direction, exact, tolerance)


def test_asof_of_times_and_nothing(spark):
    at = lambda s: dt.datetime(2020, 1, 1, 0, 0, s)
    left = spark.createDataFrame([("a", at(10)), ("a", at(30))], "k string, t timestamp")
    right = spark.createDataFrame([("a", at(9), 1), ("a", at(20), 2)], "k string, u timestamp, v int")
    got = asof.asof_join(left, right, ["k"], "t", right_on="u", tolerance=5)
    assert sorted((r.t.second, r.v) for r in got.collect()) == [(10, 1), (30, None)]
    assert [r.v for r in asof.asof_join(left, right.limit(0), ["k"], "t", right_on="u").collect()] == [None, None]
    assert asof.asof_join(left.limit(0), right, ["k"], "t", "nearest", right_on="u").count() == 0


def intervals():
    out = [("a", None, None, 0), ("a", 3, 3, 1), ("a", 31, 32, 2), ("b", 0, 2047, 3), ("b", 2048, 4095, 4), ("b", 50, 40, 5), ("c", None, 100, 6), ("c", 100, None, 7), (None, 1, 9, 8)]
    for j in range(9, 60):
        a = rng.randrange(-3000, 20000)
        out.append((rng.choice("abc"), a, a + rng.choice([0, 1, 31, 32, 127, 128, 129, 511, 2048, 9000]), j))
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_join(spark, how):
    spans = intervals()
    points = [(i, rng.choice(["a", "b", "c", "d", None]), rng.choice([None, *range(-2500, 21000, 37), 0, 31, 32, 2047, 2048])) for i in range(250)]
    p = spark.createDataFrame([(i, k, day(n), "x") for i, k, n in points], "i int, k string, d date, a string")
    v = spark.createDataFrame([(k, day(a), day(b), j) for k, a, b, j in spans], "k string, lo date, hi date, j int")
    want = []
    for i, k, n in points:
        hit = [j for q, a, b, j in spans if q is not None and q == k and n is not None and (a is None or a <= n) and (b is None or n <= b)]
        want += [(i, j) for j in hit or ([None] if how == "left" else [])]
    got = [(r.i, r.j) for r in joins.interval_join(p, v, "k", "d", "lo", "hi", how).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)


def test_sixty_years_take_few_nodes(spark):
    """And the nodes cover each day once."""
    for start in (0, 17, 1000, -5000):
        df = spark.createDataFrame([(day(start), day(start + 60 * 365))], "a date, b date")
        rows = df.select(F.explode(joins._nodes(F.unix_date("a"), F.unix_date("b"))).alias("n")).select("n.*").collect()
        assert len(rows) < 40
        width = lambda r: joins.LEAF_DAYS * joins.FAN**r.level
        spans = sorted((r.place * width(r), (r.place + 1) * width(r)) for r in rows)
        first = (day(start) - dt.date(1970, 1, 1)).days
        assert spans[0][0] <= first < spans[0][1] and spans[-1][0] <= first + 60 * 365 < spans[-1][1]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
