"""Industry ranges: overlaps by priority, gaps, the published file, every four-digit code."""

import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import industry

SCHEMA = "grp int, priority int, lo int, hi int"


def answer(ranges, code):
    hits = [(p is None, p or 0, g) for g, p, lo, hi in ranges if g is not None and lo is not None and hi is not None and lo <= code <= hi]
    return min(hits)[2] if hits else None


def cases():
    rng = random.Random(4)
    some = []
    for p in range(60):
        lo = rng.randrange(-50, 10050)
        some.append((rng.randrange(1, 12), p // 2, lo, lo + rng.choice([0, 1, 90, 800])))
    return {
        "overlapping": some + [(3, 1, 500, 400), (None, 0, 0, 9999), (4, 2, None, 100), (5, None, 0, 300)],
        "touching": [(1, 1, 100, 199), (1, 2, 200, 299), (2, 3, 300, 300)],
        "all codes": [(7, 1, 0, 9999)],
        "none": [],
    }


@pytest.mark.parametrize("name", list(cases()))
def test_every_code(spark, name):
    ranges = cases()[name]
    table = spark.createDataFrame(ranges, SCHEMA)
    want = {c: answer(ranges, c) for c in range(10000)}
    codes = spark.range(10000).select(F.col("id").cast("int").alias("sic"), F.lit("x").alias("ff"))
    out = industry.classify_by_table(codes, "sic", table, "ff").collect()
    assert len(out) == 10000 and {r.sic: r.ff for r in out} == want
    flat = sorted((r.lo, r.hi, r.grp) for r in industry.disjoint_ranges(table).collect())
    for (_, hi, g), (lo, _, h) in zip(flat, flat[1:]):
        assert lo > hi and (lo > hi + 1 or g != h)
    empty = {c for r in industry.gaps(table).collect() for c in range(r.lo, r.hi + 1)}
    assert empty == {c for c in want if want[c] is None}


def test_odd_codes_and_no_shuffle_of_rows(spark):
    table = spark.createDataFrame([(1, 1, 0, 9999)], SCHEMA)
    rows = spark.createDataFrame([(None, 1), (-5, 2), (10000, 3), (42, 4), (42, 4)], "sic long, lo__ int")
    out = industry.classify_by_table(rows, "sic", table, "ff")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("BroadcastHashJoin")[0]
    assert sorted((r.sic or 0, r.lo__, r.ff) for r in out.collect()) == [(-5, 2, None), (0, 1, None), (42, 4, 1), (42, 4, 1), (10000, 3, None)]


def test_published_file(spark, tmp_path):
    path = tmp_path / "classes.txt"
    path.write_text("note 0000-0001\n 1 Agric  Agriculture\r\n          0100-0199 Crops\r\n          0910-0919\r\n\r\n 2 Food\n          2000-2009 Food, 1234-1235 in words\n10 Aaa\n          0150-0160\n")
    got = [tuple(r) for r in industry.read_class_file(spark, str(path)).orderBy("priority").select("grp", "lo", "hi").collect()]
    assert got == [(1, 100, 199), (1, 910, 919), (2, 2000, 2009), (10, 150, 160)]
    by = industry.classify_by_table(spark.createDataFrame([(155,), (2005,)], "sic int"), "sic", industry.read_class_file(spark, str(path)), "ff")
    assert {r.sic: r.ff for r in by.collect()} == {155: 1, 2005: 2}
