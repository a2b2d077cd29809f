"""Exact selection against sorted lists; portfolios cut by selected points against their definition."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import crosssection as cs
from panelwright.operators import portfolios as po
from panelwright.operators import selection as se

rng = random.Random(4)
ODD = [0.0, -0.0, 1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf, math.nan]


def test_image_keeps_the_order(spark):
    vs = ODD + [2.0**e for e in range(-1074, 1024, 7)] + [math.nextafter(2.0**e, 0) for e in range(-1000, 1024, 9)] + [rng.gauss(0, 1e-3) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vs], "v double")
    rows = df.select("v", se.image(F.col("v")).alias("i"), se.value_of(se.image(F.col("v"))).alias("w")).collect()
    assert all(r.v == r.w or (math.isnan(r.v) and math.isnan(r.w)) for r in rows)
    rows.sort(key=lambda r: (math.isnan(r.v), r.v if not math.isnan(r.v) else 0))
    assert all((a.i < b.i) == (a.v != b.v or math.isnan(a.v) != math.isnan(b.v)) and a.i <= b.i for a, b in zip(rows, rows[1:]) if not math.isnan(a.v))
    assert df.select(se.image(F.lit(None).cast("double"))).first()[0] is None


def panel():
    out = [(g, rng.choice([None, round(rng.gauss(0, 2), rng.choice([0, 1, 9])), 7.25, -7.25]), rng.choice([None, rng.random() * 1e-9 + 3])) for g in "aaaabc" * 80]
    return out + [("only null", None, None), (None, 1.0, 1.0), ("one", 5.0, None)]


@pytest.mark.parametrize("fits", [1 << 17, 20, 1])
def test_order_statistics(spark, fits):
    rows = panel()
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(3)
    found = se.order_statistics(df, ["g"], ["x", "y"], lambda n: [F.lit(1), F.ceil(n / 3), n, n + 1], fits)
    got = {(r.g, r.var): (r.n, r["values"]) for r in found.collect()}
    want = {}
    for g in {r[0] for r in rows} - {None}:
        for i in (0, 1):
            vs = sorted(r[i + 1] for r in rows if r[0] == g and r[i + 1] is not None)
            if vs:
                want[g, i] = (len(vs), [vs[0], vs[math.ceil(len(vs) / 3) - 1], vs[-1], None])
    assert got == want


def test_no_window_and_no_rows_in_the_shuffle(spark):
    df = spark.createDataFrame(panel(), "g string, x double, y double")
    for out in (cs.quantile_disc(df, ["g"], "x", {"p": 0.3}), cs.group_median(df, ["g"], "y")):
        assert "Window" not in out._jdf.queryExecution().toString()
    assert cs.group_median(df.limit(0), ["g"], "x").count() == 0


def stocks(n):
    """The lowest value is over a third of one characteristic; ties, gaps, and values below all reference stocks."""
    out = []
    for i in range(n):
        month, ctry = f"2020-0{1 + i % 2}-28", rng.choice(["A", "A", "B", None])
        size = rng.choice(["mega", "large", "small", "micro", "nano"])
        tied = 1.0 if rng.random() < 0.5 else rng.choice([2.0, 3.0, 4.0])
        if size in ("micro", "nano") and i % 3 == 0 and ctry == "B":
            tied = 0.5
        out.append((ctry, month, i, size, rng.gauss(0, 1), rng.random() + 1, rng.random() + 0.5, None, None, tied, rng.choice([None, rng.gauss(0, 1)]), float(i % 4 == 0), 9.0))
    return out


CHARS = ["tied", "gappy", "two", "one"]


def brute(rows, k, min_n):
    out = {}
    for month in {r[1] for r in rows}:
        for ctry in {r[0] for r in rows} - {None}:
            for c, name in enumerate(CHARS):
                group = [(r[9 + c], r) for r in rows if r[0] == ctry and r[1] == month and r[9 + c] is not None]
                ref = [v for v, r in group if r[3] in ("mega", "large", "small")]
                if len(ref) < min_n:
                    continue
                cdf = {v: sum(x <= v for x in ref) / len(ref) for v, _ in group}
                low = min(cdf.values())
                for v, r in group:
                    share = 1e-8 if cdf[v] == low else cdf[v]
                    out[ctry, name, r[2]] = min(max(math.ceil(share * k), 1), k)
    return out


@pytest.mark.parametrize("k,min_n,rows_each", [(3, 10, 1 << 16), (5, 1, 7)])
def test_portfolios(spark, monkeypatch, k, min_n, rows_each):
    monkeypatch.setattr(se, "ROWS", rows_each)  # many buckets for each group
    rows = stocks(400)
    df = spark.createDataFrame(rows, "excntry string, eom string, id long, size_grp string, ret_exc_lead1m double, me double, me_cap double, crsp_exchcd int, comp_exchg int, " + ", ".join(f"{c} double" for c in CHARS))
    df = df.withColumn("eom", F.last_day(F.to_date("eom")))
    want = brute(rows, k, min_n)
    got = {(r.excntry, r.characteristic, r.id): r.pf for r in po.assign(df, CHARS, k, min_n=min_n).collect()}
    assert got == want
    sums = {}
    by_id = {r[2]: r for r in rows}
    for (ctry, name, i), pf in want.items():
        sums.setdefault((ctry, name, by_id[i][1], pf), []).append(by_id[i])
    pfs = po.char_portfolios(df, CHARS, k, min_n=min_n).collect()
    assert len(pfs) == len(sums)
    import statistics

    for r in pfs:
        month = "2020-01-28" if r.eom.month == 2 else "2020-02-28"
        members = sums[r.excntry, r.characteristic, month, r.pf]
        assert r.n == len(members)
        assert r.signal == pytest.approx(statistics.median(m[9 + CHARS.index(r.characteristic)] for m in members))
        assert r.ret_ew == pytest.approx(sum(m[4] for m in members) / len(members))
        assert r.ret_vw == pytest.approx(sum(m[4] * m[5] for m in members) / sum(m[5] for m in members))


def test_groups_of_one_bucket_are_placed_in_one_pass(spark, monkeypatch):
    """No counts by cell, no refinement, where every group fits a bucket; odd values as the refinement places them."""
    rng = random.Random(11)
    odd = [None, float("nan"), float("inf"), -float("inf"), -0.0, 0.0, 5e-324, 1.5, -1.5]
    rows = [(*r[:4], rng.choice([None, r[4]]), *r[5:9], rng.choice(odd), rng.choice([None, rng.random()]), None, r[12]) for r in stocks(300)]
    df = spark.createDataFrame(rows, "excntry string, eom string, id long, size_grp string, ret_exc_lead1m double, me double, me_cap double, crsp_exchcd int, comp_exchg int, " + ", ".join(f"{c} double" for c in CHARS))
    df = df.withColumn("eom", F.last_day(F.to_date("eom")))
    cut = lambda r: tuple(round(v, 9) if isinstance(v, float) else v for v in r)
    rows_of = lambda: sorted(map(repr, map(cut, po.char_portfolios(df, CHARS).select("excntry", "characteristic", "pf", "eom", "n", "signal", "ret_ew", "ret_vw", "ret_vw_cap").collect())))
    monkeypatch.setattr(se, "ROWS", 7)
    dealt = rows_of()
    monkeypatch.undo()
    monkeypatch.setattr(po, "first_counts", lambda w: pytest.fail("counted by cell"))
    assert dealt and rows_of() == dealt


def test_images_by_bits_equal_images_by_arithmetic(spark):
    values = [None, float("nan"), float("inf"), -float("inf"), -0.0, 0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 0.1, -3.0, 1e300]
    df = spark.createDataFrame([(v, [v, 1.0]) for v in values], "v double, x array<double>").repartition(2)
    for r in se.images(df.select(se.image(F.col("v")).alias("want"), "x"), "x", 2).collect():
        assert r.x == [r.want, 1023 << 52]


def test_char_portfolios_moves_no_wide_rows(spark, monkeypatch):
    """Groups of several buckets' rows are placed where they lie: nothing wide is written, and rows that come by country
    and month are neither shuffled nor sorted again."""
    df = spark.createDataFrame(stocks(400), "excntry string, eom string, id long, size_grp string, ret_exc_lead1m double, me double, me_cap double, crsp_exchcd int, comp_exchg int, " + ", ".join(f"{c} double" for c in CHARS))
    df = df.withColumn("eom", F.last_day(F.to_date("eom")))
    cut = lambda out: sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in out.collect())
    want = cut(po.char_portfolios(df, CHARS))
    biggest = df.groupBy(*po.GROUP).count().agg(F.max("count")).first()[0]
    monkeypatch.setattr(se, "ROWS", biggest // 2)
    monkeypatch.setattr(po, "wide", lambda *a, **k: pytest.fail("wide rows written"))
    dealt = df.repartition(*po.GROUP).sortWithinPartitions(*po.GROUP).selectExpr("*", "tied * 2 AS more")
    out = po.char_portfolios(dealt, CHARS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort ") == 1
    assert cut(out) == want
