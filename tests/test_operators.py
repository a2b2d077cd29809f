import random

import duckdb
import pytest
from pyspark.sql import functions as F

from panelwright.operators import crosssection as cs
from panelwright.operators import expand, joins, portfolios, rows, security


@pytest.fixture(scope="module")
def lopsided(spark):
    """One group holds most rows and one value a third of them."""
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        g = "hot" if i % 4 else f"g{i % 20}"
        x = 0.0 if i % 3 == 0 else rnd.choice([rnd.gauss(0, 1e-4), rnd.gauss(0, 1), rnd.gauss(0, 1e6), -7.0])
        data.append((i, g, None if i % 50 == 0 else x))
    return data, spark.createDataFrame(data, "id long, g string, x double")


def test_ranks_match_brute_force_on_a_hot_group(lopsided):
    data, df = lopsided
    t = cs.rank_table(df, ["g"], "x").withColumns({"up": cs.average_rank(), "down": cs.average_rank(True), "low": cs.min_rank()})
    got = {r.id: (r.up, r.down, r.low) for r in cs.attach_ranks(df, t, ["g"], "x", ["up", "down", "low"]).collect()}
    groups = {}
    for i, g, x in data:
        if x is not None:
            groups.setdefault(g, []).append(x)
    for i, g, x in data:
        if x is None:
            assert got[i] == (None, None, None)
            continue
        below = sum(y < x for y in groups[g])
        ties = sum(y == x for y in groups[g])
        up = below + (ties + 1) / 2
        assert got[i] == (up, len(groups[g]) + 1 - up, below + 1)


def test_quantiles_and_median_match_brute_force(lopsided):
    data, df = lopsided
    q = {r.g: r for r in cs.quantile_disc(df, ["g"], "x", {"a": 0.01, "b": 0.5, "c": 0.999}).collect()}
    med = {r.g: r["median"] for r in cs.group_median(df, ["g"], "x").collect()}
    groups = {}
    for _, g, x in data:
        if x is not None:
            groups.setdefault(g, []).append(x)
    for g, xs in groups.items():
        xs.sort()
        for name, p in (("a", 0.01), ("b", 0.5), ("c", 0.999)):
            assert q[g][name] == xs[max(1, -int(-(p * len(xs) - 1e-9) // 1)) - 1]
        n = len(xs)
        assert med[g] == (xs[(n - 1) // 2] + xs[n // 2]) / 2


def test_slots_keep_order(spark):
    xs = [-1e300, -5.0, -1e-9, 0.0, 1e-12, 3e-7, 0.5, 0.5000001, 1e5, 1e308]
    got = [r.s for r in spark.createDataFrame([(x,) for x in xs], "x double").select(cs.slot_of(F.col("x")).alias("s")).collect()]
    assert got == sorted(got) and max(got) - min(got) < 24000


def test_expand_backward_interval_and_unique_keys(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2020-01-30', DATE'2020-03-01', 'a'), (1, DATE'2020-02-28', DATE'2020-03-02', 'b'), (2, DATE'2020-05-02', DATE'2020-05-01', 'c') t(k, s, e, code)")
    out = expand.expand_interval(df, ["k"], "s", "e").collect()
    assert len({(r.k, r.date) for r in out}) == len(out) and {r.k for r in out} == {1}
    assert {str(r.date): r.code for r in out}["2020-02-28"] == "b"
    months = expand.expand_interval(df, ["k"], "s", "e", "month").collect()
    assert sorted(str(r.date) for r in months) == ["2020-01-31", "2020-02-29"]


def test_interval_join_open_bounds(spark):
    p = spark.sql("SELECT * FROM VALUES (1, DATE'2020-01-05'), (1, DATE'2021-07-01'), (2, DATE'2020-01-05') t(k, d)")
    i = spark.sql("SELECT * FROM VALUES (1, CAST(NULL AS DATE), DATE'2020-01-05', 'x'), (1, DATE'2020-01-06', CAST(NULL AS DATE), 'y') t(k, a, b, c)")
    got = {(r.k, str(r.d)): r.c for r in joins.interval_join(p, i, "k", "d", "a", "b").collect()}
    assert got == {(1, "2020-01-05"): "x", (1, "2021-07-01"): "y", (2, "2020-01-05"): None}


def test_prefer_source_and_keep_first(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (3, 0, "d"), (3, 0, "e"), (3, 1, "f")], "k int, s int, v string")
    assert sorted(r.v for r in rows.prefer_source(df, ["k"], "s", 1).collect()) == ["b", "c"]
    assert sorted(r.v for r in rows.keep_first(df, ["k"], ["s"]).collect()) == ["a", "c", "d"]


@pytest.fixture(scope="module")
def stocks(spark):
    rnd = random.Random(3)
    data = [
        (i, "AAA" if i % 3 else "BBB", rnd.choice(["mega", "large", "small", "micro"]), rnd.gauss(0, 0.1), rnd.uniform(1, 100), rnd.choice([rnd.gauss(0, 1), 0.0]))
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "id long, excntry string, size_grp string, ret_exc_lead1m double, me double, c double")
    return df.withColumns({"eom": F.lit("2020-01-31").cast("date"), "me_cap": F.least("me", F.lit(50.0)), "crsp_exchcd": F.lit(1), "comp_exchg": F.lit(None).cast("int")})


def test_portfolio_invariants(stocks):
    pfs = portfolios.char_portfolios(stocks, ["c"]).collect()
    assert sum(r.n for r in pfs) == 400 and {r.pf for r in pfs} <= {1, 2, 3} and {str(r.eom) for r in pfs} == {"2020-02-29"}
    placed = portfolios.assign(stocks, ["c"])
    assert placed.count() == 400 and placed.filter("pf IS NULL").count() == 0
    w = portfolios.with_weights(placed).groupBy("excntry", "pf").agg(F.sum("w_ew").alias("a"), F.sum("w_vw").alias("b"), F.sum("w_vw_cap").alias("c"))
    for r in w.collect():
        assert (r.a, r.b, r.c) == pytest.approx((1, 1, 1))


def test_hml_is_top_minus_bottom(stocks):
    pfs = portfolios.char_portfolios(stocks, ["c"])
    by = {(r.excntry, r.pf): r for r in pfs.collect()}
    for r in portfolios.high_minus_low(pfs, "eom").collect():
        assert r.ret_vw == pytest.approx(by[r.excntry, 3].ret_vw - by[r.excntry, 1].ret_vw)
        assert r.n_stocks == by[r.excntry, 3].n + by[r.excntry, 1].n


def test_a_narrow_variable_is_spread_over_parts(spark):
    df = spark.range(5000).select((F.lit(1000.0) + F.col("id") / 500).alias("x"))
    most = df.groupBy(cs.slot_of(F.col("x")), cs.part_of(F.col("x"))).count().agg(F.max("count")).first()[0]
    assert most < 0.01 * 5000
    t = cs.rank_table(df.withColumn("g", F.lit(1)), ["g"], "x").orderBy("x").collect()
    assert [r.n_below for r in t] == list(range(5000)) and {r.n_all for r in t} == {5000}


def test_relaxed_union_refuses_differing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(1, 2.5)], "x int, z double")
    with pytest.raises(ValueError, match="'y', 'z'"):
        rows.union_relaxed(a, b)
    with pytest.raises(ValueError, match="cshtrm"):
        security.comp_monthly(spark.createDataFrame([("1", "1", 1, 1)], "gvkey string, iid string, eom int, source int"), spark.createDataFrame([("1", "1", 1, 0, 2)], "gvkey string, iid string, eom int, source int, cshtrm int"))


def test_main_row_flag_counts_securities_without_a_number(spark):
    data = [("1", None, 1, 1), ("1", None, 1, 0), ("1", "01", 1, 0), (None, None, 1, 0), (None, None, 1, 0)]
    out = security.obs_main_flag(spark.createDataFrame(data, "gvkey string, iid string, eom int, source_crsp int"))
    assert sorted((r.gvkey or "", r.iid or "", r.source_crsp, r.obs_main) for r in out.collect()) == [("", "", 0, 1), ("", "", 0, 1), ("1", "", 0, 0), ("1", "", 1, 1), ("1", "01", 0, 1)]


def test_daily_returns_are_clamped_for_high_ids_only(spark):
    days = spark.sql("SELECT id, date'2020-03-05' AS date, 2.0D AS ret_exc FROM VALUES (99999), (100000) AS t(id)")
    cuts = spark.createDataFrame([(2020, 3, -1.0, 1.0)], "year int, month int, ret_exc_0_1 double, ret_exc_99_9 double")
    assert {r.id: r.ret_exc for r in portfolios.winsorize_daily(days, cuts).collect()} == {99999: 2.0, 100000: 1.0}
