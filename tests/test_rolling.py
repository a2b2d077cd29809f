import datetime
import math
import statistics as st

import pytest
from pyspark.sql import functions as F

from panelwright.operators import ols, rolling


def days(spark, rows, cols):
    """rows: (id, group, values...); a group is a month, days follow the row order."""
    data = [(r[0], 24000 + r[1], i, *r[2:]) for i, r in enumerate(rows)]
    schema = "id long, m int, k int, " + ", ".join(f"{c} double" for c in cols)
    df = spark.createDataFrame(data, schema)
    need = ["ret_exc", "ret", "mktrf", "tvol", "shares", "dolvol_d", "prc_adj", "smb_ff", "hml"]
    return df.withColumns({c: F.lit(None).cast("double") for c in need if c not in cols}).withColumns(
        {"date": F.date_add(F.lit("2000-01-01").cast("date"), F.col("k")), "zero__": F.lit(0)}
    )


def roll(df, name, least=1, **kw):
    out = rolling.roll(df, [(name, "_21d", least)], **kw)
    return {(r.id, r.eom.year * 12 + r.eom.month - 24000): r for r in out.collect()}


def test_rvol(spark):
    rows = [(1, g, v) for g, vs in enumerate([[1, 2, 3], [2, 4, 4], [3, 3, 3], [-1, 0, 1], [5]], 1) for v in map(float, vs)]
    r = roll(days(spark, rows, ["ret_exc"]), "rvol")
    assert [r[1, g].rvol_21d for g in (1, 2, 3, 4)] == pytest.approx([1, math.sqrt(4 / 3), 0, 1])
    assert r[1, 5].rvol_21d is None
    assert set(roll(days(spark, rows, ["ret_exc"]), "rvol", 2)) == {(1, 1), (1, 2), (1, 3), (1, 4)}


def test_rmax_uses_what_exists(spark):
    rows = [(1, 1, 0.0, v) for v in (1.0, 2.0, 3.0, 4.0, 5.0, 6.0)] + [(1, 2, 0.0, 2.0), (1, 2, 0.0, None), (1, 2, 0.0, 4.0)]
    r = roll(days(spark, rows, ["ret_exc", "ret"]), "rmax")
    assert (r[1, 1].rmax5_21d, r[1, 1].rmax1_21d) == (4.0, 6.0)
    assert (r[1, 2].rmax5_21d, r[1, 2].rmax1_21d) == (3.0, 4.0)


def test_skew(spark):
    rows = [(1, 1, v) for v in (-1.0, 0.0, 1.0)] + [(1, 2, 2.0)] * 4 + [(1, 3, v) for v in (1.0, 2.0, 5.0)]
    r = roll(days(spark, rows, ["ret_exc"]), "skew")
    assert r[1, 1].rskew_21d == pytest.approx(0) and r[1, 2].rskew_21d is None
    assert r[1, 3].rskew_21d == pytest.approx(1.293, abs=1e-3)


def test_capm_exact_line_and_constant_market(spark):
    rows = [(1, 1, 1 + 2 * m, m) for m in (0.0, 1.0, 2.0, 4.0)] + [(1, 2, v, 1.0) for v in (1.0, 2.0, 4.0)]
    r = roll(days(spark, rows, ["ret_exc", "mktrf"]), "capm")
    assert r[1, 1].beta_21d == pytest.approx(2) and r[1, 1].ivol_capm_21d == pytest.approx(0, abs=1e-7)
    assert r[1, 2].beta_21d is None


def test_downbeta_only_falling_days(spark):
    rows = [(1, 1, 3 * m, m) for m in (-1.0, -2.0, -4.0)] + [(1, 1, 9.0, 1.0)]
    assert roll(days(spark, rows, ["ret_exc", "mktrf"]), "downbeta", 4)[1, 1].betadown_21d == pytest.approx(3)


def test_three_factor_exact_model(spark):
    pts = [(0.1, 0.4, 0.2), (0.3, -0.2, 0.5), (-0.4, 0.1, 0.3), (0.2, 0.2, -0.6), (0.5, -0.3, -0.1), (-0.2, 0.6, 0.4)]
    rows = [(1, 1, 1 + 2 * m + 3 * s + 4 * h, m, s, h) for m, s, h in pts] + [(1, 1, 1.0, 0.1, None, 0.2)]
    r = roll(days(spark, rows, ["ret_exc", "mktrf", "smb_ff", "hml"]), "ff3")
    assert r[1, 1].ivol_ff3_21d == pytest.approx(0, abs=1e-6)


def test_zero_trades(spark):
    rows = [(1, 1, t, 1.0) for t in (0.0, 0.0, 3.0)] + [(2, 1, t, 1.0) for t in (1.0, 1.0, 4.0)]
    r = roll(days(spark, rows, ["tvol", "shares"]), "zero_trades")
    assert r[1, 1].zero_trades_21d == pytest.approx(14.01)
    assert r[2, 1].zero_trades_21d == pytest.approx(0.005)


def test_ami_skips_zero_volume(spark):
    rows = [(1, 1, 0.1, r, d) for r, d in ((0.5, 2.0), (-0.5, 4.0), (0.3, 0.0))]
    assert roll(days(spark, rows, ["ret_exc", "ret", "dolvol_d"]), "ami")[1, 1].ami_21d == pytest.approx((0.25 + 0.125) / 2 * 1e6)


def test_turnover_and_dolvol(spark):
    rows = [(1, 1, 2e6, 1.0, 10.0), (1, 1, 4e6, 1.0, 30.0), (1, 1, 1.0, 0.0, None)]
    df = days(spark, rows, ["tvol", "shares", "dolvol_d"])
    t = roll(df, "turnover", 3)[1, 1]
    assert (t.turnover_21d, t.turnover_var_21d) == pytest.approx((3, st.stdev([2, 4]) / 3))
    d = roll(df, "dolvol", 2)[1, 1]
    assert (d.dolvol_21d, d.dolvol_var_21d) == pytest.approx((20, st.stdev([10, 30]) / 20))


def test_window_covers_months_without_rows(spark):
    rows = [(1, 1, 1.0), (1, 1, 3.0), (1, 4, 5.0)]
    out = rolling.roll(days(spark, rows, ["ret_exc"]), [("rvol", 3, 2)])
    got = {r.eom.year * 12 + r.eom.month - 24000: r.rvol_3m for r in out.collect()}
    assert got == pytest.approx({1: math.sqrt(2), 2: math.sqrt(2), 3: math.sqrt(2)})


def test_no_window_ends_after_the_end_month(spark):
    rows = [(1, 1, 1.0), (1, 1, 3.0), (1, 3, 5.0), (1, 3, 6.0)]
    out = rolling.roll(days(spark, rows, ["ret_exc"]), [("rvol", 3, 2)], end=datetime.date(2000, 2, 29))
    assert {r.eom.year * 12 + r.eom.month - 24000: r.rvol_3m for r in out.collect()} == pytest.approx({1: math.sqrt(2), 2: math.sqrt(2)})


def test_empty_input_gives_no_rows(spark):
    df = days(spark, [(1, 1, 1.0)], ["ret_exc"]).filter("id < 0")
    for name in ("rvol", "skew", "rmax", "capm", "ff3"):
        assert roll(df, name) == {}


def test_grouped_ols_singular_group_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 4.0), ("a", 2.0, 3.0, 6.0), ("a", 4.0, 5.0, 10.0), ("a", 3.0, 1.0, 2.0)], "g string, y double, x double, z double")
    r = ols.grouped_ols(df, ["g"], "y", ["x", "z"]).first()
    assert r.n == 4 and r.b_x is None and r.b_z is None


def test_level_of_a_series_does_not_matter(spark):
    """Returns and factors shifted by a million, over 60 months: the same volatilities and slopes; by ten, the same skewness."""
    import numpy as np

    rng = np.random.default_rng(1)
    grid = lambda x: np.round(x * 2**20) / 2**20  # a shift is exact
    n = 60 * 12
    x = grid(rng.normal(size=(n, 3)))
    y = grid(x @ [0.5, 1.0, -1.0] + rng.normal(size=n) ** 3)

    def run(shift):
        rows = [(1, 2000 * 12 + i // 12, 0, float(y[i]) + shift, *(float(v) + shift for v in x[i])) for i in range(n)]
        df = spark.createDataFrame(rows, "id int, m int, zero__ int, ret_exc double, mktrf double, smb_ff double, hml double")
        out = rolling.roll(df, [("ff3", "_1260d", 100), ("skew", "_1260d", 100), ("rvol", "_1260d", 100), ("capm_ext", "_1260d", 100)])
        return out.filter("eom = DATE'2004-11-30' OR eom = DATE'2005-11-30'").orderBy("eom").collect()

    plain, near, shifted = run(0.0), run(10.0), run(1e6)
    assert len(plain) == 2
    for a, m, b in zip(plain, near, shifted):
        for c in ("ivol_ff3_1260d", "rvol_1260d", "ivol_capm_1260d", "beta_1260d"):
            assert b[c] == pytest.approx(a[c], rel=1e-9), c
        for c in ("iskew_ff3_1260d", "rskew_1260d", "iskew_capm_1260d", "coskew_1260d"):
            assert m[c] == pytest.approx(a[c], rel=1e-8, abs=1e-8), c
    design = np.column_stack([np.ones(n), x])
    e = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
    assert shifted[0].ivol_ff3_1260d == pytest.approx(np.sqrt(e @ e / (n - 3)), rel=1e-9)
    assert shifted[0].rvol_1260d == pytest.approx(y.std(ddof=1), rel=1e-9)


def test_every_window_reads_written_months(spark):
    """The days are folded once: what rolls over three windows neither reads the days nor joins the factors again."""
    days = spark.range(400).select(
        (F.col("id") % 3).alias("id"), F.lit("a").alias("excntry"), F.expr("date_add(date '2020-01-01', CAST(id AS INT))").alias("date"), F.lit(1).alias("ret_lag_dif"),
        F.expr("id % 7 - 2.5D").alias("ret"), F.expr("id % 5 - 1.5D").alias("ret_exc"), F.lit(1.0).alias("ret_local"), F.lit(2.0).alias("dolvol"), F.lit(3.0).alias("prc"), F.lit(1.0).alias("adjfct"),
    ).withColumn("eom", F.last_day("date"))
    factors = days.select("excntry", "date", F.expr("dayofyear(date) % 4 - 1.0D").alias("mktrf"))
    prepared = rolling.prepare_days(days, factors)
    out = rolling.roll(prepared, [("rvol", "_21d", 2), ("rmax", "_21d", 2), ("rvol", "_126d", 4), ("capm", "_252d", 10)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan and "Join" not in plan
    assert out.count() > 0
