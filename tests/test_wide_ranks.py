import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import crosssection as cs
from panelwright.operators import factors as fa


def test_wide_ranks_equal_the_rank_table(spark):
    """Groups ranked on the wide rows and by the rank table agree: ties, nulls, repeated ids, missing ids and keys."""
    rng = random.Random(5)
    pick = lambda: rng.choice([None, -0.0, 0.0, 1.0, 2.5, float("nan"), rng.random()])
    data = [(rng.choice([None, *range(40)]), rng.choice(["a", "b", None]), pick(), pick()) for _ in range(300)]
    df = spark.createDataFrame(data, "id int, g string, x double, y double")
    key = lambda r: repr(tuple(r))
    for f in (cs.rank_pct, cs.z_ranks):
        wide, long = (f(df, ["id"], ["g"], {"x": True, "y": False}, 3, most=most) for most in (1000, 0))
        assert wide.columns == long.columns and wide.count() == 300
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
        cut = lambda out: sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in out.collect()), key=key)
        assert cut(wide) == cut(long)


def panel(spark, n, repeat=0):
    """One country and month of ``n`` stocks and ``repeat`` rows that come again; every fifth value is missing, some tie."""
    names = [*fa.MGMT, *fa.PERF, *{c for g in fa.QUALITY.values() for c in g if c != "evol__"}, "roeq_be_std", "roe_be_std"]
    value = lambda j: F.when((F.col("id") + j) % 5 != 0, ((F.col("id") * (2 * j + 3)) % 97).cast("double") + F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(0))
    ids = spark.range(n).union(spark.range(repeat)).withColumn("id", F.when(F.col("id") != 3, F.col("id")))
    flags = {c: F.lit(1) for c in ("common", "primary_sec", "obs_main", "exch_main", "ret_exc", "me")}
    key = {"excntry": F.when(F.col("id") != 5, "a"), "eom": F.lit("2000-01-31").cast("date")}
    return ids.withColumns(flags | key | {c: value(j) for j, c in enumerate(dict.fromkeys(names))})


def test_large_groups_are_ranked_on_wide_rows(spark, monkeypatch):
    """300,000 stocks of a country and month are ranked without a long row for each value."""
    monkeypatch.setattr(cs, "melt", lambda *a: pytest.fail("melted"))
    rows = panel(spark, 300_000)
    got = fa.mispricing(rows, 30).agg(F.count("mispricing_mgmt"), F.max("mispricing_mgmt"), F.count(F.lit(1))).first()
    assert got[0] > 250_000 and 0.5 < got[1] <= 1 and got[2] == 300_000
    assert fa.quality_minus_junk(rows, 30).agg(F.count("qmj")).first()[0] > 250_000


def test_quality_in_one_pass_equals_its_rank_tables(spark, monkeypatch):
    """Also for repeated rows, and rows without an id or country."""
    rows = panel(spark, 200, repeat=20)
    cut = lambda out: sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in out.collect())
    one = cut(fa.quality_minus_junk(rows, 30))
    monkeypatch.setattr(cs, "ROWS", 0)
    assert len(one) > 220 and cut(fa.quality_minus_junk(rows, 30)) == one
