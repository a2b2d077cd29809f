"""The two end-to-end builds on the smallest tables, with thresholds to match."""

from conftest import SF
from pyspark.sql import functions as F

from panelwright.operators import expand, joins, market
from panelwright.plans import characteristics as ch
from panelwright.plans import portfolios as pf
from panelwright.sources import adapters
from panelwright.sources.build import published
from panelwright.sources.tables import Tables


def test_portfolio_build(spark, tmp_path):
    t = Tables(spark, SF)
    month = adapters.security_month(t, "part").withColumns(
        {"c_price": F.col("prc"), "c_volume": F.col("tvol"), "gics": F.col("id") * 100000, "ff49": F.col("id") % 12, "ret_exc_lead1m": F.col("prc") % 7 / 100}
    )
    day = adapters.security_day(t, "part")
    cuts = market.size_cutoffs(month)
    panel = market.size_groups(month, cuts)
    info = spark.createDataFrame([("c_price", 1), ("c_volume", -1)], "characteristic string, direction long")
    labels = spark.createDataFrame([("c_price", "a"), ("c_volume", "a")], "characteristic string, cluster string")
    countries = panel.select("excntry").distinct().withColumn("development", F.lit("developed"))
    mk = panel.groupBy("excntry", "eom").agg(F.count("id").alias("stocks"), F.sum("me").alias("me_lag1"), F.avg("ret_exc_lead1m").alias("mkt_vw_exc"))
    mkd = day.groupBy("excntry", "date").agg(F.count("id").alias("stocks"), F.sum("me").alias("me_lag1"), F.avg("ret_exc").alias("mkt_vw_exc"))
    s = pf.Settings(breakpoint_min=3, stocks_min=1, months_min=1, countries_min=1, home="AMERICA", managed_countries=("ASIA",))
    out = pf.portfolio_returns(panel, day, cuts, market.return_cutoffs(month), mk, mkd, countries, info, labels, ["c_price", "c_volume"], s)
    assert {"pfs", "hml", "lms_daily", "clusters", "regional_clusters_daily", "cmp", "industry_gics"} <= set(out)
    counts = {k: out[k].count() for k in ("pfs", "pfs_daily", "hml", "lms", "clusters", "regional", "cmp")}
    assert all(counts.values()), counts
    pf.write_outputs({"hml": out["hml"]}, str(tmp_path), F.lit("1999-12-31").cast("date"))
    back = published(spark, str(tmp_path), "hml")
    assert back.count() == out["hml"].filter("eom <= DATE'1999-12-31'").count()


def test_daily_grid_runs_in_one_pass(spark):
    t = Tables(spark, SF)
    day = adapters.security_day(t)
    f = adapters.factor_series(t, "date")
    mk = market.market_returns(day, "d")
    rules = ch.Rules(
        dimson_month_min=1, spread_min_days=1,
        daily_grid=(("rvol", "_21d", 3), ("rmax", "_21d", 3), ("dimsonbeta", "_126d", 8), ("zero_trades", "_126d", 8), ("rvol", "_252d", 20), ("mktvol", "_252d", 20), ("mktcorr", "_1260d", 50)),
    )
    out = ch.daily_characteristics(day, f, mk, rules)
    keys = out.groupBy("id", "eom").count().filter("count > 1").count()
    assert keys == 0
    row = out.agg(*[F.count(c).alias(c) for c in ("rvol_21d", "beta_dimson_126d", "zero_trades_126d", "betabab_1260d", "bidaskhl_21d")]).first()
    assert all(row), row


def test_characteristics_build(spark):
    t = Tables(spark, SF)
    month = adapters.security_month(t).withColumns({"gvkey": F.lpad(F.col("id").cast("string"), 6, "0"), "me_company": F.col("me")})
    fx = expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t)))
    rules = ch.Rules(
        min_breakpoint_stocks=1, min_portfolio_stocks=1, min_rank_stocks=2, beta_months=24, beta_min=12, resmom=((24, 12, 6, 1),), spread_min_days=1,
        dimson_month_min=1, home="AMERICA",
        daily_grid=(("rvol", "_21d", 3), ("rmax", "_21d", 3), ("rvol", "_252d", 20), ("mktvol", "_252d", 20), ("mktcorr", "_1260d", 50)),
    )
    out = ch.characteristics(month, adapters.security_day(t), adapters.firm_accounting(t), adapters.firm_accounting(t, "quarterly"), fx, rules)
    names = set(out.columns)
    assert {"ret_12_1", "be_me", "f_score", "beta_24m", "resff3_6_1", "betabab_1260d", "mispricing_mgmt", "qmj", "bidaskhl_21d"} <= names
    assert len(names) == len(out.columns)
    seen = out.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id", "eom").alias("k"), F.count("at_me").alias("a"), F.count("ret_12_1").alias("m")).first()
    assert seen.n == seen.k == month.count() and seen.a and seen.m
