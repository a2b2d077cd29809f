import datetime as dt

from pyspark.sql import functions as F

from panelwright.operators import security


def test_months_of_daily_quotes_need_no_further_exchange(spark):
    day = dt.date(2020, 1, 6)
    names = "gvkey iid datadate tpci exchg prcstd curcdd ajexdi curcddv div divd divsp prccd prchd prcld cshtrd cshoc qunit trfd".split()
    row = lambda g: (g, "01", day, "0", 11, 3, "USD", 1.0, "USD", 0.1, 0.1, 0.0, 5.0, 6.0, 4.0, 9.0, 2e6, 1.0, 1.0)
    home, world = spark.createDataFrame([row("1"), row("1")], names), spark.createDataFrame([row("2")], names)
    shares = spark.createDataFrame([("1", 3.0, 1.0, day)], "gvkey string, csho_fund double, ajex_fund double, ddate date")
    fx = spark.createDataFrame([("USD", day, 1.0)], "curcdd string, datadate date, fx double")
    daily = security.comp_daily(home, world, F.broadcast(shares), F.broadcast(fx))
    out = security.adjusted_month(daily, ["gvkey", "iid"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r.gvkey, r.dolvol, str(r.eom)) for r in out.collect()) == [("1", 45.0, "2020-01-31"), ("2", 45.0, "2020-01-31")]
