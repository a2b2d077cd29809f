"""The security build: it goes on after a failure, and moves nothing between steps keyed alike. Published versions."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from panelwright.operators import expand, joins, security
from panelwright.plans import security as plan
from panelwright.queries import securities as sq
from panelwright.sources import adapters
from panelwright.sources.build import Build, publish, published
from panelwright.sources.tables import Tables


def vendor_files(spark):
    t = Tables(spark, SF)
    month, day, i = adapters.security_month(t), adapters.security_day(t), F.col("id")
    feed = sq._feed(t)
    daily = day.select(
        i.alias("permno"), "permco", F.col("date").alias("dlycaldt"), F.col("prc").alias("dlyprc"), F.lit("TR").alias("dlyprcflg"), F.col("ret").alias("dlyret"),
        (F.col("ret") - 0.01).alias("dlyretx"), F.col("tvol").alias("dlyvol"), F.col("adjfct").alias("dlycumfacshr"), F.col("prc_high").alias("dlyhigh"), F.col("prc_low").alias("dlylow"),
        (F.col("shares") * 1000).alias("shrout"), F.lit("EQTY").alias("securitytype"), F.lit("COM").alias("securitysubtype"), F.lit("NS").alias("sharetype"), F.lit("CORP").alias("issuertype"),
        F.lit("Y").alias("usincflg"), F.lit("N").alias("primaryexch"), F.lit("RW").alias("conditionaltype"),
    )
    none = F.lit(None).cast("string")
    delist = month.filter("id % 2 = 0").groupBy(i.alias("permno")).agg(F.max("eom").alias("delistingdt")).select(
        "permno", "delistingdt", F.lit(-0.15).alias("delret"), F.lit("ACQ").alias("delreasontype"), none.alias("delactiontype"), none.alias("delpaymenttype"), none.alias("delstatustype")
    )
    links = month.filter("source_crsp = 1").groupBy(i.alias("permno")).agg(F.min("gvkey").alias("gvkey"), F.min("iid").alias("iid"), F.min("eom").alias("linkstart")).withColumn("linkend", F.lit(None).cast("date"))
    quotes = day.select(
        "id", "gvkey", "iid", F.col("date").alias("datadate"), F.lit("0").alias("tpci"), (10 + i % 8).alias("exchg"), F.lit(3).alias("prcstd"), F.col("curcd").alias("curcdd"), F.col("curcd").alias("curcddv"),
        F.col("adjfct").alias("ajexdi"), F.lit(0.1).alias("div"), F.lit(0.1).alias("divd"), F.lit(0.0).alias("divsp"), F.col("prc").alias("prccd"), F.col("prc_high").alias("prchd"), F.col("prc_low").alias("prcld"),
        F.col("tvol").alias("cshtrd"), F.lit(1.0).alias("trfd"), F.lit(1.0).alias("qunit"), (F.col("shares") * 1e6).alias("cshoc"),
    )
    m = F.col("midx")
    rates = month.select("midx").unionByName(day.select("midx")).distinct().select("midx", F.lit(0.001).alias("t30ret"), F.lit(0.002).alias("rf"))
    status = month.select("gvkey", "iid").distinct().withColumns({"secstat": F.lit("A"), "dlrsni": F.lit("07")})
    return plan.Files(
        feed, daily, delist, links, quotes.filter(i % 2 == 1), quotes.filter(i % 2 == 0), sq._shares(t), expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t))), status, rates,
        month.select((10 + i % 8).alias("exchg"), "excntry"),
    )


@pytest.fixture(scope="module")
def files(spark):
    return vendor_files(spark)


class Stopped(Exception):
    pass


class Counting(Build):
    """Counts the stages it makes; dies after a given one."""

    def __init__(self, *args, die_after=None):
        super().__init__(*args)
        self.made, self.die_after = [], die_after

    def stage(self, name, make, by, sort=None):
        known = self.finished(name)
        out = super().stage(name, make, by, sort)
        if known is None:
            self.made.append(name)
        if name == self.die_after:
            raise Stopped(name)
        return out


def digest(df):
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*[F.round(c, 9) if t == "double" else F.col(c) for c, t in df.dtypes]).cast("decimal(38,0)"))).first()


def test_build_goes_on_after_a_failure(spark, files, tmp_path):
    first = Counting(spark, f"{tmp_path}/a", 4, die_after="comp-quotes")
    with pytest.raises(Stopped):
        plan.security_panels(first, files)
    assert first.made == ["crsp-fields-month", "crsp-month", "comp-quotes"]
    again = Counting(spark, f"{tmp_path}/a", 4)
    month, day = plan.security_panels(again, files)
    assert not set(again.made) & set(first.made)
    assert again.made == ["comp-month", "securities-month", "world-month", "crsp-fields-day", "crsp-day", "comp-day", "world-day"]
    whole = plan.security_panels(Build(spark, f"{tmp_path}/b", 4), files)
    assert [digest(month), digest(day)] == [digest(x) for x in whole]
    assert month.count() and day.count() and month.groupBy("id", "eom").count().filter("count > 1").isEmpty()
    third = Counting(spark, f"{tmp_path}/a", 4)
    plan.security_panels(third, files)
    assert third.made == []


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_steps_keyed_alike_move_nothing(spark, files, tmp_path):
    build = Build(spark, f"{tmp_path}/c", 4)
    days = plan._quotes(build, files)
    rets = security.index_returns(days.withColumnRenamed("curcdd", "curcd"), plan.IDS, "datadate", "d")
    gone = security.delist_dates(rets, build.stage("status", lambda: files.status, plan.IDS), plan.IDS, "datadate")
    steps = security.apply_delisting(days.join(rets, [*plan.IDS, "datadate"], "left"), gone, plan.IDS, "datadate", ["ret", "ret_local"])
    assert exchanges(steps) == [] and steps.count() == days.count()
    assert exchanges(security.adjusted_month(days, plan.IDS)) == []
    panel = build.stage("panel", lambda: adapters.security_month(Tables(spark, SF)).select("id", "eom", "ret_exc", "ret_lag_dif"), ["id"], ["eom"])
    assert exchanges(security.next_return(panel)) == []


def test_outputs_appear_together(spark, tmp_path):
    root = str(tmp_path / "out")
    put = lambda n: lambda path: spark.range(n).write.parquet(path)
    with pytest.raises(FileNotFoundError):
        published(spark, root, "a")
    publish(spark, root, {"a": put(3), "b": put(4)})

    def fail(path):
        spark.range(1).write.parquet(path)
        raise Stopped

    with pytest.raises(Stopped):
        publish(spark, root, {"a": put(30), "b": fail})
    assert (published(spark, root, "a").count(), published(spark, root, "b").count()) == (3, 4)
    publish(spark, root, {"a": put(5), "b": put(6)})
    assert (published(spark, root, "a").count(), published(spark, root, "b").count()) == (5, 6)
