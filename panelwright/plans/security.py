"""From vendor files to the monthly and the daily world panel.

The stages are tables in buckets of their identifier (:class:`panelwright.sources.build.Build`): daily quotes and
months of the accounting vendor by (gvkey, iid), the reference exchange by permno, the panels by id. Returns, gaps,
delistings and next month's return are windows and joins on these keys and move nothing. A build that failed goes
on after the last finished stage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import typed_null
from ..operators import expand, joins, security
from ..sources.build import Build

IDS = ["gvkey", "iid"]
#: Columns of the panels and their types (fixed values).
TYPES = {
    "id": "long", "permno": "long", "permco": "long", "gvkey": "string", "iid": "string", "excntry": "string", "exch_main": "int", "common": "int",
    "primary_sec": "int", "bidask": "int", "crsp_shrcd": "double", "crsp_exchcd": "double", "comp_tpci": "string", "comp_exchg": "long", "curcd": "string",
    "fx": "double", "date": "date", "eom": "date", "adjfct": "double", "shares": "double", "me": "double", "me_company": "double", "prc": "double",
    "prc_local": "double", "prc_high": "double", "prc_low": "double", "dolvol": "double", "tvol": "double", "ret": "double", "ret_local": "double",
    "ret_exc": "double", "ret_lag_dif": "long", "div_tot": "double", "div_cash": "double", "div_spc": "double", "source_crsp": "int",
}
DAILY_ONLY_MONTHLY = ("permno", "permco", "gvkey", "iid", "crsp_shrcd", "crsp_exchcd", "comp_tpci", "comp_exchg", "me_company", "prc_local", "div_tot", "div_cash", "div_spc")


@dataclass
class Files:
    """Vendor files as tables; the columns are those that the operators of ``operators.security`` ask for."""

    crsp_month: DataFrame
    crsp_day: DataFrame
    delist: DataFrame
    links: DataFrame  # permno, gvkey, iid, linkstart, linkend
    comp_home: DataFrame
    comp_world: DataFrame
    shares: DataFrame  # gvkey, datadate, csho_fund, ajex_fund
    fx: DataFrame  # datadate, curcdd, fx
    status: DataFrame
    rates: DataFrame
    exchanges: DataFrame  # exchg, excntry: one row for each seen
    primary: dict[str, DataFrame] = field(default_factory=dict)
    header: DataFrame | None = None


def _panel(df: DataFrame, names: dict[str, Column]) -> DataFrame:
    """The columns of the panel, NULL where the vendor has none."""
    have = {c: F.col(c) for c in df.columns} | names
    return df.select(*[(have[c] if c in have else typed_null()).cast(t).alias(c) for c, t in TYPES.items()])


def _crsp(build: Build, files: Files, freq: str) -> DataFrame:
    feed = files.crsp_month if freq == "m" else files.crsp_day
    tag = "month" if freq == "m" else "day"
    fields = build.stage(f"crsp-fields-{tag}", lambda: security.crsp_fields(feed, freq), ["permno"], ["date"])

    def clean():
        out = security.harmonise_crsp(security.crsp_security(fields, files.delist, files.rates, freq))
        linked = joins.interval_join(out, files.links, "permno", "date", "linkstart", "linkend")
        # one link counts on a date
        return linked.groupBy("permno", "date").agg(F.min(F.struct("gvkey", "iid", *[c for c in out.columns if c not in ("permno", "date")])).alias("row")).select("permno", "date", "row.*")

    done = build.stage(f"crsp-{tag}", clean, ["permno"], ["date"])
    return _panel(done, {"crsp_shrcd": F.col("shrcd"), "crsp_exchcd": F.col("exchcd"), "adjfct": F.col("cfacshr"), "shares": F.col("shrout"), "tvol": F.col("vol")})


def _quotes(build: Build, files: Files) -> DataFrame:
    def make():
        filed = files.shares.groupBy("gvkey", "datadate").agg(F.max("csho_fund").alias("csho_fund"), F.max("ajex_fund").alias("ajex_fund"))
        return security.comp_daily(files.comp_home, files.comp_world, expand.carry_forward(filed, "gvkey", "datadate", "ddate").drop("datadate"), files.fx)

    return build.stage("comp-quotes", make, IDS, ["datadate"])


def _comp(build: Build, files: Files, freq: str) -> DataFrame:
    days = _quotes(build, files)
    tag = "month" if freq == "m" else "day"

    def rows():
        if freq == "d":
            return days.withColumnRenamed("cshtrd", "tvol")
        month = security.adjusted_month(days, IDS)
        last = days.select(*IDS, "datadate", "tpci", "exchg", "prcstd", "cshoc", "ri", "ri_local", "fx", "me")
        return month.join(last, [*IDS, "datadate"]).withColumnRenamed("cshtrm", "tvol")

    def clean():
        df = rows().withColumnRenamed("curcdd", "curcd")
        out = security.comp_security(df, files.status, files.rates, security.main_exchange(files.exchanges), freq)
        out = security.harmonise_comp(out)
        if not files.primary:
            return out.withColumn("primary_sec", F.lit(1))
        return joins.primary_flag(out, files.primary, files.header, "gvkey", "iid", "datadate", [*IDS, "datadate"])

    done = build.stage(f"comp-{tag}", clean, IDS, ["datadate"])
    return _panel(done, {"comp_tpci": F.col("tpci"), "comp_exchg": F.col("exchg"), "date": F.col("datadate"), "adjfct": F.col("ajexdi"), "shares": F.col("cshoc")})


def security_panels(build: Build, files: Files) -> tuple[DataFrame, DataFrame]:
    """(monthly, daily) world panels: both vendors, next month's excess return and the main-row flag."""
    both = build.stage("securities-month", lambda: _crsp(build, files, "m").unionByName(_comp(build, files, "m")), ["id"], ["eom"])
    month = build.stage("world-month", lambda: security.obs_main_flag(security.next_return(both)), ["id"], ["eom"])

    def days():
        keep = lambda df: df.select(*[c for c in TYPES if c not in DAILY_ONLY_MONTHLY])
        return security.world_panel_daily(keep(_crsp(build, files, "d")), keep(_comp(build, files, "d")), month)

    return month, build.stage("world-day", days, ["id"], ["date"])
