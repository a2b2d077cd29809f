"""Portfolio build: characteristics in, portfolio, long-short, theme and regional returns out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import portfolios as po
from ..sources import sinks
from ..sources.build import publish
from ..sources.scratch import stage


@dataclass(frozen=True)
class Settings:
    """Portfolio settings; the defaults are the published ones."""

    portfolios: int = 3
    breakpoints: str = "non_mc"
    breakpoint_min: int = 10
    weighting: str = "market_cap"
    stocks_min: int = 5
    months_min: int = 60
    countries_min: int = 3
    exclude: tuple = ("ZWE", "VEN")
    managed_countries: tuple = ("USA",)
    home: str = "USA"


def portfolio_returns(
    panel: DataFrame, days: DataFrame, cutoffs: DataFrame, return_cutoffs: DataFrame, market: DataFrame, market_daily: DataFrame,
    countries: DataFrame, directions: DataFrame, labels: DataFrame, chars: list[str], settings: Settings | None = None,
    return_cutoffs_daily: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All portfolio outputs by name, for every country and characteristic at once. With
    ``return_cutoffs_daily`` the daily returns are winsorized like the monthly ones."""
    s = settings or Settings()
    stocks = po.screen(po.winsorize_lead(po.cap_equity(panel, cutoffs), return_cutoffs))
    stocks = stage(stocks, "stocks")
    if return_cutoffs_daily is not None:
        days = po.winsorize_daily(days, return_cutoffs_daily)
    args = (chars, s.portfolios, s.breakpoints, s.breakpoint_min)
    out = {"pfs": stage(po.char_portfolios(stocks, *args), "pfs"), "pfs_daily": stage(po.daily_portfolios(stocks, days, *args), "pfs-daily")}
    members = po.region_table(countries, s.home, list(s.exclude), s.countries_min)
    for tag, date, mkt, scale in (("", "eom", market, 1), ("_daily", "date", market_daily, 21)):
        hml = po.high_minus_low(out["pfs" + tag], date, s.portfolios, signal=not tag)
        lms = po.long_minus_short(hml, directions)
        clusters = po.cluster_portfolios(lms, labels, date)
        region = lambda df, by, least: po.regional(df, mkt, members, date, by, s.weighting, s.months_min * scale, least)
        out |= {
            "hml" + tag: hml, "lms" + tag: lms, "clusters" + tag: clusters, "regional" + tag: region(lms, "characteristic", s.stocks_min),
            "regional_clusters" + tag: region(clusters.withColumnRenamed("n_factors", "n_stocks_min"), "cluster", 1),
        }
    two_digit = F.substring(F.col("gics").cast("string"), 1, 2).cast("long")
    out["industry_gics"] = po.industry_returns(stocks.withColumn("gics", two_digit), "gics", s.breakpoint_min)
    out["industry_ff49"] = po.industry_returns(stocks.filter(F.col("excntry") == s.home), "ff49", s.breakpoint_min)
    out["cmp"] = po.managed_portfolios(stocks.filter(F.col("excntry").isin(list(s.managed_countries))), chars)
    return out


def write_outputs(outputs: dict[str, DataFrame], root: str, end) -> str:
    """Each output cut at ``end``, one directory per country or region; rows without one go to the directory "none". All
    appear together as a new version (see ``sources.build.published``); the folder of that version is returned."""

    def writer(df: DataFrame):
        date = "eom" if "eom" in df.columns else "date"
        by = "region" if "region" in df.columns else "excntry"
        capped = sinks.date_capped(df.withColumn(by, F.coalesce(by, F.lit("none"))), date, end)
        return lambda path: sinks.write_partitioned(capped, path, by)

    spark = next(iter(outputs.values())).sparkSession
    return publish(spark, root, {name: writer(df) for name, df in outputs.items()})
