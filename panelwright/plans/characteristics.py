"""Characteristics build: security panels and statements in, one wide security x month table out.

Stages read by several later steps (the monthly and daily world panels, the accounting
characteristics, the factors) are written once to the shared scratch folder and read back with
column pruning; everything else stays lazy.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import accounting, factors, joins, market, panel, rolling, spread
from ..sources.scratch import stage


@dataclass(frozen=True)
class Rules:
    """Thresholds of a build; the defaults are the published ones."""

    #: No window ends after the month of this date; None: windows end when their data is out of reach.
    end: date | None = None
    publication_lag: int = 4
    max_age: int = 18
    min_breakpoint_stocks: int = 10
    min_portfolio_stocks: int = 3
    min_rank_stocks: int = 10
    max_missing_ranks: int = 3
    beta_months: int = 60
    beta_min: int = 36
    resmom: tuple = ((36, 24, 12, 1), (36, 24, 6, 1))
    spread_min_days: int = 10
    dimson_month_min: int = 14
    daily_grid: tuple = (
        *((m, "_21d", 15) for m in ("rvol", "rmax", "skew", "capm_ext", "ff3", "hxz4", "dimsonbeta", "zero_trades")),
        *((m, "_126d", 60) for m in ("zero_trades", "turnover", "dolvol", "ami")),
        *((m, "_252d", 120) for m in ("rvol", "capm", "downbeta", "zero_trades", "prc_to_high", "mktvol")),
        ("mktcorr", "_1260d", 750),
    )
    home: str = "USA"


def size_and_market(month: DataFrame, day: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Monthly panel with size groups, and market returns by month and by day."""
    sized = stage(market.size_groups(month, market.size_cutoffs(month)), "month")
    by_month = market.market_returns(sized, "m", market.return_cutoffs(sized, "m"))
    by_day = market.market_returns(day, "d", market.return_cutoffs(day, "d"))
    return sized, stage(by_month, "market"), stage(by_day, "market-daily")


def accounting_characteristics(
    annual: DataFrame, quarterly: DataFrame, fx: DataFrame, month: DataFrame, rules: Rules
) -> DataFrame:
    """Fresher of annual and quarterly characteristics per firm and publication month."""
    equity = accounting.market_equity(month, "me_company")
    build = lambda df, q, suffix: stage(
        accounting.create_characteristics(df, fx, equity, rules.publication_lag, rules.max_age, q, suffix), "accounting"
    )
    return accounting.fresher_of_two(
        build(annual, False, ""), build(quarterly, True, "_qitem"), accounting.characteristic_names()
    )


def daily_characteristics(day: DataFrame, daily_factors: DataFrame, market_daily: DataFrame, rules: Rules) -> DataFrame:
    """Rolling daily metrics of the whole grid (one pass over the days) and the high-low spread."""
    lead_lag = panel.market_lead_lag(daily_factors).select(
        "excntry", "date", "mktrf_ld1", "mktrf_lg1", F.lit(True).alias("lead_lag__")
    )
    days = rolling.prepare_days(day, daily_factors).join(lead_lag, ["excntry", "date"], "left")
    days = days.withColumn("lead_lag__", F.coalesce("lead_lag__", F.lit(False)))
    days = panel.three_day_sums(days, {"ret_exc": "ret_exc_3l", "mktrf": "mkt_exc_3l"})
    custom = {"dimsonbeta": rolling.dimsonbeta(rules.dimson_month_min)}
    metrics = rolling.roll(days, list(rules.daily_grid), custom=custom, end=rules.end)
    hl = spread.bidask_hl(day, market_daily, rules.spread_min_days)
    return rolling.derived_daily(joins.merge_metrics([metrics, hl], ["id", "eom"]))


def characteristics(
    month: DataFrame, day: DataFrame, annual: DataFrame, quarterly: DataFrame, fx: DataFrame, rules: Rules | None = None
) -> DataFrame:
    """The wide table: accounting, market, factor-based, daily and composite characteristics."""
    rules = rules or Rules()
    sized, by_month, by_day = size_and_market(month, day)
    acc = accounting_characteristics(annual, quarterly, fx, sized, rules)
    acc = acc.withColumnRenamed("public_date", "eom")
    own = panel.market_characteristics(sized, by_month)
    prelim = stage(
        sized.join(own, ["id", "eom"], "left").join(acc, ["gvkey", "eom"], "left"), "prelim"
    )
    ap = lambda rets, mkt, date: stage(
        factors.ap_factors(rets, prelim, mkt, date, rules.min_breakpoint_stocks, rules.min_portfolio_stocks, rules.home), f"factors-{date}"
    )
    monthly, daily = ap(sized, by_month, "eom"), ap(day, by_day, "date")
    rows = stage(rolling.regression_rows(sized, monthly), "regressions")
    parts = [
        rolling.market_beta(rows, rules.beta_months, rules.beta_min),
        *[rolling.residual_momentum(rows, *r) for r in rules.resmom],
        daily_characteristics(day, daily, by_day, rules),
        factors.mispricing(prelim, rules.min_rank_stocks, rules.max_missing_ranks),
    ]
    wide = stage(joins.enrich(prelim, [joins.merge_metrics(parts, ["id", "eom"])], ["id", "eom"]), "wide")
    qmj = factors.quality_minus_junk(wide, rules.min_rank_stocks)
    return wide.join(qmj, ["excntry", "id", "eom"], "left")
