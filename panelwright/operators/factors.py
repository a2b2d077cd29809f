"""Size-characteristic sorts, factor series and rank composites."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_index
from ..functions.nulls import count_nulls, div, mean_across
from ..sources.scratch import stage
from .crosssection import Step, Values, melt, quantile_disc, rank_pct, winsorize, z_chain, z_ranks, z_score
from .market import contiguous_lag, quality_filter

LEGS = ["small_low", "small_mid", "small_high", "big_low", "big_mid", "big_high"]


def clamp_by_month(df: DataFrame, col: str, lo: float = 0.001, hi: float = 0.999) -> DataFrame:
    """Clamp a column to its percentiles of the month."""
    cuts = quantile_disc(df, ["eom"], col, {"lo__": lo, "hi__": hi})
    return df.join(cuts, "eom", "left").withColumn(col, winsorize(col, "lo__", "hi__")).drop("lo__", "hi__")


def sort_base(panel: DataFrame, chars: list[str]) -> DataFrame:
    """Last month's sort variables of stocks that were eligible last month, with the size leg."""
    lagged = ["comp_exchg", "crsp_exchcd", "exch_main", "obs_main", "common", "primary_sec", "excntry", "size_grp", "me", *chars]
    df = contiguous_lag(panel.withColumn("midx", month_index("eom")), lagged)
    ok = reduce(lambda a, b: a & b, [F.col(f"{c}_l") == 1 for c in ("obs_main", "exch_main", "common", "primary_sec")])
    big = F.when(F.col("size_grp_l").isin("large", "mega"), "big").when(F.col("size_grp_l").isNotNull(), "small")
    return df.filter(ok & (F.col("ret_lag_dif") == 1) & F.col("me_l").isNotNull()).withColumn("size_pf", big)


def ff_sort(
    base: DataFrame, returns: DataFrame, chars: list[str], date: str, min_bp: int, min_pf: int, home: str = "USA"
) -> DataFrame:
    """2 x 3 sorts on size and each characteristic, all characteristics in one pass.

    Result per (excntry, date, characteristic): the six value-weighted legs, ``lms`` and ``smb``.
    Weights come from group totals joined back, not from a window over the portfolio.
    """
    ids = ["excntry_l", "eom", "id", "size_pf", "size_grp_l", "me_l", "crsp_exchcd_l", "comp_exchg_l"]
    long = melt(base, ids, [f"{c}_l" for c in chars], "char__", "val__")
    abroad = F.col("size_grp_l").isin("small", "large", "mega") & (F.col("excntry_l") != home)
    listed = ((F.col("crsp_exchcd_l") == 1) | (F.col("comp_exchg_l") == 11)) & (F.col("excntry_l") == home)
    group = ["excntry_l", "eom", "char__"]
    points = quantile_disc(long.filter(abroad | listed), group, "val__", {"p30__": 0.3, "p70__": 0.7}, count="n__")
    label = F.when(F.col("val__") >= F.col("p70__"), "high").when(F.col("val__") >= F.col("p30__"), "mid").otherwise("low")
    placed = (
        long.filter(F.col("size_pf").isNotNull())
        .join(points.filter(F.col("n__") >= min_bp), group)
        .select(*group, "id", "me_l", F.concat_ws("_", "size_pf", label).alias("leg"))
    )
    totals = (
        placed.groupBy(*group, "leg")
        .agg(F.sum("me_l").alias("me_leg"), F.count(F.lit(1)).alias("n_leg"))
        .filter(F.col("n_leg") >= min_pf)
    )
    rets = returns.select(F.col("excntry").alias("excntry_l"), "id", "eom", *([date] if date != "eom" else []), "ret_exc")
    # the security's own weights times returns are summed before the division by the leg total
    parts = (
        placed.join(rets, ["excntry_l", "id", "eom"])
        .groupBy("excntry_l", "char__", "leg", *dict.fromkeys(["eom", date]))
        .agg(F.sum(F.col("me_l") * F.col("ret_exc")).alias("num__"))
        .join(totals, [*group, "leg"])
        .withColumn("ret__", div("num__", "me_leg"))
    )
    wide = parts.groupBy("excntry_l", date, "char__").pivot("leg", LEGS).agg(F.first("ret__"))
    c = F.col
    lms = (c("small_high") + c("big_high")) / 2 - (c("small_low") + c("big_low")) / 2
    smb = (c("small_high") + c("small_mid") + c("small_low")) / 3 - (c("big_high") + c("big_mid") + c("big_low")) / 3
    return wide.select(
        F.col("excntry_l").alias("excntry"), date, F.expr("substr(char__, 1, length(char__) - 2)").alias("characteristic"),
        *LEGS, lms.alias("lms"), smb.alias("smb"),
    )


def ap_factors(
    returns: DataFrame, panel: DataFrame, market: DataFrame, date: str = "eom", min_bp: int = 10, min_pf: int = 3, home: str = "USA"
) -> DataFrame:
    """Market, size, value, investment and profitability factors per country and date."""
    gap = 1 if date == "eom" else 5
    use = returns.filter((F.col("ret_lag_dif") <= gap) & F.col("ret_exc").isNotNull())
    if date == "eom":
        use = use.filter(F.col("ret_lag_dif") == 1)
    use = clamp_by_month(use.select("excntry", "id", *dict.fromkeys(["eom", date]), "ret_exc"), "ret_exc")
    chars = ["be_me", "at_gr1", "niq_be"]
    s = ff_sort(sort_base(panel, chars), use, chars, date, min_bp, min_pf, home)
    at = lambda char, leg: F.max(F.when(F.col("characteristic") == char, F.col(leg)))
    wide = s.groupBy("excntry", date).agg(
        at("be_me", "lms").alias("hml"), at("be_me", "smb").alias("smb_ff"), (-at("at_gr1", "lms")).alias("inv"),
        at("niq_be", "lms").alias("roe"), ((at("at_gr1", "smb") + at("niq_be", "smb")) / 2).alias("smb_hxz"),
    )
    mkt = market.select("excntry", date, F.col("mkt_vw_exc").alias("mktrf"))
    return mkt.join(wide, ["excntry", date], "left").select("excntry", date, "mktrf", "hml", "smb_ff", "inv", "roe", "smb_hxz")


# Inputs of the composites; True ranks in descending order.
MGMT = {"chcsho_12m": True, "eqnpo_12m": False, "oaccruals_at": True, "noa_at": True, "at_gr1": True, "ppeinv_gr1a": True}
PERF = {"o_score": True, "ret_12_1": False, "gp_at": False, "niq_at": False}
QUALITY = {
    "prof": {"gp_at": False, "ni_be": False, "ni_at": False, "ocf_at": False, "gp_sale": False, "oaccruals_at": True},
    "growth": {"gpoa_ch5": False, "roe_ch5": False, "roa_ch5": False, "cfoa_ch5": False, "gmar_ch5": False},
    "safety": {"betabab_1260d": True, "debt_at": True, "o_score": True, "z_score": False, "evol__": True},
}
GEO = ["excntry", "eom"]


def mispricing(panel: DataFrame, min_stocks: int, max_missing: int = 3) -> DataFrame:
    """Mean percentile ranks of the management and performance inputs; NULL if more than
    ``max_missing`` inputs are missing. All ten ranks come from one rank table."""
    # read for the sizes of groups and for the ranks
    use = stage(quality_filter(panel, "ret_exc", "me").select("id", *GEO, *MGMT, *PERF), "ranked")
    r = rank_pct(use, ["id"], GEO, MGMT | PERF, min_stocks)
    def score(names) -> Column:
        cols = [f"rank_{c}" for c in names]
        return F.when(count_nulls(cols) <= max_missing, mean_across(cols))

    return r.select("id", "eom", score(PERF).alias("mispricing_perf"), score(MGMT).alias("mispricing_mgmt"))


def quality_minus_junk(panel: DataFrame, min_stocks: int) -> DataFrame:
    """Profitability, growth and safety composites of rank z-scores and their combination."""
    use = quality_filter(panel, "ret_exc", "me").withColumn("evol__", F.coalesce(2 * F.col("roeq_be_std"), "roe_be_std"))
    inputs = reduce(lambda a, b: a | b, QUALITY.values())
    use = stage(use.select("id", *GEO, *inputs), "ranked")
    parts, total = {name: False for name in QUALITY}, {"all__": False}

    # composites are cut at 12 decimals, so that equal scores tie whatever the order of summation
    def cut(x: np.ndarray) -> np.ndarray:
        return np.copysign(np.floor(np.abs(x) * 1e12 + 0.5) / 1e12, x) + 0.0

    def composites(z: Values) -> Values:
        out = {}
        for name, cols in QUALITY.items():
            own = [z[f"z_{c}"] for c in cols]
            n = sum(~np.isnan(x) for x in own)
            out[name] = cut(np.where(n > 0, sum(np.nan_to_num(x) for x in own) / np.maximum(n, 1), np.nan))
        return out

    score = z_score(min_stocks)
    steps = [
        Step(inputs, "z_", score, composites),
        Step(parts, "qmj_", score, lambda z: {"all__": cut((z["qmj_prof"] + z["qmj_growth"] + z["qmj_safety"]) / 3)}),
        Step(total, "z_", score),
    ]
    out = ["qmj_prof", "qmj_growth", "qmj_safety", "z_all__"]
    ranked = z_chain(use, ["id"], GEO, steps, out, lambda rows: _quality_of_large(rows, inputs, min_stocks))
    return ranked.select("excntry", "id", "eom", *out[:3], F.col("z_all__").alias("qmj"))


def _quality_of_large(use: DataFrame, inputs: dict[str, bool], min_stocks: int) -> DataFrame:
    """The steps of :func:`quality_minus_junk` on groups too large for one task: each through its rank table."""
    z = z_ranks(use, ["id"], GEO, inputs, min_stocks, most=0)
    tidy = lambda c: F.round(c, 12)
    raw = z.select("id", *GEO, *[tidy(mean_across([f"z_{c}" for c in cols])).alias(name) for name, cols in QUALITY.items()])
    # each step is read several times by the next one, so it is written once
    raw = stage(raw, "qmj")
    parts = z_ranks(raw, ["id"], GEO, {name: False for name in QUALITY}, min_stocks, prefix="qmj_", most=0)
    total = (F.col("qmj_prof") + F.col("qmj_growth") + F.col("qmj_safety")) / 3
    parts = stage(parts.withColumn("all__", tidy(total)), "qmj")
    final = z_ranks(parts, ["id"], GEO, {"all__": False}, min_stocks, most=0)
    return parts.drop("all__").join(final, ["id", *GEO], "left").select("id", *GEO, "qmj_prof", "qmj_growth", "qmj_safety", "z_all__")
