"""Bid-ask spread and volatility from daily high and low prices."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import div, safe_div


def impute_high_low(df: DataFrame) -> DataFrame:
    """Repair daily ranges from the last valid range of the security.

    A range is void on quote-only or no-volume days, when not positive, or when it is a point. A
    void day takes the last valid range if the price lies inside it, or that range shifted to
    touch the price if it lies outside. Ranges wider than 8:1 are void afterwards. ``hlreset``
    says which replacement applied (0 none, 1 inside, 2 below, 3 above or unknown).
    """
    w = Window.partitionBy("id").orderBy("date")
    lo, hi, prc = F.col("prc_low"), F.col("prc_high"), F.col("prc")
    void = (F.col("bidask") == 1) | (F.col("tvol") == 0) | (lo <= 0) | (hi <= 0) | (lo == hi)
    blank = lambda c: F.when(~F.coalesce(void, F.lit(False)), c)
    df = df.withColumns({"lo__": blank(lo), "hi__": blank(hi), "first__": F.row_number().over(w) == 1})
    lo, hi = F.col("lo__"), F.col("hi__")
    usable = ~F.col("first__") | F.coalesce((lo > 0) & (hi > lo), F.lit(False))
    df = df.withColumns({"alo__": F.when(usable, lo), "ahi__": F.when(usable, hi)})
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns(
        {
            "void__": F.col("alo__").isNull(),
            "alo__": F.last("alo__", ignorenulls=True).over(upto),
            "ahi__": F.last("ahi__", ignorenulls=True).over(upto),
        }
    )
    alo, ahi, fix = F.col("alo__"), F.col("ahi__"), F.col("void__")
    nothing = prc.isNull() & alo.isNull() & ahi.isNull()
    kind = (
        F.when(fix & (prc.between(alo, ahi) | nothing), 1)
        .when(fix & (prc < alo), 2)
        .when(fix & F.coalesce(prc > ahi, F.lit(True)), 3)
        .otherwise(0)
    )
    df = df.withColumn("hlreset", kind)
    k = F.col("hlreset")
    new_lo = F.when(k == 1, alo).when(k == 2, prc).when(k == 3, alo + (prc - ahi)).otherwise(lo)
    new_hi = F.when(k == 1, ahi).when(k == 2, ahi - (alo - prc)).when(k == 3, prc).otherwise(hi)
    df = df.withColumns({"prc_low": new_lo, "prc_high": new_hi})
    wide = (F.col("prc_low") != 0) & (div("prc_high", "prc_low") > 8)
    wide = F.coalesce(wide, F.lit(False))
    return df.withColumns(
        {"prc_low": F.when(~wide, F.col("prc_low")), "prc_high": F.when(~wide, F.col("prc_high"))}
    ).drop("lo__", "hi__", "alo__", "ahi__", "void__", "first__")


def overnight_adjust(df: DataFrame) -> DataFrame:
    """Shift the day's range to include the prior close; add the two-day envelope."""
    w = Window.partitionBy("id").orderBy("date")
    df = df.withColumns(
        {
            "prc_l1": F.lag("prc").over(w),
            "prc_low_l1": F.lag("prc_low").over(w),
            "prc_high_l1": F.lag("prc_high").over(w),
        }
    )
    lo, hi, close = F.col("prc_low"), F.col("prc_high"), F.col("prc_l1")
    below, above = (close < lo) & (close > 0), (close > hi) & (close > 0)
    df = df.withColumns(
        {
            "prc_high_t": F.when(above, close).when(below, hi - (lo - close)).otherwise(hi),
            "prc_low_t": F.when(above, lo + (close - hi)).when(below, close).otherwise(lo),
        }
    )
    return df.withColumns(
        {
            "prc_high_2d": F.greatest("prc_high_t", "prc_high_l1"),
            "prc_low_2d": F.least("prc_low_t", "prc_low_l1"),
        }
    )


def high_low_spread(df: DataFrame, min_obs: int) -> DataFrame:
    """Monthly mean spread and volatility; months need more than ``min_obs`` spreads."""
    const = 3 - 2 * math.sqrt(2)
    k2 = math.sqrt(8 / math.pi)
    square = lambda a, b: F.pow(F.log(div(a, b)), F.lit(2.0))
    df = df.withColumns(
        {
            "beta__": F.when(
                (F.col("prc_low_t") > 0) & (F.col("prc_low_l1") > 0),
                square("prc_high_t", "prc_low_t") + square("prc_high_l1", "prc_low_l1"),
            ),
            "gamma__": F.when(F.col("prc_low_2d") > 0, square("prc_high_2d", "prc_low_2d")),
        }
    )
    b, g = F.col("beta__"), F.col("gamma__")
    df = df.withColumn("alpha__", (math.sqrt(2) - 1) * F.sqrt(b) / const - F.sqrt(g / const))
    growth = F.exp("alpha__")
    spread = 2 * (growth - 1) / (1 + growth)
    sigma = (F.sqrt(b / 2) - F.sqrt(b)) / (k2 * const) + F.sqrt(g / (k2 * k2 * const))
    floor0 = lambda c: F.when(c < 0, F.lit(0.0)).otherwise(c)
    return (
        df.select("id", "eom", floor0(spread).alias("s__"), floor0(sigma).alias("v__"))
        .groupBy("id", "eom")
        .agg(F.avg("s__").alias("bidaskhl_21d"), F.avg("v__").alias("rvolhl_21d"), F.count("s__").alias("n__"))
        .filter(F.col("n__") > min_obs)
        .drop("n__")
    )


def bidask_hl(days: DataFrame, market: DataFrame, min_obs: int) -> DataFrame:
    """High-low spread per security and month, over days on which the country's market has a return."""
    traded = market.filter(F.col("mkt_vw_exc").isNotNull()).select("excntry", "date")
    df = days.join(traded, ["excntry", "date"])
    df = df.withColumns({c: safe_div(c, "adjfct") for c in ("prc", "prc_high", "prc_low")})
    return high_low_spread(overnight_adjust(impute_high_low(df)), min_obs)
