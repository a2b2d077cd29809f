"""Cutoffs, size groups, winsorizing and country market returns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import div
from .crosssection import quantile_disc, quantile_disc_many, winsorize

# Percentiles and their column suffixes.
RETURN_PROBS = {"0_1": 0.001, "1": 0.01, "99": 0.99, "99_9": 0.999}
SIZE_PROBS = {"nyse_p1": 0.01, "nyse_p20": 0.20, "nyse_p50": 0.50, "nyse_p80": 0.80}
RETURNS = ["ret", "ret_local", "ret_exc"]


def flags_on(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n) == 1 for n in names])


def quality_filter(df: DataFrame, *required: str) -> DataFrame:
    """Main, common, primary securities on a main exchange, with ``required`` columns present."""
    keep = flags_on(["common", "primary_sec", "obs_main", "exch_main"])
    for c in required:
        keep = keep & F.col(c).isNotNull()
    return df.filter(keep)


def contiguous_lag(df: DataFrame, cols: list[str], key: str = "id", index: str = "midx", suffix: str = "_l") -> DataFrame:
    """Previous month's values, NULL unless the previous row is exactly one month older."""
    w = Window.partitionBy(key).orderBy(index)
    step = F.col(index) - F.lag(index).over(w)
    return df.withColumns({c + suffix: F.when(step == 1, F.lag(c).over(w)) for c in cols})


def contiguous_lead(df: DataFrame, col: str, out: str, key: str = "id", index: str = "midx") -> DataFrame:
    w = Window.partitionBy(key).orderBy(index)
    return df.withColumn(
        out, F.when(F.lead(index).over(w) - F.col(index) == 1, F.lead(col).over(w))
    )


def size_cutoffs(df: DataFrame) -> DataFrame:
    """Market equity percentiles per month over the reference exchange (code 1)."""
    ref = quality_filter(df.filter(F.col("crsp_exchcd") == 1), "me")
    return quantile_disc(ref, ["eom"], "me", SIZE_PROBS, count="n")


def size_groups(df: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """mega / large / small / micro / nano from the month's cutoffs; without cutoffs all are mega."""
    me = F.col("me")
    label = (
        F.when(me.isNull(), F.lit(None).cast("string"))
        .when(F.col("nyse_p80").isNull() | (me >= F.col("nyse_p80")), "mega")
        .when(me >= F.col("nyse_p50"), "large")
        .when(me >= F.col("nyse_p20"), "small")
        .when(me >= F.col("nyse_p1"), "micro")
        .otherwise("nano")
    )
    cuts = cutoffs.select("eom", *SIZE_PROBS)
    return df.join(cuts, "eom", "left").withColumn("size_grp", label).drop(*SIZE_PROBS)


def return_cutoffs(df: DataFrame, freq: str = "m", crsp_only: bool = False, exclude: tuple[str, ...] = ("ZWE",)) -> DataFrame:
    """Twelve return percentiles per month (``freq='m'``) or per year and month of days (``'d'``)."""
    use = quality_filter(df, "ret_exc").filter(~F.col("excntry").isin(list(exclude)))
    if crsp_only:
        use = use.filter(F.col("source_crsp") == 1)
    keys = ["eom"]
    if freq == "d":
        use = use.withColumns({"year": F.year("date"), "month": F.month("date")})
        keys = ["year", "month"]
    return quantile_disc_many(use, keys, RETURNS, RETURN_PROBS, count=("n", "ret"))


def winsorize_returns(df: DataFrame, cutoffs: DataFrame, keys: list[str], only: Column | None = None) -> DataFrame:
    """Clamp the three returns to the 0.1 % / 99.9 % cutoffs of ``keys``; by default only rows
    of the non-reference source are touched."""
    only = (F.col("source_crsp") == 0) if only is None else only
    bounds = [f"{r}_{s}" for r in RETURNS for s in ("0_1", "99_9")]
    out = df.join(cutoffs.select(*keys, *bounds), keys, "left")
    return out.withColumns(
        {r: winsorize(r, f"{r}_0_1", f"{r}_99_9", only) for r in RETURNS}
    ).drop(*bounds)


def market_index(df: DataFrame, date: str, max_gap: int) -> DataFrame:
    """Value- and equal-weighted returns per country and date over eligible stocks."""
    ok = quality_filter(df, "me_lag1", "ret_local").filter(F.col("ret_lag_dif") <= max_gap)
    weight = F.sum("me_lag1")
    vw = lambda r: div(F.sum(F.col(r) * F.col("me_lag1")), weight)
    return ok.groupBy("excntry", date).agg(
        F.count(F.lit(1)).alias("stocks"),
        weight.alias("me_lag1"),
        F.sum("dolvol_lag1").alias("dolvol_lag1"),
        vw("ret_local").alias("mkt_vw_lcl"),
        F.avg("ret_local").alias("mkt_ew_lcl"),
        vw("ret").alias("mkt_vw"),
        F.avg("ret").alias("mkt_ew"),
        vw("ret_exc").alias("mkt_vw_exc"),
        F.avg("ret_exc").alias("mkt_ew_exc"),
    )


def drop_thin_days(df: DataFrame, n: str, date: str, keys: list[str], share: float) -> DataFrame:
    """Keep dates whose count reaches ``share`` of the largest count of the same keys and month."""
    w = Window.partitionBy(*keys, F.year(date), F.month(date))
    return (
        df.withColumn("top__", F.max(n).over(w))
        .filter(div(F.col(n).cast("double"), F.col("top__").cast("double")) >= share)
        .drop("top__")
    )


def market_returns(df: DataFrame, freq: str = "m", cutoffs: DataFrame | None = None) -> DataFrame:
    """Country market returns from a security panel, monthly or daily.

    One shuffle by id for the lags; the country-date aggregation combines map-side, so a dominant
    country costs no more than the others.
    """
    date, gap = ("eom", 1) if freq == "m" else ("date", 14)
    w = Window.partitionBy("id").orderBy(date)
    out = df.withColumns(
        {"me_lag1": F.lag("me").over(w), "dolvol_lag1": F.lag("dolvol").over(w)}
    )
    if cutoffs is not None:
        keys = ["eom"]
        if freq == "d":
            out = out.withColumns({"year": F.year("date"), "month": F.month("date")})
            keys = ["year", "month"]
        out = winsorize_returns(out, cutoffs, keys)
    out = market_index(out, date, gap)
    return drop_thin_days(out, "stocks", date, ["excntry"], 0.25) if freq == "d" else out
