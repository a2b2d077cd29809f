"""Security-level cleaning: volume eras, identifiers, returns, delistings, source merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_index
from ..functions.nulls import as_col, bool_false, div, finite, typed_null
from . import joins, rows

# End of each volume-reporting era on the dealer exchange and its divisor.
VOLUME_ERAS = [("2001-01-31", 2.0), ("2001-12-31", 1.8), ("2003-12-30", 1.6)]
# Security-level delisting reasons that imply a 30 % loss.
LOSS_REASONS = ["02", "03"]
DELIST_LOSS = -0.3
# Price-status codes that count as a valid price.
VALID_PRICE = [3, 4, 10]
# Link types accepted from the link history.
LINK_TYPES = ("LC", "LU", "LS")
# Delisting reasons treated as performance related.
PERFORMANCE_REASONS = [
    "MVOT", "MTMK", "SHLD", "LP", "INSC", "INSF", "CORQ", "DERE", "BKPY", "OFFRE", "DELQ", "FARG",
    "EQRQ", "DEEX", "FING",
]
# Exchanges never flagged as a main exchange.
SPECIAL_EXCHANGES = [
    0, 1, 2, 3, 4, 15, 16, 17, 18, 21, 13, 19, 20, 127, 150, 157, 229, 263, 269, 281, 283, 290,
    320, 326, 341, 342, 347, 348, 349, 352,
]


def volume_by_era(date: str, volume: str | Column, exchange: str, code) -> Column:
    """Divide volume on one exchange by the era's double-counting factor."""
    on = F.col(exchange) == F.lit(code)
    out = None
    for last_day, factor in VOLUME_ERAS:
        hit = on & (F.col(date) <= F.lit(last_day).cast("date"))
        val = as_col(volume) / factor
        out = F.when(hit, val) if out is None else out.when(hit, val)
    return out.otherwise(as_col(volume))


def composite_id(gvkey: str, iid: str) -> Column:
    """Integer id: 3 (iid has W), 2 (has C) or 1, then gvkey, then two characters of iid."""
    i = F.col(iid)
    prefix = F.when(i.contains("W"), "3").when(i.contains("C"), "2").otherwise("1")
    return F.concat(prefix, F.col(gvkey), F.substring(i, 1, 2)).try_cast("long")


def pct_change(c: str, w) -> Column:
    """Change against the last earlier non-null value."""
    prev = F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return finite(div(c, prev) - 1)


def index_returns(df: DataFrame, ids: list[str], date: str, freq: str = "m") -> DataFrame:
    """Returns from total-return indices, with the gap since the last observation.

    On a currency switch the local return restarts from the common-currency one. The input must
    be unique on (ids, date); rows without an index or a valid price status are left out.
    """
    w = Window.partitionBy(*ids).orderBy(date)
    gap = (
        month_index(date) - month_index(F.lag(date).over(w))
        if freq == "m"
        else F.datediff(F.col(date), F.lag(date).over(w))
    )
    switched = F.col("curcd") != F.lag("curcd").over(w)
    return (
        df.filter(F.col("ri").isNotNull() & F.col("prcstd").isin(VALID_PRICE))
        .withColumns(
            {
                "ret": pct_change("ri", w),
                "local__": pct_change("ri_local", w),
                "ret_lag_dif": gap.cast("long"),
                "switched__": switched,
            }
        )
        .withColumn("ret_local", F.when(F.col("switched__"), F.col("ret")).otherwise(F.col("local__")))
        .select(*ids, date, "ret", "ret_local", "ret_lag_dif")
    )


def delist_dates(returns: DataFrame, status: DataFrame, ids: list[str], date: str) -> DataFrame:
    """Last date with a non-zero local return of each inactive security and its delisting return."""
    last = (
        returns.filter(F.col("ret_local").isNotNull() & (F.col("ret_local") != 0))
        .groupBy(*ids)
        .agg(F.max(date).alias("date_delist"))
    )
    return (
        last.join(status, ids)
        .filter(F.col("secstat") == "I")
        .select(
            *ids,
            "date_delist",
            F.when(F.col("dlrsni").isin(LOSS_REASONS), F.lit(DELIST_LOSS)).otherwise(0.0).alias("dlret"),
        )
    )


def apply_delisting(df: DataFrame, delist: DataFrame, ids: list[str], date: str, cols: list[str]) -> DataFrame:
    """Compound the delisting return on the delisting date and drop later rows."""
    on_day = F.col(date) == F.col("date_delist")
    return (
        df.join(delist, ids, "left")
        .filter(F.col("date_delist").isNull() | (F.col(date) <= F.col("date_delist")))
        .withColumns(
            {c: F.when(on_day, (1 + F.col(c)) * (1 + F.col("dlret")) - 1).otherwise(F.col(c)) for c in cols}
        )
        .drop("date_delist", "dlret")
    )


def delist_code_return(ret: Column, delret: Column, reason: Column, action: Column, payment: Column, status: Column) -> Column:
    """Return compounded with the delisting return; performance delistings without one lose 30 %."""
    dropped = (action == "GDR") & (payment == "PRCF") & (status == "VCL")
    bad = dropped & ((reason == "UNAV") | reason.isin(PERFORMANCE_REASONS))
    dl = F.when(delret.isNull() & bad, F.lit(DELIST_LOSS)).otherwise(delret)
    r = F.when(ret.isNull() & dl.isNotNull(), F.lit(0.0)).otherwise(ret)
    return (r + 1) * (F.coalesce(dl, F.lit(0.0)) + 1) - 1


def implied_dividend(w, ret: str = "ret", retx: str = "retx", prc: str = "prc", adj: str = "cfacshr") -> Column:
    """Dividend per share implied by the gap between total and price return."""
    prev = F.lag(adj).over(w)
    return F.when(
        prev != 0, (F.col(ret) - F.col(retx)) * F.lag(prc).over(w) * div(F.col(adj), prev)
    )


def excess_return(df: DataFrame, rates: DataFrame, date: str, freq: str = "m") -> DataFrame:
    """ret minus the month's bill rate (t30ret, else rf); daily rows carry 1/21 of it.

    ``rates`` has one row per month index ``midx`` with t30ret and rf.
    """
    scale = 1 if freq == "m" else 21
    return (
        df.withColumn("midx__", month_index(date))
        .join(rates.withColumnRenamed("midx", "midx__"), "midx__", "left")
        .withColumn("ret_exc", F.col("ret") - F.coalesce("t30ret", "rf") / scale)
        .drop("midx__", "t30ret", "rf")
    )


def company_total(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Total over a company's securities on a date; NULL when none is known."""
    total = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.sum(value).alias(out))
    return df.join(total, keys, "left")


def month_high_low(monthly: DataFrame, daily: DataFrame, key: str) -> DataFrame:
    """Highest and lowest traded daily price of the month, NULL where the month has no trade flag."""
    hl = (
        daily.filter(F.col("prcflg") == "TR")
        .groupBy(key, "eom")
        .agg(F.max("prc").alias("hi__"), F.min("prc").alias("lo__"))
    )
    traded = F.col("prcflg") == "TR"
    return (
        monthly.join(hl, [key, "eom"], "left")
        .withColumns({"askhi": F.when(traded, F.col("hi__")), "bidlo": F.when(traded, F.col("lo__"))})
        .drop("hi__", "lo__")
    )


def adjusted_month(df: DataFrame, ids: list[str]) -> DataFrame:
    """Month rows from days: split-adjusted high, low, dividends and volume in units of the last valid day.

    Everything folds into one aggregation; the last valid day is taken with max_by.
    """
    a = F.col("ajexdi")
    valid = F.col("prc_local").isNotNull() & F.col("curcdd").isNotNull() & F.col("prcstd").isin(VALID_PRICE)
    adj = lambda c: div(c, a)
    per_month = df.groupBy(*ids, "eom").agg(
        F.greatest(F.max(adj("prc")), F.max(adj("prc_high"))).alias("hi__"),
        F.least(F.min(adj("prc")), F.min(adj("prc_low"))).alias("lo__"),
        *[F.sum(adj(c)).alias(f"{c}__") for c in ("div_tot", "div_cash", "div_spc", "cshtrd")],
        F.sum("dolvol").alias("dolvol"),
        F.max_by(F.struct("datadate", "prc_local", "prc", "curcdd", "ajexdi"), F.when(valid, F.col("datadate"))).alias("last__"),
        F.count_if(valid).alias("valid__"),
    )
    f = F.col("last__.ajexdi")
    return per_month.filter(F.col("valid__") > 0).select(
        *ids,
        "eom",
        F.col("last__.datadate").alias("datadate"),
        F.col("last__.curcdd").alias("curcdd"),
        F.col("last__.prc_local").alias("prc_local"),
        F.col("last__.prc").alias("prc"),
        f.alias("ajexdi"),
        (F.col("hi__") * f).alias("prc_high"),
        (F.col("lo__") * f).alias("prc_low"),
        *[(F.col(f"{c}__") * f).alias(o) for c, o in (("div_tot", "div_tot"), ("div_cash", "div_cash"), ("div_spc", "div_spc"), ("cshtrd", "cshtrm"))],
        "dolvol",
        F.lit(1).alias("source"),
    )


def crsp_fields(df: DataFrame, freq: str = "m") -> DataFrame:
    """Standard fields and flags from the reference exchange feed (columns carry mth / dly prefixes)."""
    p = "mth" if freq == "m" else "dly"
    hi, lo = (("mthaskhi", "mthbidlo") if freq == "m" else ("dlyhigh", "dlylow"))
    prc = F.col(f"{p}prc")
    regular = F.col("conditionaltype") == "RW"
    main = {"N": 1, "A": 2, "Q": 3}
    common = (
        (F.col("securitytype") == "EQTY")
        & (F.col("securitysubtype") == "COM")
        & (F.col("sharetype") == "NS")
        & F.col("issuertype").isin("ACOR", "CORP")
        & (F.col("usincflg") == "Y")
    )
    code = None
    for x, c in main.items():
        hit = (F.col("primaryexch") == x) & regular
        code = F.when(hit, c) if code is None else code.when(hit, c)
    flag = F.col(f"{p}prcflg")
    positive = lambda v: F.when((prc > 0) & (F.col(v) > 0), F.col(v))
    return df.select(
        "permno",
        "permco",
        F.col(f"{p}caldt").cast("date").alias("date"),
        F.when(flag == "BA", 1).when(flag == "TR", 0).alias("bidask"),
        prc.alias("prc"),
        (F.col("shrout") / 1000).alias("shrout"),
        F.col(f"{p}ret").alias("ret"),
        F.col(f"{p}retx").alias("retx"),
        F.col(f"{p}cumfacshr").alias("cfacshr"),
        F.col(f"{p}vol").alias("vol"),
        positive(hi).alias("prc_high"),
        positive(lo).alias("prc_low"),
        code.alias("exchcd"),
        (F.col("primaryexch").isin(list(main)) & regular).cast("int").alias("exch_main"),
        F.when(common, 10).alias("shrcd"),
        (prc * F.col("shrout") / 1000).alias("me"),
    )


def main_exchange(df: DataFrame) -> DataFrame:
    """Exchange -> country, 'multi national' when an exchange serves several, with the main flag."""
    country = F.when(F.countDistinct("excntry") > 1, "multi national").otherwise(F.max("excntry"))
    return (
        df.filter(F.col("excntry").isNotNull() & F.col("exchg").isNotNull())
        .groupBy("exchg")
        .agg(country.alias("excntry"))
        .withColumn(
            "exch_main",
            ((F.col("excntry") != "multi national") & ~F.col("exchg").isin(SPECIAL_EXCHANGES)).cast("int"),
        )
    )


def firm_shares(quarterly: DataFrame, annual: DataFrame) -> DataFrame:
    """Reported shares and adjustment factors from quarterly and annual filings of the standard format."""
    std = (
        (F.col("indfmt") == "INDL") & (F.col("datafmt") == "STD") & (F.col("popsrc") == "D") & (F.col("consol") == "C")
    )
    def take(df, s, a):
        ok = std & F.col(s).isNotNull() & F.col(a).isNotNull()
        return df.filter(ok).select("gvkey", "datadate", F.col(s).alias("csho_fund"), F.col(a).alias("ajex_fund"))

    return take(quarterly, "cshoq", "ajexq").unionByName(take(annual, "csho", "ajex"))


def comp_daily(na: DataFrame, world: DataFrame, shares: DataFrame, fx: DataFrame) -> DataFrame:
    """Daily quotes of two vendors' files in USD: prices, market equity, volume, index, dividends."""
    quoted = lambda c, unit: F.when(F.col("prcstd") != 5, div(F.col(c), unit))
    base = ["gvkey", "iid", "datadate", "tpci", "exchg", "prcstd", "curcdd", "ajexdi", "curcddv", "div", "divd", "divsp"]
    unit = F.col("qunit")
    g = world.select(
        *base,
        div("prccd", unit).alias("prc_local"),
        quoted("prchd", unit).alias("prc_high_lcl"),
        quoted("prcld", unit).alias("prc_low_lcl"),
        "cshtrd",
        (F.col("cshoc") / 1e6).alias("cshoc"),
        (div(div("prccd", unit), "ajexdi") * F.col("trfd")).alias("ri_local"),
    )
    one = F.lit(1.0)
    n = na.join(shares.withColumnRenamed("ddate", "datadate"), ["gvkey", "datadate"], "left").select(
        *base,
        F.col("prccd").alias("prc_local"),
        quoted("prchd", one).alias("prc_high_lcl"),
        quoted("prcld", one).alias("prc_low_lcl"),
        volume_by_era("datadate", "cshtrd", "exchg", 14).alias("cshtrd"),
        F.coalesce(F.col("cshoc") / 1e6, F.col("csho_fund") * div("ajex_fund", "ajexdi")).alias("cshoc"),
        (div("prccd", "ajexdi") * F.col("trfd")).alias("ri_local"),
    )
    # dealt by security and month: equal rows meet, and monthly aggregations of the result move nothing more
    both = n.unionByName(g).withColumn("eom", F.last_day("datadate")).repartition("gvkey", "iid", "eom").distinct()
    rates = fx.select("datadate", F.col("curcdd"), "fx")
    div_rates = fx.select("datadate", F.col("curcdd").alias("curcddv"), F.col("fx").alias("fx_div"))
    usd = both.join(rates, ["curcdd", "datadate"], "left").join(div_rates, ["curcddv", "datadate"], "left")
    local, rate = F.col("prc_local"), F.col("fx")
    pay = lambda c: F.coalesce(F.col(c), F.lit(0.0)) * F.col("fx_div")
    return usd.select(
        "gvkey", "iid", "datadate", "tpci", "exchg", "prcstd", "curcdd", "prc_local", "ajexdi", "cshtrd", "cshoc", "ri_local", "fx",
        (local * rate).alias("prc"),
        (F.col("prc_high_lcl") * rate).alias("prc_high"),
        (F.col("prc_low_lcl") * rate).alias("prc_low"),
        (local * rate * F.col("cshoc")).alias("me"),
        (F.col("cshtrd") * local * rate).alias("dolvol"),
        (F.col("ri_local") * rate).alias("ri"),
        pay("div").alias("div_tot"),
        pay("divd").alias("div_cash"),
        pay("divsp").alias("div_spc"),
        "eom",
    )


def comp_monthly(from_days: DataFrame, from_months: DataFrame) -> DataFrame:
    """One month row per security: the daily-based row (source 1) where both exist. Both sides have the same
    columns."""
    rows.same_columns(from_days, from_months)
    both = from_days.unionByName(from_months)
    return rows.prefer_source(both, ["gvkey", "iid", "eom"], "source", 1).drop("source")


def obs_main_flag(df: DataFrame) -> DataFrame:
    """1 for a security-month recorded once, or for the reference source when recorded twice. Months of a firm
    whose security has no number are one security; rows without a firm are recorded once."""
    n = df.filter(F.col("gvkey").isNotNull()).groupBy("gvkey", F.col("iid").alias("iid__"), "eom").agg(F.count(F.lit(1)).alias("n__"))
    same = (df.gvkey == n.gvkey) & df.iid.eqNullSafe(n.iid__) & (df.eom == n.eom)
    single = F.coalesce("n__", F.lit(0)) <= 1
    return df.join(n, same, "left").select(df["*"], (single | (F.col("source_crsp") == 1)).cast("int").alias("obs_main"))


def world_panel_daily(crsp: DataFrame, comp: DataFrame, months: DataFrame) -> DataFrame:
    """Union of two harmonised daily files. The main-row flag is that of the security's month in ``months`` (the
    monthly world panel), since a month has many days; days of no such month have none."""
    flag = months.groupBy("id", "eom").agg(F.max("obs_main").alias("obs_main"))
    return rows.union_relaxed(crsp, comp).join(flag, ["id", "eom"], "left")


def next_return(panel: DataFrame) -> DataFrame:
    """Adds the excess return of the next month, NULL if that month is missing."""
    w = Window.partitionBy("id").orderBy("eom")
    return panel.withColumn("ret_exc_lead1m", F.when(F.lead("ret_lag_dif").over(w) == 1, F.lead("ret_exc").over(w)))


def world_panel(crsp: DataFrame, comp: DataFrame) -> DataFrame:
    """Union of two harmonised security files with the next month's return and the main-row flag."""
    return obs_main_flag(next_return(rows.union_relaxed(crsp, comp)))


def crsp_security(df: DataFrame, delist: DataFrame, rates: DataFrame, freq: str = "m") -> DataFrame:
    """Volume eras, dividends, delisting returns, excess returns and company equity, one row per (permno, date)."""
    w = Window.partitionBy("permno").orderBy("date")
    scaled = 100 if freq == "m" else 1
    out = (
        df.withColumn("vol", volume_by_era("date", "vol", "exchcd", 3))
        .withColumns({"dolvol": F.abs("prc") * F.col("vol"), "div_tot": implied_dividend(w)})
        .withColumn("key__", month_index("date") if freq == "m" else F.col("date"))
    )
    key = month_index("delistingdt") if freq == "m" else F.col("delistingdt")
    d = delist.withColumn("key__", key).drop("delistingdt")
    out = out.join(d, ["permno", "key__"], "left").withColumn(
        "ret",
        delist_code_return(
            F.col("ret"), F.col("delret"), F.col("delreasontype"), F.col("delactiontype"),
            F.col("delpaymenttype"), F.col("delstatustype"),
        ),
    )
    out = excess_return(out, rates, "date", freq)
    out = company_total(out, ["permco", "date"], "me", "me_company")
    out = out.withColumns({c: F.col(c) * scaled for c in ("vol", "dolvol")})
    return out.drop("key__", "delret", "delreasontype", "delactiontype", "delpaymenttype", "delstatustype")


def comp_security(
    df: DataFrame, status: DataFrame, rates: DataFrame, exchanges: DataFrame, freq: str = "m"
) -> DataFrame:
    """Returns, delistings, excess returns and exchange flags for the accounting vendor's file."""
    ids = ["gvkey", "iid"]
    rets = index_returns(df, ids, "datadate", freq)
    out = df.join(rets, [*ids, "datadate"], "left")
    out = apply_delisting(out, delist_dates(rets, status, ids, "datadate"), ids, "datadate", ["ret", "ret_local"])
    out = excess_return(out, rates, "datadate", freq)
    return out.join(exchanges, "exchg", "left").drop("ri", "ri_local")


def harmonise_comp(df: DataFrame) -> DataFrame:
    """Identifiers and flags of the accounting vendor's file in the common schema."""
    return df.withColumns(
        {
            "id": composite_id("gvkey", "iid"),
            "permno": F.lit(None).cast("long"),
            "permco": F.lit(None).cast("long"),
            "common": F.coalesce(F.col("tpci") == "0", bool_false()).cast("int"),
            "bidask": F.coalesce(F.col("prcstd") == 4, bool_false()).cast("int"),
            "crsp_shrcd": typed_null(),
            "crsp_exchcd": typed_null(),
            "me_company": F.col("me"),
            "source_crsp": F.lit(0),
        }
    )


def harmonise_crsp(df: DataFrame) -> DataFrame:
    """Identifiers and flags of the reference exchange file in the common schema."""
    return df.withColumns(
        {
            "id": F.col("permno"),
            "excntry": F.lit("USA"),
            "common": F.coalesce(F.col("shrcd").isin(10, 11, 12), bool_false()).cast("int"),
            "primary_sec": F.lit(1),
            "curcd": F.lit("USD"),
            "fx": F.lit(1.0),
            "eom": F.last_day("date"),
            "prc_local": F.col("prc"),
            "ret_local": F.col("ret"),
            "ret_lag_dif": F.lit(1).cast("long"),
            "source_crsp": F.lit(1),
        }
    )
