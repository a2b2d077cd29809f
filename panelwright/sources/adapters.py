"""Shape the driver tables into the panels the operators expect.

The vendor tables are not available, so trade lines stand in for quotes: a supplier (or a part)
is a security, its region (or nation) the country, extended price the market value. Each adapter
reduces the fact table with one keyed aggregation (combined map-side), after which a security has
at most one row per day or month. That calendar bound is what makes the per-security windows
further on safe: no window partition can grow with the size of the fact table.

Sums of money are rounded to the scale of the inputs, which removes the order-of-addition noise
and makes every later comparison reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_index
from ..functions.nulls import div
from .scratch import stage
from .tables import Tables


def _security_dims(t: Tables, entity: str, country: str) -> DataFrame:
    if entity == "supplier":
        own = t.supplier.select(
            F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("n_nationkey")
        )
    else:
        own = t.part.select(
            F.col("p_partkey").alias("id"), (F.col("p_partkey") % 25).cast("int").alias("n_nationkey")
        )
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    label = "r_name" if country == "region" else "n_name"
    return own.join(geo, "n_nationkey").select(
        "id", F.col(label).alias("excntry"), "n_nationkey", "n_regionkey"
    )


def _known(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows without a key; stated once here so that every consumer shares one scan plan."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


def _trades(t: Tables, entity: str, grain: str) -> DataFrame:
    key = "l_suppkey" if entity == "supplier" else "l_partkey"
    day = F.to_date("l_shipdate")
    unit = div("l_extendedprice", "l_quantity")
    return (
        _known(t.lineitem, key, "l_shipdate").select(
            F.col(key).alias("id"),
            (F.last_day(day) if grain == "eom" else day).alias(grain),
            "l_quantity",
            "l_extendedprice",
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
            unit.alias("unit"),
        )
        .groupBy("id", grain)
        .agg(
            F.sum("l_quantity").alias("tvol"),
            F.round(F.sum("l_extendedprice"), 2).alias("me"),
            F.round(F.sum("net"), 4).alias("dolvol"),
            F.max("unit").alias("prc_high"),
            F.min("unit").alias("prc_low"),
        )
    )


def _flags(seq: str) -> dict:
    """Deterministic listing flags from the security id."""
    i = F.col("id")
    crsp = F.col("n_regionkey") == 1
    return {
        "source_crsp": crsp.cast("int"),
        "common": (i % 10 != 3).cast("int"),
        "primary_sec": (i % 11 != 5).cast("int"),
        "exch_main": (i % 13 != 7).cast("int"),
        "obs_main": (i % 17 != 9).cast("int"),
        "crsp_exchcd": F.when(crsp, (i % 3 + 1).cast("int")),
        "comp_exchg": F.when(~crsp, F.when(i % 4 == 0, 11).otherwise(14)),
        "curcd": F.when(crsp, F.lit("USD")).otherwise(
            F.concat(F.lit("C"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        ),
        "gvkey": F.lpad((F.floor(i / 2)).cast("string"), 6, "0"),
        "iid": F.concat(F.lpad((i % 2 + 1).cast("string"), 2, "0"), F.when(i % 5 == 0, "W").otherwise("")),
        "permco": F.floor(i / 2).cast("long"),
        "shares": 1 + (i % 50) / F.lit(2.0) + (F.col(seq) % 5) / F.lit(4.0),
        "adjfct": 1 + (F.floor(F.col(seq) / 12) % 3) / F.lit(2.0),
    }


def _with_returns(df: DataFrame, time: str, gap) -> DataFrame:
    w = Window.partitionBy("id").orderBy(time)
    seq = "midx" if time == "eom" else "didx"
    return (
        df.withColumn("prc_l", F.lag("prc").over(w))
        .withColumn("ret_lag_dif", gap(w).cast("long"))
        .withColumn("ret", div("prc", "prc_l") - 1)
        .withColumn("ret_local", F.when((F.col("id") + F.col(seq)) % 13 == 0, F.col("ret") * 0).otherwise(F.col("ret")))
        .withColumn("ret_exc", F.col("ret") - 0.002)
        .drop("prc_l")
    )


def security_month(t: Tables, entity: str = "supplier", country: str = "region") -> DataFrame:
    """Security x month panel, unique on (id, eom)."""
    base = (
        _trades(t, entity, "eom")
        .join(_security_dims(t, entity, country), "id")
        .withColumn("midx", month_index("eom"))
        .withColumns(_flags("midx"))
        .withColumn("prc", div("me", "tvol"))
        .withColumns(
            {
                "div_tot": F.when(F.col("midx") % 3 == 0, F.col("prc_low") * 0.01).otherwise(0.0),
                "div_spc": F.when(F.col("midx") % 12 == 0, F.col("prc_low") * 0.005).otherwise(0.0),
            }
        )
    )
    out = _with_returns(base, "eom", lambda w: F.col("midx") - F.lag("midx").over(w))
    w = Window.partitionBy("id").orderBy("eom")
    return out.withColumn(
        "ret_exc_lead1m",
        F.when(F.lead("ret_lag_dif").over(w) == 1, F.lead("ret_exc").over(w)),
    ).drop("n_nationkey", "n_regionkey")


def security_day(t: Tables, entity: str = "supplier", country: str = "region") -> DataFrame:
    """Security x day panel, unique on (id, date)."""
    base = (
        _trades(t, entity, "date")
        .join(_security_dims(t, entity, country), "id")
        .withColumns(
            {
                "eom": F.last_day("date"),
                "midx": month_index("date"),
                "didx": F.datediff("date", F.lit("1990-01-01").cast("date")),
                "prc": div("me", "tvol"),
            }
        )
        .withColumns(_flags("midx"))
        .withColumn("bidask", ((F.col("id") + F.col("didx")) % 7 == 0).cast("int"))
        .withColumn("tvol", F.when((F.col("id") + F.col("didx")) % 19 == 0, 0.0).otherwise(F.col("tvol")))
    )
    out = _with_returns(base, "date", lambda w: F.col("didx") - F.lag("didx").over(w))
    return out.drop("n_nationkey", "n_regionkey")


def factor_series(t: Tables, grain: str = "eom", country: str = "region") -> DataFrame:
    """Five country-level factor series per month or day, derived from the trade lines."""
    day = F.to_date("l_shipdate")
    ext = F.col("l_extendedprice")
    flag_share = lambda f: F.sum(F.when(F.col("l_returnflag") == f, ext).otherwise(0.0))
    # written, so that its size is known before the trade lines are shuffled for the join
    dims = stage(_security_dims(t, "supplier", country).select("id", "excntry"), "dims")
    out = (
        _known(t.lineitem, "l_suppkey", "l_shipdate").withColumn("id", F.col("l_suppkey"))
        .withColumn(grain, F.last_day(day) if grain == "eom" else day)
        .join(dims, "id")
        .groupBy("excntry", grain)
        .agg(
            F.sum(ext).alias("g"),
            F.sum(ext * F.col("l_discount")).alias("d"),
            F.sum(ext * F.col("l_tax")).alias("x"),
            F.sum("l_quantity").alias("q"),
            F.sum("l_linenumber").alias("l"),
            F.count(F.lit(1)).alias("c"),
            flag_share("R").alias("r"),
            flag_share("A").alias("a"),
        )
    )
    r10 = lambda c: F.round(c, 10)
    return out.select(
        "excntry",
        grain,
        r10(div("d", "g") - 0.05).alias("mktrf"),
        r10(div("x", "g") - 0.04).alias("smb_ff"),
        r10(div("q", "c") / 1000 - 0.0255).alias("hml"),
        r10(div("l", "c") / 100 - 0.04).alias("smb_hxz"),
        r10(div("r", "g") / 10 - 0.033).alias("roe"),
        r10(div("a", "g") / 10 - 0.033).alias("inv"),
    )


def validity_intervals(t: Tables) -> DataFrame:
    """Per customer, the order priority valid from one order day to the day before the next.

    Orders are first reduced to one row per customer and day, so the lead window is bounded by
    the number of calendar days even for a customer that places a third of all orders.
    """
    w = Window.partitionBy("custkey").orderBy("from_date")
    return (
        t.orders.groupBy(
            F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("from_date")
        )
        .agg(F.max("o_orderpriority").alias("code"))
        .withColumn("thru_date", F.date_sub(F.lead("from_date").over(w), 1))
    )


def fx_quotes(t: Tables) -> DataFrame:
    """Monthly quotes against GBP: (fromcurd, tocurd, datadate, exratd)."""
    code = (
        F.when(F.col("c_nationkey") == 24, F.lit("USD"))
        .when(F.col("c_nationkey") == 23, F.lit("GBP"))
        .otherwise(F.concat(F.lit("C"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
    )
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(code.alias("tocurd"), F.trunc(F.to_date("o_orderdate"), "MM").alias("datadate"))
        .agg(F.round(F.avg("o_totalprice") / 100000, 11).alias("exratd"))
        .select(F.lit("GBP").alias("fromcurd"), "tocurd", "datadate", "exratd")
    )


# Accounting items and the amount each one is derived from. The derivation is a rule: item number
# j takes (0.10 + (j mod 17) / 50) of its base amount and is NULL on a fixed (firm, quarter, j) grid.
ACCOUNT_ITEMS: dict[str, str] = {
    "at": "cum", "act": "cum", "lct": "cum", "lt": "cum", "che": "g", "invt": "r", "rect": "a",
    "ppegt": "cum", "ppent": "cum", "intan": "o", "ao": "a", "aco": "x", "ap": "r", "lco": "x",
    "lo": "a", "dlc": "o", "dltt": "g", "txp": "x", "txditc": "x", "txdb": "d", "itcb": "d",
    "seq": "cum", "ceq": "cum", "pstk": "x", "pstkrv": "x", "pstkl": "x", "icapt": "cum",
    "mib": "d", "re": "g", "gdwl": "o", "ivao": "d", "ivst": "d", "sale": "g", "revt": "g",
    "cogs": "r", "xsga": "a", "xopr": "o", "xint": "x", "dp": "d", "txt": "x", "xrd": "d",
    "xad": "x", "xlr": "a", "dvt": "x", "dv": "x", "spi": "d", "nopi": "x", "mii": "d", "pi": "a",
    "xi": "x", "do": "x", "xido": "x", "ib": "r", "ni": "r", "gp": "o", "oibdp": "a",
    "ebitda": "a", "oiadp": "r", "ebit": "r", "capx": "d", "oancf": "a", "wcapt": "x",
    "prstkc": "d", "sstk": "d", "purtshr": "x", "dltr": "d", "dltis": "a", "ltdch": "x",
    "dlcch": "x", "fincf": "d", "fiao": "x", "txbcof": "x", "emp": "q",
}


def _quarter_amounts(t: Tables) -> DataFrame:
    """Per supplier and calendar quarter: the base amounts the accounting items come from."""
    ext = F.col("l_extendedprice")
    day = F.to_date("l_shipdate")
    part = lambda c, v: F.round(F.sum(F.when(F.col(c) == v, ext).otherwise(0.0)), 2)
    qend = F.last_day(F.add_months(F.trunc(day, "quarter"), 2))
    w = Window.partitionBy("id").orderBy("datadate").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _known(t.lineitem, "l_suppkey", "l_shipdate").groupBy(F.col("l_suppkey").alias("id"), qend.alias("datadate"))
        .agg(
            F.round(F.sum(ext), 2).alias("g"),
            F.round(F.sum(ext * F.col("l_discount")), 4).alias("d"),
            F.round(F.sum(ext * F.col("l_tax")), 4).alias("x"),
            part("l_returnflag", "R").alias("r"),
            part("l_returnflag", "A").alias("a"),
            part("l_linestatus", "O").alias("o"),
            F.sum("l_quantity").alias("q"),
        )
        .withColumn("cum", F.round(F.sum("g").over(w), 2))
        .withColumn("qidx", (F.year("datadate") * 4 + F.quarter("datadate")).cast("int"))
    )


def _items() -> dict:
    return {
        name: F.expr(
            f"CASE WHEN (id + 3 * qidx + {j}) % {9 + j % 5} <> 0 "
            f"THEN round({base} * (0.10D + {j % 17} / 50.0D), 6) END"
        )
        for j, (name, base) in enumerate(ACCOUNT_ITEMS.items())
    }


def _firm_keys() -> dict:
    return {
        "gvkey": F.lpad(F.col("id").cast("string"), 6, "0"),
        "curcd": F.when(F.col("id") % 3 == 0, "USD").when(F.col("id") % 3 == 1, "GBP").otherwise("C07"),
    }


def firm_accounting(t: Tables, freq: str = "annual") -> DataFrame:
    """Firm accounts at fiscal dates: every December (annual) or every quarter end."""
    df = _quarter_amounts(t).withColumns(_items()).withColumns(_firm_keys())
    extra = {
        "ni_qtr": F.round(F.col("r") * 0.2, 4),
        "sale_qtr": F.round(F.col("g") * 0.9, 4),
        "ocf_qtr": F.round(F.col("a") * 0.3, 4),
        "me_fiscal": F.when(F.col("id") % 9 != 4, F.round(F.col("cum") * 0.8, 4)),
    }
    df = df.withColumns(extra)
    if freq == "annual":
        df = df.filter(F.month("datadate") == 12)
    return df.drop("id", "g", "d", "x", "r", "a", "o", "q", "cum", "qidx")


def quarterly_ytd(t: Tables) -> DataFrame:
    """Quarterly filings with year-to-date flows (saley, iby) and some missing quarters."""
    w = Window.partitionBy("id", "fyearq").orderBy("fqtr").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _quarter_amounts(t)
        .filter((F.col("id") + F.col("qidx")) % 11 != 0)
        .withColumns(_firm_keys())
        .withColumns(
            {
                "fyearq": F.year("datadate").cast("int"),
                "fqtr": F.quarter("datadate").cast("int"),
                "fyr": F.lit(12),
            }
        )
        .withColumns(
            {
                "saley": F.round(F.sum("g").over(w), 2),
                "iby": F.round(F.sum("r").over(w), 2),
            }
        )
        .select("gvkey", F.col("curcd").alias("curcdq"), "datadate", "fyr", "fyearq", "fqtr", "saley", "iby")
    )


def industry_codes(t: Tables) -> DataFrame:
    """A SIC-like four-digit code per part."""
    return t.part.select(
        F.col("p_partkey").alias("id"),
        ((F.col("p_size") * 97 + F.col("p_partkey") * 31) % 10000).cast("int").alias("sic"),
    )


# Stand-ins for the vendors' raw tables: the driver table each comes from, and its columns as expressions that
# Spark and DuckDB read alike (base_sql writes the same rows for the statements).
def _day(c: str) -> str:
    return f"CAST({c} AS DATE)"


def _code(c: str, width: int = 6) -> str:
    return f"lpad(CAST({c} AS STRING), {width}, '0')"


def _format(flag: str, odd: str) -> dict[str, str]:
    return {"indfmt": f"CASE WHEN {flag} = '{odd}' THEN 'FS' ELSE 'INDL' END", "datafmt": "'STD'", "popsrc": "'D'", "consol": "'C'"}


RAW_TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "comp_funda": ("orders", {"gvkey": _code("o_custkey"), "datadate": _day("o_orderdate"), "sich": "CASE WHEN o_orderkey % 5 <> 0 THEN 100 + o_custkey % 9900 END", "naicsh": "110000 + o_custkey % 800", "csho": "o_totalprice", "ajex": "CASE WHEN o_orderstatus <> 'P' THEN 1.5 END", **_format("o_orderpriority", "5-LOW")}),
    "comp_fundq": ("lineitem", {"gvkey": _code("l_suppkey"), "datadate": _day("l_shipdate"), "cshoq": "CASE WHEN l_linenumber < 6 THEN l_quantity END", "ajexq": "l_tax", **_format("l_returnflag", "A")}),
    "comp_g_funda": ("lineitem", {"gvkey": _code("l_suppkey"), "datadate": f"last_day({_day('l_shipdate')})", "sich": "l_suppkey % 50", "naicsh": "CASE WHEN l_returnflag = 'R' THEN l_suppkey % 7 END"}),
    "crsp_stksecurityinfohist": ("customer", {"permno": "c_custkey", "permco": "c_custkey % 500", "secinfostartdt": "CAST('1992-01-01' AS DATE)", "secinfoenddt": "CASE WHEN c_nationkey % 2 = 0 THEN CAST('1995-06-30' AS DATE) ELSE CAST('2100-12-31' AS DATE) END", "siccd": "100 + c_custkey % 9900", "naics": "c_nationkey"}),
    "comp_co_hgic": ("orders", {"gvkey": f"CASE WHEN o_orderpriority <> '3-MEDIUM' THEN {_code('o_custkey')} END", "indfrom": f"last_day({_day('o_orderdate')})", "indthru": "CASE WHEN o_orderstatus = 'F' THEN CAST('2001-01-01' AS DATE) END", "gsubind": "10101010 + o_custkey % 70"}),
    "comp_g_co_hgic": ("lineitem", {"gvkey": f"CASE WHEN l_suppkey > 1 THEN {_code('l_suppkey')} END", "indfrom": f"last_day({_day('l_shipdate')})", "indthru": "CAST(NULL AS DATE)", "gsubind": "l_linenumber"}),
    "crsp_stkdelists": ("customer", {"permno": "c_custkey", "delistingdt": "CAST('1996-02-28' AS DATE)", "delret": "CASE WHEN c_acctbal > 0 THEN c_acctbal / 10000 END", "delactiontype": "'GDR'", "delstatustype": "c_mktsegment", "delreasontype": "CASE WHEN c_nationkey < 9 THEN 'UNAV' END", "delpaymenttype": "'PRCF'"}),
    "comp_security": ("part", {"gvkey": _code("p_partkey"), "iid": "'01'", "secstat": "CASE WHEN p_size > 20 THEN 'A' ELSE 'I' END", "dlrsni": "CASE WHEN p_size < 10 THEN '02' END", "exchg": "p_size", "excntry": "p_brand"}),
    "comp_g_security": ("customer", {"gvkey": _code("c_custkey"), "iid": "'01W'", "secstat": "'A'", "dlrsni": "CAST(NULL AS STRING)", "exchg": "c_nationkey", "excntry": "c_mktsegment"}),
    "comp_company": ("supplier", {"gvkey": _code("s_suppkey"), "prirow": "'01W'", "priusa": _code("s_nationkey", 2), "prican": "CASE WHEN s_acctbal > 0 THEN '01C' END"}),
    "comp_g_company": ("customer", {"gvkey": _code("c_custkey"), "prirow": _code("c_nationkey", 2), "priusa": "CAST(NULL AS STRING)", "prican": "CAST(NULL AS STRING)"}),
    "comp_sec_history": ("orders", {"gvkey": _code("o_custkey"), "item": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'PRIHISTUSA' WHEN o_orderpriority = '2-HIGH' THEN 'PRIHISTCAN' ELSE 'OTHER' END", "itemvalue": "o_orderstatus", "effdate": _day("o_orderdate"), "thrudate": "CAST(NULL AS DATE)"}),
    "comp_g_sec_history": ("lineitem", {"gvkey": _code("l_suppkey"), "item": "CASE WHEN l_returnflag = 'R' THEN 'PRIHISTROW' ELSE 'OTHER' END", "itemvalue": "l_linestatus", "effdate": _day("l_shipdate"), "thrudate": _day("l_shipdate")}),
    "crsp_mcti": ("orders", {"caldt": _day("o_orderdate"), "t30ret": "o_totalprice / 100000000"}),
    "ff_factors_monthly": ("lineitem", {"date": _day("l_shipdate"), "rf": "l_discount / 100"}),
    "comp_r_ex_codes": ("nation", {"exchgdesc": "n_name", "exchgcd": "n_nationkey"}),
    "crsp_ccmxpf_lnkhist": ("customer", {"lpermno": "c_custkey", "linkdt": "CASE WHEN c_nationkey % 3 <> 0 THEN CAST('1993-05-01' AS DATE) END", "linkenddt": "CASE WHEN c_nationkey % 4 <> 0 THEN CAST('1997-05-01' AS DATE) END", "linktype": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'LX' WHEN c_acctbal > 5000 THEN 'LU' ELSE 'LC' END", "gvkey": _code("c_custkey"), "liid": "'01'"}),
}


def raw_table(t: Tables, name: str) -> DataFrame:
    """One stand-in of :data:`RAW_TABLES`."""
    source, columns = RAW_TABLES[name]
    return t.read(source).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
