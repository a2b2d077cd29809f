"""Aggregations and per-entity window operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.nulls import div
from ..operators import accounting, crosssection, market, panel, security, spread
from ..sources import adapters
from .base_sql import QYTD, accounts, dense, factors, sd, sm, with_
from .markets import market_sql, qdisc
from .registry import query

WI = "WINDOW w AS (PARTITION BY id ORDER BY eom)"


@query(
    "group_agg_basic",
    with_(sm()) + "SELECT excntry, eom, min(me) AS lo, max(me) AS hi, avg(ret) AS m, sum(tvol) AS s, count(ret) AS n, count(*) AS k, arg_min(id, me) AS first_id FROM sm GROUP BY 1, 2",
    "m s",
)
def _basic(t):
    return adapters.security_month(t).groupBy("excntry", "eom").agg(
        F.min("me").alias("lo"), F.max("me").alias("hi"), F.avg("ret").alias("m"), F.sum("tvol").alias("s"),
        F.count("ret").alias("n"), F.count(F.lit(1)).alias("k"), F.min_by("id", "me").alias("first_id"),
    )


@query("sas_sum_agg", with_(accounts()) + "SELECT gvkey, sum(CASE WHEN month(datadate) = 12 AND year(datadate) < 1997 THEN xrd END) AS early, coalesce(sum(CASE WHEN year(datadate) < 1996 THEN spi END), 0) AS zeroed FROM acc GROUP BY 1", "early:6 zeroed:6")
def _sas_sum(t):
    y = F.year("datadate")
    return adapters.firm_accounting(t).groupBy("gvkey").agg(
        F.sum(F.when(y < 1997, F.col("xrd"))).alias("early"),
        F.coalesce(F.sum(F.when(y < 1996, F.col("spi"))), F.lit(0.0)).alias("zeroed"),
    )


@query(
    "breakpoints_30_70",
    with_(sm("part"), "e AS (SELECT *, row_number() OVER (PARTITION BY excntry, eom ORDER BY prc) AS rn, count(*) OVER (PARTITION BY excntry, eom) AS k FROM sm WHERE prc IS NOT NULL)")
    + f"SELECT excntry, eom, count(*) AS n, {qdisc('prc', 0.3, 'rn', 'k')} AS bp_p30, {qdisc('prc', 0.7, 'rn', 'k')} AS bp_p70 FROM e GROUP BY 1, 2",
)
def _bp(t):
    return crosssection.quantile_disc(adapters.security_month(t, "part"), ["excntry", "eom"], "prc", {"bp_p30": 0.3, "bp_p70": 0.7}, count="n")


SPECIAL = ", ".join(map(str, security.SPECIAL_EXCHANGES))


@query(
    "count_distinct_case",
    "WITH x AS (SELECT CAST(CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey ELSE 100 + s_suppkey % 15 END AS INT) AS exchg, CASE WHEN s_suppkey % 13 <> 0 THEN n_name END AS excntry FROM supplier JOIN nation ON s_nationkey = n_nationkey)\n"
    + f"SELECT exchg, excntry, CAST(excntry <> 'multi national' AND exchg NOT IN ({SPECIAL}) AS INT) AS exch_main FROM (SELECT exchg, CASE WHEN count(DISTINCT excntry) > 1 THEN 'multi national' ELSE max(excntry) END AS excntry FROM x WHERE excntry IS NOT NULL GROUP BY 1)",
)
def _exch(t):
    k = F.col("s_suppkey")
    df = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    df = df.select(F.when(k % 3 == 0, F.col("s_nationkey")).otherwise(100 + k % 15).cast("int").alias("exchg"), F.when(k % 13 != 0, F.col("n_name")).alias("excntry"))
    return security.main_exchange(df)


@query(
    "month_high_low",
    with_(sd(), "m AS (SELECT id, eom, max(prc) AS hi, min(prc) AS lo FROM sd WHERE bidask = 0 GROUP BY 1, 2), k AS (SELECT id, eom, max(date) AS last, CASE WHEN (id + max(midx)) % 4 = 0 THEN 'BA' ELSE 'TR' END AS prcflg FROM sd GROUP BY 1, 2)")
    + "SELECT id, eom, prcflg, CASE WHEN prcflg = 'TR' THEN hi END AS askhi, CASE WHEN prcflg = 'TR' THEN lo END AS bidlo FROM k LEFT JOIN m USING (id, eom)",
)
def _mhl(t):
    d = adapters.security_day(t).withColumn("prcflg", F.when(F.col("bidask") == 1, "BA").otherwise("TR"))
    m = d.groupBy("id", "eom").agg(F.max("midx").alias("mx")).select(
        "id", "eom", F.when((F.col("id") + F.col("mx")) % 4 == 0, "BA").otherwise("TR").alias("prcflg")
    )
    return security.month_high_low(m, d, "id").select("id", "eom", "prcflg", "askhi", "bidlo")


@query(
    "adjusted_month_agg",
    with_(
        sd(),
        """q AS (SELECT gvkey, iid, eom, date AS datadate, prc, prc_high, prc_low, prc AS prc_local, curcd AS curcdd, adjfct + (didx % 3) / 10.0::DOUBLE AS ajexdi,
    CASE WHEN didx % 4 = 1 THEN 5 ELSE 3 + bidask END AS prcstd, tvol AS cshtrd, dolvol, prc_low * 0.01 AS div_tot, prc_low * 0.008 AS div_cash, prc_low * 0.002 AS div_spc FROM sd)""",
        """v AS (SELECT *, greatest(max(prc / ajexdi) OVER w, max(prc_high / ajexdi) OVER w) * ajexdi AS hi, least(min(prc / ajexdi) OVER w, min(prc_low / ajexdi) OVER w) * ajexdi AS lo,
    sum(div_tot / ajexdi) OVER w * ajexdi AS dt, sum(div_cash / ajexdi) OVER w * ajexdi AS dc, sum(div_spc / ajexdi) OVER w * ajexdi AS ds, sum(cshtrd / ajexdi) OVER w * ajexdi AS sh, sum(dolvol) OVER w AS dv
    FROM q WINDOW w AS (PARTITION BY gvkey, iid, eom))""",
    )
    + """SELECT gvkey, iid, eom, datadate, curcdd, prc_local, prc, ajexdi, hi AS prc_high, lo AS prc_low, dt AS div_tot, dc AS div_cash, ds AS div_spc, sh AS cshtrm, dv AS dolvol, 1 AS source
FROM (SELECT *, max(datadate) OVER (PARTITION BY gvkey, iid, eom) AS top FROM v WHERE prcstd IN (3, 4, 10)) WHERE datadate = top""",
    "div_tot:8 div_cash:8 div_spc:8 cshtrm:6 dolvol:4",
)
def _adj_month(t):
    low = F.col("prc_low")
    d = adapters.security_day(t).select(
        "gvkey", "iid", "eom", F.col("date").alias("datadate"), "prc", "prc_high", "prc_low",
        F.col("prc").alias("prc_local"), F.col("curcd").alias("curcdd"),
        (F.col("adjfct") + (F.col("didx") % 3) / F.lit(10.0)).alias("ajexdi"),
        F.when(F.col("didx") % 4 == 1, 5).otherwise(3 + F.col("bidask")).alias("prcstd"),
        F.col("tvol").alias("cshtrd"), "dolvol",
        (low * 0.01).alias("div_tot"), (low * 0.008).alias("div_cash"), (low * 0.002).alias("div_spc"),
    )
    return security.adjusted_month(d, ["gvkey", "iid"])


@query("company_total", with_(sm()) + "SELECT id, eom, CASE WHEN count(x) OVER w > 0 THEN sum(coalesce(x, 0)) OVER w END AS me_company FROM (SELECT *, CASE WHEN (id + midx) % 3 <> 0 THEN me END AS x FROM sm) WINDOW w AS (PARTITION BY permco, eom)", "me_company:2")
def _company(t):
    df = adapters.security_month(t).withColumn("x", F.when((F.col("id") + F.col("midx")) % 3 != 0, F.col("me")))
    return security.company_total(df, ["permco", "eom"], "x", "me_company").select("id", "eom", "me_company")


@query("max_per_key", with_(sm()) + "SELECT gvkey, eom, max(me) AS me_fiscal FROM sm WHERE primary_sec = 1 AND common = 1 AND obs_main = 1 AND me IS NOT NULL GROUP BY 1, 2")
def _maxkey(t):
    df = adapters.security_month(t).withColumn("me_company", F.col("me"))
    return accounting.market_equity(df, "me_fiscal")


@query(
    "firm_age",
    with_(
        sm(),
        accounts(),
        "a AS (SELECT permco, min(eom) + 0 AS d FROM sm WHERE source_crsp = 1 GROUP BY 1), b AS (SELECT gvkey, make_date(year(min(datadate)) - 1, 12, 31) AS d FROM acc GROUP BY 1), c AS (SELECT gvkey, make_date(year(min(eom)) - 1, 12, 31) AS d FROM sm WHERE source_crsp = 0 GROUP BY 1)",
        "f AS (SELECT id, eom, least(a.d, b.d, c.d, min(eom) OVER (PARTITION BY id)) AS d FROM sm LEFT JOIN a ON sm.permco = a.permco LEFT JOIN b ON sm.gvkey = b.gvkey LEFT JOIN c ON sm.gvkey = c.gvkey)",
    )
    + "SELECT id, eom, (year(eom) - year(d)) * 12 + month(eom) - month(d) AS age FROM f",
)
def _age(t):
    df = adapters.security_month(t)
    listed = df.filter("source_crsp = 1").select("permco", F.col("eom").alias("date"))
    quotes = df.filter("source_crsp = 0").select("gvkey", F.col("eom").alias("datadate"))
    return panel.firm_age(df, listed, adapters.firm_accounting(t).select("gvkey", "datadate"), quotes)


@query("topk_mean", with_(sd()) + "SELECT id, eom, list_avg(list_reverse_sort(list(ret) FILTER (ret IS NOT NULL))[1:5]) AS top5 FROM sd GROUP BY 1, 2", "top5")
def _topk(t):
    top = F.slice(F.sort_array(F.collect_list("ret"), asc=False), 1, 5)
    # at most 31 days per month and security
    return adapters.security_day(t).groupBy("id", "eom").agg(top.alias("a")).select("id", "eom", stats.list_mean(F.col("a")).alias("top5"))


@query("last_over_max", with_(sd()) + "SELECT id, eom, arg_max(prc, date) / max(prc) AS r FROM sd GROUP BY 1, 2", "r")
def _lom(t):
    return adapters.security_day(t).groupBy("id", "eom").agg(div(F.max_by("prc", "date"), F.max("prc")).alias("r"))


@query("unbiased_skew", with_(sm("part")) + "SELECT excntry, eom, skewness(prc) AS s FROM sm GROUP BY 1, 2 HAVING count(prc) >= 3", "s:6")
def _skew(t):
    n = F.count("prc").cast("double")
    return (
        adapters.security_month(t, "part").groupBy("excntry", "eom")
        .agg((F.skewness("prc") * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))).alias("s"), n.alias("n"))
        .filter("n >= 3").drop("n")
    )


@query(
    "cov_var_corr_std",
    with_(sm("part")) + "SELECT excntry, eom, covar_samp(ret, tvol) AS c, var_samp(ret) AS v, covar_samp(ret, tvol) / nullif(sqrt(var_samp(ret) FILTER (tvol IS NOT NULL) * var_samp(tvol) FILTER (ret IS NOT NULL)), 0) AS r, sqrt(var_pop(ret) * count(ret) / nullif(count(ret) - 3, 0)) AS s3 FROM sm WHERE ret IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 3",
    "c:6 v r:7 s3",
)
def _cov(t):
    n = F.count("ret").cast("double")
    sdxy = F.sqrt(F.var_samp("ret") * F.var_samp("tvol"))
    return (
        adapters.security_month(t, "part").filter("ret IS NOT NULL").groupBy("excntry", "eom")
        .agg(F.covar_samp("ret", "tvol").alias("c"), F.var_samp("ret").alias("v"), div(F.covar_samp("ret", "tvol"), sdxy).alias("r"),
             F.sqrt(div(F.var_pop("ret") * n, n - 3)).alias("s3"), n.alias("n"))
        .filter("n > 3").drop("n")
    )


@query(
    "pivot_portfolios",
    with_(sm("part")) + "SELECT excntry, eom, " + ", ".join(f"max(CASE WHEN lab = '{s}_{c}' THEN v END) AS {s}_{c}" for s in ("small", "big") for c in ("low", "mid", "high")) + " FROM (SELECT excntry, eom, CASE WHEN id % 2 = 0 THEN 'small' ELSE 'big' END || '_' || CASE id % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'mid' ELSE 'high' END AS lab, sum(tvol) AS v FROM sm GROUP BY ALL) GROUP BY 1, 2",
)
def _pivot(t):
    i = F.col("id")
    lab = F.concat_ws("_", F.when(i % 2 == 0, "small").otherwise("big"), F.when(i % 3 == 0, "low").when(i % 3 == 1, "mid").otherwise("high"))
    labels = [f"{s}_{c}" for s in ("small", "big") for c in ("low", "mid", "high")]
    df = adapters.security_month(t, "part").withColumn("lab", lab)
    return df.groupBy("excntry", "eom").pivot("lab", labels).agg(F.sum("tvol"))


@query("conditional_pick", with_(sm()) + "SELECT excntry, eom, max(CASE WHEN id % 5 = 2 THEN prc END) AS pick, sum(CASE WHEN id % 5 IN (1, 2) THEN 1 ELSE 0 END) AS legs FROM sm GROUP BY 1, 2")
def _pick(t):
    i = F.col("id") % 5
    return adapters.security_month(t).groupBy("excntry", "eom").agg(F.max(F.when(i == 2, F.col("prc"))).alias("pick"), F.count_if(i.isin(1, 2)).alias("legs"))


# ---- per-entity windows -----------------------------------------------------------------------
@query("lag_lead_diff", with_(sm()) + f"SELECT id, eom, lag(prc) OVER w AS l, lead(prc) OVER w AS f, me - lag(me, 3) OVER w AS d3 FROM sm {WI}", "d3:2")
def _lag(t):
    h = panel.History(adapters.security_month(t), ["id"], "eom")
    return h.add({"l": h.lag("prc", 1), "f": F.lead("prc").over(h.window), "d3": h.diff("me", 3)}).df.select("id", "eom", "l", "f", "d3")


@query("cum_count", with_(sm()) + f"SELECT id, eom, count(id) OVER (PARTITION BY id ORDER BY eom) AS n FROM sm")
def _cum_count(t):
    w = Window.partitionBy("id").orderBy("eom")
    return adapters.security_month(t).select("id", "eom", F.row_number().over(w).alias("n"))


@query("cum_prod_index", with_(sm()) + "SELECT id, eom, product(1 + coalesce(ret, 0)) OVER (PARTITION BY id ORDER BY eom) AS ri FROM sm", "ri")
def _cumprod(t):
    return panel.running_product(adapters.security_month(t), "id", "eom", "ret", "ri").select("id", "eom", "ri")


@query("contiguous_lag", with_(sm("part")) + f"SELECT id, eom, CASE WHEN midx - lag(midx) OVER w = 1 THEN lag(me) OVER w END AS me_l, CASE WHEN lead(midx) OVER w - midx = 1 THEN lead(prc) OVER w END AS prc_f FROM sm {WI}")
def _contig(t):
    df = market.contiguous_lag(adapters.security_month(t, "part"), ["me"])
    return market.contiguous_lead(df, "prc", "prc_f").select("id", "eom", "me_l", "prc_f")


RI = """ri AS (SELECT gvkey, iid, eom AS datadate, midx, 3 + (id + midx) % 4 AS prcstd, prc AS ri, CASE WHEN midx % 30 < 15 THEN curcd ELSE 'EUR' END AS curcd,
    CASE WHEN (id + midx) % 8 <> 0 THEN prc * (1 + midx % 3) END AS ri_local FROM sm)"""
RETS = """rx AS (SELECT *, ri / lag(ri) OVER w - 1 AS ret, ri_local / last_value(ri_local IGNORE NULLS) OVER (PARTITION BY gvkey, iid ORDER BY datadate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 AS rl,
    midx - lag(midx) OVER w AS ret_lag_dif, curcd <> lag(curcd) OVER w AS sw FROM ri WHERE ri IS NOT NULL AND prcstd IN (3, 4, 10) WINDOW w AS (PARTITION BY gvkey, iid ORDER BY datadate)),
rets AS (SELECT gvkey, iid, datadate, ret, CASE WHEN sw THEN ret ELSE rl END AS ret_local, ret_lag_dif FROM rx)"""


def _ri(t):
    m = F.col("midx")
    return adapters.security_month(t).select(
        "gvkey", "iid", F.col("eom").alias("datadate"), (3 + (F.col("id") + m) % 4).alias("prcstd"), F.col("prc").alias("ri"),
        F.when(m % 30 < 15, F.col("curcd")).otherwise("EUR").alias("curcd"),
        F.when((F.col("id") + m) % 8 != 0, F.col("prc") * (1 + m % 3)).alias("ri_local"),
    )


@query("pct_change", with_(sm(), RI, RETS) + "SELECT * FROM rets", "ret ret_local")
def _pct(t):
    return security.index_returns(_ri(t), ["gvkey", "iid"], "datadate", "m")


DELIST = """rts AS (SELECT * REPLACE (CASE WHEN datadate < DATE '2001-01-01' THEN ret_local END AS ret_local) FROM rets),
st AS (SELECT DISTINCT gvkey, iid, CASE WHEN CAST(gvkey AS BIGINT) % 2 = 0 THEN 'I' ELSE 'A' END AS secstat, CASE WHEN CAST(gvkey AS BIGINT) % 4 = 0 THEN '02' ELSE '07' END AS dlrsni FROM ri),
dl AS (SELECT gvkey, iid, max(datadate) AS date_delist FROM rts WHERE ret_local IS NOT NULL AND ret_local <> 0 GROUP BY 1, 2),
dd AS (SELECT gvkey, iid, date_delist, CASE WHEN dlrsni IN ('02', '03') THEN -0.3 ELSE 0.0 END AS dlret FROM dl JOIN st USING (gvkey, iid) WHERE secstat = 'I')"""


@query(
    "delist_adjust",
    with_(sm(), RI, RETS, DELIST)
    + """SELECT gvkey, iid, datadate, CASE WHEN datadate = date_delist THEN (1 + ret) * (1 + dlret) - 1 ELSE ret END AS ret,
  CASE WHEN datadate = date_delist THEN (1 + ret_local) * (1 + dlret) - 1 ELSE ret_local END AS ret_local
FROM rts LEFT JOIN dd USING (gvkey, iid) WHERE date_delist IS NULL OR datadate <= date_delist""",
    "ret ret_local",
)
def _delist(t):
    ids = ["gvkey", "iid"]
    ri = _ri(t)
    # the last local returns are missing, so that delisting comes before the end of the data
    rets = security.index_returns(ri, ids, "datadate", "m").withColumn("ret_local", F.when(F.col("datadate") < "2001-01-01", F.col("ret_local")))
    k = F.col("gvkey").cast("long")
    status = ri.select(*ids).distinct().select(*ids, F.when(k % 2 == 0, "I").otherwise("A").alias("secstat"), F.when(k % 4 == 0, "02").otherwise("07").alias("dlrsni"))
    dl = security.delist_dates(rets, status, ids, "datadate")
    return security.apply_delisting(rets, dl, ids, "datadate", ["ret", "ret_local"]).drop("ret_lag_dif")


CODES = """c AS (SELECT id, eom, CASE WHEN (id + midx) % 6 <> 0 THEN ret END AS ret, CASE WHEN (id + midx) % 4 = 0 THEN -0.1::DOUBLE END AS delret,
  CASE id % 3 WHEN 0 THEN 'UNAV' WHEN 1 THEN 'LP' ELSE 'ACQ' END AS reason, CASE WHEN midx % 2 = 0 THEN 'GDR' ELSE 'MER' END AS action FROM sm)"""
PERF = ", ".join(f"'{r}'" for r in security.PERFORMANCE_REASONS)


@query(
    "delist_code_adjust",
    with_(sm(), CODES, f"d AS (SELECT *, CASE WHEN delret IS NULL AND action = 'GDR' AND (reason = 'UNAV' OR reason IN ({PERF})) THEN -0.3::DOUBLE ELSE delret END AS dl FROM c)")
    + "SELECT id, eom, (CASE WHEN ret IS NULL AND dl IS NOT NULL THEN 0.0 ELSE ret END + 1) * (coalesce(dl, 0) + 1) - 1 AS ret FROM d",
    "ret",
)
def _delist_code(t):
    i, m = F.col("id"), F.col("midx")
    c = security.delist_code_return(
        F.when((i + m) % 6 != 0, F.col("ret")), F.when((i + m) % 4 == 0, F.lit(-0.1)),
        F.when(i % 3 == 0, "UNAV").when(i % 3 == 1, "LP").otherwise("ACQ"), F.when(m % 2 == 0, "GDR").otherwise("MER"),
        F.lit("PRCF"), F.lit("VCL"),
    )
    return adapters.security_month(t).select("id", "eom", c.alias("ret"))


@query("implied_dividend", with_(sm()) + f"SELECT id, eom, CASE WHEN lag(adjfct) OVER w <> 0 THEN (ret - (ret - 0.01)) * lag(prc) OVER w * (adjfct / lag(adjfct) OVER w) END AS d FROM sm {WI}", "d:6")
def _impl(t):
    w = Window.partitionBy("id").orderBy("eom")
    df = adapters.security_month(t).withColumn("retx", F.col("ret") - 0.01)
    return df.select("id", "eom", security.implied_dividend(w, adj="adjfct").alias("d"))


@query(
    "excess_return",
    with_(sd(), factors(), "rf AS (SELECT year(eom) * 12 + month(eom) AS midx, CASE WHEN month(eom) % 3 <> 0 THEN max(hml) / 10 END AS t30ret, max(smb_ff) / 10 AS rf FROM fct GROUP BY 1, eom)")
    + "SELECT id, date, ret - coalesce(t30ret, rf) / 21 AS ret_exc FROM sd LEFT JOIN rf USING (midx)",
    "ret_exc",
)
def _excess(t):
    f = adapters.factor_series(t).groupBy("eom").agg((F.max("hml") / 10).alias("h"), (F.max("smb_ff") / 10).alias("rf"))
    rates = f.select((F.year("eom") * 12 + F.month("eom")).alias("midx"), F.when(F.month("eom") % 3 != 0, F.col("h")).alias("t30ret"), "rf")
    return security.excess_return(adapters.security_day(t).drop("ret_exc"), rates, "date", "d").select("id", "date", "ret_exc")


@query(
    "quarterize",
    with_(QYTD)
    + """SELECT gvkey, fyearq, fqtr, CASE WHEN NOT bad THEN sq END AS saley_q FROM (SELECT *, CASE WHEN n = 1 THEN saley ELSE saley - lag(saley) OVER w END AS sq,
  CASE WHEN n = 1 THEN coalesce(fqtr <> 1, TRUE) ELSE coalesce(fqtr - lag(fqtr) OVER w <> 1, TRUE) END AS bad
FROM (SELECT *, row_number() OVER (PARTITION BY gvkey, fyr, fyearq ORDER BY fqtr) AS n FROM qy) WINDOW w AS (PARTITION BY gvkey, fyr, fyearq ORDER BY fqtr))""",
    "saley_q:2",
)
def _quarterize(t):
    return accounting.quarterize(adapters.quarterly_ytd(t), ["saley"]).select("gvkey", "fyearq", "fqtr", "saley_q")


@query(
    "ttm",
    with_(QYTD, "z AS (SELECT *, saley AS saleq FROM qy)")
    + """SELECT gvkey, fyearq, fqtr, CASE WHEN ok THEN s WHEN fqtr = 4 THEN saley END AS sale FROM (SELECT *, saleq + lag(saleq) OVER w + lag(saleq, 2) OVER w + lag(saleq, 3) OVER w AS s,
  coalesce(lag(curcdq, 3) OVER w = curcdq AND fqtr + lag(fqtr) OVER w + lag(fqtr, 2) OVER w + lag(fqtr, 3) OVER w = 10, FALSE) AS ok FROM z WINDOW w AS (PARTITION BY gvkey, fyr ORDER BY fyearq, fqtr))""",
    "sale:2",
)
def _ttm(t):
    df = adapters.quarterly_ytd(t).withColumn("saleq", F.col("saley"))
    return accounting.cumulate_4q(df, ["saleq"]).select("gvkey", "fyearq", "fqtr", "sale")


def _mom_sql(pairs):
    out = []
    for near, far in pairs:
        a = f"lag(ri_x, {near}) OVER w"
        b = f"lag(ri_x, {far}) OVER w"
        out.append(f"CASE WHEN {b} <> 0 AND count > {far} AND lag(ret_x, {near}) OVER w IS NOT NULL THEN {a} / {b} - 1 END AS ret_{far}_{near}")
    return ", ".join(out)


def _seas_sql(y0, y1, period):
    lags = [f"lag(ret_x, {i}) OVER w" for i in range((y0 - 1) * period, y1 * period)]
    ann = [f"lag(ret_x, {y * period - 1}) OVER w" for y in range(y0, y1 + 1)]
    n, a = len(lags), len(ann)
    return (
        f"CASE WHEN count >= {y1 * period} THEN ({' + '.join(ann)}) / {a} END AS seas_{y0}_{y1}an, "
        f"CASE WHEN count >= {y1 * period} THEN ({' + '.join(lags)} - ({' + '.join(ann)})) / {n - a} END AS seas_{y0}_{y1}na"
    )


MSPINE = """mk AS ({mk}),
s AS (SELECT id, last_day(CAST(unnest(generate_series(date_trunc('month', min(eom)), date_trunc('month', max(eom)), INTERVAL 1 MONTH)) AS DATE)) AS eom FROM sm GROUP BY 1),
b0 AS (SELECT s.id, s.eom, sm.* EXCLUDE (id, eom), ret AS rx FROM s LEFT JOIN sm USING (id, eom)),
b AS (SELECT *, product(1 + coalesce(ret, 0)) OVER w AS ri, product(1 + coalesce(rx, 0)) OVER w AS ri_x, row_number() OVER w AS count, CASE WHEN ret_lag_dif = 1 THEN rx END AS ret_x,
  div_tot * shares AS dv, div_spc * shares AS ds, shares * adjfct AS aux FROM b0 WINDOW w AS (PARTITION BY id ORDER BY eom))""".format(mk="SELECT 1")


def _div_sql(k, base, label):
    return f"CASE WHEN count >= {k} AND me <> 0 THEN sum({base}) OVER (PARTITION BY id ORDER BY eom ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) / me END AS {label}{k}m_me"


def _eqn_sql(k):
    return f"CASE WHEN ri > 0 AND lag(ri, {k}) OVER w > 0 AND me > 0 AND lag(me, {k}) OVER w > 0 AND count > {k} THEN ln(ri / lag(ri, {k}) OVER w) - ln(me / lag(me, {k}) OVER w) END AS eqnpo_{k}m"


def _chs_sql(k):
    return f"CASE WHEN lag(aux, {k}) OVER w <> 0 AND count > {k} THEN aux / lag(aux, {k}) OVER w - 1 END AS chcsho_{k}m"


YIELDS = [f"div{k}m_me" for k in panel.DIVIDEND_MONTHS] + [f"divspc{k}m_me" for k in panel.SPECIAL_MONTHS]
PAYOUT = [f"eqnpo_{k}m" for k in panel.ISSUE_MONTHS]
SEAS = panel.SEASONS
MC_COLS = YIELDS + PAYOUT + [f"chcsho_{k}m" for k in panel.ISSUE_MONTHS] + [f"ret_{j}_{i}" for i, j in panel.MOMENTUM] + [f"seas_{a}_{b}{s}" for a, b in SEAS for s in ("an", "na")]
MC_SQL = (
    "SELECT id, eom, me AS market_equity, "
    + ", ".join(
        [_div_sql(k, "dv", "div") for k in panel.DIVIDEND_MONTHS]
        + [_div_sql(k, "ds", "divspc") for k in panel.SPECIAL_MONTHS]
        + [_eqn_sql(k) for k in panel.ISSUE_MONTHS]
        + [_chs_sql(k) for k in panel.ISSUE_MONTHS]
        + [_mom_sql(panel.MOMENTUM)]
        + [_seas_sql(a, b, 12) for a, b in SEAS]
    )
    + f" FROM b {WI}"
)
MC_SNAP = "SELECT * REPLACE (" + ", ".join(
    [f"CASE WHEN {c} < 1e-5 THEN 0.0 ELSE {c} END AS {c}" for c in YIELDS]
    + [f"CASE WHEN abs({c}) < 1e-5 THEN 0.0 ELSE {c} END AS {c}" for c in PAYOUT]
) + f") FROM ({MC_SQL})"


def _mc(t, **kw):
    df = adapters.security_month(t)
    mk = df.groupBy("excntry", "eom").agg(F.avg("ret_exc").alias("mkt_vw_exc"))
    return panel.market_characteristics(df, mk, **kw)


@query("market_chars_monthly", with_(sm(), MSPINE) + MC_SNAP, " ".join(f"{c}:7" for c in MC_COLS))
def _mcm(t):
    return _mc(t)


@query("momentum", with_(sm(), MSPINE) + f"SELECT id, eom, {_mom_sql(panel.MOMENTUM)} FROM b {WI}", " ".join(f"ret_{j}_{i}:7" for i, j in panel.MOMENTUM))
def _mom(t):
    return _mc(t).select("id", "eom", *[f"ret_{j}_{i}" for i, j in panel.MOMENTUM])


@query("share_change", with_(sm(), MSPINE) + f"SELECT id, eom, {', '.join(_chs_sql(k) for k in panel.ISSUE_MONTHS)} FROM b {WI}", " ".join(f"chcsho_{k}m" for k in panel.ISSUE_MONTHS))
def _chs(t):
    return _mc(t).select("id", "eom", *[f"chcsho_{k}m" for k in panel.ISSUE_MONTHS])


@query("net_payout", with_(sm(), MSPINE) + f"SELECT id, eom, {', '.join(PAYOUT)} FROM ({MC_SNAP})", " ".join(PAYOUT))
def _eqn(t):
    return _mc(t).select("id", "eom", *PAYOUT)


@query("dividend_yield", with_(sm(), MSPINE) + f"SELECT id, eom, {', '.join(YIELDS)} FROM ({MC_SNAP})", " ".join(f"{c}:10" for c in YIELDS))
def _yield(t):
    return _mc(t).select("id", "eom", *YIELDS)


@query("seasonality", with_(sm(), MSPINE) + f"SELECT id, eom, {', '.join(_seas_sql(a, b, 3) for a, b in SEAS)} FROM b {WI}", " ".join(f"seas_{a}_{b}{s}" for a, b in SEAS for s in ("an", "na")))
def _seas(t):
    """The same five blocks on quarters instead of years, so that all of them have data."""
    return _mc(t, period=3).select("id", "eom", *[f"seas_{a}_{b}{s}" for a, b in SEAS for s in ("an", "na")])


@query("rolling_sum_min1", with_(sm()) + "SELECT id, eom, sum(x) OVER (PARTITION BY id ORDER BY eom ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS s FROM (SELECT id, eom, CASE WHEN (id + midx) % 9 < 3 THEN tvol END AS x FROM sm)")
def _rsum(t):
    df = adapters.security_month(t).withColumn("x", F.when((F.col("id") + F.col("midx")) % 9 < 3, F.col("tvol")))
    return panel.rolling_sum(df, "id", "eom", "x", 6, "s").select("id", "eom", "s")


# ---- high-low spread ----------------------------------------------------------------------------
HL = """hl AS (SELECT id, date, eom, midx, excntry, bidask, tvol, adjfct, prc / adjfct AS prc,
  CASE WHEN (id + didx) % 4 <> 0 THEN prc_high * 1.03 ELSE prc_high END / adjfct AS prc_high, CASE WHEN (id + didx) % 4 <> 0 THEN prc_low * 0.97 ELSE prc_low END / adjfct AS prc_low FROM sd)"""
HL2 = """h1 AS (SELECT *, CASE WHEN bidask = 1 OR tvol = 0 OR prc_low <= 0 OR prc_high <= 0 OR prc_low = prc_high THEN NULL ELSE prc_high END AS hi,
  CASE WHEN bidask = 1 OR tvol = 0 OR prc_low <= 0 OR prc_high <= 0 OR prc_low = prc_high THEN NULL ELSE prc_low END AS lo,
  row_number() OVER (PARTITION BY id ORDER BY date) AS n FROM hl),
h2 AS (SELECT *, CASE WHEN lo > 0 AND hi > lo THEN lo WHEN n > 1 THEN lo END AS al0, CASE WHEN lo > 0 AND hi > lo THEN hi WHEN n > 1 THEN hi END AS ah0 FROM h1),
h3 AS (SELECT *, al0 IS NULL AS fl, last_value(al0 IGNORE NULLS) OVER w AS al, last_value(ah0 IGNORE NULLS) OVER w AS ah FROM h2 WINDOW w AS (PARTITION BY id ORDER BY date)),
h4 AS (SELECT *, CASE WHEN fl AND ((prc >= al AND prc <= ah) OR (prc IS NULL AND al IS NULL AND ah IS NULL)) THEN 1 WHEN fl AND prc < al THEN 2 WHEN fl AND coalesce(prc > ah, TRUE) THEN 3 ELSE 0 END AS hlreset FROM h3),
h5 AS (SELECT * REPLACE (CASE hlreset WHEN 1 THEN al WHEN 2 THEN prc WHEN 3 THEN al + (prc - ah) ELSE lo END AS prc_low, CASE hlreset WHEN 1 THEN ah WHEN 2 THEN ah - (al - prc) WHEN 3 THEN prc ELSE hi END AS prc_high) FROM h4),
h6 AS (SELECT * REPLACE (CASE WHEN prc_low <> 0 AND prc_high / prc_low > 8 THEN NULL ELSE prc_low END AS prc_low, CASE WHEN prc_low <> 0 AND prc_high / prc_low > 8 THEN NULL ELSE prc_high END AS prc_high) FROM h5)"""
HL3 = """o1 AS (SELECT *, lag(prc) OVER w AS p1, lag(prc_low) OVER w AS lo1, lag(prc_high) OVER w AS hi1 FROM h6 WINDOW w AS (PARTITION BY id ORDER BY date)),
o2 AS (SELECT *, CASE WHEN p1 > prc_high AND p1 > 0 THEN p1 WHEN p1 < prc_low AND p1 > 0 THEN prc_high - (prc_low - p1) ELSE prc_high END AS ht,
  CASE WHEN p1 > prc_high AND p1 > 0 THEN prc_low + (p1 - prc_high) WHEN p1 < prc_low AND p1 > 0 THEN p1 ELSE prc_low END AS lt FROM o1),
o3 AS (SELECT *, greatest(ht, hi1) AS h2d, least(lt, lo1) AS l2d FROM o2)"""


def _hl(t):
    d = adapters.security_day(t)
    wide = (F.col("id") + F.col("didx")) % 4 != 0
    return d.withColumns(
        {
            "prc_high": F.when(wide, F.col("prc_high") * 1.03).otherwise(F.col("prc_high")),
            "prc_low": F.when(wide, F.col("prc_low") * 0.97).otherwise(F.col("prc_low")),
        }
    )


def _hl_adj(t):
    return _hl(t).withColumns({c: div(c, "adjfct") for c in ("prc", "prc_high", "prc_low")})


@query("high_low_impute", with_(sd(), HL, HL2) + "SELECT id, date, prc_low, prc_high, hlreset FROM h6")
def _impute(t):
    return spread.impute_high_low(_hl_adj(t)).select("id", "date", "prc_low", "prc_high", "hlreset")


@query("overnight_adjust", with_(sd(), HL, HL2, HL3) + "SELECT id, date, ht AS prc_high_t, lt AS prc_low_t, h2d AS prc_high_2d, l2d AS prc_low_2d FROM o3")
def _overnight(t):
    df = spread.overnight_adjust(spread.impute_high_low(_hl_adj(t)))
    return df.select("id", "date", "prc_high_t", "prc_low_t", "prc_high_2d", "prc_low_2d")


@query(
    "hl_spread",
    with_(
        sd(), factors("date"),
        HL.replace("FROM sd)", "FROM sd JOIN (SELECT excntry, date FROM fct WHERE mktrf <> 0) USING (excntry, date))"), HL2, HL3,
        "k AS (SELECT 3 - 2 * sqrt(2) AS c, sqrt(8 / pi()) AS k2)",
        "b AS (SELECT id, eom, CASE WHEN lt > 0 AND lo1 > 0 THEN ln(ht / lt) ** 2 + ln(hi1 / lo1) ** 2 END AS beta, CASE WHEN l2d > 0 THEN ln(h2d / l2d) ** 2 END AS gamma FROM o3)",
        "a AS (SELECT *, (sqrt(2) - 1) * sqrt(beta) / c - sqrt(gamma / c) AS alpha, (sqrt(beta / 2) - sqrt(beta)) / (k2 * c) + sqrt(gamma / (k2 * k2 * c)) AS sigma FROM b, k)",
        "s AS (SELECT id, eom, greatest(2 * (exp(alpha) - 1) / (1 + exp(alpha)), CASE WHEN alpha IS NULL THEN NULL ELSE 0 END) AS spread, greatest(sigma, CASE WHEN sigma IS NULL THEN NULL ELSE 0 END) AS sigma FROM a)",
    )
    + "SELECT id, eom, avg(spread) AS bidaskhl_21d, avg(sigma) AS rvolhl_21d FROM s GROUP BY 1, 2 HAVING count(spread) > 3",
    "bidaskhl_21d rvolhl_21d",
)
def _hls(t):
    mk = adapters.factor_series(t, "date").select("excntry", "date", F.when(F.col("mktrf") != 0, F.col("mktrf")).alias("mkt_vw_exc"))
    return spread.bidask_hl(_hl(t), mk, 3)


@query(
    "three_day_sum",
    with_(sd(), factors("date"))
    + "SELECT id, date, ret_exc + lag(ret_exc) OVER w + lag(ret_exc, 2) OVER w AS ret_exc_3l, mktrf + lag(mktrf) OVER w + lag(mktrf, 2) OVER w AS mkt_exc_3l FROM sd JOIN fct USING (excntry, date) WINDOW w AS (PARTITION BY id ORDER BY date)",
    "ret_exc_3l:10 mkt_exc_3l:10",
)
def _three(t):
    df = adapters.security_day(t).join(adapters.factor_series(t, "date"), ["excntry", "date"])
    return panel.three_day_sums(df, {"ret_exc": "ret_exc_3l", "mktrf": "mkt_exc_3l"}).select("id", "date", "ret_exc_3l", "mkt_exc_3l")


@query(
    "market_lead_lag",
    with_(factors("date", dims_cte=True)) + "SELECT excntry, date, lead(mktrf) OVER (PARTITION BY excntry, last_day(date) ORDER BY date) AS mktrf_ld1, lag(mktrf) OVER (PARTITION BY excntry ORDER BY date) AS mktrf_lg1 FROM fct",
    "mktrf_ld1:10 mktrf_lg1:10",
)
def _leadlag(t):
    return panel.market_lead_lag(adapters.factor_series(t, "date")).select("excntry", "date", "mktrf_ld1", "mktrf_lg1")
