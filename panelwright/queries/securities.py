"""Security files of two vendors: field maps, daily and monthly builds, the world panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import expand, joins, rows, security
from ..plans import helpers
from ..sources import adapters
from .base_sql import FXQ, raw_tables, sd, sm, with_
from .panels import PERF
from .registry import query
from .relational import CROSS, FXD

# a quote feed in the reference exchange's layout, derived from the security panel
FEED = """fd AS (SELECT id AS permno, permco, eom AS mthcaldt, prc * CASE WHEN (id + midx) % 10 = 0 THEN -1 ELSE 1 END AS mthprc, CASE WHEN (id + midx) % 3 = 0 THEN 'BA' WHEN (id + midx) % 3 = 1 THEN 'TR' ELSE 'XX' END AS mthprcflg,
  ret AS mthret, ret - 0.01::DOUBLE AS mthretx, tvol AS mthvol, adjfct AS mthcumfacshr, prc_high AS mthaskhi, CASE WHEN id % 6 = 0 THEN 0.0 ELSE prc_low END AS mthbidlo, shares * 1000 AS shrout,
  CASE WHEN id % 7 = 0 THEN 'FUND' ELSE 'EQTY' END AS securitytype, 'COM' AS securitysubtype, 'NS' AS sharetype, CASE WHEN id % 5 = 0 THEN 'ACOR' WHEN id % 5 = 1 THEN 'REIT' ELSE 'CORP' END AS issuertype, 'Y' AS usincflg,
  CASE id % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'A' WHEN 2 THEN 'Q' ELSE 'X' END AS primaryexch, CASE WHEN (id + midx) % 9 = 0 THEN 'NW' ELSE 'RW' END AS conditionaltype FROM sm)"""
MAP = """mp AS (SELECT permno, permco, mthcaldt AS date, CASE mthprcflg WHEN 'BA' THEN 1 WHEN 'TR' THEN 0 END AS bidask, mthprc AS prc, shrout / 1000 AS shrout, mthret AS ret, mthretx AS retx, mthcumfacshr AS cfacshr, mthvol AS vol,
  CASE WHEN mthprc > 0 AND mthaskhi > 0 THEN mthaskhi END AS prc_high, CASE WHEN mthprc > 0 AND mthbidlo > 0 THEN mthbidlo END AS prc_low,
  CASE WHEN conditionaltype = 'RW' THEN CASE primaryexch WHEN 'N' THEN 1 WHEN 'A' THEN 2 WHEN 'Q' THEN 3 END END AS exchcd, CAST(primaryexch IN ('A', 'N', 'Q') AND conditionaltype = 'RW' AS INT) AS exch_main,
  CASE WHEN securitytype = 'EQTY' AND issuertype IN ('ACOR', 'CORP') THEN 10 END AS shrcd, mthprc * shrout / 1000 AS me FROM fd)"""


def _feed(t):
    i, m = F.col("id"), F.col("midx")
    return adapters.security_month(t).select(
        i.alias("permno"), "permco", F.col("eom").alias("mthcaldt"), (F.col("prc") * F.when((i + m) % 10 == 0, -1).otherwise(1)).alias("mthprc"),
        F.when((i + m) % 3 == 0, "BA").when((i + m) % 3 == 1, "TR").otherwise("XX").alias("mthprcflg"), F.col("ret").alias("mthret"), (F.col("ret") - 0.01).alias("mthretx"),
        F.col("tvol").alias("mthvol"), F.col("adjfct").alias("mthcumfacshr"), F.col("prc_high").alias("mthaskhi"), F.when(i % 6 == 0, 0.0).otherwise(F.col("prc_low")).alias("mthbidlo"),
        (F.col("shares") * 1000).alias("shrout"), F.when(i % 7 == 0, "FUND").otherwise("EQTY").alias("securitytype"), F.lit("COM").alias("securitysubtype"), F.lit("NS").alias("sharetype"),
        F.when(i % 5 == 0, "ACOR").when(i % 5 == 1, "REIT").otherwise("CORP").alias("issuertype"), F.lit("Y").alias("usincflg"),
        F.when(i % 4 == 0, "N").when(i % 4 == 1, "A").when(i % 4 == 2, "Q").otherwise("X").alias("primaryexch"), F.when((i + m) % 9 == 0, "NW").otherwise("RW").alias("conditionaltype"),
    )


@query("crsp_field_map", with_(sm(), FEED, MAP) + "SELECT * FROM mp")
def _map(t):
    return security.crsp_fields(_feed(t), "m")


# the helper tables, one statement each; values of type double enter a digest as millionths
_STD = "indfmt = 'INDL' AND datafmt = 'STD' AND popsrc = 'D' AND consol = 'C'"
HELPER_SQL = {
    "sic_naics_na": ("SELECT DISTINCT gvkey, datadate, sich AS sic, naicsh AS naics FROM comp_funda", "gvkey datadate sic naics"),
    "sic_naics_gl": ("SELECT DISTINCT gvkey, datadate, sich AS sic, naicsh AS naics FROM comp_g_funda", "gvkey datadate sic naics"),
    "firm_shares": (f"SELECT gvkey, datadate, cshoq AS csho_fund, ajexq AS ajex_fund FROM comp_fundq WHERE {_STD} AND cshoq IS NOT NULL AND ajexq IS NOT NULL UNION ALL SELECT gvkey, datadate, csho, ajex FROM comp_funda WHERE {_STD} AND csho IS NOT NULL AND ajex IS NOT NULL", "gvkey datadate csho_fund* ajex_fund*"),
    "permno0": ("SELECT DISTINCT permno, permco, secinfostartdt, secinfoenddt, siccd AS sic, naics FROM crsp_stksecurityinfohist", "permno permco secinfostartdt secinfoenddt sic naics"),
    "comp_hgics_na": ("SELECT DISTINCT gvkey, indfrom, indthru, gsubind AS gics FROM comp_co_hgic WHERE gvkey IS NOT NULL", "gvkey indfrom indthru gics"),
    "comp_hgics_gl": ("SELECT DISTINCT gvkey, indfrom, indthru, gsubind AS gics FROM comp_g_co_hgic WHERE gvkey IS NOT NULL", "gvkey indfrom indthru gics"),
    "crsp_dsedelist": ("FROM crsp_stkdelists", "permno delistingdt delret* delactiontype delstatustype delreasontype delpaymenttype"),
    "crsp_msedelist": ("FROM crsp_stkdelists", "permno delistingdt delret* delactiontype delstatustype delreasontype delpaymenttype"),
    "sec_info": ("SELECT gvkey, iid, secstat, dlrsni FROM comp_security UNION ALL SELECT gvkey, iid, secstat, dlrsni FROM comp_g_security", "gvkey iid secstat dlrsni"),
    "crsp_mcti_t30ret": ("FROM crsp_mcti", "caldt t30ret*"),
    "ff_factors_monthly": ("FROM ff_factors_monthly", "date rf*"),
    "comp_r_ex_codes": ("FROM comp_r_ex_codes", "exchgdesc exchgcd"),
    "ex_country": ("SELECT DISTINCT exchg, excntry FROM comp_g_security UNION ALL (SELECT DISTINCT exchg, excntry FROM comp_security)", "exchg excntry"),
    "header": ("SELECT gvkey, prirow, priusa, prican FROM comp_company UNION ALL SELECT gvkey, prirow, priusa, prican FROM comp_g_company WHERE gvkey NOT IN (SELECT gvkey FROM comp_company)", "gvkey prirow priusa prican"),
    "prihistusa": ("SELECT gvkey, itemvalue AS prihistusa, effdate, thrudate FROM comp_sec_history WHERE item = 'PRIHISTUSA'", "gvkey prihistusa effdate thrudate"),
    "prihistcan": ("SELECT gvkey, itemvalue AS prihistcan, effdate, thrudate FROM comp_sec_history WHERE item = 'PRIHISTCAN'", "gvkey prihistcan effdate thrudate"),
    "prihistrow": ("SELECT gvkey, itemvalue AS prihistrow, effdate, thrudate FROM comp_g_sec_history WHERE item = 'PRIHISTROW'", "gvkey prihistrow effdate thrudate"),
    "fx1": ("FROM fx1", "curcdd datadate fx*"),
    "crsp_sf_m": ("""SELECT mp.*, gvkey, liid AS iid FROM mp LEFT JOIN crsp_stksecurityinfohist n ON mp.permno = n.permno AND date BETWEEN secinfostartdt AND secinfoenddt
  LEFT JOIN crsp_ccmxpf_lnkhist k ON mp.permno = lpermno AND linktype IN ('LC', 'LU', 'LS') AND (linkdt IS NULL OR date >= linkdt) AND (linkenddt IS NULL OR date <= linkenddt)""", "permno permco date bidask prc* shrout* ret* retx* cfacshr* vol* prc_high* prc_low* exchcd gvkey iid exch_main shrcd me*"),
}


def _cells(columns: str) -> str:
    """The text of a row, for a digest that both engines agree on."""
    whole = lambda c: f"CAST(round({c[:-1]} * 1000000) AS BIGINT)" if c.endswith("*") else c
    return " || '|' || ".join(f"coalesce(CAST({whole(c)} AS STRING), '~')" for c in columns.split())


def _helper_rows() -> str:
    row = "SELECT '{0}' AS helper, count(*) AS n_rows, coalesce(sum(CAST('0x' || substr(md5({1}), 1, 8) AS BIGINT)), 0)::BIGINT AS digest FROM ({2})"
    return " UNION ALL ".join(row.format(name, _cells(cols), sql) for name, (sql, cols) in HELPER_SQL.items())


@query("build_raw_helpers", with_(*raw_tables(), FXQ, CROSS, sm(), FEED, MAP) + _helper_rows())
def _helpers(t):
    """All helper tables from one scan of each raw table: name, rows and digest of each."""
    raw = {name: adapters.raw_table(t, name) for name in adapters.RAW_TABLES} | {"comp_exrt_dly": adapters.fx_quotes(t)}
    made = helpers.raw_helpers(t.spark, helpers.RawTables(raw, {"m": _feed(t)}))
    out = None
    for name, df in made.items():
        cell = F.conv(F.substring(F.md5(F.expr(_cells(HELPER_SQL[name][1]))), 1, 8), 16, 10).cast("long")
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(cell), F.lit(0)).alias("digest")).select(F.lit(name).alias("helper"), "n_rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out


RATES = "rates AS (SELECT DISTINCT midx, CASE WHEN midx % 4 <> 0 THEN 0.001::DOUBLE + (midx % 10) / 10000.0::DOUBLE END AS t30ret, 0.002::DOUBLE AS rf FROM sm)"
DEL = "de AS (SELECT id AS permno, max(eom) AS delistingdt, CASE WHEN id % 5 = 0 THEN -0.15::DOUBLE END AS delret, CASE id % 3 WHEN 0 THEN 'UNAV' WHEN 1 THEN 'BKPY' ELSE 'ACQ' END AS reason FROM sm WHERE id % 2 = 0 GROUP BY id)"


def _rates(t):
    m = F.col("midx")
    return adapters.security_month(t).select("midx").distinct().select(
        "midx", F.when(m % 4 != 0, 0.001 + (m % 10) / F.lit(10000.0)).alias("t30ret"), F.lit(0.002).alias("rf")
    )


@query(
    "crsp_security_file",
    with_(
        sm(), FEED, MAP, RATES, DEL,
        f"""c1 AS (SELECT mp.*, delret, reason, year(date) * 12 + month(date) AS midx, vol / CASE WHEN exchcd = 3 AND date < DATE '2001-02-01' THEN 2 WHEN exchcd = 3 AND date <= DATE '2001-12-31' THEN 1.8::DOUBLE WHEN exchcd = 3 AND date < DATE '2003-12-31' THEN 1.6::DOUBLE ELSE 1 END AS v,
  CASE WHEN lag(cfacshr) OVER w <> 0 THEN (ret - retx) * lag(prc) OVER w * (cfacshr / lag(cfacshr) OVER w) END AS div_tot
  FROM mp LEFT JOIN de ON mp.permno = de.permno AND year(date) * 12 + month(date) = year(delistingdt) * 12 + month(delistingdt) WINDOW w AS (PARTITION BY mp.permno ORDER BY date))""",
        f"c2 AS (SELECT *, CASE WHEN delret IS NULL AND reason IS NOT NULL AND (reason = 'UNAV' OR reason IN ({PERF})) THEN -0.3::DOUBLE ELSE delret END AS dl FROM c1)",
        "c3 AS (SELECT *, (CASE WHEN ret IS NULL AND dl IS NOT NULL THEN 0 ELSE ret END + 1) * (coalesce(dl, 0) + 1) - 1 AS r FROM c2)",
    )
    + """SELECT permno, permco, date, bidask, prc, exchcd, v * 100 AS vol, abs(prc) * v * 100 AS dolvol, div_tot, r AS ret, r - coalesce(t30ret, rf) AS ret_exc, me,
  CASE WHEN count(me) OVER c > 0 THEN sum(coalesce(me, 0)) OVER c END AS me_company FROM c3 LEFT JOIN rates USING (midx) WINDOW c AS (PARTITION BY permco, date)""",
)
def _crsp(t):
    p = F.col("permno")
    days = adapters.security_month(t).filter("id % 2 = 0").groupBy(F.col("id").alias("permno")).agg(F.max("eom").alias("delistingdt"))
    delist = days.select(
        "permno", "delistingdt", F.when(p % 5 == 0, -0.15).alias("delret"), F.when(p % 3 == 0, "UNAV").when(p % 3 == 1, "BKPY").otherwise("ACQ").alias("delreasontype"),
        F.lit("GDR").alias("delactiontype"), F.lit("PRCF").alias("delpaymenttype"), F.lit("VCL").alias("delstatustype"),
    )
    out = security.crsp_security(security.crsp_fields(_feed(t), "m"), delist, _rates(t), "m")
    return out.select("permno", "permco", "date", "bidask", "prc", "exchcd", "vol", "dolvol", "div_tot", "ret", "ret_exc", "me", "me_company")


FILES = """fq AS (SELECT gvkey, eom AS datadate, me AS cshoq, adjfct AS ajexq, CASE WHEN id % 4 = 0 THEN 'FS' ELSE 'INDL' END AS indfmt FROM sm WHERE id % 2 = 0 AND month(eom) % 3 = 0),
fa AS (SELECT gvkey, eom AS datadate, CASE WHEN id % 5 <> 1 THEN me / 2 END AS csho, adjfct AS ajex FROM sm WHERE id % 2 = 1 AND month(eom) = 12),
fs AS (SELECT gvkey, datadate, cshoq AS csho_fund, ajexq AS ajex_fund FROM fq WHERE indfmt = 'INDL' UNION ALL SELECT gvkey, datadate, csho, ajex FROM fa WHERE csho IS NOT NULL)"""


def _shares(t):
    std = {"datafmt": F.lit("STD"), "popsrc": F.lit("D"), "consol": F.lit("C")}
    df = adapters.security_month(t)
    q = df.filter((F.col("id") % 2 == 0) & (F.month("eom") % 3 == 0)).select(
        "gvkey", F.col("eom").alias("datadate"), F.col("me").alias("cshoq"), F.col("adjfct").alias("ajexq"), F.when(F.col("id") % 4 == 0, "FS").otherwise("INDL").alias("indfmt")
    ).withColumns(std)
    a = df.filter((F.col("id") % 2 == 1) & (F.month("eom") == 12)).select(
        "gvkey", F.col("eom").alias("datadate"), F.when(F.col("id") % 5 != 1, F.col("me") / 2).alias("csho"), F.col("adjfct").alias("ajex"), F.lit("INDL").alias("indfmt")
    ).withColumns(std)
    return security.firm_shares(q, a)


@query("firm_shares_union", with_(sm(), FILES) + "SELECT * FROM fs", "csho_fund:3")
def _fs(t):
    return _shares(t)


# daily files of the accounting vendor: home (odd ids) and world (even ids)
COMP = """fs1 AS (SELECT gvkey, datadate, max(csho_fund) AS csho_fund, max(ajex_fund) AS ajex_fund FROM fs GROUP BY 1, 2),
fs2 AS (SELECT gvkey, csho_fund, ajex_fund, CAST(unnest(generate_series(datadate, stop, INTERVAL 1 DAY)) AS DATE) AS ddate FROM (SELECT *, least(lead(datadate) OVER (PARTITION BY gvkey ORDER BY datadate), last_day(CAST(datadate + INTERVAL 12 MONTH AS DATE))) - 1 AS stop FROM fs1)),
dq AS (SELECT gvkey, iid, date AS datadate, CASE WHEN id % 10 = 3 THEN '1' ELSE '0' END AS tpci, CASE WHEN id % 3 = 0 THEN 14 ELSE 11 END AS exchg, 3 + (id + didx) % 3 AS prcstd, curcd AS curcdd, CASE WHEN id % 4 <> 1 THEN curcd END AS curcddv, adjfct AS ajexdi,
  prc_low * 0.01 AS div, prc_low * 0.008 AS divd, CASE WHEN id % 3 = 0 THEN prc_low * 0.002 END AS divsp, prc AS prccd, prc_high AS prchd, prc_low AS prcld, tvol AS cshtrd, 1 + (didx % 100) / 1000.0::DOUBLE AS trfd, CASE WHEN id % 4 = 0 THEN 100.0 ELSE 1.0 END AS qunit, CASE WHEN id % 5 <> 2 THEN shares * 1000000 END AS cshoc, id FROM sd),
ci AS (SELECT gvkey, iid, datadate, tpci, exchg, prcstd, curcdd, curcddv, ajexdi, div, divd, divsp, prccd / qunit AS pl, CASE WHEN prcstd <> 5 THEN prchd / qunit END AS hl, CASE WHEN prcstd <> 5 THEN prcld / qunit END AS ll, cshtrd, cshoc / 1e6 AS cshoc, (prccd / qunit) / ajexdi * trfd AS ri_local FROM dq WHERE id % 2 = 0
  UNION SELECT q.gvkey, iid, datadate, tpci, exchg, prcstd, curcdd, curcddv, ajexdi, div, divd, divsp, prccd, CASE WHEN prcstd <> 5 THEN prchd END, CASE WHEN prcstd <> 5 THEN prcld END,
  CASE WHEN exchg = 14 THEN CASE WHEN datadate < DATE '2001-02-01' THEN cshtrd / 2 WHEN datadate <= DATE '2001-12-31' THEN cshtrd / 1.8::DOUBLE WHEN datadate < DATE '2003-12-31' THEN cshtrd / 1.6::DOUBLE ELSE cshtrd END ELSE cshtrd END,
  coalesce(cshoc / 1e6, csho_fund * (ajex_fund / ajexdi)), prccd / ajexdi * trfd FROM dq q LEFT JOIN fs2 ON q.gvkey = fs2.gvkey AND q.datadate = fs2.ddate WHERE id % 2 = 1),
cm AS (SELECT ci.*, b.fx, c.fx AS fxv FROM ci LEFT JOIN fxd b ON ci.curcdd = b.curcdd AND ci.datadate = b.datadate LEFT JOIN fxd c ON ci.curcddv = c.curcdd AND ci.datadate = c.datadate),
cd AS (SELECT gvkey, iid, datadate, tpci, exchg, prcstd, curcdd, pl AS prc_local, ajexdi, cshtrd, cshoc, ri_local, fx, pl * fx AS prc, hl * fx AS prc_high, ll * fx AS prc_low, pl * fx * cshoc AS me, cshtrd * pl * fx AS dolvol, ri_local * fx AS ri,
  coalesce(div, 0) * fxv AS div_tot, coalesce(divd, 0) * fxv AS div_cash, coalesce(divsp, 0) * fxv AS div_spc, last_day(datadate) AS eom FROM cm)"""
COMP_BASE = [sm(), FILES, sd().split(",\n", 1)[1].replace("trades AS", "trades_d AS").replace("FROM trades t", "FROM trades_d t"), FXQ, CROSS, FXD, COMP]


def _comp_daily(t):
    i = F.col("id")
    d = adapters.security_day(t).select(
        "id", "gvkey", "iid", F.col("date").alias("datadate"), F.when(i % 10 == 3, "1").otherwise("0").alias("tpci"), F.when(i % 3 == 0, 14).otherwise(11).alias("exchg"),
        (3 + (i + F.col("didx")) % 3).alias("prcstd"), F.col("curcd").alias("curcdd"), F.when(i % 4 != 1, F.col("curcd")).alias("curcddv"), F.col("adjfct").alias("ajexdi"),
        (F.col("prc_low") * 0.01).alias("div"), (F.col("prc_low") * 0.008).alias("divd"), F.when(i % 3 == 0, F.col("prc_low") * 0.002).alias("divsp"),
        F.col("prc").alias("prccd"), F.col("prc_high").alias("prchd"), F.col("prc_low").alias("prcld"), F.col("tvol").alias("cshtrd"),
        (1 + (F.col("didx") % 100) / F.lit(1000.0)).alias("trfd"), F.when(i % 4 == 0, 100.0).otherwise(1.0).alias("qunit"), F.when(i % 5 != 2, F.col("shares") * 1000000).alias("cshoc"),
    )
    sh = _shares(t).groupBy("gvkey", "datadate").agg(F.max("csho_fund").alias("csho_fund"), F.max("ajex_fund").alias("ajex_fund"))
    sh = expand.carry_forward(sh, "gvkey", "datadate", "ddate").drop("datadate")
    fx = expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t)))
    return security.comp_daily(d.filter(i % 2 == 1), d.filter(i % 2 == 0), sh, fx)


@query("comp_daily", with_(*COMP_BASE) + "SELECT * FROM cd")
def _cdq(t):
    return _comp_daily(t)


MONTHLY = """v AS (SELECT *, greatest(max(prc / ajexdi) OVER w, max(prc_high / ajexdi) OVER w) * ajexdi AS hi, least(min(prc / ajexdi) OVER w, min(prc_low / ajexdi) OVER w) * ajexdi AS lo, sum(dolvol) OVER w AS dv FROM cd WINDOW w AS (PARTITION BY gvkey, iid, eom)),
m1 AS (SELECT gvkey, iid, eom, datadate, curcdd, prc_local, prc, ajexdi, hi AS prc_high, lo AS prc_low, dv AS dolvol, 1 AS source FROM (SELECT *, max(datadate) OVER (PARTITION BY gvkey, iid, eom) AS top FROM v WHERE prc_local IS NOT NULL AND curcdd IS NOT NULL AND prcstd IN (3, 4, 10)) WHERE datadate = top),
m0 AS (SELECT gvkey, iid, eom, eom AS datadate, curcd AS curcdd, prc AS prc_local, prc * 2 AS prc, adjfct AS ajexdi, prc_high, prc_low, dolvol, 0 AS source FROM sm WHERE id % 3 <> 1),
mm AS (SELECT *, count(*) OVER (PARTITION BY gvkey, iid, eom) AS n FROM (SELECT * FROM m1 UNION ALL SELECT * FROM m0))"""


@query("comp_monthly", with_(*COMP_BASE, MONTHLY) + "SELECT * EXCLUDE (n, source) FROM mm WHERE n = 1 OR (n = 2 AND source = 1)", "dolvol:5")
def _cmq(t):
    cols = ["gvkey", "iid", "eom", "datadate", "curcdd", "prc_local", "prc", "ajexdi", "prc_high", "prc_low", "dolvol", "source"]
    a = security.adjusted_month(_comp_daily(t), ["gvkey", "iid"]).select(*cols)
    b = adapters.security_month(t).filter("id % 3 <> 1").select(
        "gvkey", "iid", "eom", F.col("eom").alias("datadate"), F.col("curcd").alias("curcdd"), F.col("prc").alias("prc_local"), (F.col("prc") * 2).alias("prc"),
        F.col("adjfct").alias("ajexdi"), "prc_high", "prc_low", "dolvol", F.lit(0).alias("source"),
    )
    return security.comp_monthly(a, b)


CS = """ri AS (SELECT gvkey, iid, eom AS datadate, midx, id, 3 + (id + midx) % 4 AS prcstd, prc AS ri, prc * (1 + midx % 2) AS ri_local, CASE WHEN midx % 30 < 15 THEN curcd ELSE 'EUR' END AS curcd, 10 + id % 8 AS exchg FROM sm),
rx AS (SELECT gvkey, iid, datadate, ri / lag(ri) OVER w - 1 AS ret, CASE WHEN curcd <> lag(curcd) OVER w THEN ri / lag(ri) OVER w - 1 ELSE ri_local / lag(ri_local) OVER w - 1 END AS ret_local, midx - lag(midx) OVER w AS ret_lag_dif FROM ri WHERE prcstd IN (3, 4, 10) WINDOW w AS (PARTITION BY gvkey, iid ORDER BY datadate)),
dd AS (SELECT gvkey, iid, max(datadate) AS date_delist, CASE WHEN CAST(gvkey AS BIGINT) % 4 = 0 THEN -0.3::DOUBLE ELSE 0.0 END AS dlret FROM rx WHERE ret_local <> 0 AND CAST(gvkey AS BIGINT) % 2 = 0 GROUP BY 1, 2),
ex AS (SELECT exchg, CASE WHEN count(DISTINCT excntry) > 1 THEN 'multi national' ELSE max(excntry) END AS excntry FROM (SELECT 10 + id % 8 AS exchg, excntry FROM sm) GROUP BY 1)"""


@query(
    "comp_security_file",
    with_(sm(), CS, RATES)
    + """SELECT gvkey, iid, datadate, CASE WHEN datadate = date_delist THEN (1 + ret) * (1 + dlret) - 1 ELSE ret END AS ret, CASE WHEN datadate = date_delist THEN (1 + ret_local) * (1 + dlret) - 1 ELSE ret_local END AS ret_local, ret_lag_dif,
  CASE WHEN datadate = date_delist THEN (1 + ret) * (1 + dlret) - 1 ELSE ret END - coalesce(t30ret, rf) AS ret_exc, excntry,
  CAST(excntry <> 'multi national' AND exchg NOT IN (0, 1, 2, 3, 4, 15, 16, 17, 18, 21, 13, 19, 20) AS INT) AS exch_main
FROM ri LEFT JOIN rx USING (gvkey, iid, datadate) LEFT JOIN dd USING (gvkey, iid) LEFT JOIN rates USING (midx) LEFT JOIN ex USING (exchg) WHERE date_delist IS NULL OR datadate <= date_delist""",
    "ret ret_local ret_exc",
)
def _comp(t):
    m, i, k = F.col("midx"), F.col("id"), F.col("gvkey").cast("long")
    panel = adapters.security_month(t)
    df = panel.select(
        "gvkey", "iid", F.col("eom").alias("datadate"), (3 + (i + m) % 4).alias("prcstd"), F.col("prc").alias("ri"), (F.col("prc") * (1 + m % 2)).alias("ri_local"),
        F.when(m % 30 < 15, F.col("curcd")).otherwise("EUR").alias("curcd"), (10 + i % 8).alias("exchg"),
    )
    status = df.select("gvkey", "iid").distinct().select("gvkey", "iid", F.when(k % 2 == 0, "I").otherwise("A").alias("secstat"), F.when(k % 4 == 0, "02").otherwise("07").alias("dlrsni"))
    ex = security.main_exchange(panel.select((10 + i % 8).alias("exchg"), "excntry"))
    out = security.comp_security(df, status, _rates(t), ex, "m")
    return out.select("gvkey", "iid", "datadate", "ret", "ret_local", "ret_lag_dif", "ret_exc", "excntry", "exch_main")


@query(
    "world_panel",
    with_(
        sm(),
        "c AS (SELECT id, gvkey, iid, eom, prc, ret_exc, 1::BIGINT AS ret_lag_dif, 1 AS source_crsp FROM sm WHERE source_crsp = 1)",
        "k AS (SELECT CAST('1' || gvkey || substr(iid, 1, 2) AS BIGINT) AS id, gvkey, iid, eom, prc, ret_exc, ret_lag_dif, 0 AS source_crsp FROM sm WHERE source_crsp = 0 OR midx % 4 = 0)",
        "u AS (SELECT *, CASE WHEN lead(ret_lag_dif) OVER w = 1 THEN lead(ret_exc) OVER w END AS ret_exc_lead1m FROM (SELECT * FROM c UNION ALL SELECT * FROM k) WINDOW w AS (PARTITION BY id ORDER BY eom))",
    )
    + "SELECT *, CAST(count(gvkey) OVER (PARTITION BY gvkey, iid, eom) <= 1 OR source_crsp = 1 AS INT) AS obs_main FROM u",
    "ret_exc ret_exc_lead1m",
)
def _world(t):
    cols = ["id", "gvkey", "iid", "eom", "prc", "ret_exc", "ret_lag_dif", "source_crsp"]
    df = adapters.security_month(t)
    a = df.filter("source_crsp = 1").withColumns({"ret_lag_dif": F.lit(1).cast("long"), "source_crsp": F.lit(1)}).select(*cols)
    b = df.filter((F.col("source_crsp") == 0) | (F.col("midx") % 4 == 0)).withColumns(
        {"id": F.concat(F.lit("1"), "gvkey", F.substring("iid", 1, 2)).cast("long"), "source_crsp": F.lit(0)}
    ).select(*cols)
    return security.world_panel(a, b)


@query(
    "world_panel_daily",
    with_(
        sm(),
        sd().split(",\n", 1)[1].replace("trades AS", "trades_d AS").replace("FROM trades t", "FROM trades_d t"),
        "mw AS (SELECT id, gvkey, iid, eom, 1 AS source_crsp FROM sm WHERE source_crsp = 1 UNION ALL SELECT 1000000 + id, gvkey, iid, eom, 0 FROM sm WHERE source_crsp = 0 OR midx % 4 = 0)",
        "mo AS (SELECT id, eom, CAST(count(gvkey) OVER (PARTITION BY gvkey, iid, eom) <= 1 OR source_crsp = 1 AS INT) AS obs_main FROM mw)",
        "dw AS (SELECT id, date, eom, prc, ret_exc FROM sd WHERE source_crsp = 1 UNION ALL SELECT 1000000 + id, date, eom, prc, ret_exc FROM sd WHERE source_crsp = 0 OR midx % 4 = 0)",
    )
    + "SELECT dw.*, obs_main FROM dw LEFT JOIN (SELECT id, eom, max(obs_main) AS obs_main FROM mo GROUP BY ALL) USING (id, eom)",
    "ret_exc",
)
def _world_d(t):
    def halves(df, *cols):
        second = df.filter((F.col("source_crsp") == 0) | (F.col("midx") % 4 == 0)).withColumns({"id": F.col("id") + 1_000_000, "source_crsp": F.lit(0)})
        return [x.select(*cols) for x in (df.filter("source_crsp = 1"), second)]

    months = security.obs_main_flag(rows.union_relaxed(*halves(adapters.security_month(t), "id", "gvkey", "iid", "eom", "source_crsp")))
    return security.world_panel_daily(*halves(adapters.security_day(t), "id", "date", "eom", "prc", "ret_exc"), months)
