"""Factor sorts, composites, portfolios, long-short, themes and regions."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import factors as fa
from ..operators import market
from ..operators import portfolios as po
from ..sources import adapters
from ..sources.scratch import stage
from .base_sql import sd, sm, with_
from .markets import CUT_WHERE, LAGGED, MKT_DBL, OK, SIZE_CUTS, SIZE_GRP, cutoffs_sql, market_sql, qdisc
from .registry import query

# ---- size-characteristic sorts -------------------------------------------------------------------
CH = ["be_me", "at_gr1", "niq_be"]
CHX = "cx AS (SELECT *, dolvol / me AS be_me, prc_low / prc_high AS at_gr1, CASE WHEN (id + midx) % 7 <> 0 THEN tvol END AS niq_be FROM sg)"
LAGS = ["comp_exchg", "crsp_exchcd", "exch_main", "obs_main", "common", "primary_sec", "excntry", "size_grp", "me", *CH]
BASE = (
    "bs0 AS (SELECT id, eom, ret_lag_dif, " + ", ".join(f"CASE WHEN midx - lag(midx) OVER w = 1 THEN lag({c}) OVER w END AS {c}_l" for c in LAGS)
    + " FROM cx WINDOW w AS (PARTITION BY id ORDER BY eom)),\n"
    "bs AS (SELECT *, CASE WHEN size_grp_l IN ('large', 'mega') THEN 'big' WHEN size_grp_l IS NOT NULL THEN 'small' END AS size_pf FROM bs0 "
    "WHERE obs_main_l = 1 AND exch_main_l = 1 AND common_l = 1 AND primary_sec_l = 1 AND ret_lag_dif = 1 AND me_l IS NOT NULL)"
)
HOME = "AMERICA"
CLAMP = lambda src, cond: (
    f"rt0 AS (SELECT * FROM {src} WHERE {cond} AND ret_exc IS NOT NULL),\n"
    f"rtb AS (SELECT eom, {qdisc('ret_exc', 0.001, 'rn', 'k')} AS lo, {qdisc('ret_exc', 0.999, 'rn', 'k')} AS hi FROM (SELECT eom, ret_exc, row_number() OVER (PARTITION BY eom ORDER BY ret_exc) AS rn, count(*) OVER (PARTITION BY eom) AS k FROM rt0) GROUP BY eom),\n"
    "rt AS (SELECT rt0.* REPLACE (CASE WHEN ret_exc < lo THEN lo WHEN ret_exc > hi THEN hi ELSE ret_exc END AS ret_exc) FROM rt0 LEFT JOIN rtb USING (eom))"
)
LEG = lambda d, f: f"sum(CASE WHEN leg = '{f}' THEN r END) AS {f}"


def ff_ctes(date: str, min_bp: int = 3, min_pf: int = 1) -> list[str]:
    elig = f"((size_grp_l IN ('small', 'large', 'mega') AND excntry_l <> '{HOME}') OR ((crsp_exchcd_l = 1 OR comp_exchg_l = 11) AND excntry_l = '{HOME}'))"
    out = []
    for c in CH:
        out += [
            f"bp_{c} AS (SELECT excntry_l, eom, count(*) AS n, {qdisc(f'{c}_l', 0.3, 'rn', 'k')} AS p30, {qdisc(f'{c}_l', 0.7, 'rn', 'k')} AS p70 FROM (SELECT *, row_number() OVER (PARTITION BY excntry_l, eom ORDER BY {c}_l) AS rn, count(*) OVER (PARTITION BY excntry_l, eom) AS k FROM bs WHERE {elig} AND {c}_l IS NOT NULL) GROUP BY 1, 2)",
            f"pl_{c} AS (SELECT bs.excntry_l, bs.eom, id, me_l, size_pf || '_' || CASE WHEN {c}_l >= p70 THEN 'high' WHEN {c}_l >= p30 THEN 'mid' ELSE 'low' END AS leg FROM bs JOIN bp_{c} USING (excntry_l, eom) WHERE n >= {min_bp} AND {c}_l IS NOT NULL AND size_pf IS NOT NULL)",
            f"wt_{c} AS (SELECT *, me_l / sum(me_l) OVER g AS w, count(*) OVER g AS m FROM pl_{c} WINDOW g AS (PARTITION BY excntry_l, eom, leg))",
            f"pr_{c} AS (SELECT excntry, rt.{date}, leg, sum(w * ret_exc) AS r FROM rt JOIN wt_{c} x ON rt.id = x.id AND rt.eom = x.eom AND rt.excntry = x.excntry_l WHERE m >= {min_pf} GROUP BY 1, 2, 3)",
            f"pv_{c} AS (SELECT excntry, {date}, " + ", ".join(LEG(date, f) for f in fa.LEGS) + f" FROM pr_{c} GROUP BY 1, 2)",
            f"ff_{c} AS (SELECT *, (small_high + big_high) / 2 - (small_low + big_low) / 2 AS lms, (small_high + small_mid + small_low) / 3 - (big_high + big_mid + big_low) / 3 AS smb FROM pv_{c})",
        ]
    return out


AP = lambda date: f"""SELECT mk.excntry, mk.{date}, mkt_vw_exc AS mktrf, b.lms AS hml, b.smb AS smb_ff, -a.lms AS inv, q.lms AS roe, (a.smb + q.smb) / 2 AS smb_hxz
FROM mk LEFT JOIN ff_be_me b USING (excntry, {date}) LEFT JOIN ff_at_gr1 a USING (excntry, {date}) LEFT JOIN ff_niq_be q USING (excntry, {date})"""


def _chars(t):
    df = stage(adapters.security_month(t), "panel")
    df = market.size_groups(df, market.size_cutoffs(df))
    return df.withColumns(
        {
            "be_me": F.col("dolvol") / F.col("me"), "at_gr1": F.col("prc_low") / F.col("prc_high"),
            "niq_be": F.when((F.col("id") + F.col("midx")) % 7 != 0, F.col("tvol")),
        }
    ).transform(lambda x: stage(x, "sorted"))


@query(
    "ff_sort",
    with_(sm(), SIZE_CUTS, SIZE_GRP, CHX, BASE, CLAMP("sm", "ret_lag_dif = 1"), *ff_ctes("eom"))
    + " UNION ALL ".join(f"SELECT excntry, eom, '{c}' AS characteristic, {', '.join(fa.LEGS)}, lms, smb FROM ff_{c}" for c in CH),
    " ".join([*fa.LEGS, "lms", "smb"]),
)
def _ff(t):
    p = _chars(t)
    r = fa.clamp_by_month(p.filter("ret_lag_dif = 1 AND ret_exc IS NOT NULL").select("excntry", "id", "eom", "ret_exc"), "ret_exc")
    return fa.ff_sort(fa.sort_base(p, CH), r, CH, "eom", 3, 1, HOME)


AP_DBL = "mktrf hml smb_ff inv roe smb_hxz"


@query(
    "ap_factors",
    with_(sm(), SIZE_CUTS, SIZE_GRP, CHX, BASE, CLAMP("sm", "ret_lag_dif = 1"), *ff_ctes("eom"), f"ml AS (SELECT *, {LAGGED.format(d='eom')} FROM sm)", f"mk AS ({market_sql('ml', 'eom', 1)})") + AP("eom"),
    AP_DBL,
)
def _ap(t):
    p = _chars(t)
    return fa.ap_factors(p, p, market.market_returns(adapters.security_month(t)), "eom", 3, 1, HOME)


@query(
    "ap_factors_daily",
    with_(
        sm(), SIZE_CUTS, SIZE_GRP, CHX, BASE, "mdone AS (SELECT 1)", sd().split(",\n", 1)[1].replace("trades AS", "trades_d AS").replace("FROM trades t", "FROM trades_d t"),
        CLAMP("sd", "ret_lag_dif <= 5"), *ff_ctes("date"),
        "mk AS (SELECT excntry, date, avg(ret_exc) AS mkt_vw_exc FROM sd GROUP BY 1, 2)",
    )
    + AP("date"),
    AP_DBL,
)
def _apd(t):
    d = adapters.security_day(t)
    mk = d.groupBy("excntry", "date").agg(F.avg("ret_exc").alias("mkt_vw_exc"))
    return fa.ap_factors(d, _chars(t), mk, "date", 3, 1, HOME)


# ---- composites ---------------------------------------------------------------------------------------
MIS = {**fa.MGMT, **fa.PERF}
Q_IN = [c for g in fa.QUALITY.values() for c in g if c != "evol__"] + ["roeq_be_std", "roe_be_std"]
BASES = ["tvol", "prc", "me", "prc_high", "prc_low", "dolvol"]


def _fake_sql(names, offset=0):
    return ", ".join(
        f"CASE WHEN (id + midx + {j}) % {5 + j % 4} <> 0 THEN {BASES[j % 6]} {'+' if j % 2 else '-'} {j} * tvol END AS {n}" for j, n in enumerate(names, start=offset)
    )


def _fake(df, names, offset=0):
    out = {}
    for j, n in enumerate(names, start=offset):
        b, q = F.col(BASES[j % 6]), j * F.col("tvol")
        out[n] = F.when((F.col("id") + F.col("midx") + j) % (5 + j % 4) != 0, b + q if j % 2 else b - q)
    return df.withColumns(out)


def _avg_rank(src, names, min_n, desc):
    parts = []
    for n in names:
        o = "DESC" if desc[n] else "ASC"
        parts.append(
            f"CASE WHEN {n} IS NOT NULL AND count({n}) OVER g >= {min_n} THEN rank() OVER (PARTITION BY excntry, eom ORDER BY {n} {o} NULLS LAST) + (count(*) OVER (PARTITION BY excntry, eom, {n}) - 1) / 2.0::DOUBLE END AS r_{n}, count({n}) OVER g AS k_{n}"
        )
    return f"SELECT id, excntry, eom, {', '.join(parts)} FROM {src} WINDOW g AS (PARTITION BY excntry, eom)"


def lmean(cols):
    return f"list_avg(list_filter([{', '.join(cols)}], lambda x: x IS NOT NULL))"


def nulls_in(cols):
    return " + ".join(f"CAST({c} IS NULL AS INT)" for c in cols)


PCT = {n: f"r_{n} / k_{n}" for n in MIS}


@query(
    "mispricing",
    with_(sm("part"), f"cx AS (SELECT *, {_fake_sql(MIS)} FROM sm WHERE {OK} AND ret_exc IS NOT NULL AND me IS NOT NULL)", f"rk AS ({_avg_rank('cx', MIS, 30, MIS)})",
          "pc AS (SELECT id, eom, " + ", ".join(f"{e} AS p_{n}" for n, e in PCT.items()) + " FROM rk)")
    + "SELECT id, eom, "
    + ", ".join(f"CASE WHEN {nulls_in([f'p_{n}' for n in g])} <= 3 THEN {lmean([f'p_{n}' for n in g])} END AS mispricing_{lab}" for lab, g in (("perf", fa.PERF), ("mgmt", fa.MGMT)))
    + " FROM pc",
    "mispricing_perf mispricing_mgmt",
)
def _mis(t):
    return fa.mispricing(_fake(adapters.security_month(t, "part"), MIS), 30)


Z_ALL = {k: v for g in fa.QUALITY.values() for k, v in g.items()}
zsql = lambda n: f"(r_{n} - avg(r_{n}) OVER g) / nullif(stddev_samp(r_{n}) OVER g, 0) AS z_{n}"
ONE = {"prof": False, "growth": False, "safety": False}


@query(
    "qmj",
    with_(
        sm("part"), f"c0 AS (SELECT *, {_fake_sql(Q_IN)} FROM sm WHERE {OK} AND ret_exc IS NOT NULL AND me IS NOT NULL)", "cx AS (SELECT *, coalesce(2 * roeq_be_std, roe_be_std) AS evol__ FROM c0)",
        f"rk AS ({_avg_rank('cx', Z_ALL, 30, Z_ALL)})",
        "zz AS (SELECT id, excntry, eom, " + ", ".join(zsql(n) for n in Z_ALL) + " FROM rk WINDOW g AS (PARTITION BY excntry, eom))",
        "co AS (SELECT id, excntry, eom, " + ", ".join(f"round({lmean([f'z_{c}' for c in g])}, 12) AS {lab}" for lab, g in fa.QUALITY.items()) + " FROM zz)",
        f"r2 AS ({_avg_rank('co', ONE, 30, ONE)})",
        "z2 AS (SELECT id, excntry, eom, " + ", ".join(zsql(n).replace(f"AS z_{n}", f"AS qmj_{n}") for n in ONE) + " FROM r2 WINDOW g AS (PARTITION BY excntry, eom))",
        "c3 AS (SELECT *, round((qmj_prof + qmj_growth + qmj_safety) / 3, 12) AS tot FROM z2)", f"r3 AS ({_avg_rank('c3', {'tot': False}, 30, {'tot': False})})",
        "z3 AS (SELECT id, excntry, eom, " + zsql("tot") + " FROM r3 WINDOW g AS (PARTITION BY excntry, eom))",
    )
    + "SELECT z2.*, z_tot AS qmj FROM z2 LEFT JOIN z3 USING (id, excntry, eom)",
    "qmj_prof:5 qmj_growth:5 qmj_safety:5 qmj:4",
)
def _qmj(t):
    return fa.quality_minus_junk(_fake(adapters.security_month(t, "part"), Q_IN), 30)


# ---- characteristic portfolios ---------------------------------------------------------------------
CHARS = ["c_price", "c_volume", "c_range", "c_size"]
PC = "pc AS (SELECT sg.*, prc AS c_price, CASE WHEN (id + midx) % 9 <> 0 THEN tvol END AS c_volume, prc_high / prc_low AS c_range, CASE WHEN id % 4 <> 2 THEN me END AS c_size, CASE WHEN id % 6 <> 0 THEN 100000 * (10 + id % 9) + id END AS gics, id % 12 + 1 AS ff49 FROM sg)"


def pc_ctes(country="region"):
    return [
        sm("part", country), SIZE_CUTS, SIZE_GRP, PC,
        f"rcut AS ({cutoffs_sql('sm', 'eom', CUT_WHERE)})",
        "p1 AS (SELECT pc.* REPLACE (CASE WHEN source_crsp = 0 AND ret_exc_lead1m > ret_exc_99_9 THEN ret_exc_99_9 WHEN source_crsp = 0 AND ret_exc_lead1m < ret_exc_0_1 THEN ret_exc_0_1 ELSE ret_exc_lead1m END AS ret_exc_lead1m), "
        "least(me, nyse_p80) AS me_cap FROM pc LEFT JOIN cut USING (eom) LEFT JOIN rcut ON last_day(CAST(rcut.eom - INTERVAL 1 MONTH AS DATE)) = pc.eom WHERE size_grp IS NOT NULL AND me IS NOT NULL AND ret_exc_lead1m IS NOT NULL)",
    ]


def _pc(t, country="region"):
    unused = ("gvkey", "iid", "permco", "curcd", "shares", "adjfct", "div_tot", "div_spc", "ret_lag_dif")
    df = stage(adapters.security_month(t, "part", country).drop(*unused), "panel")
    cuts = market.size_cutoffs(df)
    i, m = F.col("id"), F.col("midx")
    df = market.size_groups(df, cuts).withColumns(
        {
            "c_price": F.col("prc"), "c_volume": F.when((i + m) % 9 != 0, F.col("tvol")), "c_range": F.col("prc_high") / F.col("prc_low"),
            "c_size": F.when(i % 4 != 2, F.col("me")), "gics": F.when(i % 6 != 0, 100000 * (10 + i % 9) + i), "ff49": i % 12 + 1,
        }
    )
    return stage(po.screen(po.winsorize_lead(po.cap_equity(df, cuts), market.return_cutoffs(df))), "stocks")


def place_ctes(min_n=10, k=3, bps="size_grp IN ('mega', 'large', 'small')"):
    return [
        "ln AS (" + " UNION ALL ".join(f"SELECT excntry, eom, id, '{c}' AS characteristic, CAST({c} AS DOUBLE) AS var, size_grp, ret_exc_lead1m, me, me_cap, coalesce({bps}, FALSE) AS bp FROM p1 WHERE {c} IS NOT NULL" for c in CHARS) + ")",
        f"lb AS (SELECT * FROM (SELECT *, sum(CAST(bp AS INT)) OVER (PARTITION BY excntry, characteristic, eom) AS bn FROM ln) WHERE bn >= {min_n})",
        "cd AS (SELECT *, coalesce(sum(CAST(bp AS INT)) OVER (PARTITION BY excntry, characteristic, eom ORDER BY var RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / bn::DOUBLE, 0) AS cdf FROM lb)",
        f"pf AS (SELECT *, CAST(least(greatest(ceil(CASE WHEN cdf = min(cdf) OVER (PARTITION BY excntry, characteristic, eom) THEN 1e-8 ELSE cdf END * {k}), 1), {k}) AS INT) AS pf FROM cd)",
    ]


NEXT = "last_day(CAST(eom + INTERVAL 1 MONTH AS DATE)) AS eom"
PFS = f"SELECT excntry, characteristic, pf, {NEXT}, count(*) AS n, median(var) AS signal, avg(ret_exc_lead1m) AS ret_ew, sum(ret_exc_lead1m * me) / sum(me) AS ret_vw, sum(ret_exc_lead1m * me_cap) / sum(me_cap) AS ret_vw_cap FROM pf GROUP BY excntry, characteristic, pf, pf.eom"
RDBL = "ret_ew ret_vw ret_vw_cap"


@query("char_portfolios", with_(*pc_ctes(), *place_ctes()) + PFS, "signal:9 " + RDBL)
def _pfs(t):
    return po.char_portfolios(_pc(t), CHARS)


@query("char_portfolios_nyse", with_(*pc_ctes(), *place_ctes(5, 5, "((crsp_exchcd = 1 AND comp_exchg IS NULL) OR (comp_exchg = 11 AND crsp_exchcd IS NULL))")) + PFS, "signal:9 " + RDBL)
def _pfs_nyse(t):
    return po.char_portfolios(_pc(t), CHARS, k=5, bps="nyse", min_n=5)


# 153 characteristics: every third one has ties, every fifth one gaps
MANY = [f"g{i:03d}" for i in range(153)]


def _many_sql():
    def one(i):
        base = ("prc", "tvol", "me", "prc_high / prc_low", "dolvol / me")[i % 5]
        c = f"floor({base} * {i % 7 + 1} / 50)" if i % 3 == 0 else f"{base} * {i % 4 - 1.5} + id % {i + 2}"
        return f"CASE WHEN (id + midx) % {i + 3} <> 0 THEN {c} END" if i % 5 == 0 else c

    return [f"CAST({one(i)} AS DOUBLE) AS {c}" for i, c in enumerate(MANY)]


MANY_SQL = "pm AS (SELECT excntry, eom, id, ret_exc_lead1m, me, me_cap, coalesce(size_grp IN ('mega', 'large', 'small'), FALSE) AS bp, " + ", ".join(_many_sql()) + " FROM p1)"
PLACE_MANY = [
    f"ln AS (UNPIVOT pm ON {', '.join(MANY)} INTO NAME characteristic VALUE var)",
    "lb AS (SELECT * FROM (SELECT *, sum(CAST(bp AS INT)) OVER (PARTITION BY excntry, characteristic, eom) AS bn FROM ln) WHERE bn >= 10)",
    *place_ctes()[2:],
]


@query("char_portfolios_153", with_(*pc_ctes(), MANY_SQL, *PLACE_MANY) + PFS, "signal:9 " + RDBL)
def _pfs_153(t):
    # dealt and sorted by country and month before they get their 153 columns, so that wide rows do not move
    stocks = _pc(t).repartition(*po.GROUP).sortWithinPartitions(*po.GROUP)
    return po.char_portfolios(stocks.selectExpr("*", *_many_sql()), MANY)


@query("ecdf_portfolio", with_(*pc_ctes(), *place_ctes()) + "SELECT excntry, characteristic, eom, id, pf FROM pf")
def _ecdf_pf(t):
    return po.assign(_pc(t), CHARS).select("excntry", "characteristic", "eom", "id", "pf")


@query("me_cap", with_(*pc_ctes()) + "SELECT id, eom, me_cap FROM p1")
def _cap(t):
    return _pc(t).select("id", "eom", "me_cap")


@query(
    "winsorize_lead_return",
    with_(sm("part"), f"cut AS ({cutoffs_sql('sm', 'eom', CUT_WHERE)})")
    + "SELECT id, sm.eom, CASE WHEN source_crsp = 0 AND ret_exc_lead1m > ret_exc_99_9 THEN ret_exc_99_9 WHEN source_crsp = 0 AND ret_exc_lead1m < ret_exc_0_1 THEN ret_exc_0_1 ELSE ret_exc_lead1m END AS ret_exc_lead1m FROM sm LEFT JOIN cut ON last_day(CAST(cut.eom - INTERVAL 1 MONTH AS DATE)) = sm.eom",
    "ret_exc_lead1m",
)
def _wl(t):
    df = adapters.security_month(t, "part")
    return po.winsorize_lead(df, market.return_cutoffs(df)).select("id", "eom", "ret_exc_lead1m")


DAYS_HIGH = "hi AS MATERIALIZED (SELECT * REPLACE (CASE WHEN id % 2 = 0 THEN id + 100000 ELSE id END AS id), year(date) AS year, month(date) AS month FROM sd)"


@query(
    "winsorize_daily_return",
    with_(
        sd(), DAYS_HIGH, f"rk AS (SELECT year, month, ret_exc, row_number() OVER (PARTITION BY year, month ORDER BY ret_exc) AS rn, count(*) OVER (PARTITION BY year, month) AS k FROM hi WHERE {CUT_WHERE})",
        f"dcut AS (SELECT year, month, {qdisc('ret_exc', 0.001, 'rn', 'k')} AS lo, {qdisc('ret_exc', 0.999, 'rn', 'k')} AS up FROM rk GROUP BY 1, 2)",
    )
    + "SELECT id, date, CASE WHEN id > 99999 AND ret_exc > up THEN up WHEN id > 99999 AND ret_exc < lo THEN lo ELSE ret_exc END AS ret_exc FROM hi LEFT JOIN dcut USING (year, month)",
    "ret_exc",
)
def _wd(t):
    d = adapters.security_day(t).withColumn("id", F.when(F.col("id") % 2 == 0, F.col("id") + 100_000).otherwise(F.col("id")))
    return po.winsorize_daily(d, market.return_cutoffs(d, "d")).select("id", "date", "ret_exc")


IND = lambda c, n: f"SELECT excntry, {c}, {NEXT}, count(*) AS n, avg(ret_exc_lead1m) AS ret_ew, sum(ret_exc_lead1m * me) / sum(me) AS ret_vw, sum(ret_exc_lead1m * me_cap) / sum(me_cap) AS ret_vw_cap FROM p2 GROUP BY excntry, {c}, p2.eom HAVING count(*) >= {n}"


@query("industry_returns", with_(*pc_ctes(), "p2 AS (SELECT * REPLACE (CAST(substr(CAST(gics AS VARCHAR), 1, 2) AS BIGINT) AS gics) FROM p1 WHERE gics IS NOT NULL)") + IND("gics", 5), RDBL)
def _ind(t):
    p = _pc(t).withColumn("gics", F.substring(F.col("gics").cast("string"), 1, 2).cast("long"))
    return po.industry_returns(p, "gics", 5)


@query("industry_returns_ff49", with_(*pc_ctes(), "p2 AS (SELECT * FROM p1 WHERE excntry = 'AMERICA')") + IND("ff49", 5), RDBL)
def _ind49(t):
    return po.industry_returns(_pc(t).filter(F.col("excntry") == "AMERICA"), "ff49", 5)


WTS = "wt AS (SELECT *, 1.0::DOUBLE / count(*) OVER g AS w_ew, me / sum(me) OVER g AS w_vw, me_cap / sum(me_cap) OVER g AS w_vw_cap FROM pf WINDOW g AS (PARTITION BY excntry, characteristic, eom, pf))"
SDP = sd("part").split(",\n", 1)[1].replace("trades AS", "trades_d AS").replace("FROM trades t", "FROM trades_d t")
DAILY = "SELECT wt.excntry, characteristic, pf, date, count(*) AS n, sum(w_ew * d.ret_exc) AS ret_ew, sum(w_vw * d.ret_exc) AS ret_vw, sum(w_vw_cap * d.ret_exc) AS ret_vw_cap FROM wt JOIN sd d ON wt.id = d.id AND wt.eom = CAST(date_trunc('month', d.date) AS DATE) - 1 WHERE d.ret_exc IS NOT NULL GROUP BY ALL"


def _daily(t):
    return po.daily_portfolios(_pc(t), adapters.security_day(t, "part"), CHARS)


@query("daily_portfolios", with_(*pc_ctes(), SDP, *place_ctes(), WTS) + DAILY, RDBL)
def _dpf(t):
    return _daily(t)


@query(
    "portfolio_signals",
    with_(*pc_ctes(), *place_ctes(), WTS)
    + f"SELECT wt.excntry, characteristic, pf, last_day(CAST(wt.eom + INTERVAL 1 MONTH AS DATE)) AS eom, " + ", ".join(f"sum(w_vw_cap * coalesce(CAST(p1.{c} AS DOUBLE), 0)) AS {c}" for c in CHARS) + " FROM wt JOIN p1 USING (id, eom) GROUP BY wt.excntry, characteristic, pf, wt.eom",
    "c_price:6 c_volume:6 c_range:6 c_size:5",
)
def _sig(t):
    return po.portfolio_signals(_pc(t), CHARS)


@query(
    "cmp",
    with_(
        *pc_ctes(), re.sub(r"CAST\((c_\w+) AS DOUBLE\)", r"ln(CAST(\1 AS DOUBLE))", place_ctes()[0]),
        "r0 AS (SELECT *, (rank() OVER (PARTITION BY excntry, characteristic, size_grp, eom ORDER BY var) + (count(*) OVER (PARTITION BY excntry, characteristic, size_grp, eom, var) - 1) / 2.0::DOUBLE) / (count(*) OVER (PARTITION BY excntry, characteristic, size_grp, eom) + 1) AS p FROM ln)",
        "r1 AS (SELECT *, p - avg(p) OVER (PARTITION BY excntry, characteristic, size_grp, eom) AS dev FROM r0)",
        "r2 AS (SELECT *, dev / nullif(sum(abs(dev)) OVER (PARTITION BY excntry, characteristic, size_grp, eom) / 2, 0) AS w FROM r1)",
    )
    + f"SELECT excntry, characteristic, size_grp, {NEXT}, count(*) AS n_stocks, sum(ret_exc_lead1m * w) AS ret_weighted, sum(var * w) AS signal_weighted FROM r2 GROUP BY excntry, characteristic, size_grp, r2.eom HAVING stddev_samp(var) <> 0",
    "ret_weighted:9 signal_weighted:7",
)
def _cmp(t):
    # characteristics in logs, as usual for sizes and volumes
    return po.managed_portfolios(_pc(t).withColumns({c: F.log(c) for c in CHARS}), CHARS)


def hml_sql(src, date, k=3, signal=True):
    cols = (["signal"] if signal else []) + ["ret_ew", "ret_vw", "ret_vw_cap"]
    d = lambda c: f"max(CASE WHEN pf = {k} THEN {c} END) - max(CASE WHEN pf = 1 THEN {c} END) AS {c}"
    return f"SELECT excntry, characteristic, {date}, max(CASE WHEN pf = {k} THEN n END) + max(CASE WHEN pf = 1 THEN n END) AS n_stocks, min(n) AS n_stocks_min, {', '.join(d(c) for c in cols)} FROM {src} WHERE pf IN (1, {k}) GROUP BY 1, 2, 3 HAVING count(*) = 2"


INFO = "inf AS (SELECT c AS characteristic, CAST(d AS BIGINT) AS direction FROM (VALUES ('c_price', -1), ('c_volume', 1), ('c_range', 1), ('c_size', -1), ('c_absent', 1)) v(c, d)), lab AS (SELECT c AS characteristic, l AS cluster FROM (VALUES ('c_price', 'value'), ('c_volume', 'trade'), ('c_range', 'trade'), ('c_size', 'size')) v(c, l))"
HML = [f"pfs AS ({PFS})", f"hml AS ({hml_sql('pfs', 'eom')})"]
LMS = "lms AS (SELECT inf.characteristic, direction, excntry, eom, n_stocks, n_stocks_min, signal * direction AS signal, ret_ew * direction AS ret_ew, ret_vw * direction AS ret_vw, ret_vw_cap * direction AS ret_vw_cap FROM inf LEFT JOIN hml USING (characteristic))"


def _info(t):
    rows = [("c_price", -1), ("c_volume", 1), ("c_range", 1), ("c_size", -1), ("c_absent", 1)]
    return t.spark.createDataFrame(rows, "characteristic string, direction long")


def _labels(t):
    return t.spark.createDataFrame([("c_price", "value"), ("c_volume", "trade"), ("c_range", "trade"), ("c_size", "size")], "characteristic string, cluster string")


def _hml(t, country="region", min_n=10):
    return po.high_minus_low(po.char_portfolios(_pc(t, country), CHARS, min_n=min_n), "eom")


@query("hml", with_(*pc_ctes(), *place_ctes(), *HML) + "SELECT * FROM hml", "signal:6 " + RDBL)
def _hmlq(t):
    return _hml(t)


@query("hml_daily", with_(*pc_ctes(), SDP, *place_ctes(), WTS, f"dp AS ({DAILY})") + hml_sql("dp", "date", signal=False), RDBL)
def _hmld(t):
    return po.high_minus_low(_daily(t), "date", signal=False)


@query("lms", with_(*pc_ctes(), *place_ctes(), *HML, INFO, LMS) + "SELECT * FROM lms", "signal:6 " + RDBL)
def _lms(t):
    return po.long_minus_short(_hml(t), _info(t))


CLU = "clu AS (SELECT excntry, cluster, eom, count(*) AS n_factors, avg(ret_ew) AS ret_ew, avg(ret_vw) AS ret_vw, avg(ret_vw_cap) AS ret_vw_cap FROM lms LEFT JOIN lab USING (characteristic) GROUP BY 1, 2, 3)"


@query("cluster_portfolios", with_(*pc_ctes(), *place_ctes(), *HML, INFO, LMS, CLU) + "SELECT * FROM clu", RDBL)
def _clu(t):
    return po.cluster_portfolios(po.long_minus_short(_hml(t), _info(t)), _labels(t), "eom")


# regions: nations of the five regions, with NATION_24 as the home market
MEMB = """cc AS (SELECT n_name AS excntry, CASE WHEN n_nationkey % 3 = 0 THEN 'developed' WHEN n_nationkey % 3 = 1 THEN 'emerging' ELSE 'frontier' END AS dev FROM nation WHERE n_name NOT IN ('NATION_7', 'NATION_8')),
mem AS (SELECT 'developed' AS region, excntry, 3 AS cmin FROM cc WHERE dev = 'developed' AND excntry <> 'NATION_24' UNION ALL SELECT 'emerging', excntry, 3 FROM cc WHERE dev = 'emerging'
  UNION ALL SELECT 'frontier', excntry, 3 FROM cc WHERE dev = 'frontier' UNION ALL SELECT 'world', excntry, 1 FROM cc UNION ALL SELECT 'world_ex_us', excntry, 3 FROM cc WHERE excntry <> 'NATION_24'),
mkt AS (SELECT excntry, eom, count(*) AS stocks, sum(me) AS me_lag1, avg(ret_exc) AS mkt_vw_exc FROM sm GROUP BY 1, 2)"""


def reg_sql(src, by, stocks, direction):
    dr = "max(direction) AS direction, " if direction else ""
    avg = ", ".join(f"sum({c} * me_lag1) / sum(me_lag1) AS {c}" for c in ("ret_ew", "ret_vw", "ret_vw_cap", "mkt_vw_exc"))
    return (
        f"SELECT * FROM (SELECT region, {by}, eom, count(*) AS n_countries, {dr}{avg} FROM {src} JOIN mkt USING (excntry, eom) JOIN mem USING (excntry) WHERE n_stocks_min >= {stocks} AND mkt_vw_exc IS NOT NULL GROUP BY region, {by}, eom, cmin HAVING count(*) >= cmin)"
        f" QUALIFY count(*) OVER (PARTITION BY region, {by}) >= 24"
    )


def _members(t):
    k = F.col("n_nationkey") % 3
    c = t.nation.select(F.col("n_name").alias("excntry"), F.when(k == 0, "developed").when(k == 1, "emerging").otherwise("frontier").alias("development"))
    return po.region_table(c, "NATION_24", ["NATION_7", "NATION_8"], 3)


def _mkt(t):
    return adapters.security_month(t, "part", "nation").groupBy("excntry", "eom").agg(F.count(F.lit(1)).alias("stocks"), F.sum("me").alias("me_lag1"), F.avg("ret_exc").alias("mkt_vw_exc"))


NAT = [*pc_ctes("nation"), *place_ctes(4), *HML, INFO, LMS, MEMB]


@query("regional_portfolios", with_(*NAT) + reg_sql("lms", "characteristic", 1, True), RDBL + " mkt_vw_exc")
def _reg(t):
    lms = po.long_minus_short(_hml(t, "nation", 4), _info(t))
    return po.regional(lms, _mkt(t), _members(t), "eom", "characteristic", periods_min=24, stocks_min=1)


@query("regional_clusters", with_(*NAT, CLU, "cl2 AS (SELECT *, n_factors AS n_stocks_min FROM clu)") + reg_sql("cl2", "cluster", 1, False), RDBL + " mkt_vw_exc")
def _regc(t):
    lms = po.long_minus_short(_hml(t, "nation", 4), _info(t))
    clu = po.cluster_portfolios(lms, _labels(t), "eom").withColumnRenamed("n_factors", "n_stocks_min")
    return po.regional(clu, _mkt(t), _members(t), "eom", "cluster", periods_min=24, stocks_min=1)


CMPX = ["prc", "tvol", "dolvol"]


@query(
    "panel_compare",
    with_(
        sm("part"), "v2 AS (SELECT id, eom, prc * (1 + (id % 3) / 50.0::DOUBLE) AS prc, tvol + id % 4 AS tvol, dolvol FROM sm WHERE (id + midx) % 8 <> 0)",
        "mm AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", sm.{c} AS x, v2.{c} AS y FROM sm JOIN v2 USING (id, eom)" for c in CMPX) + ")",
        "mr AS (SELECT *, rank() OVER (PARTITION BY \"column\" ORDER BY x) + (count(*) OVER (PARTITION BY \"column\", x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY \"column\" ORDER BY y) + (count(*) OVER (PARTITION BY \"column\", y) - 1) / 2.0::DOUBLE AS ry FROM mm)",
    )
    + 'SELECT "column", count(*) AS n, corr(x, y) AS pearson, corr(rx, ry) AS spearman, avg(x) AS mean_a, avg(y) AS mean_b, stddev_samp(x) AS sd_a, stddev_samp(y) AS sd_b FROM mr GROUP BY 1',
    "pearson spearman mean_a:3 mean_b:3 sd_a:3 sd_b:3",
)
def _compare(t):
    a = adapters.security_month(t, "part").select("id", "eom", "midx", *CMPX)
    i = F.col("id")
    b = a.filter((i + F.col("midx")) % 8 != 0).withColumns({"prc": F.col("prc") * (1 + (i % 3) / F.lit(50.0)), "tvol": F.col("tvol") + i % 4})
    return po.panel_compare(a, b, ["id", "eom"], CMPX)
