"""Accounting characteristics. The oracle formulas are written out separately in SQL."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import accounting as ac
from ..operators import expand, joins, rows, scores
from ..operators.panel import History
from ..sources import adapters
from .base_sql import FXQ, QYTD, accounts, dense, sm, with_
from .registry import query
from .relational import CROSS, FXD

K = "gvkey, curcd, datadate"
KEYS = ["gvkey", "curcd", "datadate"]
OVER = "WINDOW w AS (PARTITION BY gvkey, curcd ORDER BY datadate)"


def L(x: str, k: int) -> str:
    return f"lag({x}, {k}) OVER w"


def _z(x: str) -> str:
    return f"coalesce({x}, 0)"


def _either(a: str, sign: str, b: str) -> str:
    """Sum or difference that is missing only if both parts are."""
    return f"CASE WHEN coalesce({a}, {b}) IS NOT NULL THEN {_z(a)} {sign} {_z(b)} END"


def _pos(x: str) -> str:
    return f"CASE WHEN ({x}) > 0 THEN {x} END"


def _change(x: str) -> str:
    return f"({x} - lag({x}, 12) OVER w)"


#: One definition per item; ``items`` finds the order.
ITEM_SQL = {
    # earnings
    "sale_x": "coalesce(sale, revt)", "opex_x": "coalesce(xopr, cogs + xsga)", "gp_x": "coalesce(gp, sale_x - cogs)",
    "ebitda_x": "coalesce(ebitda, oibdp, sale_x - opex_x, gp_x - xsga)", "ebit_x": "coalesce(ebit, oiadp, ebitda_x - dp)",
    "op_x": f"ebitda_x + {_z('xrd')}", "ope_x": "ebitda_x - xint", "pi_x": f"coalesce(pi, ebit_x - xint + {_z('spi')} + {_z('nopi')})",
    "xido_x": f"""coalesce(xido, xi + {_z('"do"')})""", "ni_x": f"coalesce(ib, ni - xido_x, pi_x - txt - {_z('mii')})",
    "nix_x": f'coalesce(ni, ni_x + {_z("xido_x")}, ni_x + xi + "do")', "fi_x": "nix_x + xint",
    # claims on the firm
    "debt_x": _either("dltt", "+", "dlc"), "netdebt_x": f"debt_x - {_z('che')}", "pstk_x": "coalesce(pstkrv, pstkl, pstk)",
    "txditc_x": f"coalesce(txditc, {_either('txdb', '+', 'itcb')})", "seq_x": f'coalesce(seq, ceq + {_z("pstk_x")}, "at" - lt)',
    "be_x": _pos(f"seq_x + {_z('txditc_x')} - {_z('pstk_x')}"),
    "bev_x": _pos(f"coalesce(icapt + {_z('dlc')} - {_z('che')}, netdebt_x + seq_x + {_z('mib')})"),
    "cl_x": "coalesce(lct, ap + dlc + txp + lco)", "ncl_x": "lt - cl_x", "col_x": f"cl_x - {_z('dlc')}", "ncol_x": "lt - cl_x - dltt",
    "ol_x": "col_x + ncol_x", "fnl_x": f"debt_x + {_z('pstk_x')}",
    # what it holds
    "at_x": f'coalesce("at", seq_x + dltt + {_z("lct")} + {_z("lo")} + {_z("txditc")})', "ca_x": "coalesce(act, rect + invt + che + aco)",
    "nca_x": "at_x - ca_x", "coa_x": "ca_x - che", "ncoa_x": f"at_x - ca_x - {_z('ivao')}", "oa_x": "coa_x + ncoa_x",
    "caliq_x": "coalesce(ca_x - invt, che + rect)", "aliq_x": f"che + 0.75 * coa_x + 0.5 * (at_x - ca_x - {_z('intan')})",
    "fna_x": f"{_z('ivst')} + {_z('ivao')}", "ppeinv_x": "ppegt + invt", "lnoa_x": "ppent + intan + ao - lo + dp",
    # differences of both
    "nwc_x": "ca_x - cl_x", "cowc_x": "coa_x - col_x", "nncoa_x": "ncoa_x - ncol_x", "noa_x": "oa_x - ol_x", "nfna_x": "fna_x - fnl_x",
    # flows
    "oacc_x": f"CASE WHEN count > 12 THEN coalesce(ni_x - oancf, {_change('cowc_x')} + {_change('nncoa_x')}) END",
    "tacc_x": f"CASE WHEN count > 12 THEN oacc_x + {_change('nfna_x')} END",
    "ocf_x": f"coalesce(oancf, ni_x - oacc_x, ni_x + dp - {_z('wcapt')})", "fcf_x": "ocf_x - capx", "cop_x": f"ebitda_x + {_z('xrd')} - oacc_x",
    "div_x": "coalesce(dvt, dv)", "eqis_x": "sstk", "eqbb_x": _either("prstkc", "+", "purtshr"), "eqnetis_x": _either("eqis_x", "-", "eqbb_x"),
    "eqpo_x": "div_x + eqbb_x", "eqnpo_x": "div_x - eqnetis_x",
    "dltnetis_x": f"CASE WHEN count > 12 OR coalesce(dltis, dltr, ltdch) IS NOT NULL THEN coalesce({_either('dltis', '-', 'dltr')}, ltdch, {_change('dltt')}) END",
    "dstnetis_x": f"CASE WHEN count > 12 OR dlcch IS NOT NULL THEN coalesce(dlcch, {_change('dlc')}) END",
    "dbnetis_x": _either("dstnetis_x", "+", "dltnetis_x"), "netis_x": "eqnetis_x + dbnetis_x",
    "fincf_x": f"coalesce(fincf, netis_x - dv + {_z('fiao')} + {_z('txbcof')})",
}
ITEM_NAMES = list(ITEM_SQL)
LEVELS: list[list[str]] = []
while sum(map(len, LEVELS)) < len(ITEM_SQL):
    known = {n for level in LEVELS for n in level}
    LEVELS.append([n for n, e in ITEM_SQL.items() if n not in known and set(re.findall(r"\w+_x\b", e)) <= known])


def items(src: str = "accd") -> str:
    neg = ", ".join(f'CASE WHEN "{c}" >= 0 THEN "{c}" END AS "{c}"' for c in ("at", "sale", "revt", "dv", "che"))
    ctes = [f"x0 AS (SELECT * REPLACE ({neg}) FROM {src})"]
    for i, level in enumerate(LEVELS, start=1):
        ctes.append(f"x{i} AS (SELECT *, {', '.join(f'{ITEM_SQL[n]} AS {n}' for n in level)} FROM x{i - 1} {OVER})")
    return ",\n".join(ctes)


X = f"x{len(LEVELS)}"
FREQ = "quarterly"
BASE = [dense(FREQ), items()]


def acc_sql(exprs: dict[str, str], src: str = X, extra: list[str] | None = None) -> str:
    sel = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    return with_(*BASE, *(extra or [])) + f"SELECT {K}, {sel} FROM {src} {OVER}"


def _panel(t):
    return ac.accounting_panel(adapters.firm_accounting(t, FREQ))


def _layer(t, make):
    """Spark side of a formula block: keys plus the block's columns."""
    h = History(_panel(t), ["gvkey", "curcd"], "datadate")
    exprs = make(h)
    return h.add(exprs).df.select(*KEYS, *exprs)


def block(name: str, sql_exprs: dict[str, str], make, digits: int = 6):
    query(name, acc_sql(sql_exprs), " ".join(f"{n}:{digits}" for n in sql_exprs))(lambda t: _layer(t, make))


# ---- formula texts ----------------------------------------------------------------------------------
def s_growth(x, k):
    return {f"{x.replace('_x', '')}_gr{k // 12}": f"CASE WHEN {L(x, k)} > 0 AND count > {k} THEN {x} / {L(x, k)} - 1 END"}


def s_chg(x, k):
    return {f"{x.replace('_x', '')}_gr{k // 12}a": f"CASE WHEN at_x > 0 AND count > {k} THEN ({x} - {L(x, k)}) / at_x END"}


def s_ratio(name, n, d, mode=1):
    guard = {1: f"{d} <> 0", 2: f"{d} <> 0", 3: f"{d} > 0", 8: f"{n} > 0 AND {d} > 0"}[mode]
    den = f"abs({d})" if mode == 2 else d
    return {name: f"CASE WHEN {guard} THEN {n} / {den} END"}


def merged(*ds):
    out = {}
    for d in ds:
        out |= d
    return out


# The items of each published family of characteristics.
GROWTH = "at_x ca_x nca_x lt cl_x ncl_x be_x pstk_x debt_x sale_x cogs xsga opex_x capx invt".split()
CHANGE = "che invt rect ppegt ivao ivst intan dlc ap txp dltt txditc coa_x col_x cowc_x ncoa_x ncol_x nncoa_x oa_x ol_x fna_x fnl_x nfna_x gp_x ebitda_x ebit_x ope_x ni_x nix_x dp fincf_x ocf_x fcf_x nwc_x eqnetis_x dltnetis_x dstnetis_x dbnetis_x netis_x eqnpo_x txt eqbb_x eqis_x div_x eqpo_x capx be_x".split()
S_RATIOS = merged(
    s_ratio("capx_at", "capx", "at_x"), s_ratio("rd_at", "xrd", "at_x"), s_ratio("spi_at", "spi", "at_x"), s_ratio("xido_at", "xido_x", "at_x"),
    s_ratio("nri_at", "(spi + xido_x)", "at_x"), *[s_ratio(f"{i}_sale", f"{i}_x", "sale_x") for i in ("gp", "ebitda", "ebit", "pi", "ni", "ocf", "fcf")],
    s_ratio("nix_sale", "ni", "sale_x"), *[s_ratio(f"{i}_at", f"{i}_x", "at_x") for i in ("gp", "ebitda", "ebit", "fi", "cop", "ni")],
    *[s_ratio(f"{i}_be", f"{i}_x", "be_x") for i in ("ope", "ni", "nix", "ocf", "fcf")],
    *[s_ratio(f"{i}_bev", f"{i}_x", "bev_x") for i in ("gp", "ebitda", "ebit", "fi", "cop", "be", "debt", "pstk")],
    *[s_ratio(f"{i}_ppen", f"{i}_x", "ppent") for i in ("gp", "ebitda", "fcf")],
    *[s_ratio(f"{i}_at", f"{i}_x", "at_x") for i in ("fincf", "netis", "eqnetis", "eqis", "dbnetis", "dltnetis", "dstnetis", "eqnpo", "eqbb", "div", "debt")],
    s_ratio("debt_be", "debt_x", "be_x"), s_ratio("ebit_int", "ebit_x", "xint"), s_ratio("cash_bev", "che", "bev_x"),
    s_ratio("debtlt_bev", "dltt", "bev_x"), s_ratio("debtst_bev", "dlc", "bev_x"), s_ratio("oaccruals_at", "oacc_x", "at_x"),
    s_ratio("taccruals_at", "tacc_x", "at_x"), s_ratio("oaccruals_ni", "oacc_x", "nix_x", 2), s_ratio("taccruals_ni", "tacc_x", "nix_x", 2),
    {"noa_at": f"CASE WHEN count > 12 AND {L('at_x', 12)} > 0 THEN noa_x / {L('at_x', 12)} END"},
)
S_SOUND = merged(
    *[s_ratio(*r) for r in (
        ("int_debt", "xint", "debt_x"), ("ocf_debt", "ocf_x", "debt_x"), ("ebitda_debt", "ebitda_x", "debt_x"), ("debtst_debt", "dlc", "debt_x"),
        ("debtlt_debt", "dltt", "debt_x"), ("int_debtlt", "xint", "dltt"), ("profit_cl", "ebitda_x", "cl_x"), ("ocf_cl", "ocf_x", "cl_x"),
        ("cash_lt", "che", "lt"), ("cl_lt", "cl_x", "lt"), ("inv_act", "invt", "act"), ("rec_act", "rect", "act"), ("opex_at", "opex_x", "at_x"),
        ("nwc_at", "nwc_x", "at_x"), ("lt_ppen", "lt", "ppent"), ("debtlt_be", "dltt", "be_x"), ("fcf_ocf", "fcf_x", "ocf_x", 3),
        ("adv_sale", "xad", "sale_x"), ("staff_sale", "xlr", "sale_x"), ("sale_bev", "sale_x", "bev_x"), ("rd_sale", "xrd", "sale_x"),
        ("sale_be", "sale_x", "be_x"), ("sale_nwc", "sale_x", "nwc_x", 3), ("tax_pi", "txt", "pi_x", 3), ("cash_at", "che", "at_x", 3),
        ("ni_emp", "ni_x", "emp", 3), ("sale_emp", "sale_x", "emp", 3))],
    {"div_ni": "CASE WHEN coalesce(nix_x, ni_x) > 0 AND nix_x <> 0 THEN div_x / nix_x END"},
)


def mean_year_sql(x):
    return f"coalesce(({x} + {L(x, 12)}) / 2, {x}, {L(x, 12)})"


def days_sql(a, f):
    return f"CASE WHEN count > 12 AND {f} <> 0 THEN 365 * {mean_year_sql(a)} / {f} END"


def turn_sql(n, d):
    return f"CASE WHEN count > 12 AND {mean_year_sql(d)} <> 0 THEN {n} / {mean_year_sql(d)} END"


CYCLE = f"(({days_sql('invt', 'cogs')}) + ({days_sql('rect', 'sale_x')}) - ({days_sql('ap', 'cogs')}))"
S_LIQ = merged(
    {"inv_days": days_sql("invt", "cogs"), "rec_days": days_sql("rect", "sale_x"), "ap_days": days_sql("ap", "cogs")},
    s_ratio("cash_cl", "che", "cl_x", 3), s_ratio("caliq_cl", "caliq_x", "cl_x", 3), s_ratio("ca_cl", "ca_x", "cl_x", 3),
    {"cash_conversion": f"CASE WHEN {CYCLE} >= 0 THEN {CYCLE} END",
     "inv_turnover": turn_sql("cogs", "invt"), "at_turnover": turn_sql("sale_x", "at_x"), "rec_turnover": turn_sql("sale_x", "rect"),
     "ap_turnover": turn_sql(f"(cogs + (invt - {L('invt', 12)}))", "ap")},
)


def over_lag_sql(n, d, k=12):
    return f"CASE WHEN count > {k} AND {L(d, k)} > 0 THEN {n} / {L(d, k)} END"


S_LAGPROF = {"op_atl1": over_lag_sql("op_x", "at_x"), "gp_atl1": over_lag_sql("gp_x", "at_x"), "ope_bel1": over_lag_sql("ope_x", "be_x"), "cop_atl1": over_lag_sql("cop_x", "at_x"), "aliq_at": over_lag_sql("aliq_x", "at_x")}


def ce_sql(x):
    return f"CASE WHEN {L(x, 12)} + {L(x, 24)} > 0 AND count > 24 THEN {x} / (({L(x, 12)} + {L(x, 24)}) / 2) - 1 END"


def flt(vals):
    return f"list_filter([{', '.join(vals)}], lambda x: x IS NOT NULL)"


def su_sql(x, q=8, least=6):
    past = flt([f"{L(x, 3 + 3 * j)} - {L(x, 15 + 3 * j)}" for j in range(q)])
    return f"CASE WHEN count > {12 + 3 * q} AND len({past}) > {least} AND list_stddev_samp({past}) <> 0 THEN (({x} - {L(x, 12)}) - list_avg({past})) / list_stddev_samp({past}) END"


def sd_sql(x, n, least, step):
    past = flt([x] + [L(x, step * j) for j in range(1, n)])
    return f"CASE WHEN count > {(n - 1) * step} AND len({past}) >= {least} THEN list_stddev_samp({past}) END"


def ratio_at(n, d, k):
    return f"CASE WHEN {L(d, k)} > 0 THEN {L(n, k)} / {L(d, k)} END" if k else f"CASE WHEN {d} > 0 THEN {n} / {d} END"


def ch5_sql(n, d):
    return f"CASE WHEN count > 60 THEN ({ratio_at(n, d, 0)}) - ({ratio_at(n, d, 60)}) END"


def ev_sql(years=5):
    def ser(n):
        return flt([f"CASE WHEN {L('at_x', 12 * j + 12)} <> 0 THEN {L(n, 12 * j)} / {L('at_x', 12 * j + 12)} END" for j in range(years)])
    a, b = ser("ni_x"), ser("ocf_x")
    return f"CASE WHEN count > {12 * years} AND len({a}) >= {years} AND len({b}) >= {years} AND list_stddev_samp({b}) > 0 THEN list_stddev_samp({a}) / list_stddev_samp({b}) END"


MARGINS = "mg AS (SELECT *, CASE WHEN sale_qtr > 0 THEN ocf_qtr / sale_qtr END AS ocfq_saleq, CASE WHEN sale_qtr > 0 THEN ni_qtr / sale_qtr END AS niq_saleq, CASE WHEN be_x > 0 THEN ni_qtr / be_x END AS roeq, CASE WHEN be_x > 0 THEN ni_x / be_x END AS roe FROM " + X + ")"
S_VOL = {"ocfq_saleq_std": sd_sql("ocfq_saleq", 16, 8, 3), "niq_saleq_std": sd_sql("niq_saleq", 16, 8, 3), "roeq_be_std": sd_sql("roeq", 20, 12, 3), "roe_be_std": sd_sql("roe", 5, 5, 12)}
S_CH5 = {"gpoa_ch5": ch5_sql("gp_x", "at_x"), "roe_ch5": ch5_sql("ni_x", "be_x"), "roa_ch5": ch5_sql("ni_x", "at_x"), "cfoa_ch5": ch5_sql("ocf_x", "at_x"), "gmar_ch5": ch5_sql("gp_x", "sale_x")}


def f_sql():
    at1, at2 = L("at_x", 12), L("at_x", 24)
    roa = f"CASE WHEN count > 12 AND {at1} > 0 THEN ni_x / {at1} END"
    croa = f"CASE WHEN count > 12 AND {at1} > 0 THEN ocf_x / {at1} END"
    roa1 = f"CASE WHEN count > 24 AND {at2} > 0 THEN {L('ni_x', 12)} / {at2} END"
    d = lambda n, m: f"CASE WHEN count > 12 AND {m} > 0 AND {L(m, 12)} > 0 THEN {n} / {m} - {L(n, 12)} / {L(m, 12)} END"
    turn = f"CASE WHEN count > 24 AND {at1} > 0 AND {at2} > 0 THEN sale_x / {at1} - {L('sale_x', 12)} / {at2} END"
    ups = [roa, croa, f"({roa}) - ({roa1})", f"({croa}) - ({roa})", d("ca_x", "cl_x"), d("gp_x", "sale_x"), turn]
    return " + ".join([f"CAST(({u}) > 0 AS INT)" for u in ups] + [f"CAST(({d('dltt', 'at_x')}) < 0 AS INT)", "CAST(coalesce(eqis_x, 0) = 0 AS INT)"])


def o_sql():
    r = lambda n, d: f"(CASE WHEN {d} > 0 THEN {n} / {d} END)"
    n1 = L("nix_x", 12)
    return (
        f"-1.32 - 0.407 * (CASE WHEN at_x > 0 THEN ln(at_x) END) + 6.03 * {r('debt_x', 'at_x')} - 1.43 * {r('(ca_x - cl_x)', 'at_x')} + 0.076 * {r('cl_x', 'ca_x')}"
        f" - 1.72 * (CASE WHEN lt IS NOT NULL AND at_x IS NOT NULL THEN CAST(lt > at_x AS INT) END) - 2.37 * {r('nix_x', 'at_x')} - 1.83 * {r('(pi_x + dp)', 'lt')}"
        f" + 0.285 * (CASE WHEN count > 12 AND nix_x IS NOT NULL AND {n1} IS NOT NULL THEN CAST(nix_x < 0 AND {n1} < 0 AS INT) END)"
        f" - 0.52 * (CASE WHEN count > 12 AND abs(nix_x) + abs({n1}) <> 0 THEN (nix_x - {n1}) / (abs(nix_x) + abs({n1})) END)"
    )


def z_sql():
    r = lambda n, d: f"(CASE WHEN {d} > 0 THEN {n} / {d} END)"
    return f"1.2 * {r('(ca_x - cl_x)', 'at_x')} + 1.4 * {r('re', 'at_x')} + 3.3 * {r('ebitda_x', 'at_x')} + 0.6 * {r('me_fiscal', 'lt')} + {r('sale_x', 'at_x')}"


def kz_sql():
    p = L("ppent", 12)
    o = lambda n: f"(CASE WHEN count > 12 AND {p} > 0 THEN {n} / {p} END)"
    return f"-1.002 * {o('(ni_x + dp)')} + 0.283 * (CASE WHEN at_x > 0 THEN (at_x + me_fiscal - be_x) / at_x END) + 3.139 * (CASE WHEN debt_x + seq_x <> 0 THEN debt_x / (debt_x + seq_x) END) - 39.368 * {o('div_x')} - 1.315 * {o('che')}"


def iv_sql():
    b1 = L("be_x", 12)
    po = "(CASE WHEN nix_x > 0 THEN div_x / nix_x WHEN at_x <> 0 THEN div_x / (at_x * 0.06) END)"
    roe = f"(CASE WHEN count > 12 AND be_x + {b1} > 0 THEN nix_x / ((be_x + {b1}) / 2) END)"
    val = f"(be_x + ({roe} - 0.12) / 1.12 * be_x + ({roe} - 0.12) / (1.12::DOUBLE * 0.12::DOUBLE) * ((1 + (1 - {po}) * {roe}) * be_x))"
    return f"CASE WHEN {val} > 0 THEN {val} END"


def dur_ctes() -> list[str]:
    ctes = [f"e0 AS (SELECT *, CASE WHEN count > 12 AND {L('be_x', 12)} > 1 THEN ni_x / {L('be_x', 12)} END AS r0, CASE WHEN count > 12 AND {L('sale_x', 12)} > 1 THEN sale_x / {L('sale_x', 12)} - 1 END AS g0, be_x AS b0 FROM {X} {OVER})"]
    for t in range(1, 11):
        ctes.append(f"e{t} AS (SELECT *, 0.06 * (1 - 0.24) + 0.24 * g{t - 1} AS g{t}, 0.12 * (1 - 0.57) + 0.57 * r{t - 1} AS r{t}, b{t - 1} * (1 + g{t}) AS b{t}, b{t - 1} * (r{t} - g{t}) AS c{t} FROM e{t - 1})")
    return ctes


ED_CD = " + ".join(f"c{t} / power(1.12::DOUBLE, {t})" for t in range(1, 11))
ED_W = " + ".join(f"{t} * (c{t} / power(1.12::DOUBLE, {t}))" for t in range(1, 11))
ED_ERR = "CASE WHEN " + " OR ".join(f"coalesce(b{t} < 0, FALSE)" for t in range(1, 11)) + " THEN 1.0 ELSE 0.0 END"
inc = lambda i: f"CAST({L('ni_x', 3 * i)} > {L('ni_x', 3 * i + 12)} AS INT)"
NI_INC = "CASE WHEN count >= 33 AND " + " AND ".join(f"{inc(i)} IS NOT NULL" for i in range(8)) + " THEN " + " + ".join(" * ".join(inc(j) for j in range(i + 1)) for i in range(8)) + " END"
cs_ = lambda k: f"CASE WHEN {L('sale_x', k)} > 0 THEN {L('capx', k)} / {L('sale_x', k)} END" if k else "CASE WHEN sale_x > 0 THEN capx / sale_x END"
PASTC = f"(({cs_(12)}) + ({cs_(24)}) + ({cs_(36)}))"
CAPEX = f"CASE WHEN {PASTC} <> 0 AND count > 36 THEN ({cs_(0)}) / ({PASTC} / 3) - 1 END"
EMP = f"CASE WHEN count > 12 AND 0.5 * emp + 0.5 * {L('emp', 12)} <> 0 AND (emp - {L('emp', 12)}) / (0.5 * emp + 0.5 * {L('emp', 12)}) <> 0 THEN (emp - {L('emp', 12)}) / (0.5 * emp + 0.5 * {L('emp', 12)}) END"
TANG = "CASE WHEN at_x <> 0 THEN (che + 0.715 * rect + 0.547 * invt + 0.535 * ppegt) / at_x END"
LAGA = lambda x: {f"{x.replace('_x', '')}_gr1a": f"CASE WHEN {L('at_x', 12)} > 0 AND count > 12 THEN ({x} - {L(x, 12)}) / {L('at_x', 12)} END"}
SUMA = lambda x: {f"{x.replace('_x', '')}_gr1a": f"CASE WHEN at_x + {L('at_x', 12)} > 0 AND count > 12 THEN ({x} - {L(x, 12)}) / (at_x + {L('at_x', 12)}) END"}
S_REL = {"dsale_dinv": f"({ce_sql('sale_x')}) - ({ce_sql('invt')})", "dsale_drec": f"({ce_sql('sale_x')}) - ({ce_sql('rect')})", "dgp_dsale": f"({ce_sql('gp_x')}) - ({ce_sql('sale_x')})", "dsale_dsga": f"({ce_sql('sale_x')}) - ({ce_sql('xsga')})"}
S_QTR = {"saleq_gr1": f"CASE WHEN count > 12 AND {L('sale_qtr', 12)} > 0 THEN sale_qtr / {L('sale_qtr', 12)} - 1 END", "niq_be": over_lag_sql("ni_qtr", "be_x", 3), "niq_at": over_lag_sql("ni_qtr", "at_x", 3)}
RD5 = f"CASE WHEN count > 48 AND at_x > 0 THEN (xrd + 0.8 * {L('xrd', 12)} + 0.6 * {L('xrd', 24)} + 0.4 * {L('xrd', 36)} + 0.2 * {L('xrd', 48)}) / at_x END"

# ---- registrations ------------------------------------------------------------------------------------
query("accounting_helpers", with_(*BASE) + f"SELECT {K}, {', '.join(ITEM_NAMES)} FROM {X}", " ".join(f"{n}:5" for n in ITEM_NAMES))(
    lambda t: _panel(t).select(*KEYS, *ITEM_NAMES)
)
block("var_growth", merged(*[s_growth(x, k) for k in (12, 36) for x in GROWTH]), lambda h: merged(*[ac.growth(h, x, k) for k in (12, 36) for x in ac.GROWTH_ITEMS]))
block("chg_to_assets", merged(*[s_chg(x, k) for k in (12, 36) for x in CHANGE]), lambda h: merged(*[ac.change_to_assets(h, x, k) for k in (12, 36) for x in ac.CHANGE_ITEMS]))
block("chg_to_lagassets", merged(LAGA("noa_x"), LAGA("ppeinv_x")), lambda h: ac.change_to_lag_assets(h, "noa_x") | ac.change_to_lag_assets(h, "ppeinv_x"))
block("chg_to_avgassets", SUMA("lnoa_x"), lambda h: ac.change_to_sum_assets(h, "lnoa_x"))
block("chg_to_exp", {"sale_ce": ce_sql("sale_x"), "invt_ce": ce_sql("invt")}, lambda h: ac.change_to_expected(h, "sale_x") | ac.change_to_expected(h, "invt"))
block("relative_growth", S_REL, ac.relative_growth)
block("chg_ratio", S_CH5, lambda h: merged(*[ac.change_in_ratio(h, f"{n}_ch5", a, b, 60) for n, a, b in (("gpoa", "gp_x", "at_x"), ("roe", "ni_x", "be_x"), ("roa", "ni_x", "at_x"), ("cfoa", "ocf_x", "at_x"), ("gmar", "gp_x", "sale_x"))]))
block("mean_year", {"m_invt": mean_year_sql("invt"), "m_at": mean_year_sql("at_x")}, lambda h: {"m_invt": ac.year_mean(h, "invt"), "m_at": ac.year_mean(h, "at_x")})
block("standardized_unexpected", {"sale_qtr_su": su_sql("sale_qtr"), "ni_qtr_su": su_sql("ni_qtr")}, lambda h: ac.surprise(h, "sale_qtr", 8, 6) | ac.surprise(h, "ni_qtr", 8, 6))
block("consecutive_increase_count", {"ni_inc8q": NI_INC}, ac.earnings_increases)
block("earnings_variability", {"earnings_variability": ev_sql()}, ac.earnings_variability)
block("capex_abn", {"capex_abn": CAPEX}, ac.capex_abnormal)
block("tangibility", {"tangibility": TANG}, lambda h: {"tangibility": ac.tangibility()})
block("emp_gr", {"emp_gr1": EMP}, lambda h: ac.employee_growth(h, False))
block("ratios_1", merged(*[s_growth(x, k) for k in (12, 36) for x in GROWTH], *[s_chg(x, k) for k in (12, 36) for x in CHANGE], S_RATIOS), ac.ratios_1)
block("soundness_misc_ratios", S_SOUND, lambda h: ac.soundness_ratios())
block("liquidity_efficiency", S_LIQ, ac.liquidity)
block("lagged_profitability", S_LAGPROF, ac.lagged_profitability)
block("quarterly_profitability", S_QTR, ac.quarterly_profit)
block("rd_capital", {"rd5_at": RD5}, ac.rd_capital)
block("f_score", {"f_score": f_sql()}, scores.f_score)
block("o_score", {"o_score": o_sql()}, scores.o_score)
block("z_score", {"z_score": z_sql()}, lambda h: scores.z_score())
block("kz_index", {"kz_index": kz_sql()}, scores.kz_index)
block("intrinsic_value", {"intrinsic_value": iv_sql()}, scores.intrinsic_value, 4)


def _vol(t, only):
    h = History(_panel(t), ["gvkey", "curcd"], "datadate")
    h.add(ac.margins())
    out = ac.stability(h)
    return h.add(out).df.select(*KEYS, *only)


VOLQ = ["ocfq_saleq_std", "niq_saleq_std", "roeq_be_std"]
query("volq", acc_sql({n: S_VOL[n] for n in VOLQ}, "mg", [MARGINS]), " ".join(f"{n}:7" for n in VOLQ))(lambda t: _vol(t, VOLQ))
query("vola", acc_sql({"roe_be_std": S_VOL["roe_be_std"]}, "mg", [MARGINS]), "roe_be_std:7")(lambda t: _vol(t, ["roe_be_std"]))
STAB = S_VOL | {"earnings_variability": ev_sql()} | S_CH5
query("stability_and_scores", acc_sql(STAB, "mg", [MARGINS]), " ".join(f"{n}:6" for n in STAB))(lambda t: _vol(t, list(STAB)))


@query(
    "equity_duration",
    with_(*BASE, *dur_ctes()) + f"SELECT {K}, 10 + 1.12::DOUBLE / 0.12 AS ed_constant, {ED_CD} AS ed_cd, {ED_W} AS ed_cd_w, {ED_ERR} AS ed_err FROM e10",
    "ed_constant ed_cd:4 ed_cd_w:4 ed_err",
)
def _dur(t):
    return scores.equity_duration(_panel(t)).select(*KEYS, "ed_constant", "ed_cd", "ed_cd_w", "ed_err")


PERS = [
    f"pb AS (SELECT gvkey, curcd, datadate, y, CASE WHEN count > 12 THEN {L('y', 12)} END AS x FROM (SELECT *, CASE WHEN at_x > 0 THEN ni_x / at_x END AS y FROM {X}) {OVER})",
    "pr AS (SELECT * FROM pb WHERE y IS NOT NULL AND x IS NOT NULL)",
    "pc AS (SELECT a.*, c.datadate AS calc FROM pr a JOIN (SELECT DISTINCT datadate FROM pr) c ON a.datadate > make_date(year(c.datadate) - 5, 12, 31) AND a.datadate <= c.datadate AND month(a.datadate) = month(c.datadate))",
    "pf AS (SELECT gvkey, curcd, calc, regr_slope(y, x) OVER g AS b, y - (regr_intercept(y, x) OVER g + regr_slope(y, x) OVER g * x) AS e, count(*) OVER g AS n FROM pc WINDOW g AS (PARTITION BY gvkey, curcd, calc))",
    "pp AS (SELECT gvkey, curcd, calc AS datadate, max(b) AS ni_ar1, stddev_samp(e) AS ni_ivol FROM pf WHERE n >= {n} GROUP BY 1, 2, 3)",
]


@query("regr_slope_intercept_resid", with_(*BASE, *[c.replace("{n}", "4") for c in PERS]) + "SELECT * FROM pp", "ni_ar1:6 ni_ivol")
def _pers(t):
    return ac.earnings_persistence(_panel(t), 5, 4)


# ---- market-scaled characteristics and the full build -----------------------------------------------
MEQ = "meq AS (SELECT lpad(CAST(id AS VARCHAR), 6, '0') AS gvkey, eom, max(CASE WHEN id % 8 = 7 AND midx % 5 = 0 THEN -1.0 ELSE me END) AS me_company FROM sm WHERE primary_sec = 1 AND common = 1 AND obs_main = 1 GROUP BY 1, 2)"


def _equity(t):
    m = adapters.security_month(t).withColumns(
        {
            "gvkey": F.lpad(F.col("id").cast("string"), 6, "0"),
            "me_company": F.when((F.col("id") % 8 == 7) & (F.col("midx") % 5 == 0), F.lit(-1.0)).otherwise(F.col("me")),
        }
    )
    return ac.market_equity(m, "me_company")


ME = "at_x be_x debt_x netdebt_x che sale_x gp_x ebitda_x ebit_x ope_x ni_x nix_x cop_x ocf_x fcf_x div_x eqbb_x eqis_x eqpo_x eqnpo_x eqnetis_x xrd".split()
MEV = "at_x bev_x ppent be_x che sale_x gp_x ebitda_x ebit_x ope_x ni_x nix_x cop_x ocf_x fcf_x debt_x pstk_x dltt dlc dltnetis_x dstnetis_x dbnetis_x netis_x fincf_x".split()


def stem(x):
    return x.replace("_x", "")


def pub_ctes(src: str, lag: int = 4, top: int = 18) -> list[str]:
    return [
        f"u0 AS (SELECT *, last_day(CAST(datadate + INTERVAL {lag} MONTH AS DATE)) AS a0 FROM {src} WHERE data_available = 1)",
        f"u1 AS (SELECT *, least(last_day(CAST(lead(a0) OVER (PARTITION BY gvkey ORDER BY datadate) - INTERVAL 1 MONTH AS DATE)), last_day(CAST(datadate + INTERVAL {top} MONTH AS DATE))) AS b0_ FROM u0)",
        "u2 AS (SELECT *, last_day(CAST(unnest(generate_series(date_trunc('month', a0), date_trunc('month', b0_), INTERVAL 1 MONTH)) AS DATE)) AS public_date FROM u1 WHERE b0_ >= a0)",
    ]


MEX = (
    "m0 AS (SELECT u2.*, meq.me_company AS mec, fxd.fx FROM u2 LEFT JOIN fxd ON u2.public_date = fxd.datadate AND u2.curcd = fxd.curcdd LEFT JOIN meq ON u2.gvkey = meq.gvkey AND u2.public_date = meq.eom)",
    "m1 AS (SELECT *, CASE WHEN mec > 0 THEN mec END AS me_company, CASE WHEN mec + netdebt_x * fx > 0 THEN mec + netdebt_x * fx END AS mev, CASE WHEN at_x * fx - be_x * fx + mec > 0 THEN at_x * fx - be_x * fx + mec END AS mat FROM m0)",
)
DUR = "((ed_cd_w * fx) / me_company + ed_constant * ((me_company - ed_cd * fx) / me_company))"
S_ME = merged(
    {"enterprise_value": "mev"},
    *[{f"{stem(x)}_me": f"CASE WHEN me_company <> 0 THEN {x} * fx / me_company END"} for x in ME],
    *[{f"{stem(x)}_mev": f"CASE WHEN mev <> 0 THEN {x} * fx / mev END"} for x in MEV],
    {"ival_me": "CASE WHEN me_company <> 0 THEN intrinsic_value * fx / me_company END",
     "aliq_mat": "CASE WHEN lag(mat, 12) OVER p <> 0 THEN aliq_x * fx / lag(mat, 12) OVER p END",
     "eq_dur": f"CASE WHEN ed_err = 0 AND {DUR} > 0 THEN {DUR} END"},
)
DURX = ["dx AS (SELECT *, 10 + 1.12::DOUBLE / 0.12 AS ed_constant, " + ED_CD + " AS ed_cd, " + ED_W + " AS ed_cd_w, " + ED_ERR + f" AS ed_err, {iv_sql()} AS intrinsic_value FROM e10 {OVER})"]
MARKET = [sm(), MEQ, FXQ, CROSS, FXD, *BASE, *dur_ctes(), *DURX]


@query(
    "scale_me_mev",
    with_(*MARKET, *pub_ctes("dx"), *MEX)
    + f"SELECT gvkey, public_date, {', '.join(f'{e} AS {n}' for n, e in S_ME.items())} FROM m1 WINDOW p AS (PARTITION BY gvkey ORDER BY public_date)",
    " ".join(f"{n}:{3 if n == 'enterprise_value' else 6}" for n in S_ME),
)
def _scale(t):
    h = History(_panel(t), ["gvkey", "curcd"], "datadate")
    h.add(scores.intrinsic_value(h))
    df = scores.equity_duration(h.df)
    pub = expand.publication_expand(df.filter("data_available = 1"), "gvkey", "datadate", 4, 18)
    fx = expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t)))
    pub = pub.join(fx.select(F.col("datadate").alias("public_date"), F.col("curcdd").alias("curcd"), "fx"), ["public_date", "curcd"], "left")
    return ac.market_scaled(pub, _equity(t)).select("gvkey", "public_date", *S_ME)


S_DIRECT = merged(
    *[s_growth(x, k) for k in (12, 36) for x in GROWTH], *[s_chg(x, k) for k in (12, 36) for x in CHANGE], S_RATIOS, S_SOUND, S_LIQ, S_LAGPROF, S_QTR, S_REL,
    LAGA("noa_x"), LAGA("ppeinv_x"), SUMA("lnoa_x"), s_growth("capx", 24),
    {"rd5_at": RD5, "ni_inc8q": NI_INC, "capex_abn": CAPEX, "tangibility": TANG, "emp_gr1": EMP, "saleq_su": su_sql("sale_qtr"), "niq_su": su_sql("ni_qtr"),
     "f_score": f_sql(), "o_score": o_sql(), "z_score": z_sql(), "kz_index": kz_sql(), "at_be": "CASE WHEN be_x <> 0 THEN at_x / be_x END"},
    s_ratio("pi_nix", "pi_x", "nix_x", 8), s_ratio("ocf_at", "ocf_x", "at_x", 3), s_ratio("op_at", "op_x", "at_x", 3), STAB,
)
LAYER_2 = {
    "sale_emp_gr1": f"CASE WHEN count > 12 AND {L('sale_emp', 12)} > 0 THEN sale_emp / {L('sale_emp', 12)} - 1 END",
    "niq_be_chg1": f"CASE WHEN count > 12 THEN niq_be - {L('niq_be', 12)} END",
    "niq_at_chg1": f"CASE WHEN count > 12 THEN niq_at - {L('niq_at', 12)} END",
    "ocf_at_chg1": f"CASE WHEN count > 12 THEN ocf_at - {L('ocf_at', 12)} END",
}
RENAME = [("xrd", "rd"), ("xsga", "sga"), ("dlc", "debtst"), ("dltt", "debtlt"), ("oancf", "ocf"), ("ppegt", "ppeg"), ("ppent", "ppen"), ("che", "cash"), ("invt", "inv"), ("rect", "rec"), ("txt", "tax"), ("ivao", "lti"), ("ivst", "sti"), ("sale_qtr", "saleq"), ("ni_qtr", "niq"), ("ocf_qtr", "ocfq")]


def final_name(n):
    for a, b in RENAME:
        n = n.replace(a, b, 1)
    return n


NAMES = ac.characteristic_names()
_ALL = {final_name(n): f"dd.{n}" if not n.endswith("_su") else f"dd.{n}" for n in (*S_DIRECT, *LAYER_2)} | {final_name(n): f"({e})" for n, e in S_ME.items()}
_ALL |= {"assets": "at_x * fx", "sales": "sale_x * fx", "book_equity": "be_x * fx", "net_income": "ni_x * fx", "intrinsic_value": "intrinsic_value", "ni_ar1": "pers.ni_ar1", "ni_ivol": "pers.ni_ivol"}


def build_sql() -> str:
    direct = ", ".join(f"{e} AS {n}" for n, e in S_DIRECT.items())
    two = ", ".join(f"{e} AS {n}" for n, e in LAYER_2.items())
    sel = ", ".join(f"{_ALL[n].replace('dd.', 'm1.').replace('pers.', 'm1.')} AS {n}" for n in NAMES)
    margin = MARGINS.replace(f"FROM {X}", "FROM dx")
    return (
        with_(*MARKET, margin, *[c.replace("{n}", "5") for c in PERS],
              f"d1 AS (SELECT *, {direct} FROM mg {OVER})", f"d2 AS (SELECT *, {two} FROM d1 {OVER})",
              "d3 AS (SELECT d2.*, ni_ar1, ni_ivol FROM d2 LEFT JOIN pp USING (gvkey, curcd, datadate))", *pub_ctes("d3"), *MEX)
        + f"SELECT gvkey, public_date, datadate, {sel} FROM m1 WINDOW p AS (PARTITION BY gvkey ORDER BY public_date)"
    )


MONEY = {"assets", "sales", "book_equity", "net_income", "enterprise_value", "intrinsic_value"}


@query("create_acc_chars", build_sql(), " ".join(f"{n}:{3 if n in MONEY else 7 if n == 'emp_gr1' else 5}" for n in NAMES))
def _build(t):
    """All 315 characteristics at publication months."""
    fx = expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t)))
    return ac.create_characteristics(adapters.firm_accounting(t, FREQ), fx, _equity(t))


ANN = "an AS (SELECT gvkey, datadate, last_day(CAST(datadate + INTERVAL 4 MONTH AS DATE)) AS public_date, gp, xrd, capx FROM acc WHERE month(datadate) = 12), qt AS (SELECT gvkey, datadate, last_day(CAST(datadate + INTERVAL (CASE WHEN month(datadate) = 12 THEN 4 ELSE 10 - month(datadate) % 7 END) MONTH AS DATE)) AS public_date, gp, xrd, capx FROM acc), q1 AS (SELECT gvkey, public_date, arg_max(datadate, datadate) AS qd, arg_max({'a': gp}, datadate).a AS gp, arg_max({'a': xrd}, datadate).a AS xrd, arg_max({'a': capx}, datadate).a AS capx FROM qt GROUP BY 1, 2)"


@query(
    "fresher_of_two",
    with_(accounts("quarterly"), ANN)
    + "SELECT an.gvkey, an.public_date, " + ", ".join(f"CASE WHEN an.{c} IS NULL OR (q1.{c} IS NOT NULL AND qd > an.datadate) THEN q1.{c} ELSE an.{c} END AS {c}" for c in ("gp", "xrd", "capx")) + " FROM an LEFT JOIN q1 ON an.gvkey = q1.gvkey AND an.public_date = q1.public_date",
    "gp:6 xrd:6 capx:6",
)
def _fresher(t):
    acc = adapters.firm_accounting(t, "quarterly").select("gvkey", "datadate", "gp", "xrd", "capx")
    m = F.month("datadate")
    ann = acc.filter(m == 12).withColumn("public_date", F.last_day(F.add_months("datadate", 4)))
    q = acc.withColumn("public_date", F.last_day(F.add_months("datadate", F.when(m == 12, 4).otherwise(10 - m % 7))))
    q = rows.keep_last(q, ["gvkey", "public_date"], ["datadate"]).withColumnsRenamed({c: f"{c}_qitem" for c in ("gp", "xrd", "capx")})
    return ac.fresher_of_two(ann, q, ["gp", "xrd", "capx"])


def list_sql() -> str:
    counts = ", ".join(f"count({n}) AS {n}" for n in NAMES)
    return f"SELECT name, n_known, n_rows FROM (UNPIVOT (SELECT {counts}, count(*) AS n_rows FROM (\n{build_sql()}\n) AS built) ON * EXCLUDE (n_rows) INTO NAME name VALUE n_known)"


@query("char_list", list_sql())
def _chars(t):
    """The kept characteristics by name: how many rows of the build know each, out of all rows."""
    return ac.known_counts(_build(t), NAMES)


STD = """wd AS (SELECT *, CASE WHEN CAST(gvkey AS BIGINT) % 3 = 0 THEN 'FS' ELSE 'INDL' END AS indfmt FROM acc WHERE CAST(gvkey AS BIGINT) % 4 <> 1
  UNION ALL SELECT * REPLACE (gp + 7 AS gp), 'INDL' FROM acc WHERE CAST(gvkey AS BIGINT) % 6 = 0 AND CAST(gvkey AS BIGINT) % 4 <> 1),
w1 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY gvkey, datadate) AS k FROM wd WHERE datadate >= DATE '1996-01-01') WHERE k = 1 OR (k = 2 AND indfmt = 'INDL')),
bo AS (SELECT gvkey, curcd, datadate, 'GLOBAL' AS source, gp, sale, ib + coalesce(xi, 0) + coalesce("do", 0) AS ni FROM w1
  UNION ALL SELECT gvkey, curcd, datadate, 'NA', gp * 2, sale, ni FROM acc WHERE (CAST(gvkey AS BIGINT) % 5 < 3 OR CAST(gvkey AS BIGINT) % 4 = 1) AND datadate >= DATE '1996-01-01'),
b1 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY gvkey, datadate) AS k FROM bo) WHERE k = 1 OR (k = 2 AND source = 'GLOBAL'))"""


@query(
    "standardize_accounting",
    with_(accounts(), sm(), MEQ, FXQ, CROSS, FXD, STD)
    + """SELECT b1.gvkey, b1.datadate, 'USD' AS curcd, source, gp * fx AS gp, sale * fx AS sale, ni * fx AS ni, me_company AS me_fiscal
FROM b1 LEFT JOIN fxd ON b1.datadate = fxd.datadate AND b1.curcd = fxd.curcdd LEFT JOIN meq ON b1.gvkey = meq.gvkey AND b1.datadate = meq.eom""",
    "gp:4 sale:4 ni:4 me_fiscal:2",
)
def _standard(t):
    acc = adapters.firm_accounting(t).select(*KEYS, "gp", "sale", "ib", "xi", "do", "ni")
    k = F.col("gvkey").cast("long")
    std = lambda df, fmt, pop: df.withColumns({"datafmt": F.lit(fmt), "popsrc": F.lit(pop), "consol": F.lit("C")})
    world = acc.filter(k % 4 != 1).withColumn("indfmt", F.when(k % 3 == 0, "FS").otherwise("INDL"))
    world = world.unionByName(acc.filter((k % 6 == 0) & (k % 4 != 1)).withColumns({"gp": F.col("gp") + 7, "indfmt": F.lit("INDL")}))
    home = acc.filter((k % 5 < 3) | (k % 4 == 1)).withColumns({"gp": F.col("gp") * 2, "indfmt": F.lit("INDL")})
    fx = expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t)))
    out = ac.standardize(std(world, "HIST_STD", "I"), std(home, "STD", "D"), fx, _equity(t), ["gp", "sale", "ni"], "1996-01-01")
    return out.select("gvkey", "datadate", "curcd", "source", "gp", "sale", "ni", "me_fiscal")


STDQ = """q0 AS (SELECT gvkey, curcdq, datadate, fyr, fyearq, fqtr, saley, iby, CASE WHEN CAST(gvkey AS BIGINT) % 2 = 0 THEN iby * 2 END AS oancfy, CASE WHEN fqtr <> 2 THEN saley / fqtr END AS saleq, saley * 3 AS atq, 1.5::DOUBLE AS dpq FROM qy WHERE datadate >= DATE '1993-01-01'),
qb AS (SELECT *, 'GLOBAL' AS source FROM q0 WHERE CAST(gvkey AS BIGINT) % 4 <> 1 UNION ALL SELECT * REPLACE (saley * 2 AS saley, atq * 2 AS atq), 'NA' FROM q0 WHERE CAST(gvkey AS BIGINT) % 5 < 3 OR CAST(gvkey AS BIGINT) % 4 = 1),
qm AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY gvkey, fyr, fyearq, fqtr) AS k FROM qb) WHERE k = 1 OR (k = 2 AND source = 'GLOBAL')),
qx AS (SELECT qm.* REPLACE (saley * fx AS saley, iby * fx AS iby, oancfy * fx AS oancfy, saleq * fx AS saleq, atq * fx AS atq, dpq * fx AS dpq, 'USD' AS curcdq) FROM qm LEFT JOIN fxd ON qm.datadate = fxd.datadate AND qm.curcdq = fxd.curcdd),
qn AS (SELECT *, row_number() OVER (PARTITION BY gvkey, fyr, fyearq ORDER BY fqtr) AS n FROM qx),
qf AS (SELECT *, CASE WHEN n = 1 THEN fqtr = 1 ELSE fqtr - lag(fqtr) OVER w = 1 END AS ok, CASE WHEN n = 1 THEN saley ELSE saley - lag(saley) OVER w END AS ds, CASE WHEN n = 1 THEN iby ELSE iby - lag(iby) OVER w END AS di, CASE WHEN n = 1 THEN oancfy ELSE oancfy - lag(oancfy) OVER w END AS do_ FROM qn WINDOW w AS (PARTITION BY gvkey, fyr, fyearq ORDER BY fqtr)),
qg AS (SELECT *, coalesce(saleq, CASE WHEN ok THEN ds END) AS sq, CASE WHEN ok THEN di END AS iq, CASE WHEN ok THEN do_ END AS oq FROM qf),
qs AS (SELECT *, coalesce(lag(curcdq, 3) OVER w = curcdq AND fqtr + lag(fqtr) OVER w + lag(fqtr, 2) OVER w + lag(fqtr, 3) OVER w = 10, FALSE) AS run,
  sq + lag(sq) OVER w + lag(sq, 2) OVER w + lag(sq, 3) OVER w AS s4, iq + lag(iq) OVER w + lag(iq, 2) OVER w + lag(iq, 3) OVER w AS i4, oq + lag(oq) OVER w + lag(oq, 2) OVER w + lag(oq, 3) OVER w AS o4 FROM qg WINDOW w AS (PARTITION BY gvkey, fyr ORDER BY fyearq, fqtr)),
qo AS (SELECT *, row_number() OVER (PARTITION BY gvkey, datadate ORDER BY fyr DESC, fyearq DESC, fqtr DESC) AS top FROM qs)"""


@query(
    "standardize_accounting_quarterly",
    with_(QYTD, sm(), MEQ, FXQ, CROSS, FXD, STDQ)
    + """SELECT qo.gvkey, qo.datadate, curcdq AS curcd, source, atq AS "at", iq AS ni_qtr, sq AS sale_qtr, coalesce(oq, iq + dpq) AS ocf_qtr,
  coalesce(CASE WHEN run THEN s4 END, CASE WHEN fqtr = 4 THEN saley END) AS sale, coalesce(CASE WHEN run THEN i4 END, CASE WHEN fqtr = 4 THEN iby END) AS ib,
  coalesce(CASE WHEN run THEN o4 END, CASE WHEN fqtr = 4 THEN oancfy END) AS oancf, me_company AS me_fiscal
FROM qo LEFT JOIN meq ON qo.gvkey = meq.gvkey AND qo.datadate = meq.eom WHERE top = 1""",
    "at:3 ni_qtr:3 sale_qtr:3 ocf_qtr:3 sale:0 ib:3 oancf:3 me_fiscal:2",
)
def _standard_q(t):
    k = F.col("gvkey").cast("long")
    null = F.lit(None).cast("double")
    q = adapters.quarterly_ytd(t).withColumns(
        {
            "oancfy": F.when(k % 2 == 0, F.col("iby") * 2), "saleq": F.when(F.col("fqtr") != 2, F.col("saley") / F.col("fqtr")), "atq": F.col("saley") * 3,
            "dpq": F.lit(1.5), "ibq": null, "xiq": null, "ppentq": null, "dpactq": null, "indfmt": F.lit("INDL"), "consol": F.lit("C"),
        }
    )
    world = q.filter(k % 4 != 1).withColumns({"datafmt": F.lit("HIST_STD"), "popsrc": F.lit("I")})
    home = q.filter((k % 5 < 3) | (k % 4 == 1)).withColumns({"saley": F.col("saley") * 2, "atq": F.col("atq") * 2, "datafmt": F.lit("STD"), "popsrc": F.lit("D")})
    fx = expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t)))
    out = ac.standardize_quarterly(world, home, fx, _equity(t), ["sale", "ib", "oancf"], ["atq"], "1993-01-01")
    return out.select("gvkey", "datadate", "curcd", "source", "at", "ni_qtr", "sale_qtr", "ocf_qtr", "sale", "ib", "oancf", "me_fiscal")
