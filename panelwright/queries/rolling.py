"""Rolling metrics: every oracle regroups raw daily rows per window, independent of the partials."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ols, panel, rolling
from ..sources import adapters
from .base_sql import factors, sd, sm, with_
from .markets import qdisc
from .registry import query

ZERO = 2  # months with this many zero returns or more are left out
D1 = """d1 AS (SELECT id, date, excntry, midx AS m, eom, CASE WHEN ret_lag_dif <= 14 THEN ret_exc END AS ret_exc, CASE WHEN ret_lag_dif <= 14 THEN ret END AS ret,
  dolvol AS dolvol_d, shares, tvol, prc / adjfct AS prc_adj, mktrf, smb_ff, hml, smb_hxz, roe, inv,
  sum(CASE WHEN ret_local = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY id, eom) AS zero_obs FROM sd JOIN fct USING (excntry, date))"""


def win(k: int, where: str, src: str = "d1") -> str:
    return f"w0 AS (SELECT *, unnest(generate_series(m, m + {k - 1})) AS em FROM {src} WHERE {where})"


RETW = f"ret_exc IS NOT NULL AND zero_obs < {ZERO}"
EOM = "last_day(make_date((em - 1) // 12, (em - 1) % 12 + 1, 1)) AS eom"


def metric_sql(k: int, least: int, select: str, where: str = RETW, count: str = "ret_exc", row: str = "TRUE", having: str = "TRUE", extra: str = "") -> str:
    return (
        with_(sd(), factors("date"), D1, win(k, where), f"w AS (SELECT *, count({count}) OVER (PARTITION BY id, em) AS nn FROM w0)", *([extra] if extra else []))
        + f"SELECT id, {EOM}, {select} FROM w WHERE nn >= {least} AND {row} GROUP BY id, em HAVING {having}"
    )


def _days(t):
    f = adapters.factor_series(t, "date")
    return rolling.prepare_days(adapters.security_day(t), f)


def _roll(t, name, sfx, least, **kw):
    return rolling.roll(_days(t), [(name, sfx, least)], max_zero=ZERO, **kw)


BETA = "regr_slope(ret_exc, mktrf)"
nz = lambda c: f"CASE WHEN isfinite({c}) THEN {c} END"


@query("rvol", metric_sql(12, 40, "stddev_samp(ret_exc) AS rvol_252d"), "rvol_252d")
def _rvol(t):
    return _roll(t, "rvol", "_252d", 40)


@query("rvol_21d", metric_sql(1, 4, "stddev_samp(ret_exc) AS rvol_21d"), "rvol_21d")
def _rvol21(t):
    return _roll(t, "rvol", "_21d", 4)


@query("rmax", metric_sql(1, 4, "list_avg(list_reverse_sort(list(ret) FILTER (ret IS NOT NULL))[1:5]) AS rmax5_21d, max(ret) AS rmax1_21d"), "rmax5_21d rmax1_21d")
def _rmax(t):
    return _roll(t, "rmax", "_21d", 4)


@query("rmax_126d", metric_sql(6, 20, "list_avg(list_reverse_sort(list(ret) FILTER (ret IS NOT NULL))[1:5]) AS rmax5_126d, max(ret) AS rmax1_126d"), "rmax5_126d rmax1_126d")
def _rmax6(t):
    return _roll(t, "rmax", "_126d", 20)


@query("skew", metric_sql(6, 20, "skewness(ret_exc) AS rskew_126d"), "rskew_126d:6")
def _skew(t):
    return _roll(t, "skew", "_126d", 20)


@query("prc_to_high", metric_sql(12, 40, "arg_max(prc_adj, date) / max(prc_adj) AS prc_highprc_252d", having="count(prc_adj) >= 40"), "prc_highprc_252d")
def _prc(t):
    return _roll(t, "prc_to_high", "_252d", 40)


@query("capm", metric_sql(12, 40, f"{BETA} AS beta_252d, sqrt((regr_syy(ret_exc, mktrf) - {BETA} * regr_sxy(ret_exc, mktrf)) / (count(*) - 1)) AS ivol_capm_252d"), "beta_252d:6 ivol_capm_252d:6")
def _capm(t):
    return _roll(t, "capm", "_252d", 40)


EXT = "r AS (SELECT id, em, mktrf, mktrf - avg(mktrf) OVER g AS xd, ret_exc - avg(ret_exc) OVER g - regr_slope(ret_exc, mktrf) OVER g * (mktrf - avg(mktrf) OVER g) AS e, regr_slope(ret_exc, mktrf) OVER g AS b FROM w WHERE nn >= 20 WINDOW g AS (PARTITION BY id, em))"


@query(
    "capm_ext",
    with_(sd(), factors("date"), D1, win(6, RETW), "w AS (SELECT *, count(ret_exc) OVER (PARTITION BY id, em) AS nn FROM w0)", EXT)
    + f"SELECT id, {EOM}, max(b) AS beta_126d, stddev_samp(e) AS ivol_capm_126d, skewness(e) AS iskew_capm_126d, avg(e * xd * xd) / (sqrt(avg(e * e)) * avg(xd * xd)) AS coskew_126d FROM r GROUP BY id, em",
    "beta_126d:6 ivol_capm_126d:7 iskew_capm_126d:5 coskew_126d:5",
)
def _capm_ext(t):
    return _roll(t, "capm_ext", "_126d", 20)


@query("downbeta", metric_sql(12, 40, f"{BETA} AS betadown_252d", row="mktrf < 0", having="count(ret_exc) >= 20"), "betadown_252d:6")
def _down(t):
    return _roll(t, "downbeta", "_252d", 40)


@query("mktvol", metric_sql(12, 40, "stddev_samp(mktrf) AS __mktvol_252d"), "__mktvol_252d")
def _mktvol(t):
    return _roll(t, "mktvol", "_252d", 40)


@query("ami", metric_sql(6, 20, "avg(abs(ret) / nullif(dolvol_d, 0) * 1e6) AS ami_126d", having="count(dolvol_d) >= 20"), "ami_126d:6")
def _ami(t):
    return _roll(t, "ami", "_126d", 20)


def ols_sql(xs: list[str], y: str = "ret_exc", src: str = "w1", keys: str = "id, em") -> tuple[list[str], str]:
    """Residuals by successive partialling-out: each step removes one regressor from all the rest."""
    ctes = []
    cols = [y, *xs]
    prev = src
    for i, x in enumerate(xs):
        rest = [c for c in cols if c not in xs[: i + 1]]
        exprs = ", ".join(
            f"{c} - avg({c}) OVER g - coalesce(regr_slope({c}, {x}) OVER g, 0) * ({x} - avg({x}) OVER g) AS {c}" for c in rest
        )
        ctes.append(f"{src}_{i} AS (SELECT {keys}, {exprs} FROM {prev} WINDOW g AS (PARTITION BY {keys}))")
        prev = f"{src}_{i}"
    return ctes, prev


def resid_query(name: str, xs: list[str], ddof: int, k: int, least: int) -> str:
    ctes, last = ols_sql(xs)
    have = " AND ".join(f"{x} IS NOT NULL" for x in xs)
    return (
        with_(sd(), factors("date"), D1, win(k, RETW), f"w1 AS (SELECT id, em, ret_exc, {', '.join(xs)} FROM (SELECT *, count(ret_exc) OVER (PARTITION BY id, em) AS nn FROM w0) WHERE nn >= {least} AND {have})", *ctes)
        + f"SELECT id, {EOM}, sqrt(sum(ret_exc * ret_exc) / (count(*) - {ddof})) AS ivol_{name}_126d, skewness(ret_exc) AS iskew_{name}_126d FROM {last} GROUP BY id, em"
    )


@query("ff3_resid", resid_query("ff3", ["mktrf", "smb_ff", "hml"], 3, 6, 20), "ivol_ff3_126d:6 iskew_ff3_126d:5")
def _ff3(t):
    return _roll(t, "ff3", "_126d", 20)


@query("hxz4_resid", resid_query("hxz4", ["mktrf", "smb_hxz", "roe", "inv"], 4, 6, 20), "ivol_hxz4_126d:6 iskew_hxz4_126d:5")
def _hxz4(t):
    return _roll(t, "hxz4", "_126d", 20)


LEADLAG = "ll AS (SELECT excntry, date, lead(mktrf) OVER (PARTITION BY excntry, last_day(date) ORDER BY date) AS mktrf_ld1, lag(mktrf) OVER (PARTITION BY excntry ORDER BY date) AS mktrf_lg1 FROM fct)"


def _frisch_sum(xs: list[str]) -> str:
    """Sum of slopes from the 3x3 normal equations by Cramer's rule."""
    a, b, c = xs
    s = lambda u, v: f"regr_sxy({u}, {v})"
    q = ", ".join(f"{s(u, v)} AS s_{i}{j}" for i, u in enumerate(xs) for j, v in enumerate(xs)) + ", " + ", ".join(f"{s('ret_exc', u)} AS t_{i}" for i, u in enumerate(xs))
    det = lambda m: f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]}) + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))"
    base = [[f"s_{i}{j}" for j in range(3)] for i in range(3)]
    tops = []
    for k in range(3):
        m = [[f"t_{i}" if j == k else base[i][j] for j in range(3)] for i in range(3)]
        tops.append(det(m))
    return q, f"({' + '.join(tops)}) / nullif({det(base)}, 0)"


_Q, _B = _frisch_sum(["mktrf", "mktrf_ld1", "mktrf_lg1"])


@query(
    "dimson_beta",
    with_(
        sd(), factors("date"), D1, LEADLAG,
        f"d2 AS (SELECT d1.*, mktrf_ld1, mktrf_lg1, count(*) OVER (PARTITION BY id, d1.eom) AS n1 FROM d1 JOIN ll USING (excntry, date) WHERE {RETW})",
        win(6, "TRUE", "d2"),
        "w AS (SELECT *, count(ret_exc) OVER (PARTITION BY id, em) AS nn FROM w0)",
        f"s AS (SELECT id, em, {_Q} FROM w WHERE nn >= 20 AND n1 >= 3 AND mktrf_ld1 IS NOT NULL AND mktrf_lg1 IS NOT NULL GROUP BY id, em)",
    )
    + f"SELECT id, {EOM}, {_B} AS beta_dimson_126d FROM s",
    "beta_dimson_126d:5",
)
def _dimson(t):
    f = adapters.factor_series(t, "date")
    ll = panel.market_lead_lag(f).select("excntry", "date", "mktrf_ld1", "mktrf_lg1", F.lit(True).alias("lead_lag__"))
    days = rolling.prepare_days(adapters.security_day(t), f).join(ll, ["excntry", "date"])
    return rolling.roll(days, [("dimsonbeta", "_126d", 20)], max_zero=ZERO, custom={"dimsonbeta": rolling.dimsonbeta(3)})


@query(
    "zero_trades",
    with_(
        sd(), factors("date"), D1, win(6, "tvol IS NOT NULL"),
        "z AS (SELECT id, em, avg(CAST(tvol = 0 AS INT)) * 21 AS z, avg(CASE WHEN shares <> 0 THEN tvol / (shares * 1e6) END) AS tn FROM (SELECT *, count(tvol) OVER (PARTITION BY id, em) AS nn FROM w0) WHERE nn >= 20 GROUP BY id, em)",
        "q AS (SELECT *, round(tn, 15) AS tr FROM z)",
    )
    + f"SELECT id, {EOM}, z + (rank() OVER (PARTITION BY em ORDER BY tr DESC) + (count(*) OVER (PARTITION BY em, tr) - 1) / 2.0) / count(tn) OVER (PARTITION BY em) / 100 AS zero_trades_126d FROM q",
    "zero_trades_126d:7",
)
def _zero(t):
    return _roll(t, "zero_trades", "_126d", 20)


@query("dolvol", metric_sql(6, 20, "avg(dolvol_d) AS dolvol_126d, CASE WHEN avg(dolvol_d) <> 0 THEN stddev_samp(dolvol_d) / avg(dolvol_d) END AS dolvol_var_126d", where="dolvol_d IS NOT NULL", count="dolvol_d"), "dolvol_126d:0 dolvol_var_126d:6")
def _dolvol(t):
    return _roll(t, "dolvol", "_126d", 20)


TN = "CASE WHEN shares <> 0 THEN tvol / (shares * 1e6) END"


@query("turnover", metric_sql(6, 0, f"avg({TN}) AS turnover_126d, CASE WHEN avg({TN}) <> 0 THEN stddev_samp({TN}) / avg({TN}) END AS turnover_var_126d", where="tvol IS NOT NULL", having="count(*) >= 20"), "turnover_126d:12 turnover_var_126d:6")
def _turnover(t):
    return _roll(t, "turnover", "_126d", 20)


CORR = f"d3 AS (SELECT id, m, zero_obs, ret_exc + lag(ret_exc) OVER w + lag(ret_exc, 2) OVER w AS ret_exc_3l, mktrf + lag(mktrf) OVER w + lag(mktrf, 2) OVER w AS mkt_exc_3l FROM d1 WINDOW w AS (PARTITION BY id ORDER BY date))"


def _corr_days(t):
    return panel.three_day_sums(_days(t), {"ret_exc": "ret_exc_3l", "mktrf": "mkt_exc_3l"})


@query(
    "mktcorr",
    with_(sd(), factors("date"), D1, CORR, win(60, f"ret_exc_3l IS NOT NULL AND zero_obs < {ZERO}", "d3"))
    + f"SELECT id, {EOM}, corr(ret_exc_3l, mkt_exc_3l) AS corr_1260d FROM w0 GROUP BY id, em HAVING least(count(ret_exc_3l), count(mkt_exc_3l)) >= 150",
    "corr_1260d:6",
)
def _mktcorr(t):
    return rolling.roll(_corr_days(t), [("mktcorr", "_1260d", 150)], max_zero=ZERO)


GRID = [("rvol", "_21d", 4), ("rmax", "_21d", 4), ("rvol", "_252d", 40), ("mktvol", "_252d", 40), ("mktcorr", "_1260d", 150)]


@query(
    "bab_and_ratio",
    with_(
        sd(), factors("date"), D1, CORR,
        f"a AS (SELECT id, m AS em, list_avg(list_reverse_sort(list(ret) FILTER (ret IS NOT NULL))[1:5]) AS rmax5_21d FROM d1 WHERE {RETW} GROUP BY 1, 2 HAVING count(*) >= 4)",
        f"b AS (SELECT id, em, stddev_samp(ret_exc) AS rv, stddev_samp(mktrf) AS mv FROM (SELECT *, unnest(generate_series(m, m + 11)) AS em FROM d1 WHERE {RETW}) GROUP BY 1, 2 HAVING count(*) >= 40)",
        f"c AS (SELECT id, em, corr(ret_exc_3l, mkt_exc_3l) AS co FROM (SELECT *, unnest(generate_series(m, m + 59)) AS em FROM d3 WHERE ret_exc_3l IS NOT NULL AND zero_obs < {ZERO}) GROUP BY 1, 2 HAVING count(*) >= 150)",
    )
    + f"SELECT id, {EOM}, co * rv / nullif(mv, 0) AS betabab_1260d, rmax5_21d / nullif(rv, 0) AS rmax5_rvol_21d FROM a FULL JOIN b USING (id, em) FULL JOIN c USING (id, em)",
    "betabab_1260d:6 rmax5_rvol_21d:6",
)
def _bab(t):
    """Five metrics over three windows from a single pass over the days."""
    grid = [("rmax", "_21d", 4), ("rvol", "_252d", 40), ("mktvol", "_252d", 40), ("mktcorr", "_1260d", 150)]
    return rolling.derived_daily(rolling.roll(_corr_days(t), grid, max_zero=ZERO)).select("id", "eom", "betabab_1260d", "rmax5_rvol_21d")


@query(
    "grouped_ols",
    with_(sd(), factors("date"), "w1 AS (SELECT id, year(date) AS em, ret_exc, mktrf, smb_ff, hml FROM sd JOIN fct USING (excntry, date) WHERE ret_exc IS NOT NULL)", *ols_sql(["mktrf", "smb_ff", "hml"])[0],
          "f AS (SELECT id, em, count(*) AS n, sqrt(sum(ret_exc * ret_exc) / nullif(count(*) - 4, 0)) AS resid_sd, skewness(ret_exc) AS resid_skew FROM w1_2 GROUP BY 1, 2)")
    + "SELECT id, em AS year, n, resid_sd, resid_skew FROM f WHERE n >= 30",
    "resid_sd:6 resid_skew:5",
)
def _ols(t):
    df = adapters.security_day(t).join(adapters.factor_series(t, "date"), ["excntry", "date"]).withColumn("year", F.year("date"))
    g = ols.grouped_ols(df, ["id", "year"], "ret_exc", ["mktrf", "smb_ff", "hml"])
    return g.filter("n >= 30").select("id", "year", "n", "resid_sd", "resid_skew")


@query(
    "grouped_ols_slopes",
    with_(sd(), factors("date"))
    + "SELECT id, year(date) AS year, count(*) AS n, regr_intercept(ret_exc, mktrf) AS intercept, regr_slope(ret_exc, mktrf) AS b_mktrf FROM sd JOIN fct USING (excntry, date) WHERE ret_exc IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 30",
    "intercept:6 b_mktrf:6",
)
def _ols1(t):
    df = adapters.security_day(t).join(adapters.factor_series(t, "date"), ["excntry", "date"]).withColumn("year", F.year("date"))
    return ols.grouped_ols(df, ["id", "year"], "ret_exc", ["mktrf"]).filter("n >= 30").select("id", "year", "n", "intercept", "b_mktrf")


MSF2 = f"""m1 AS (SELECT id, eom, midx AS m, ret_exc, mktrf, hml, smb_ff FROM sm JOIN fct USING (excntry, eom) WHERE ret_local <> 0 AND ret_exc IS NOT NULL AND ret_lag_dif = 1 AND mktrf IS NOT NULL),
pc AS (SELECT eom, {qdisc('ret_exc', 0.02, 'rn', 'k')} AS lo, {qdisc('ret_exc', 0.98, 'rn', 'k')} AS hi FROM (SELECT *, row_number() OVER (PARTITION BY eom ORDER BY ret_exc) AS rn, count(*) OVER (PARTITION BY eom) AS k FROM m1) GROUP BY eom),
m2 AS (SELECT m1.* REPLACE (CASE WHEN ret_exc < lo THEN lo WHEN ret_exc > hi THEN hi ELSE ret_exc END AS ret_exc) FROM m1 LEFT JOIN pc USING (eom)),
me AS (SELECT DISTINCT m AS em, eom AS e FROM m2)"""


def _rows(t):
    return rolling.regression_rows(adapters.security_month(t), adapters.factor_series(t), (0.02, 0.98))


@query(
    "market_beta",
    with_(sm(), factors(), MSF2, "w0 AS (SELECT *, unnest(generate_series(m, m + 35)) AS em FROM m2)")
    + f"SELECT id, e AS eom, {BETA} AS beta_36m, sqrt((regr_syy(ret_exc, mktrf) - {BETA} * regr_sxy(ret_exc, mktrf)) / (count(*) - 1)) AS ivol_capm_36m FROM w0 JOIN me USING (em) GROUP BY id, em, e HAVING count(*) >= 18",
    "beta_36m:6 ivol_capm_36m:6",
)
def _beta(t):
    return rolling.market_beta(_rows(t), 36, 18)


def _resmom_sql(incl, skip):
    # coefficients by partialling out over full windows, residuals of the sub-window afterwards
    ctes, last = ols_sql(["mktrf", "hml", "smb_ff"], keys="id, em, m")
    ctes = [c.replace("PARTITION BY id, em, m", "PARTITION BY id, em") for c in ctes]
    return (
        with_(sm(), factors(), MSF2, "w1 AS (SELECT id, em, m, ret_exc, mktrf, hml, smb_ff FROM (SELECT *, count(*) OVER (PARTITION BY id, em) AS nn FROM (SELECT *, unnest(generate_series(m, m + 35)) AS em FROM m2)) WHERE nn >= 24)", *ctes)
        + f"SELECT id, e AS eom, avg(ret_exc) / nullif(stddev_samp(ret_exc), 0) AS resff3_{incl}_{skip} FROM {last} JOIN me USING (em) WHERE m <= em - {skip} AND m > em - {incl} GROUP BY id, em, e"
    )


@query("residual_momentum", _resmom_sql(12, 1), "resff3_12_1:5")
def _resmom12(t):
    return rolling.residual_momentum(_rows(t), 36, 24, 12, 1)


@query("residual_momentum_6_1", _resmom_sql(6, 1), "resff3_6_1:5")
def _resmom6(t):
    return rolling.residual_momentum(_rows(t), 36, 24, 6, 1)


@query(
    "calendar_rolling",
    with_(sd(), "w0 AS (SELECT *, unnest(generate_series(midx, midx + 2)) AS em FROM sd)")
    + f"SELECT id, {EOM}, sum(tvol) AS vol, max(prc) AS top, count(*) AS n FROM w0 GROUP BY id, em",
)
def _calendar(t):
    """Trailing three-month windows of plain additive partials, absent end months included."""
    mt = rolling.Metric("plain", lambda df, s, m: df, [], sums={"vol": F.sum("tvol"), "n": F.count(F.lit(1))}, maxs={"top": F.max("prc")}, gated=False)
    days = adapters.security_day(t).withColumns({"m": F.col("midx"), "zero__": F.lit(0)})
    out = rolling.trailing(rolling.month_partials(days, [mt]), 3, [mt])
    from ..functions.dates import index_to_month_end

    return out.select("id", index_to_month_end("end_month").alias("eom"), "vol", "top", "n")
