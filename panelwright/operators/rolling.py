"""Calendar-aligned rolling metrics over trailing windows of k months.

Daily rows are folded once to (security, month) partial sums, whatever the number of metrics and
window lengths. A window of k months is then a range frame over at most one row per month, so the
fan-out of overlapping windows never touches daily data. End months in which the security has no
rows still get a value as long as their window holds data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from ..functions.dates import index_to_month_end, month_index
from ..functions.nulls import div, safe_div
from ..functions.stats import Moments, list_mean, moment_name, monomials, sd_from_ss, skew_from_sums
from ..sources.scratch import stage
from .crosssection import average_rank, rank_table
from .ols import about_anchor, centred_sums, fit, moment_sums

# Window suffix -> months.
WINDOWS = {"_21d": 1, "_126d": 6, "_252d": 12, "_1260d": 60}


def months_of(sfx: str | int) -> int:
    return WINDOWS[sfx] if sfx in WINDOWS else int(sfx)


def prepare_days(days: DataFrame, factors: DataFrame, max_gap: int = 14) -> DataFrame:
    """Join factors, drop days without a market return, void returns after long gaps. Factors are written first: else
    their size may be known too late, and the days are shuffled and sorted for the join."""
    near = F.col("ret_lag_dif") <= max_gap
    return (
        days.join(stage(factors, "factors"), ["excntry", "date"])
        .filter(F.col("mktrf").isNotNull())
        .withColumns(
            {
                "zero__": (F.col("ret_local") == 0).cast("int"),
                "ret_exc": F.when(near, F.col("ret_exc")),
                "ret": F.when(near, F.col("ret")),
                "dolvol_d": F.col("dolvol"),
                "prc_adj": safe_div("prc", "adjfct"),
                "m": month_index("eom"),
            }
        )
    )


@dataclass
class Metric:
    """A rolling statistic: monthly partials, how they combine, and the final formulas.

    ``sums``, ``maxs``, ``lasts`` and ``tops`` are month aggregates; ``gated`` partials are void in
    months with too many zero returns. ``finish`` receives the frame with the combined partials
    under the same names and returns it with output columns and the boolean ``<name>__ok``.
    """

    name: str
    finish: Callable[[DataFrame, str, int], DataFrame]
    outputs: list[str]
    sums: dict[str, Column] = field(default_factory=dict)
    maxs: dict[str, Column] = field(default_factory=dict)
    lasts: dict[str, Column] = field(default_factory=dict)
    tops: dict[str, Column] = field(default_factory=dict)
    gated: bool = True
    central: Central | None = None

    def partials(self) -> dict[str, Column]:
        return self.sums | self.maxs | self.lasts | self.tops

    def added(self) -> list[str]:
        """Columns that add up over months."""
        return [*self.sums, *(self.central.names() if self.central else [])]


@dataclass
class Central:
    """Central moments of ``columns`` up to ``order`` over the rows of ``use``, counted in the column ``n``."""

    columns: list[str]
    order: int
    use: Column
    tag: str
    n: str

    def names(self) -> list[str]:
        return [moment_name(t) for t in monomials([f"{self.tag}{c}" for c in self.columns], self.order)]

    def state(self) -> tuple[dict[str, Column], dict[str, Column]]:
        return centred_sums(self.columns, self.use, self.tag, self.n, self.order)


def _have(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _n(use: Column) -> Column:
    return F.count_if(use)


def _named(tag: str, v: str) -> str:
    return moment_name((f"{tag}{v}",))


def _sd(tag: str, v: str, n: str, ddof: int = 1) -> Column:
    m = Moments([f"{tag}{v}"], n)
    raw2 = F.col(moment_name((f"{tag}{v}", f"{tag}{v}")))
    return sd_from_ss(m.c2(f"{tag}{v}", f"{tag}{v}"), F.col(n).cast("double"), ddof, raw2 * 1e-13)


RET = ["ret_exc"]


def _done(df: DataFrame, name: str, ok: Column, out: dict[str, Column]) -> DataFrame:
    ok = F.coalesce(ok, F.lit(False))
    return df.withColumns({f"{name}__ok": ok} | {k: F.when(ok, v) for k, v in out.items()})


def rvol() -> Metric:
    tag = "rv_"
    def finish(df, sfx, least):
        return _done(df, "rvol", F.col("rv_n") >= least, {f"rvol{sfx}": _sd(tag, "ret_exc", "rv_n")})
    use = _have("ret_exc")
    return Metric("rvol", finish, ["rvol"], {"rv_n": _n(use)}, central=Central(RET, 2, use, tag, "rv_n"))


def mktvol() -> Metric:
    tag = "mv_"
    use = _have("ret_exc")
    def finish(df, sfx, least):
        return _done(df, "mktvol", F.col("mv_n") >= least, {f"__mktvol{sfx}": _sd(tag, "mktrf", "mv_n")})
    return Metric("mktvol", finish, ["__mktvol"], {"mv_n": _n(use)}, central=Central(["mktrf"], 2, use, tag, "mv_n"))


def rmax() -> Metric:
    use = _have("ret_exc")
    # a security has at most 31 days in a month, so the collected list is bounded
    top = F.slice(F.sort_array(F.collect_list(F.when(use, F.col("ret"))), asc=False), 1, 5)
    def finish(df, sfx, least):
        best = F.slice(F.sort_array("mx_top", asc=False), 1, 5)
        out = {f"rmax5{sfx}": list_mean(best), f"rmax1{sfx}": F.when(F.size(best) > 0, F.element_at(best, 1))}
        return _done(df, "rmax", F.col("mx_n") >= least, out)
    return Metric("rmax", finish, ["rmax5", "rmax1"], {"mx_n": _n(use)}, tops={"mx_top": top})


def skew() -> Metric:
    tag = "sk_"
    use = _have("ret_exc")
    def finish(df, sfx, least):
        m = Moments([f"{tag}ret_exc"], "sk_n")
        v = f"{tag}ret_exc"
        ss = m.c2(v, v)
        out = skew_from_sums(ss, m.c3(v, v, v), m.n, F.col(moment_name((v, v))) * 1e-13)
        return _done(df, "skew", F.col("sk_n") >= least, {f"rskew{sfx}": out})
    return Metric("skew", finish, ["rskew"], {"sk_n": _n(use)}, central=Central(RET, 3, use, tag, "sk_n"))


def prc_to_high() -> Metric:
    use = _have("ret_exc")
    def finish(df, sfx, least):
        ok = (F.col("ph_n") >= least) & (F.col("ph_np") >= least)
        return _done(df, "prc_to_high", ok, {f"prc_highprc{sfx}": div("ph_last", "ph_max")})
    return Metric(
        "prc_to_high", finish, ["prc_highprc"],
        sums={"ph_n": _n(use), "ph_np": F.count(F.when(use, F.col("prc_adj")))},
        maxs={"ph_max": F.max(F.when(use, F.col("prc_adj")))},
        lasts={"ph_last": F.max_by("prc_adj", F.when(use, F.col("date")))},
    )


def _slope(tag: str, y: str, x: str, n: str) -> tuple[Column, Column, Moments]:
    m = Moments([f"{tag}{y}", f"{tag}{x}"], n)
    sxx = m.c2(f"{tag}{x}", f"{tag}{x}")
    clean = F.when(sxx > F.col(moment_name((f"{tag}{x}", f"{tag}{x}"))) * 1e-13, sxx)
    return div(m.c2(f"{tag}{y}", f"{tag}{x}"), clean), clean, m


def capm() -> Metric:
    tag = "cp_"
    use = _have("ret_exc", "mktrf")
    def finish(df, sfx, least):
        beta, _, m = _slope(tag, "ret_exc", "mktrf", "cp_n")
        df = df.withColumn("cp_b", beta)
        y, x = f"{tag}ret_exc", f"{tag}mktrf"
        ss = m.c2(y, y) - F.col("cp_b") * m.c2(y, x)
        out = {f"beta{sfx}": F.col("cp_b"), f"ivol_capm{sfx}": sd_from_ss(ss, m.n, 1, m.c2(y, y) * 1e-12)}
        return _done(df, "capm", F.col("cp_n") >= least, out)
    return Metric("capm", finish, ["beta", "ivol_capm"], {"cp_n": _n(use)}, central=Central(["ret_exc", "mktrf"], 2, use, tag, "cp_n"))


def capm_ext() -> Metric:
    tag = "ce_"
    use = _have("ret_exc", "mktrf")
    def finish(df, sfx, least):
        y, x = f"{tag}ret_exc", f"{tag}mktrf"
        beta, sxx, m = _slope(tag, "ret_exc", "mktrf", "ce_n")
        df = df.withColumn("ce_b", beta)
        b = F.col("ce_b")
        ss = m.c2(y, y) - b * m.c2(y, x)
        third = m.c3(y, y, y) - 3 * b * m.c3(y, y, x) + 3 * b * b * m.c3(y, x, x) - b * b * b * m.c3(x, x, x)
        floor = m.c2(y, y) * 1e-12
        df = df.withColumns({"ce_ss": ss, "ce_third": third, "ce_exx": m.c3(y, x, x) - b * m.c3(x, x, x), "ce_sxx": sxx, "ce_floor": floor})
        good = F.when(F.col("ce_ss") > F.col("ce_floor"), F.col("ce_ss"))
        cosk = div(div("ce_exx", m.n), F.sqrt(div(good, m.n)) * div("ce_sxx", m.n))
        out = {
            f"beta{sfx}": b,
            f"ivol_capm{sfx}": sd_from_ss(F.col("ce_ss"), m.n, 1, F.col("ce_floor")),
            f"iskew_capm{sfx}": skew_from_sums(F.col("ce_ss"), F.col("ce_third"), m.n, F.col("ce_floor")),
            f"coskew{sfx}": cosk,
        }
        return _done(df, "capm_ext", F.col("ce_n") >= least, out)
    return Metric("capm_ext", finish, ["beta", "ivol_capm", "iskew_capm", "coskew"], {"ce_n": _n(use)}, central=Central(["ret_exc", "mktrf"], 3, use, tag, "ce_n"))


def ami() -> Metric:
    use = _have("ret_exc")
    ratio = F.when(use & (F.col("dolvol_d") != 0), F.abs("ret") / F.nullif(F.col("dolvol_d"), F.lit(0.0)) * 1e6)
    def finish(df, sfx, least):
        ok = (F.col("am_n") >= least) & (F.col("am_nv") >= least)
        return _done(df, "ami", ok, {f"ami{sfx}": div("am_s", "am_k")})
    return Metric("ami", finish, ["ami"], {"am_n": _n(use), "am_nv": F.count(F.when(use, F.col("dolvol_d"))), "am_s": F.sum(ratio), "am_k": F.count(ratio)})


def downbeta() -> Metric:
    tag = "db_"
    use = _have("ret_exc") & (F.col("mktrf") < 0)
    def finish(df, sfx, least):
        beta, _, _ = _slope(tag, "ret_exc", "mktrf", "db_n")
        ok = (F.col("db_all") >= least) & (F.col("db_n") >= least / 2)
        return _done(df, "downbeta", ok, {f"betadown{sfx}": beta})
    sums = {"db_n": _n(use), "db_all": _n(_have("ret_exc"))}
    return Metric("downbeta", finish, ["betadown"], sums, central=Central(["ret_exc", "mktrf"], 2, use, tag, "db_n"))


def _residual_metric(name: str, tag: str, xs: list[str], ddof: int) -> Metric:
    use = _have("ret_exc", *xs)
    def finish(df, sfx, least):
        df = fit(df, "ret_exc", xs, f"{tag}n", tag, third=True)
        n, ss, floor = F.col(f"{tag}n").cast("double"), F.col(f"{tag}ss"), F.col(f"{tag}floor")
        out = {
            f"ivol_{name}{sfx}": sd_from_ss(ss, n, ddof, floor),
            f"iskew_{name}{sfx}": skew_from_sums(ss, F.col(f"{tag}third"), n, floor),
        }
        return _done(df, name, (F.col(f"{tag}all") >= least) & (n > 0), out)
    sums = {f"{tag}n": _n(use), f"{tag}all": _n(_have("ret_exc"))}
    return Metric(name, finish, [f"ivol_{name}", f"iskew_{name}"], sums, central=Central(["ret_exc", *xs], 3, use, tag, f"{tag}n"))


def ff3() -> Metric:
    """Residual sd (divisor n - 3) and skewness of the three-factor model."""
    return _residual_metric("ff3", "f3_", ["mktrf", "smb_ff", "hml"], 3)


def hxz4() -> Metric:
    """Residual sd (divisor n - 4) and skewness of the four-factor model."""
    return _residual_metric("hxz4", "h4_", ["mktrf", "smb_hxz", "roe", "inv"], 4)


def dimsonbeta(min_month: int = 0) -> Metric:
    """Sum of the slopes on the market, its lead and its lag.

    ``min_month`` drops months with fewer rows than it from the regression.
    """
    tag, xs = "dm_", ["mktrf", "mktrf_ld1", "mktrf_lg1"]
    base = _have("ret_exc") & F.col("lead_lag__")
    use = base & _have(*xs)
    enough = F.count_if(base) >= min_month
    def finish(df, sfx, least):
        df = fit(df, "ret_exc", xs, f"{tag}n", tag, third=False)
        total = F.col(f"{tag}beta0") + F.col(f"{tag}beta1") + F.col(f"{tag}beta2")
        ok = (F.col(f"{tag}all") >= least) & (F.col(f"{tag}n") > 0)
        return _done(df, "dimsonbeta", ok, {f"beta_dimson{sfx}": total})
    sums = {f"{tag}all": _n(base), f"{tag}n": F.when(enough, _n(use))}
    return Metric("dimsonbeta", finish, ["beta_dimson"], sums, central=Central(["ret_exc", *xs], 2, use, tag, f"{tag}n"))


def _turn(use: Column) -> Column:
    shares = F.col("shares")
    return F.when(use & (shares != 0), F.col("tvol") / F.nullif(shares * 1e6, F.lit(0.0)))


def zero_trades() -> Metric:
    """Zero-volume days per 21 plus a turnover rank tie-break within the end month."""
    use = _have("tvol")
    def finish(df, sfx, least):
        ok = F.col("zt_n") >= least
        # cut to fixed digits: the rank table is joined back on it, and sums differ in their last bit with their order
        df = df.withColumns({"zt_turn": F.when(ok, F.round(div("zt_ts", "zt_tn"), 15)), "zt_zero": F.when(ok, div("zt_z", "zt_n") * 21)})
        t = rank_table(df.filter(ok), ["end_month"], "zt_turn").select(
            F.col("end_month").alias("em__"), F.col("zt_turn").alias("tv__"), (average_rank(True) / F.col("n_all") / 100).alias("rk__")
        )
        df = df.join(t, (F.col("end_month") == F.col("em__")) & (F.col("zt_turn") == F.col("tv__")), "left")
        return _done(df, "zero_trades", ok, {f"zero_trades{sfx}": F.col("rk__") + F.col("zt_zero")}).drop("em__", "tv__", "rk__")
    v = _turn(use)
    return Metric(
        "zero_trades", finish, ["zero_trades"],
        {"zt_n": _n(use), "zt_z": F.count_if(F.col("tvol") == 0), "zt_ts": F.sum(v), "zt_tn": F.count(v)}, gated=False,
    )


def dolvol() -> Metric:
    tag = "dv_"
    use = _have("dolvol_d")
    def finish(df, sfx, least):
        mean = Moments([f"{tag}dolvol_d"], "dv_n").mean(f"{tag}dolvol_d")
        out = {f"dolvol{sfx}": mean, f"dolvol_var{sfx}": F.when(mean != 0, div(_sd(tag, "dolvol_d", "dv_n"), mean))}
        return _done(df, "dolvol", F.col("dv_n") >= least, out)
    return Metric("dolvol", finish, ["dolvol", "dolvol_var"], {"dv_n": _n(use)} | moment_sums(["dolvol_d"], 2, use, tag), gated=False)


def turnover() -> Metric:
    use = _have("tvol")
    v = _turn(use)
    def finish(df, sfx, least):
        n = F.col("tn_k").cast("double")
        mean = div("tn_s", n)
        ss = F.col("tn_q") - div(F.col("tn_s") * F.col("tn_s"), n)
        out = {f"turnover{sfx}": mean, f"turnover_var{sfx}": F.when(mean != 0, div(sd_from_ss(ss, n, 1, F.col("tn_q") * 1e-13), mean))}
        return _done(df, "turnover", F.col("tn_n") >= least, out)
    return Metric("turnover", finish, ["turnover", "turnover_var"], {"tn_n": _n(use), "tn_s": F.sum(v), "tn_q": F.sum(v * v), "tn_k": F.count(v)}, gated=False)


def mktcorr() -> Metric:
    tag = "mc_"
    use = _have("ret_exc_3l", "mkt_exc_3l")
    def finish(df, sfx, least):
        y, x = f"{tag}ret_exc_3l", f"{tag}mkt_exc_3l"
        m = Moments([y, x], "mc_n")
        keep = lambda v: F.when(m.c2(v, v) > F.col(moment_name((v, v))) * 1e-13, m.c2(v, v))
        return _done(df, "mktcorr", F.col("mc_n") >= least, {f"corr{sfx}": div(m.c2(y, x), F.sqrt(keep(y) * keep(x)))})
    return Metric("mktcorr", finish, ["corr"], {"mc_n": _n(use)}, central=Central(["ret_exc_3l", "mkt_exc_3l"], 2, use, tag, "mc_n"))


METRICS: dict[str, Callable[[], Metric]] = {
    "rvol": rvol, "rmax": rmax, "skew": skew, "prc_to_high": prc_to_high, "capm": capm, "capm_ext": capm_ext,
    "downbeta": downbeta, "mktvol": mktvol, "ami": ami, "ff3": ff3, "hxz4": hxz4, "dimsonbeta": dimsonbeta,
    "zero_trades": zero_trades, "dolvol": dolvol, "turnover": turnover, "mktcorr": mktcorr,
}


def month_partials(days: DataFrame, metrics: list[Metric], max_zero: int = 10) -> DataFrame:
    """All partials of all metrics per (id, month m) in one aggregation over the days, written: every window length
    reads the months, and no task holds days and windows at once."""
    g = fold(days.groupBy("id", "m"), metrics, F.sum("zero__").alias("zeros__"))
    open_month = F.coalesce(F.col("zeros__"), F.lit(0)) < max_zero
    gate = {k: F.when(open_month, F.col(k)) for mt in metrics if mt.gated for k in (*mt.partials(), *mt.added())}
    g = g.withColumns(gate).drop("zeros__") if gate else g.drop("zeros__")
    return level(stage(g, "months"), metrics, "id")


def fold(groups: GroupedData, metrics: list[Metric], *more: Column) -> DataFrame:
    """The partials of metrics; central moments as means and central sums."""
    parts: dict[str, Column] = {}
    after: dict[str, Column] = {}
    for mt in metrics:
        parts |= mt.partials()
        if mt.central:
            held, made = mt.central.state()
            parts |= held
            after |= made
    g = groups.agg(*more, *[c.alias(k) for k, c in parts.items()])
    return g.withColumns(after) if after else g


def level(months: DataFrame, metrics: list[Metric], key: str) -> DataFrame:
    """Central moments of months as sums about one level per series, which windows can add."""
    for c in [mt.central for mt in metrics if mt.central]:
        months = about_anchor(months, c.columns, c.tag, c.n, key, c.order)
    return months


def trailing(months: DataFrame, k: int, metrics: list[Metric], key: str = "id", last_month: int | None = None) -> DataFrame:
    """Combine month partials over every trailing k-month window that holds data: (id, end_month, ...). Without
    ``last_month`` windows end up to k - 1 months after a security's last data; with it, no window ends later."""
    if last_month is not None:
        months = months.filter(F.col("m") <= last_month)
    if k == 1:
        return months.withColumnRenamed("m", "end_month")
    w = Window.partitionBy(key).orderBy("m")
    ahead = F.least(F.coalesce(F.lead("m").over(w) - F.col("m"), F.lit(k)), F.lit(k))
    spread = months.withColumn("ahead__", ahead).withColumn("step__", F.explode(F.sequence(F.lit(0), F.col("ahead__") - 1)))
    if last_month is not None:
        spread = spread.filter(F.col("m") + F.col("step__") <= last_month)
    own = F.col("step__") == 0
    parts = [c for mt in metrics for c in dict.fromkeys([*mt.partials(), *mt.added()])]
    spread = spread.select(key, (F.col("m") + F.col("step__")).alias("m"), own.alias("own__"), *[F.when(own, F.col(c)).alias(c) for c in parts])
    f = Window.partitionBy(key).orderBy("m").rangeBetween(-(k - 1), 0)
    out = {}
    for mt in metrics:
        out |= {c: F.sum(c).over(f) for c in mt.added()}
        out |= {c: F.max(c).over(f) for c in mt.maxs}
        out |= {c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("m"))).over(f) for c in mt.lasts}
        out |= {c: F.flatten(F.collect_list(c).over(f)) for c in mt.tops}
    return spread.select(key, F.col("m").alias("end_month"), *[c.alias(n) for n, c in out.items()])


def roll(days: DataFrame, grid: list[tuple[str, str | int, int]], max_zero: int = 10, custom: dict[str, Metric] | None = None, end=None) -> DataFrame:
    """Metrics (name, window, minimum observations) for every security and end month, up to the month of the date
    ``end`` if given.

    One row per (id, eom) for which at least one metric has enough observations.
    """
    built = {n: (custom or {}).get(n) or METRICS[n]() for n, _, _ in grid}
    months = month_partials(days, list(built.values()), max_zero)
    last_month = None if end is None else end.year * 12 + end.month
    frames = []
    for k in sorted({months_of(s) for _, s, _ in grid}):
        mine = [(built[n], s, least) for n, s, least in grid if months_of(s) == k]
        used = list({mt.name: mt for mt, _, _ in mine}.values())
        keep = [c for mt in used for c in dict.fromkeys([*mt.partials(), *mt.added()])]
        df = trailing(months.select("id", "m", *keep), k, used, last_month=last_month)
        for mt, s, least in mine:
            label = s if isinstance(s, str) else f"_{s}m"
            df = mt.finish(df, label, least)
        labels = {mt.name: (s if isinstance(s, str) else f"_{s}m") for mt, s, _ in mine}
        ok = F.lit(False)
        for mt in used:
            ok = ok | F.col(f"{mt.name}__ok")
        outs = [o + labels[mt.name] for mt in used for o in mt.outputs]
        frames.append(df.filter(ok).select("id", index_to_month_end("end_month").alias("eom"), *outs))
    if len(frames) == 1:
        return frames[0]
    from .joins import merge_metrics

    return merge_metrics(frames, ["id", "eom"])


# ---- monthly regressions --------------------------------------------------------------------------
def regression_rows(panel: DataFrame, factors: DataFrame, bounds: tuple[float, float] = (0.001, 0.999)) -> DataFrame:
    """Valid monthly observations with factors, excess returns clamped to the month's percentiles."""
    from .crosssection import quantile_disc, winsorize

    rows = (
        panel.join(factors, ["excntry", "eom"])
        .filter((F.col("ret_local") != 0) & F.col("ret_exc").isNotNull() & (F.col("ret_lag_dif") == 1) & F.col("mktrf").isNotNull())
        .select("id", "eom", "ret_exc", "mktrf", "hml", "smb_ff", month_index("eom").alias("m"))
    )
    cuts = quantile_disc(rows, ["eom"], "ret_exc", {"lo__": bounds[0], "hi__": bounds[1]})
    return rows.join(cuts, "eom", "left").withColumn("ret_exc", winsorize("ret_exc", "lo__", "hi__")).drop("lo__", "hi__")


def market_beta(rows: DataFrame, n: int, least: int) -> DataFrame:
    """Trailing n-month market beta and idiosyncratic volatility."""
    mt = capm()
    months = level(fold(rows.groupBy("id", "m"), [mt]), [mt], "id")
    df = mt.finish(trailing(months, n, [mt]), f"_{n}m", least)
    # end months are limited to months present in the data
    seen = rows.select(F.col("m").alias("end_month"), "eom").distinct()
    return df.filter("capm__ok").join(seen, "end_month").select("id", "eom", f"beta_{n}m", f"ivol_capm_{n}m")


def residual_momentum(rows: DataFrame, n: int, least: int, incl: int, skip: int) -> DataFrame:
    """Mean over sd of three-factor residuals of the months (end - incl, end - skip], from regressions
    over the trailing n months."""
    xs = ["mktrf", "hml", "smb_ff"]
    names = ["ret_exc", *xs]
    tag = "rm_"
    use = _have(*names)
    mt = Metric("resmom", lambda df, s, m: df, [], {"rm_n": _n(use)}, central=Central(names, 2, use, tag, "rm_n"))
    months, sums = level(fold(rows.groupBy("id", "m"), [mt]), [mt], "id"), mt.added()
    w = Window.partitionBy("id").orderBy("m")
    ahead = F.least(F.coalesce(F.lead("m").over(w) - F.col("m"), F.lit(n)), F.lit(n))
    spread = months.withColumn("ahead__", ahead).withColumn("step__", F.explode(F.sequence(F.lit(0), F.col("ahead__") - 1)))
    own = F.col("step__") == 0
    spread = spread.select("id", (F.col("m") + F.col("step__")).alias("m"), *[F.when(own, F.col(c)).alias(c) for c in sums])
    full = Window.partitionBy("id").orderBy("m").rangeBetween(-(n - 1), 0)
    part = Window.partitionBy("id").orderBy("m").rangeBetween(-(incl - 1), -skip)
    df = spread.select(
        "id", F.col("m").alias("end_month"),
        *[F.sum(c).over(full).alias(c) for c in sums],
        *[F.sum(c).over(part).alias(f"p_{c}") for c in sums],
    ).filter((F.col("rm_n") >= least) & (F.col("p_rm_n") > 0))
    df = fit(df, "ret_exc", xs, "rm_n", tag, third=False)
    mom = Moments([f"{tag}{v}" for v in names], "rm_n")
    load = {"ret_exc": F.lit(1.0)} | {x: -F.col(f"{tag}beta{i}") for i, x in enumerate(xs)}
    mean = {v: mom.mean(f"{tag}{v}") for v in names}
    pn = F.col("p_rm_n").cast("double")
    raw1 = lambda v: F.col("p_" + moment_name((f"{tag}{v}",)))
    raw2 = lambda u, v: F.col("p_" + moment_name(tuple(f"{tag}{q}" for q in sorted((u, v), key=names.index))))
    first = second = None
    for u in names:
        t1 = load[u] * (raw1(u) - pn * mean[u])
        first = t1 if first is None else first + t1
        for v in names:
            t2 = load[u] * load[v] * (raw2(u, v) - mean[u] * raw1(v) - mean[v] * raw1(u) + pn * mean[u] * mean[v])
            second = t2 if second is None else second + t2
    df = df.withColumns({"e1__": first, "e2__": second})
    sd = sd_from_ss(F.col("e2__") - div(F.col("e1__") * F.col("e1__"), pn), pn)
    seen = rows.select(F.col("m").alias("end_month"), "eom").distinct()
    return df.join(seen, "end_month").select("id", "eom", div(div("e1__", pn), sd).alias(f"resff3_{incl}_{skip}"))


def derived_daily(df: DataFrame) -> DataFrame:
    """Beta from correlation and volatilities, and extreme return per unit of volatility."""
    return df.withColumns(
        {
            "betabab_1260d": div(F.col("corr_1260d") * F.col("rvol_252d"), "__mktvol_252d"),
            "rmax5_rvol_21d": div("rmax5_21d", "rvol_252d"),
        }
    ).drop("__mktvol_252d")
