"""Composite accounting scores."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import div, safe_div, zero
from .panel import History


def _c(name: str) -> Column:
    return F.col(name)


def f_score(h: History, name: str = "f_score") -> dict[str, Column]:
    """Nine binary signals of profitability, funding and efficiency."""
    n = _c("count")
    at1, at2 = h.lag("at_x", 12), h.lag("at_x", 24)
    seen = (n > 12) & (at1 > 0)
    roa = F.when(seen, div("ni_x", at1))
    croa = F.when(seen, div("ocf_x", at1))
    roa_then = F.when((n > 24) & (at2 > 0), div(h.lag("ni_x", 12), at2))
    def delta(num: str, den: str) -> Column:
        d1 = h.lag(den, 12)
        return F.when((n > 12) & (_c(den) > 0) & (d1 > 0), div(num, den) - div(h.lag(num, 12), d1))

    turn = F.when((n > 24) & (at1 > 0) & (at2 > 0), div("sale_x", at1) - div(h.lag("sale_x", 12), at2))
    ups = [roa, croa, roa - roa_then, croa - roa, delta("ca_x", "cl_x"), delta("gp_x", "sale_x"), turn]
    flags = [(u > 0).cast("int") for u in ups]
    flags.append((delta("dltt", "at_x") < 0).cast("int"))
    flags.append((zero("eqis_x") == 0).cast("int"))
    return {name: reduce(lambda a, b: a + b, flags)}


def o_score(h: History, name: str = "o_score") -> dict[str, Column]:
    """Bankruptcy score; weights are fixed values."""
    n, ni, ni1 = _c("count"), _c("nix_x"), h.lag("nix_x", 12)
    both = F.abs(ni) + F.abs(ni1)
    loss = F.when((n > 12) & ni.isNotNull() & ni1.isNotNull(), ((ni < 0) & (ni1 < 0)).cast("double"))
    swing = F.when((n > 12) & (both != 0), div(ni - ni1, both))
    under = F.when(_c("lt").isNotNull() & _c("at_x").isNotNull(), (_c("lt") > _c("at_x")).cast("double"))
    terms = [
        (-0.407, F.when(_c("at_x") > 0, F.log(_c("at_x")))),
        (6.03, safe_div("debt_x", "at_x", 3)),
        (-1.43, safe_div(_c("ca_x") - _c("cl_x"), "at_x", 3)),
        (0.076, safe_div("cl_x", "ca_x", 3)),
        (-1.72, under),
        (-2.37, safe_div("nix_x", "at_x", 3)),
        (-1.83, safe_div(_c("pi_x") + _c("dp"), "lt", 3)),
        (0.285, loss),
        (-0.52, swing),
    ]
    return {name: reduce(lambda a, t: a + t[0] * t[1], terms, F.lit(-1.32))}


def z_score(name: str = "z_score") -> dict[str, Column]:
    """Distress score; weights are fixed values."""
    terms = [
        (1.2, safe_div(_c("ca_x") - _c("cl_x"), "at_x", 3)),
        (1.4, safe_div("re", "at_x", 3)),
        (3.3, safe_div("ebitda_x", "at_x", 3)),
        (0.6, safe_div("me_fiscal", "lt", 3)),
        (1.0, safe_div("sale_x", "at_x", 3)),
    ]
    return {name: reduce(lambda a, b: a + b, [w * t for w, t in terms])}


def kz_index(h: History, name: str = "kz_index") -> dict[str, Column]:
    """Financing constraint index; weights are fixed values."""
    base = h.lag("ppent", 12)
    over = lambda num: F.when((_c("count") > 12) & (base > 0), div(num, base))
    terms = [
        (-1.002, over(_c("ni_x") + _c("dp"))),
        (0.283, safe_div(_c("at_x") + _c("me_fiscal") - _c("be_x"), "at_x", 3)),
        (3.139, safe_div("debt_x", _c("debt_x") + _c("seq_x"))),
        (-39.368, over(_c("div_x"))),
        (-1.315, over(_c("che"))),
    ]
    return {name: reduce(lambda a, b: a + b, [w * t for w, t in terms])}


def intrinsic_value(h: History, name: str = "intrinsic_value", r: float = 0.12) -> dict[str, Column]:
    """Residual income value from payout and return on mean book equity; kept when positive."""
    nix, be = _c("nix_x"), _c("be_x")
    be1 = h.lag("be_x", 12)
    payout = F.when(nix > 0, div("div_x", nix)).when(_c("at_x") != 0, div("div_x", _c("at_x") * 0.06))
    roe = F.when((_c("count") > 12) & (be + be1 > 0), div(nix, (be + be1) / 2))
    ahead = (1 + (1 - payout) * roe) * be
    value = be + (roe - r) / (1 + r) * be + (roe - r) / ((1 + r) * r) * ahead
    return {name: F.when(value > 0, value)}


def equity_duration(
    df: DataFrame, horizon: int = 10, r: float = 0.12, roe_mean: float = 0.12, roe_ar: float = 0.57, g_mean: float = 0.06, g_ar: float = 0.24
) -> DataFrame:
    """Discounted distributions over a finite horizon with mean-reverting growth and profitability.

    Adds ``ed_cd``, ``ed_cd_w``, ``ed_constant`` and ``ed_err``. Growth and return decay towards their means, so
    both are powers in t; book equity is a column per year. A missing input makes the sums missing.
    """
    h = History(df, ["gvkey", "curcd"], "datadate")
    h.add(duration_start(h))
    return duration(h, horizon, r, roe_mean, roe_ar, g_mean, g_ar).df.drop(*DURATION_START)


DURATION_START = ["ed_roe0", "ed_g0"]


def duration_start(h: History) -> dict[str, Column]:
    """Profitability and growth that :func:`duration` starts from."""
    seen = _c("count") > 12
    be1, s1 = h.lag("be_x", 12), h.lag("sale_x", 12)
    return {
        "ed_roe0": F.when(seen & (be1 > 1), div("ni_x", be1)),
        "ed_g0": F.when(seen & (s1 > 1), div("sale_x", s1) - 1),
    }


def duration(
    h: History, horizon: int = 10, r: float = 0.12, roe_mean: float = 0.12, roe_ar: float = 0.57, g_mean: float = 0.06, g_ar: float = 0.24
) -> History:
    """Adds the columns of :func:`equity_duration`, from those of :func:`duration_start`."""
    for t in range(1, horizon + 1):
        held = _c(f"ed_be{t - 1}") if t > 1 else _c("be_x")
        grow = g_mean + g_ar**t * (_c("ed_g0") - g_mean)
        earn = roe_mean + roe_ar**t * (_c("ed_roe0") - roe_mean)
        h.add({f"ed_be{t}": held * (1 + grow), f"ed_flow{t}": held * (earn - grow) / (1 + r) ** t})
    flows = [_c(f"ed_flow{t}") for t in range(1, horizon + 1)]
    negative = reduce(or_, [F.coalesce(_c(f"ed_be{t}") < 0, F.lit(False)) for t in range(1, horizon + 1)])
    h.add(
        {
            "ed_constant": F.lit(horizon + (1 + r) / r),
            "ed_cd": reduce(add, flows),
            "ed_cd_w": reduce(add, [t * flow for t, flow in enumerate(flows, start=1)]),
            "ed_err": negative.cast("double"),
        }
    )
    h.df = h.df.drop(*[f"ed_{x}{t}" for x in ("be", "flow") for t in range(1, horizon + 1)])
    return h
