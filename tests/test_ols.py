"""Grouped regressions against numpy: level shifts, dependent and constant regressors, tiny groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators.ols import grouped_ols

rng = np.random.default_rng(3)
XS = ["a", "b", "c"]


def groups():
    """Values are multiples of 2**-20, so that a shift by a million is exact."""
    grid = lambda x: np.round(x * 2**20) / 2**20
    out = {}
    for g, n in (("plain", 60), ("small", 5), ("twin", 40), ("flat", 30), ("both", 25), ("line", 20)):
        x = grid(rng.normal(size=(n, 3)))
        if g in ("twin", "both"):
            x[:, 1] = 2 * x[:, 0]
        if g in ("flat", "both"):
            x[:, 2] = 1.5
        y = grid(0.5 + x @ [1.0, -2.0, 0.5] + (0 if g == "line" else rng.normal(size=n) ** 3))
        out[g] = (x, y)
    return out


GROUPS = groups()


def reference(x, y, keep):
    m = np.column_stack([np.ones(len(y)), x[:, keep]])
    b = np.linalg.lstsq(m, y, rcond=None)[0]
    e = y - m @ b
    sd = np.sqrt(e @ e / (len(y) - len(keep) - 1)) if len(y) > len(keep) + 1 else None
    z = e - e.mean()
    n = len(y)
    skew = (z**3).mean() / (z**2).mean() ** 1.5 * np.sqrt(n * (n - 1)) / (n - 2)
    return b, sd, skew


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_against_least_squares(spark, shift):
    rows = [(g, *(float(v) + shift for v in x[i]), float(y[i]) + shift) for g, (x, y) in GROUPS.items() for i in range(len(y))]
    rows += [("plain", None, 1.0, 1.0, 1.0), ("empty", None, None, None, 1.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, y double").repartition(5)
    got = {r.g: r for r in grouped_ols(df, ["g"], "y", XS, drop=True).collect()}
    lost = {"twin": ["b"], "flat": ["c"], "both": ["b", "c"]}
    for g, (x, y) in GROUPS.items():
        r = got[g]
        keep = [i for i, v in enumerate(XS) if v not in lost.get(g, [])]
        b, sd, skew = reference(x, y, keep)
        assert r.dropped == lost.get(g, []) and r.n == len(y)
        assert [r[f"b_{XS[i]}"] for i in keep] == pytest.approx(list(b[1:]), rel=1e-8)
        if g == "line":
            if shift:  # means near a million have ten digits after the point
                assert r.resid_sd < 1e-4
            else:
                assert r.resid_sd == 0 and r.resid_skew is None
        else:
            assert r.resid_sd == pytest.approx(sd, rel=1e-9) and r.resid_skew == pytest.approx(skew, rel=1e-8, abs=1e-9)
    assert got["empty"].n == 0 and got["empty"].resid_sd is None
    whole = {r.g: r for r in grouped_ols(df, ["g"], "y", XS).collect()}
    assert whole["twin"].b_a is None and whole["plain"].b_a == pytest.approx(got["plain"].b_a, rel=1e-9)
