"""Least squares per group from sums of products, solved in columns.

The cross-product matrix of a group is a handful of sums, so a regression is an ordinary
aggregation (combined map-side, no group is ever collected) followed by row-wise arithmetic. The
elimination is spread over successive projections, which keeps each expression small.

A pivot below ``TOL`` of its diagonal marks a singular group, whose coefficients are NULL. (A
solver returning some least-norm answer there would give numbers without meaning.)
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations, combinations_with_replacement
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import div
from ..functions.stats import Moments, moment_name, moment_value, monomials, sd_from_ss, skew_from_sums

TOL = 1e-10


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def solve_symmetric(
    df: DataFrame, p: int, a: Callable[[int, int], Column], b: Callable[[int], Column], tag: str, drop: bool = False
) -> DataFrame:
    """Add ``<tag>beta0..`` solving A x = b row by row through an LDL' factorization.

    A row of A that depends on earlier ones has a pivot below ``TOL`` of its diagonal. It voids the solution, or, with
    ``drop``, moves behind the others: its own coefficient is NULL and counts as 0, the rest solve what is left.
    """
    col = lambda kind, *ix: F.col(f"{tag}{kind}{'_'.join(map(str, ix))}")
    zero = lambda c: F.when(c.isNull(), F.lit(0.0)).otherwise(c) if drop else c
    used: list[str] = []

    def put(frame: DataFrame, exprs: dict[str, Column]) -> DataFrame:
        used.extend(exprs)
        return frame.withColumns(exprs)

    for j in range(p):
        pivot = a(j, j)
        rhs = b(j)
        for k in range(j):
            pivot = pivot - zero(col("l", j, k) * col("l", j, k) * col("d", k))
            rhs = rhs - zero(col("l", j, k) * col("z", k))
        df = put(df, {f"{tag}d{j}": F.when(pivot > TOL * a(j, j), pivot), f"{tag}z{j}": rhs})
        lower = {}
        for i in range(j + 1, p):
            v = a(i, j)
            for k in range(j):
                v = v - zero(col("l", i, k) * col("l", j, k) * col("d", k))
            lower[f"{tag}l{i}_{j}"] = div(v, col("d", j))  # NULL below a dropped pivot
        if lower:
            df = put(df, lower)
    for j in reversed(range(p)):
        v = div(col("z", j), col("d", j))
        for i in range(j + 1, p):
            v = v - zero(col("l", i, j) * col("beta", i))
        df = df.withColumn(f"{tag}beta{j}", v)
    if not drop:  # one missing pivot voids the whole solution
        whole = reduce(lambda x, y: x & y, [col("d", j).isNotNull() for j in range(p)])
        df = df.withColumns({f"{tag}beta{j}": F.when(whole, col("beta", j)) for j in range(p)})
    return df.drop(*used)


def fit(df: DataFrame, y: str, xs: list[str], n: str, tag: str, third: bool, drop: bool = False) -> DataFrame:
    """From columns holding raw moment sums: slopes ``<tag>beta<i>``, residual sum of squares
    ``<tag>ss``, its rounding floor ``<tag>floor`` and, if ``third``, the residual third sum."""
    names = [y, *xs]
    mom = Moments([f"{tag}{v}" for v in names], n)
    key = lambda *v: f"{tag}c__" + "__".join(v)
    pairs = list(combinations_with_replacement(names, 2))
    df = df.withColumns({key(*q): mom.c2(*[f"{tag}{v}" for v in q]) for q in pairs})
    order = {v: i for i, v in enumerate(names)}
    c2 = lambda u, v: F.col(key(*sorted((u, v), key=order.__getitem__)))
    df = solve_symmetric(df, len(xs), lambda i, j: c2(xs[i], xs[j]), lambda i: c2(y, xs[i]), tag, drop)
    beta = {x: F.coalesce(F.col(f"{tag}beta{i}"), F.lit(0.0)) if drop else F.col(f"{tag}beta{i}") for i, x in enumerate(xs)}
    ss = c2(y, y) - _total([beta[x] * c2(y, x) for x in xs])
    df = df.withColumns({f"{tag}ss": ss, f"{tag}floor": c2(y, y) * 1e-12})
    if third:
        load = {y: F.lit(1.0)} | {x: -beta[x] for x in xs}
        terms = []
        for t in combinations_with_replacement(names, 3):
            times = factorial(3)
            for v in set(t):
                times //= factorial(t.count(v))
            terms.append(times * load[t[0]] * load[t[1]] * load[t[2]] * mom.c3(*[f"{tag}{v}" for v in t]))
        df = df.withColumn(f"{tag}third", _total(terms))
    return df.drop(*[key(*q) for q in pairs])


def moment_sums(names: list[str], order: int, use: Column, tag: str) -> dict[str, Column]:
    """Aggregates: raw moment sums of the rows passing ``use``, names prefixed by ``tag``."""
    out = {}
    for term in monomials(names, order):
        out[moment_name(tuple(f"{tag}{v}" for v in term))] = F.sum(F.when(use, moment_value(term)))
    return out


def centred_sums(names: list[str], use: Column, tag: str, n: str, order: int = 3) -> tuple[dict[str, Column], dict[str, Column]]:
    """Aggregates that hold a group's means ``<tag>mean_<x>``, central second sums and raw third sums, and the columns
    made of them after the aggregation (``n`` is the column of counts there): central sums under the names that
    :class:`Moments` reads for data whose means are 0.

    Second moments merge as centred states and lose no digits to the level of the series. Third sums do, if the
    level is large against the deviations; :func:`grouped_ols` takes the level off first.
    """
    v = {x: F.when(use, F.col(x)) for x in names}
    name = lambda *t: moment_name(tuple(f"{tag}{x}" for x in sorted(t, key=names.index)))
    key = lambda *t: f"{tag}k_" + "__".join(t)
    count = F.col(n).cast("double")
    mean = {x: F.col(f"{tag}mean_{x}") for x in names}
    aggs = {f"{tag}mean_{x}": F.avg(v[x]) for x in names}
    after = {name(x): F.lit(0.0) for x in names}
    c2 = {}
    for x, y in combinations_with_replacement(names, 2):
        aggs[key(x, y)] = F.var_pop(v[x]) if x == y else F.covar_pop(v[x], v[y])
        after[name(x, y)] = F.col(key(x, y)) * count
        c2[x, y] = c2[y, x] = after[name(x, y)]
    if order >= 3:
        for x, y, z in combinations_with_replacement(names, 3):
            aggs[key(x, y, z)] = F.sum(v[x] * v[y] * v[z])
            after[name(x, y, z)] = F.col(key(x, y, z)) - mean[x] * c2[y, z] - mean[y] * c2[x, z] - mean[z] * c2[x, y] - count * mean[x] * mean[y] * mean[z]
    return aggs, after


def about_anchor(df: DataFrame, names: list[str], tag: str, n: str, by: str, order: int) -> DataFrame:
    """Turn states of :func:`centred_sums` (one row per part of a series) into sums of powers about one level for each
    ``by``, the mean of its whole series: such sums add up over parts and lose no digits to the level."""
    w = Window.partitionBy(by)
    name = lambda *t: moment_name(tuple(f"{tag}{x}" for x in sorted(t, key=names.index)))
    count = F.col(n).cast("double")
    mean = {x: F.col(f"{tag}mean_{x}") for x in names}
    level = lambda x: F.sum(mean[x] * count).over(w) / F.nullif(F.sum(F.when(mean[x].isNotNull(), count)).over(w), F.lit(0.0))
    df = df.withColumns({f"{tag}off_{x}": mean[x] - level(x) for x in names})
    d = {x: F.col(f"{tag}off_{x}") for x in names}
    out = {name(x): count * d[x] for x in names}
    for x, y in combinations_with_replacement(names, 2):
        out[name(x, y)] = F.col(name(x, y)) + count * d[x] * d[y]
    if order >= 3:
        for x, y, z in combinations_with_replacement(names, 3):
            out[name(x, y, z)] = F.col(name(x, y, z)) + d[x] * F.col(name(y, z)) + d[y] * F.col(name(x, z)) + d[z] * F.col(name(x, y)) + count * d[x] * d[y] * d[z]
    return df.withColumns(out).drop(*[f"{tag}{k}_{x}" for k in ("off", "mean") for x in names])


def grouped_ols(df: DataFrame, keys: list[str], y: str, xs: list[str], ddof: int | None = None, drop: bool = False) -> DataFrame:
    """One regression with intercept per group: n, intercept, slopes ``b_<x>``, residual sd and skew.

    The means of a group are taken off first, so that no digits are lost to the level of its series.
    With ``drop``, a regressor that depends on those before it (a constant one depends on the intercept) has no slope
    and is named in the array ``dropped``; the others are fitted without it. Else such a group has no coefficients.
    """
    use = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (y, *xs)])
    tag = "r_"
    level = df.filter(use).groupBy(*[F.col(k).alias(f"{k}__g") for k in keys]).agg(*[F.avg(c).alias(f"level_{c}") for c in (y, *xs)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}__g")) for k in keys])
    off = [(F.col(c) - F.coalesce(f"level_{c}", F.lit(0.0))).alias(c) for c in (y, *xs)]
    df = df.select(*keys, y, *xs).join(level, same, "left").select(*keys, *off, *level.columns[len(keys):])
    aggs, after = centred_sums([y, *xs], use, tag, "n")
    aggs |= {f"level_{c}": F.any_value(f"level_{c}") for c in (y, *xs)}
    g = df.groupBy(*keys).agg(F.count_if(use).alias("n"), *[c.alias(k) for k, c in aggs.items()]).withColumns(after)
    g = fit(g, y, xs, "n", tag, third=True, drop=drop)
    beta = [F.col(f"{tag}beta{i}") for i in range(len(xs))]
    load = [F.coalesce(b, F.lit(0.0)) if drop else b for b in beta]
    centre = lambda c: F.col(f"{tag}mean_{c}") + F.col(f"level_{c}")
    intercept = centre(y) - _total([b * centre(x) for b, x in zip(load, xs)])
    lost = F.array_compact(F.array(*[F.when(b.isNull(), F.lit(x)) for b, x in zip(beta, xs)]))
    d = F.lit(len(xs) + 1) - (F.size(lost) if drop else 0) if ddof is None else F.lit(ddof)
    ss, floor = F.col(f"{tag}ss"), F.col(f"{tag}floor")
    return g.select(
        *keys,
        "n",
        intercept.alias("intercept"),
        *[b.alias(f"b_{x}") for b, x in zip(beta, xs)],
        sd_from_ss(ss, F.col("n").cast("double"), d, floor).alias("resid_sd"),
        skew_from_sums(ss, F.col(f"{tag}third"), F.col("n").cast("double"), floor).alias("resid_skew"),
        *([lost.alias("dropped")] if drop else []),
    )
