"""Sample statistics rebuilt from additive sums.

Anything rolling is expressed through sums of monomials, because sums can be combined across
partitions, across months and across overlapping windows without a second look at the raw rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations_with_replacement

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import div


def monomials(names: list[str], order: int) -> list[tuple[str, ...]]:
    """All products of 1..order of the names, each as a sorted tuple of positions' names."""
    out: list[tuple[str, ...]] = []
    for k in range(1, order + 1):
        out.extend(combinations_with_replacement(names, k))
    return out


def moment_name(term: tuple[str, ...]) -> str:
    return "s__" + "__".join(term)


def moment_value(term: tuple[str, ...]) -> Column:
    v = F.col(term[0])
    for t in term[1:]:
        v = v * F.col(t)
    return v


class Moments:
    """Centred co-moments over columns that hold n and the raw monomial sums."""

    def __init__(self, names: list[str], n: str = "n__"):
        self.names = names
        self.pos = {v: i for i, v in enumerate(names)}
        self.n = F.col(n).cast("double")

    def raw(self, *term: str) -> Column:
        key = tuple(sorted(term, key=self.pos.__getitem__))
        return F.col(moment_name(key))

    def mean(self, a: str) -> Column:
        return div(self.raw(a), self.n)

    def c2(self, a: str, b: str) -> Column:
        """Sum of (a - mean a)(b - mean b)."""
        return self.raw(a, b) - div(self.raw(a) * self.raw(b), self.n)

    def c3(self, a: str, b: str, c: str) -> Column:
        """Sum of the three-way centred product."""
        ma, mb, mc = self.mean(a), self.mean(b), self.mean(c)
        return (
            self.raw(a, b, c)
            - ma * self.raw(b, c)
            - mb * self.raw(a, c)
            - mc * self.raw(a, b)
            + F.lit(2.0) * self.n * ma * mb * mc
        )


def sd_from_ss(ss: Column, n: Column, ddof: int = 1, floor: Column | None = None) -> Column:
    """sqrt(ss / (n - ddof)); a sum of squares lost to rounding (below floor) counts as 0."""
    clean = F.greatest(ss, F.lit(0.0))
    if floor is not None:
        clean = F.when(clean > floor, clean).when(clean.isNotNull(), F.lit(0.0))
    return F.when(n > ddof, F.sqrt(div(clean, n - ddof)))


def skew_from_sums(ss: Column, third: Column, n: Column, floor: Column) -> Column:
    """Bias-corrected skewness from centred second and third sums; NULL when degenerate."""
    g1 = div(div(third, n), F.pow(div(ss, n), F.lit(1.5)))
    return F.when((n >= 3) & (ss > floor), g1 * F.sqrt(n * (n - 1)) / (n - 2))


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside a lambda an expression would be computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def list_sd(arr: Column) -> Column:
    """Sample sd of a non-null double array (two passes); NULL below two elements."""

    def sd(a: Column) -> Column:
        n = F.size(a).cast("double")
        mean = div(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), n)
        ss = _with(mean, lambda m: F.aggregate(a, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)))
        return F.when(n > 1, F.sqrt(div(ss, n - 1)))

    return _with(arr, sd)


def list_mean(arr: Column) -> Column:
    n = F.size(arr).cast("double")
    return F.when(n > 0, div(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), n))
