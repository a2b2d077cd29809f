"""Null arithmetic and guarded division.

Spark runs in ANSI mode, where ``x / 0`` raises. Every division here therefore goes through
``try_divide`` and carries its own guard, so a bad denominator gives NULL and never an error, an
infinity or a NaN.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed_null() -> Column:
    """A NULL of type double."""
    return F.lit(None).cast("double")


def bool_false() -> Column:
    return F.lit(False)


def zero(c: Column | str) -> Column:
    """The value, with NULL read as 0."""
    return F.coalesce(as_col(c), F.lit(0.0))


def _either(a: Column, b: Column, value: Column) -> Column:
    return F.when(a.isNotNull() | b.isNotNull(), value)


def sum_sas(a: Column | str, b: Column | str) -> Column:
    """a + b where a single NULL counts as 0 and two NULLs stay NULL."""
    a, b = as_col(a), as_col(b)
    return _either(a, b, zero(a) + zero(b))


def sub_sas(a: Column | str, b: Column | str) -> Column:
    """a - b with the same NULL rule as :func:`sum_sas`."""
    a, b = as_col(a), as_col(b)
    return _either(a, b, zero(a) - zero(b))


def div(num: Column | str, den: Column | str) -> Column:
    return F.try_divide(as_col(num), as_col(den))


def safe_div(
    num: Column | str,
    den: Column | str,
    mode: int = 1,
    *,
    over: WindowSpec | None = None,
    count: Column | str = "count",
    fx: Column | str = "fx",
) -> Column:
    """Division under one of nine guards; NULL where the guard fails.

    ====  ==============================================  =======================
    mode  value                                           guard
    ====  ==============================================  =======================
    1     num / den                                       den <> 0
    2     num / |den|                                     den <> 0
    3     num / den                                       den > 0
    4     num / den 12 rows back                          that den > 0, count > 12
    5     num * fx / den                                  den <> 0
    6     num / den 12 rows back                          that den <> 0
    7     (num / den) 12 rows back                        that den > 0
    8     num / den                                       num > 0 and den > 0
    9     num / den 3 rows back                           that den > 0, count > 3
    ====  ==============================================  =======================

    The modes that look back (4, 6, 7, 9) need ``over``, the entity's time-ordered window.
    """
    n, d = as_col(num), as_col(den)
    if mode in (4, 6, 7, 9):
        if over is None:
            raise ValueError(f"safe_div mode {mode} looks back in time and needs `over`")
        back = F.lag(d, 3 if mode == 9 else 12).over(over)
        rows = as_col(count)
        guard, value = {
            4: (lambda: (rows > 12) & (back > 0), lambda: div(n, back)),
            6: (lambda: back != 0, lambda: div(n, back)),
            7: (lambda: back > 0, lambda: F.lag(div(n, d), 12).over(over)),
            9: (lambda: (rows > 3) & (back > 0), lambda: div(n, back)),
        }[mode]
        return F.when(guard(), value())
    table = {
        1: lambda: (d != 0, div(n, d)),
        2: lambda: (d != 0, div(n, F.abs(d))),
        3: lambda: (d > 0, div(n, d)),
        5: lambda: (d != 0, div(n * as_col(fx), d)),
        8: lambda: ((n > 0) & (d > 0), div(n, d)),
    }
    if mode not in table:
        raise ValueError(f"unknown safe_div mode {mode}")
    guard, value = table[mode]()
    return F.when(guard, value)


def finite(c: Column | str) -> Column:
    """NULL in place of NaN and of either infinity."""
    c = as_col(c)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def snap_small(c: Column | str, eps: float = 1e-5, signed: bool = False) -> Column:
    """Replace values below ``eps`` by 0 (compare |c| instead when ``signed``)."""
    c = as_col(c)
    return F.when((F.abs(c) if signed else c) < eps, F.lit(0.0)).otherwise(c)


def mean_across(cols: list[Column | str]) -> Column:
    """Mean of the non-null inputs of one row; NULL when all are NULL."""
    cs = [as_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [zero(c) for c in cs])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cs])
    return div(total, present.cast("double"))


def count_nulls(cols: list[Column | str]) -> Column:
    return reduce(lambda a, b: a + b, [as_col(c).isNull().cast("int") for c in cols])
