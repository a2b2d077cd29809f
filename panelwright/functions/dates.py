"""Calendar helpers. Month ends are always re-snapped with last_day after any shift."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col


def month_index(d: Column | str) -> Column:
    """year * 12 + month: consecutive months differ by exactly 1."""
    d = as_col(d)
    return (F.year(d) * 12 + F.month(d)).cast("int")


def month_end(d: Column | str, shift: int = 0) -> Column:
    d = as_col(d)
    return F.last_day(F.add_months(d, shift) if shift else d)


def prev_month_end(d: Column | str) -> Column:
    return F.date_sub(F.trunc(as_col(d), "MM"), 1)


def index_to_month_end(idx: Column | str) -> Column:
    """Inverse of :func:`month_index`, at the last day of the month."""
    i = as_col(idx).cast("int")
    year = F.floor((i - 1) / F.lit(12)).cast("int")
    return F.last_day(F.make_date(year, i - year * 12, F.lit(1)))


def days_or_empty(first: Column, last: Column) -> Column:
    """Daily sequence, or an empty array when last < first (plain sequence() would raise)."""
    return F.when(
        last >= first, F.sequence(first, last, F.expr("interval 1 day"))
    ).otherwise(F.array().cast("array<date>"))


def months_or_empty(first: Column, last: Column) -> Column:
    """Month-end dates from first's month to last's month; empty when that is backwards."""
    a, b = F.trunc(first, "MM"), F.trunc(last, "MM")
    seq = F.when(b >= a, F.sequence(a, b, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )
    return F.transform(seq, lambda x: F.last_day(x))


def month_steps_or_empty(first: Column, last: Column) -> Column:
    """Month ends of first, first + 1 month, ... for as long as the stepped date is <= last."""
    n = month_index(last) - month_index(first)
    steps = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    kept = F.filter(steps, lambda k: F.add_months(first, k) <= last)
    return F.transform(kept, lambda k: F.last_day(F.add_months(first, k)))
