"""As-of join: for each row of the left side, the nearest earlier (or later) row of the right side in its group.

Both sides are merged in time order and the last right row seen is carried along. A group is cut into *slices* of
time, so that a group with a third of all rows is not one task: inside a slice a window carries the state; what
a slice starts with comes from a small table of carries, one entry per group and slice. The number of
slices changes speed only, never the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICES = 512


def _scale(c: Column, kind: T.DataType) -> Column:
    """A monotone number: days, seconds or the value itself."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp").cast("double")
    return c.cast("double")


def _known(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])


def _one_way(left: DataFrame, right: DataFrame, by: list[str], backward: bool, exact: bool, slices: int) -> DataFrame:
    """Adds ``hit__`` to the left rows (by, at__, place__, l__): the nearest right row (by, at__, place__, r__) on one side."""
    span = left.agg(F.struct(F.min("place__").alias("lo"), F.max("place__").alias("hi"))).scalar()
    # rows outside the range of the left side share the first and the last slice
    cut = lambda df: df.withColumn("span__", span).withColumn(
        "slice__", F.greatest(F.lit(0), F.least(F.lit(slices - 1), F.coalesce(F.floor((F.col("place__") - F.col("span__.lo")) / F.nullif(F.col("span__.hi") - F.col("span__.lo"), F.lit(0.0)) * slices), F.lit(0)))).cast("int")
    ).drop("span__", "place__")
    rows, other = cut(left), cut(right)
    group = [*by, "slice__"]
    later = lambda c: c if backward else c.desc()
    # at equal times the right row comes first if it counts, else after
    first = F.when(F.col("r__").isNull(), 1 if exact else 0).otherwise(0 if exact else 1)
    w = Window.partitionBy(*group).orderBy(later(F.col("at__")), first).rowsBetween(Window.unboundedPreceding, 0)
    nothing = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    both = rows.withColumn("r__", nothing(other, "r__")).unionByName(other.withColumn("l__", nothing(rows, "l__")))
    seen = both.withColumn("hit__", F.last("r__", ignorenulls=True).over(w)).where(F.col("l__").isNotNull())

    pick = F.max_by if backward else F.min_by
    last = other.groupBy(*group).agg(pick("r__", "at__").alias("r__"))
    asked = rows.select(*group).distinct().withColumn("r__", nothing(other, "r__"))
    table = last.unionByName(asked).groupBy(*group).agg(F.max("r__").alias("r__"))
    order = F.col("slice__") if backward else F.col("slice__").desc()
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)  # at most ``slices`` rows
    carried = table.select(*group, F.last("r__", ignorenulls=True).over(before).alias("carry__"))
    out = seen.join(carried, group, "left")
    return out.withColumn("hit__", F.coalesce("hit__", "carry__")).drop("carry__", "r__", "slice__")


def asof_join(
    left: DataFrame, right: DataFrame, by: list[str], on: str, direction: str = "backward", tolerance: float | None = None,
    right_on: str | None = None, exact: bool = True, suffix: str = "_right", slices: int = SLICES,
) -> DataFrame:
    """Each left row once, with the columns of the nearest right row of the same ``by`` keys; NULL where there is none.

    ``direction`` is ``backward`` (right time <= left time), ``forward`` (>=) or ``nearest`` (the earlier one if both are
    as near). ``exact=False`` leaves out equal times. ``tolerance`` bounds the distance: days for dates, seconds for
    timestamps, units for numbers. Of right rows with equal keys and time the greatest counts, column by column.
    Rows with a NULL key or time match nothing; such left rows stay. The right time comes back as
    ``<right_on><suffix>``, other right columns with the suffix if the left side has the name.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"direction is {direction}")
    at = right_on or on
    values = [c for c in right.columns if c not in by and c != at]
    names = {c: c + suffix if c in left.columns else c for c in values} | {at: at + suffix}
    time, right_time = left.schema[on].dataType, right.schema[at].dataType
    r = right.where(_known([*by, at])).select(*by, F.col(at).alias("at__"), F.struct(at, *values).alias("r__"))
    r = r.groupBy(*by, "at__").agg(F.max("r__").alias("r__")).withColumn("place__", _scale(F.col("at__"), right_time))
    packed = left.select(*by, F.col(on).alias("at__"), F.struct(*left.columns).alias("l__")).withColumn("place__", _scale(F.col("at__"), time))
    known = _known([*by, "at__"])
    l = packed.where(known)
    sides = {"backward": [True], "forward": [False], "nearest": [True, False]}[direction]
    found = _one_way(l, r, by, sides[0], exact, slices)
    gap = lambda hit: F.abs(_scale(hit[at], right_time) - _scale(F.col("at__"), time))
    if len(sides) == 2:
        early = found.select(*by, "at__", F.struct("l__", F.col("hit__").alias("early__")).alias("l__"), _scale(F.col("at__"), time).alias("place__"))
        both = _one_way(early, r, by, False, exact, slices)
        a, b = F.col("l__.early__"), F.col("hit__")
        nearer = F.when(b.isNull() | (gap(a) <= gap(b)), a).otherwise(b)
        found = both.withColumn("hit__", nearer).withColumn("l__", F.col("l__.l__"))
    hit = F.col("hit__") if tolerance is None else F.when(gap(F.col("hit__")) <= tolerance, F.col("hit__"))
    rest = packed.where(~known).select("l__", F.lit(None).cast(r.schema["r__"].dataType).alias("hit__"))
    out = found.select("l__", hit.alias("hit__")).unionByName(rest)
    return out.select("l__.*", *[F.col(f"hit__.{c}").alias(names[c]) for c in (at, *values)])
