"""Interval expansion, densification and gap filling.

Sequences are generated per row inside the executor; nothing is joined against a calendar.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_or_empty, month_steps_or_empty, months_or_empty


def expand_interval(
    df: DataFrame, ids: list[str], start: str, end: str, freq: str = "day", name: str = "date"
) -> DataFrame:
    """One row per day or month step in [start, end], one row per (ids, date).

    Month steps count from the start date and are snapped to the month end.
    Backward intervals yield nothing. Overlaps of one key are settled in favour of the interval
    that starts last, with the remaining columns as tie-break.

    Intervals are shuffled, not their days: equal ones are folded first, and one that shares no day (month) with
    another of its key is expanded in place. Only the steps of those that do overlap are grouped.
    """
    seq = days_or_empty if freq == "day" else month_steps_or_empty
    rest = [c for c in df.columns if c not in (*ids, start, end)]
    # of equal intervals the greatest remaining columns would win every day
    best = F.max(F.struct(*rest) if rest else F.lit(True)).alias("row__")
    held = df.where(F.col(start) <= F.col(end)).groupBy(*ids, start, end).agg(best)
    edge = (lambda c: F.to_date(c)) if freq == "day" else F.last_day
    w = Window.partitionBy(*ids).orderBy(start, end)
    before = F.max(edge(F.col(end))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    alone = F.coalesce(before < edge(F.col(start)), F.lit(True)) & F.coalesce(edge(F.lead(start).over(w)) > edge(F.col(end)), F.lit(True))
    held = held.withColumn("alone__", alone).select(*ids, start, end, *[F.col(f"row__.{c}").alias(c) for c in rest], "alone__")
    steps = held.withColumn(name, F.explode(seq(F.col(start), F.col(end))))
    clear, out = steps.where("alone__").select(*ids, name, *rest), steps.where("NOT alone__")
    if not rest:
        return clear.unionByName(out.select(*ids, name).distinct())
    rank = F.struct(F.col(start), *[F.col(c) for c in rest])
    return clear.unionByName(
        out.groupBy(*ids, name)
        .agg(F.max_by(F.struct(*rest), rank).alias("row"))
        .select(*ids, name, *[F.col(f"row.{c}").alias(c) for c in rest])
    )


def carry_forward(df: DataFrame, key: str, date: str, name: str, months: int = 12) -> DataFrame:
    """Daily rows from a report up to the day before the next report or the month end
    ``months`` ahead, whichever is earlier. The input must be unique on (key, date)."""
    w = Window.partitionBy(key).orderBy(date)
    stop = F.date_sub(
        F.least(F.lead(date).over(w), F.last_day(F.add_months(date, months))), 1
    )
    return df.withColumn("stop__", stop).withColumn(
        name, F.explode(days_or_empty(F.col(date), F.col("stop__")))
    ).drop("stop__")


def step_fill(df: DataFrame, key: str, date: str) -> DataFrame:
    """Hold each observation daily up to (not including) the next; the last one lasts one day."""
    w = Window.partitionBy(key).orderBy(date)
    last = F.coalesce(F.date_sub(F.lead(date).over(w), 1), F.col(date))
    return df.withColumn("last__", last).withColumn(
        date, F.explode(days_or_empty(F.col(date), F.col("last__")))
    ).drop("last__")


def fx_daily(quotes: DataFrame) -> DataFrame:
    """Daily currency-to-USD table with a USD = 1 seed row."""
    seed = quotes.sparkSession.sql(
        "SELECT 'USD' AS curcdd, DATE '1950-01-01' AS datadate, CAST(1.0 AS DOUBLE) AS fx"
    )
    one = seed.unionByName(quotes.select("curcdd", "datadate", "fx"))
    return step_fill(one.groupBy("curcdd", "datadate").agg(F.max("fx").alias("fx")), "curcdd", "datadate")


def scd_to_daily(df: DataFrame, ids: list[str], start: str, end: str, code: str) -> DataFrame:
    """Code history to daily rows, reading code 0 as missing."""
    clean = df.withColumn(code, F.when(F.col(code) != 0, F.col(code)))
    return expand_interval(clean, ids, start, end, "day")


def close_open_interval(
    df: DataFrame, key: str, start: str, end: str, code: str, as_of: Column, missing: int = -999
) -> DataFrame:
    """End the last, still open interval of each key at max(as_of, latest start); code NULL -> missing."""
    w = Window.partitionBy(key).orderBy(start)
    latest = df.agg(F.max(start)).scalar()
    is_last = F.lead(start).over(w).isNull()
    return (
        df.withColumns({"is_last__": is_last, "latest__": latest})
        .withColumn(
            end,
            F.when(F.col("is_last__") & F.col(end).isNull(), F.greatest(as_of, F.col("latest__"))).otherwise(F.col(end)),
        )
        .withColumn(code, F.coalesce(F.col(code), F.lit(missing).cast(dict(df.dtypes)[code])))
        .drop("is_last__", "latest__")
    )


def gap_fill(df: DataFrame, key: str, date: str, codes: list[str]) -> DataFrame:
    """Add the days missing between consecutive rows of a key; filler days carry NULL codes."""
    w = Window.partitionBy(key).orderBy(date)
    until = F.coalesce(F.date_sub(F.lead(date).over(w), 1), F.col(date))
    out = df.withColumn("until__", until).withColumn(
        "day__", F.explode(days_or_empty(F.col(date), F.col("until__")))
    )
    first = F.col("day__") == F.col(date)
    return out.select(
        key, F.col("day__").alias(date), *[F.when(first, F.col(c)).alias(c) for c in codes]
    )


def month_spine(df: DataFrame, ids: list[str], date: str) -> DataFrame:
    """Every month end between a key's first and last observation."""
    return (
        df.groupBy(*ids)
        .agg(F.min(date).alias("lo__"), F.max(date).alias("hi__"))
        .select(*ids, F.explode(months_or_empty(F.col("lo__"), F.col("hi__"))).alias(date))
    )


def densify_months(df: DataFrame, ids: list[str], date: str) -> DataFrame:
    """The rows on the month spine, with ``data_available`` and the running ``count``.

    ``df`` must be unique on (ids, date). Each row adds the months up to the next one, so the wide rows are shuffled
    once, by ids, and not joined to the spine; a row that is not at a month end, or lacks an id, only marks its month.
    """
    w = Window.partitionBy(*ids).orderBy(date)
    rest = [c for c in df.columns if c not in (*ids, date)]
    hit = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids], F.col(date) == F.last_day(date))
    month, ahead = F.last_day(date), F.last_day(F.lead(date).over(w))
    rows = df.where(F.col(date).isNotNull()).withColumns({"hit__": hit, "ahead__": ahead, "own__": month})
    # the row's own month if it holds the data or no later row does, then the months before the next row's
    own = F.col("hit__") | F.coalesce(F.col("ahead__") > F.col("own__"), F.lit(True))
    until = F.coalesce(F.add_months("ahead__", -1), F.col("own__"))
    months = F.concat(F.when(own, F.array("own__")).otherwise(F.array().cast("array<date>")), months_or_empty(F.add_months("own__", 1), until))
    rows = rows.withColumn("month__", F.explode(months))
    here = F.col("hit__") & (F.col("month__") == F.col("own__"))
    out = rows.select(*ids, F.col("month__").alias(date), *[F.when(here, F.col(c)).alias(c) for c in rest], here.cast("int").alias("data_available"))
    return out.withColumn("count", F.row_number().over(w))


def publication_expand(df: DataFrame, key: str, date: str, lag: int, max_lag: int, name: str = "public_date") -> DataFrame:
    """Month ends at which a report is the latest public one: from ``lag`` months after its date
    to the month before the next report becomes public, at most ``max_lag`` months after.

    The input is unique on (key, date), so the intervals of a key never overlap and wide rows are
    exploded as they are, without a second shuffle.
    """
    w = Window.partitionBy(key).orderBy(date)
    staged = df.withColumn("from__", F.last_day(F.add_months(date, lag))).withColumn(
        "next__", F.lead("from__").over(w)
    )
    until = F.least(
        F.last_day(F.add_months("next__", -1)), F.last_day(F.add_months(date, max_lag))
    )
    return staged.withColumn(name, F.explode(months_or_empty(F.col("from__"), until))).drop("from__", "next__")


def forward_fill(df: DataFrame, key: str, order: str, cols: list[str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
