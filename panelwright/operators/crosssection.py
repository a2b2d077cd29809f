"""Ranks, quantiles and step functions over a cross-section, without one task per group.

A country-month can hold a third of all rows, and so can one repeated value inside it. Ranking
with ``rank() over (partition by country, month)`` would send that to a single task. Instead:

1. rows are folded to distinct values per group (``value_counts``), combined before the shuffle,
   so ties cost nothing;
2. every distinct value gets a *slot*, a fixed monotone function of the value, and the running
   counts are taken inside (group, slot), which spreads one group over many tasks;
3. the slot totals, a small table bounded by the number of slots, are accumulated per group and
   added as offsets.

The slot is a pure function of the value, so a recomputed task always lands in the same place
after an executor loss (sampled range boundaries would not give that).

The result is exact: ranks, percentiles and cumulative shares follow from the counts.

Ranks of several columns (:func:`rank_pct`, :func:`z_ranks`) take this way only for groups of over ``ROWS`` rows. The
others are ranked on the wide rows, which are shuffled once by group, one column at a time in a task's memory, instead
of a long row per value several times.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import as_col, div
from ..sources.scratch import stage
from .selection import order_statistics

SLOTS_PER_E = 16
SLOT_SCALE = 1e6
PARTS_PER_SLOT = 4096
#: Rows of a group that one task ranks, on the wide rows; larger groups go through the rank table.
ROWS = 1 << 20


def _place(v: Column) -> Column:
    """A monotone scale, logarithmic in |v| and symmetric around 0; a unit is a slot. NaN is with the greatest."""
    x = v.cast("double")
    size = F.least(F.abs(x), F.lit(1e300))  # beyond that the product below would overflow
    return F.when(F.isnan(x), 1.0).otherwise(F.signum(x)) * F.log1p(size * SLOT_SCALE) * SLOTS_PER_E


def slot_of(v: Column) -> Column:
    """Monotone bucket of a double, about 6 % wide.

    At most 2 * 16 * (ln(1.8e308) + ln(1e6)) = about 23,000 slots exist, whatever the data.
    """
    # declared non-null, so joins on the slot add no filter that would keep Spark from reusing
    # the exchange below
    return F.coalesce(F.floor(_place(v)).cast("int"), F.lit(0))


def part_of(v: Column) -> Column:
    """Monotone bucket inside a slot, about 0.0015 % wide: a variable whose spread is small against its level
    fills one slot, but many of its parts."""
    place = _place(v)
    return F.coalesce(F.floor((place - F.floor(place)) * PARTS_PER_SLOT).cast("int"), F.lit(0))


def value_counts(
    df: DataFrame,
    keys: list[str],
    value: str,
    ref: Column | None = None,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Distinct non-null values per group with ``n_at``, ``ref_at`` and any extra sums."""
    ref_at = F.count(F.lit(1)) if ref is None else F.count_if(ref)
    present = F.col(value).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    return (
        df.filter(present)
        .groupBy(*keys, value)
        .agg(
            F.count(F.lit(1)).alias("n_at"),
            ref_at.alias("ref_at"),
            *[F.sum(c).alias(name) for name, c in (sums or {}).items()],
        )
    )


def rank_table(
    df: DataFrame,
    keys: list[str],
    value: str,
    ref: Column | None = None,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """``value_counts`` plus ``n_below``, ``n_all``, ``ref_below`` and ``ref_all``.

    The counts are shuffled once more, by part; the totals of parts are read off the last value of each, so they need
    the same exchange. Without ``ref`` all rows are reference rows, and are counted once.
    """
    counts = value_counts(df, keys, value, ref, sums).withColumns({"slot__": slot_of(F.col(value)), "part__": part_of(F.col(value))})
    kinds = ["n"] if ref is None else ["n", "ref"]
    if ref is None:
        counts = counts.drop("ref_at")
    slot, part = [*keys, "slot__"], [*keys, "slot__", "part__"]
    before = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    running = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    inside = before(part, value)
    counts = counts.withColumns({f"{k}_in": running(f"{k}_at", inside) for k in kinds})
    last = F.lead(value).over(Window.partitionBy(*part).orderBy(value)).isNull()
    by_part = counts.withColumn("last__", last).where("last__").select(*part, *[(F.col(f"{k}_in") + F.col(f"{k}_at")).alias(f"{k}_part") for k in kinds])
    by_slot = by_part.groupBy(*slot).agg(*[F.sum(f"{k}_part").alias(f"{k}_slot") for k in kinds])
    group, earlier = Window.partitionBy(*keys), before(keys, "slot__")
    slots = by_slot.select(
        *slot,
        *[running(f"{k}_slot", earlier).alias(f"{k}_out") for k in kinds],
        *[F.sum(f"{k}_slot").over(group).alias(f"{k}_all") for k in kinds],
    )
    in_slot = before(slot, "part__")
    offsets = by_part.withColumns({f"{k}_in_slot": running(f"{k}_part", in_slot) for k in kinds}).join(slots, slot)
    offsets = offsets.select(*part, *[(F.col(f"{k}_out") + F.col(f"{k}_in_slot")).alias(f"{k}_off") for k in kinds], *[f"{k}_all" for k in kinds])
    out = counts.join(offsets, part).withColumns({f"{k}_below": F.col(f"{k}_in") + F.col(f"{k}_off") for k in kinds})
    if ref is None:
        out = out.withColumns({"ref_at": F.col("n_at"), "ref_below": F.col("n_below"), "ref_all": F.col("n_all")})
    return out.select(*keys, value, "n_at", "ref_at", *(sums or {}), "n_all", "ref_all", "n_below", "ref_below")


def average_rank(descending: Column | bool = False) -> Column:
    """Average rank (ties share the mean position) from the columns of a rank table."""
    up = F.col("n_below") + (F.col("n_at") + 1) / F.lit(2.0)
    down = F.col("n_all") + 1 - up
    if isinstance(descending, bool):
        return down if descending else up
    return F.when(descending, down).otherwise(up)


def min_rank(descending: bool = False) -> Column:
    below = F.col("n_below")
    if descending:
        below = F.col("n_all") - F.col("n_below") - F.col("n_at")
    return below + 1


def attach_ranks(df: DataFrame, table: DataFrame, keys: list[str], value: str, cols: list[str]) -> DataFrame:
    """Bring rank-table columns back to the rows. NULL values stay unranked.

    The join key is (group, value); a value shared by very many rows shows up as a skewed
    partition on the row side only, which AQE splits because the other side has one row for it.
    """
    return df.join(table.select(*keys, value, *cols), [*keys, value], "left")


def quantile_position(n: Column, q: float | Column) -> Column:
    """1-based position of the discrete quantile: ceil(q n) with a guard against q n = k + tiny."""
    return F.greatest(F.lit(1.0), F.ceil(n * q - 1e-9))


def quantile_disc(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], count: str | None = None
) -> DataFrame:
    """Discrete quantiles per group: the smallest value whose cumulative count reaches ceil(q n)."""
    found = order_statistics(df, keys, [value], lambda n: [quantile_position(n, q) for q in probs.values()])
    named = [F.col("values")[i].alias(name) for i, name in enumerate(probs)]
    return found.select(*keys, *([F.col("n").alias(count)] if count else []), *named)


def quantile_disc_many(
    df: DataFrame, keys: list[str], values: list[str], probs: dict[str, float], count: tuple[str, str] | None = None
) -> DataFrame:
    """Quantiles of several columns in one pass: columns ``<value>_<suffix>`` for each prob suffix; ``count`` names a
    column and the value whose rows it counts."""
    found = order_statistics(df, keys, values, lambda n: [quantile_position(n, q) for q in probs.values()])
    at = lambda i, c: F.max(F.when(F.col("var") == i, c))
    aggs = [at(i, F.col("values")[j]).alias(f"{v}_{s}") for i, v in enumerate(values) for j, s in enumerate(probs)]
    if count:
        aggs = [F.coalesce(at(values.index(count[1]), F.col("n")), F.lit(0)).alias(count[0]), *aggs]
    return found.groupBy(*keys).agg(*aggs)


def melt(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """Wide to long over double columns, dropping NULLs."""
    wide = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return wide.unpivot(ids, values, name, value).filter(F.col(value).isNotNull())


def ecdf(df: DataFrame, keys: list[str], value: str, ref: Column, out: str = "cdf") -> DataFrame:
    """Share of reference rows with a value <= the row's own (0 below the lowest reference value)."""
    t = rank_table(df, keys, value, ref=ref).withColumn(
        out, F.coalesce(div(F.col("ref_below") + F.col("ref_at"), F.col("ref_all").cast("double")), F.lit(0.0))
    )
    return attach_ranks(df, t, keys, value, [out])


def by_size(df: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups of at most ``most`` rows and those without a key, and the rows of larger groups, if any."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n__")).where(F.col("n__") > most)
    hot = stage(counts.select(*keys), "hot")
    if hot.isEmpty():
        return df, None
    return df.join(hot, keys, "left_anti"), df.join(hot, keys, "left_semi")


Values = dict[str, np.ndarray]


def numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Doubles (-0.0 as 0.0) and which of them are present."""
    column = column.cast(pa.float64())
    return column.fill_null(0.0).to_numpy() + 0.0, ~column.is_null().to_numpy()


def ranked(x: np.ndarray, known: np.ndarray, down: bool) -> tuple[np.ndarray, int]:
    """Average ranks of the known values (NaN above all, equal to itself), NaN for the others, and their number."""
    v = x[known]
    order = np.argsort(v, kind="stable")
    v = v[order]
    same = (v[1:] == v[:-1]) | (np.isnan(v[1:]) & np.isnan(v[:-1]))
    start = np.flatnonzero(np.append(len(v) > 0, ~same)) if len(v) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(v)))
    up = np.repeat(start + (size + 1) / 2, size)
    own, out = np.empty(len(v)), np.full(len(x), np.nan)
    own[order] = len(v) + 1 - up if down else up
    out[known] = own
    return out, len(v)


def owners(table: pa.Table, ids: list[str]) -> np.ndarray:
    """A number for each row, equal for rows with equal ids; -1 where an id is missing."""
    code = np.zeros(len(table), np.int64)
    for c in ids:
        own = table.column(c).combine_chunks().dictionary_encode()
        own = own.combine_chunks() if isinstance(own, pa.ChunkedArray) else own
        index = own.indices.fill_null(-1).to_numpy().astype(np.int64)
        both = np.unique(code * (len(own.dictionary) + 1) + index, return_inverse=True)[1] if len(ids) > 1 else index
        code = np.where((code < 0) | (index < 0), -1, both)
    return code


@dataclass
class Step:
    """Ranks of columns ({column: descending}) become ``score(rank, n)`` (NaN: NULL), named with ``prefix``; ``then`` may
    make the columns of the next step from all scores so far."""

    values: dict[str, bool]
    prefix: str
    score: Callable[[np.ndarray, int], np.ndarray]
    then: Callable[[Values], Values] = lambda scores: {}


def _rank_group(ids: list[str], keys: list[str], steps: list[Step], out: list[str], schema: pa.Schema, joined: bool) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        own = owners(table, ids)
        if any(table.column(k).null_count for k in keys):
            own[:] = -1
        held, count = own >= 0, np.bincount(own[own >= 0], minlength=1)
        found: Values = {}
        made: Values = {}
        for step in steps:
            for c, down in step.values.items():
                x, known = (made[c], ~np.isnan(made[c])) if c in made else numbers(table.column(c))
                score = step.score(*ranked(x, known, down))
                if count.max() > 1:  # rows that repeat an id all get the greatest
                    best = np.full(len(count), np.nan)
                    np.fmax.at(best, own[held], score[held])
                    score = best[own]
                found[step.prefix + c] = np.where(held, score, np.nan)
            made = step.then(found)
        columns = [*[table.column(c) for c in (*ids, *keys)], *[pa.array(found[c], mask=np.isnan(found[c])) for c in out]]
        done = pa.Table.from_arrays(columns, schema=schema)
        return done.take(np.repeat(np.arange(len(table)), np.where(held, count[own], 1))) if joined and count.max() > 1 else done

    return run


def _wide_ranks(df: DataFrame, ids: list[str], keys: list[str], steps: list[Step], out: list[str], joined: bool = False) -> DataFrame:
    """Columns ``out`` of the scores of each group, ranked in one task. Rows that repeat an id in a group all get the
    greatest (with ``joined`` each of them comes as often as they are, as in a join by ids and keys); rows without an id
    or key get NULL."""
    from pyspark.sql.pandas.types import to_arrow_schema

    first = list(steps[0].values)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # rows without a key are no group: they are dealt by what they hold
    salt = F.when(known, 0).otherwise(F.pmod(F.xxhash64(*ids, *first), F.lit(1 << 16)).cast("int"))
    rows = df.select(*ids, *keys, *[F.col(c).cast("double").alias(c) for c in first], salt.alias("salt__"))
    # a fixed number of partitions: merged ones would be sorted in one task
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "salt__")
    schema = T.StructType([*[df.schema[c] for c in (*ids, *keys)], *[T.StructField(c, T.DoubleType()) for c in out]])
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return rows.groupBy(*keys, "salt__").applyInArrow(_rank_group(ids, keys, steps, out, to_arrow_schema(nullable), joined), nullable)


def share_score(min_n: int) -> Callable[[np.ndarray, int], np.ndarray]:
    return lambda r, n: r / n if n >= max(min_n, 1) else np.full(len(r), np.nan)


def z_score(min_n: int) -> Callable[[np.ndarray, int], np.ndarray]:
    def score(r: np.ndarray, n: int) -> np.ndarray:
        dev = r - (n + 1) / 2
        square = np.nansum(dev * dev)
        return dev / np.sqrt(square / (n - 1)) if n >= min_n and square > 0 else np.full(len(r), np.nan)

    return score


def _in_two(
    df: DataFrame, keys: list[str], most: int | None, wide: Callable[[DataFrame], DataFrame], long: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    few, hot = by_size(df, keys, ROWS if most is None else most)
    return wide(few) if hot is None else wide(few).unionByName(long(hot))


def rank_pct(
    df: DataFrame, ids: list[str], keys: list[str], values: dict[str, bool], min_n: int, most: int | None = None
) -> DataFrame:
    """Average rank / count per group for several columns ({column: descending}) in one pass.

    Groups with fewer than ``min_n`` values give NULL. Result: ids, keys, ``rank_<column>``. A group of at most
    ``most`` rows (``ROWS``) is ranked in one task.
    """
    step = Step(values, "rank_", share_score(min_n))
    wide = lambda rows: _wide_ranks(rows, ids, keys, [step], [f"rank_{c}" for c in values])
    return _in_two(df, keys, most, wide, lambda rows: _long_pct(rows, ids, keys, values, min_n))


def z_chain(
    df: DataFrame, ids: list[str], keys: list[str], steps: list[Step], out: list[str], long: Callable[[DataFrame], DataFrame], most: int | None = None
) -> DataFrame:
    """Ranks of scores of ranks: ``steps`` in a row, for which a group is shuffled once. Larger groups go through ``long``."""
    return _in_two(df, keys, most, lambda rows: _wide_ranks(rows, ids, keys, steps, out, joined=True), long)


def _long_pct(df: DataFrame, ids: list[str], keys: list[str], values: dict[str, bool], min_n: int) -> DataFrame:
    long = melt(df, [*ids, *keys], list(values), "var__", "val__")
    group = [*keys, "var__"]
    desc = [v for v, d in values.items() if d]
    down = F.col("var__").isin(desc) if desc else F.lit(False)
    t = (
        rank_table(long, group, "val__")
        .filter(F.col("n_all") >= min_n)
        .withColumn("pct__", average_rank(down) / F.col("n_all"))
    )
    ranked = long.join(t.select(*group, "val__", "pct__"), [*group, "val__"])
    wide = ranked.groupBy(*ids, *keys).agg(
        *[F.max(F.when(F.col("var__") == v, F.col("pct__"))).alias(f"rank_{v}") for v in values]
    )
    return df.select(*ids, *keys).join(wide, [*ids, *keys], "left")


def z_ranks(
    df: DataFrame, ids: list[str], keys: list[str], values: dict[str, bool], min_n: int, prefix: str = "z_", most: int | None = None
) -> DataFrame:
    """z-score of the average rank per group for several columns ({column: descending}).

    The mean rank is (n + 1) / 2 whatever the ties; the variance comes from the ranks.
    Groups below ``min_n`` values, or with a single distinct value, give NULL. A group of at most ``most`` rows
    (``ROWS``) is ranked in one task.
    """
    step = Step(values, prefix, z_score(min_n))
    wide = lambda rows: _wide_ranks(rows, ids, keys, [step], [f"{prefix}{c}" for c in values])
    return _in_two(df, keys, most, wide, lambda rows: _long_z(rows, ids, keys, values, min_n, prefix))


def _long_z(df: DataFrame, ids: list[str], keys: list[str], values: dict[str, bool], min_n: int, prefix: str) -> DataFrame:
    long = melt(df, [*ids, *keys], list(values), "var__", "val__")
    group = [*keys, "var__"]
    desc = [v for v, d in values.items() if d]
    down = F.col("var__").isin(desc) if desc else F.lit(False)
    n = F.col("n_all").cast("double")
    t = (
        rank_table(long, group, "val__")
        .filter(F.col("n_all") >= min_n)
        .withColumn("dev__", average_rank(down) - (n + 1) / 2)
    )
    spread = t.groupBy(*group).agg(
        F.sqrt(
            div(F.sum(F.col("n_at") * F.col("dev__") * F.col("dev__")), F.max(n) - 1)
        ).alias("sd__")
    )
    z = t.join(spread, group).select(*group, "val__", div("dev__", "sd__").alias("z__"))
    ranked = long.join(z, [*group, "val__"])
    wide = ranked.groupBy(*ids, *keys).agg(
        *[F.max(F.when(F.col("var__") == v, F.col("z__"))).alias(f"{prefix}{v}") for v in values]
    )
    return df.select(*ids, *keys).join(wide, [*ids, *keys], "left")


def standardize_signal(df: DataFrame, keys: list[str], values: list[str], ids: list[str]) -> DataFrame:
    """min-rank / max min-rank - 0.5 per group for several columns."""
    long = melt(df, [*ids, *keys], values, "var__", "val__")
    group = [*keys, "var__"]
    t = rank_table(long, group, "val__").withColumn("mr__", min_rank())
    top = t.groupBy(*group).agg(F.max("mr__").alias("top__"))
    s = t.join(top, group).select(*group, "val__", (F.col("mr__") / F.col("top__") - 0.5).alias("s__"))
    wide = long.join(s, [*group, "val__"]).groupBy(*ids, *keys).agg(
        *[F.max(F.when(F.col("var__") == v, F.col("s__"))).alias(v) for v in values]
    )
    return df.select(*ids, *keys).join(wide, [*ids, *keys], "left")


def group_median(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact median per group: the mean of the values at the middle positions."""
    found = order_statistics(df, keys, [value], lambda n: [F.floor((n + 1) / 2), F.floor(n / 2) + 1])
    return found.select(*keys, ((F.col("values")[0] + F.col("values")[1]) / 2).alias(out))


def winsorize(c: str | Column, lo: str | Column, hi: str | Column, only: Column | None = None) -> Column:
    """Clamp to [lo, hi]; NULL bounds do not bind; rows outside ``only`` are left alone."""
    x, lo, hi = as_col(c), as_col(lo), as_col(hi)
    out = F.when(x > hi, hi).when(x < lo, lo).otherwise(x)
    return out if only is None else F.when(only, out).otherwise(x)

