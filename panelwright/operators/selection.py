"""Exact order statistics by refinement, for many columns and groups at once: no sort, no window, no rank table.

A double is mapped to a whole number that keeps the order (:func:`image`). Rows are first counted by the high bits
of that number, then once more, by all bits, in those cells only that hold a wanted position; if such a cell
holds more than ``FITS`` values, by some bits more in between. The counts of a group's cells travel as one array, at most
2 ** ``STEP`` entries. Rows are never moved: what they are compared with is packed into one array per group and
joined to the wide rows, and each pass aggregates map-side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import stage, stage_bucketed

FIRST = 50  # sign, exponent and two bits of the fraction remain
STEP = 14
FITS = 1 << 17
#: Rows of a group that go to one bucket; larger groups are dealt over several.
ROWS = 1 << 16
ONE = float(1 << 52)
LARGEST = 1.7976931348623157e308
LAST = (1 << 63) - 1


def image(v: Column) -> Column:
    """A whole number in the order of doubles, equal for equal values only; NaN is above all, as Spark sorts it.

    Written without branches, so that each step is evaluated once: with x = m * 2**e and 1 <= m < 2 (less for the
    smallest exponent) the number is (e + 1023) * 2**52 + (m - 1) * 2**52, which is exact.
    """
    v = v.cast("double")
    x = F.least(F.abs(v), F.lit(LARGEST))
    power = lambda e: F.pow(F.lit(2.0), e)
    guess = F.least(F.greatest(F.floor(F.log2(x)).cast("double"), F.lit(-1022.0)), F.lit(1023.0))
    at = power(guess)  # the logarithm may be off by one next to a power of two
    e = guess + (x / at >= 2).cast("double") - ((x < at) & (guess > -1022)).cast("double")
    bits = (e + 1023).cast("long") * F.lit(1 << 52) + ((x / power(e) - 1) * ONE).cast("long")
    beyond = (F.abs(v) > LARGEST).cast("long") + F.isnan(v).cast("long")
    return (bits + beyond) * (F.lit(1) - (v < 0).cast("long") * 2)


def images_of(values: pa.Array) -> np.ndarray:
    """:func:`image` of an array of doubles, read off their bits; of a missing one that of 0."""
    v = values.fill_null(0.0).to_numpy() + 0.0  # -0.0 is 0.0
    bits = v.view(np.int64)
    return np.where(np.isnan(v), (2047 << 52) + 1, np.where(bits < 0, -(bits & LAST), bits))


def images(df: DataFrame, column: str, width: int) -> DataFrame:
    """``df`` with :func:`image` of each entry of ``column``, arrays of ``width`` doubles: read off their bits, which
    costs a small part of the arithmetic of ``image`` where there are many columns."""
    schema = T.StructType([T.StructField(f.name, T.ArrayType(T.LongType())) if f.name == column else f for f in df.schema.fields])

    def run(batches):
        for b in batches:
            flat = b.column(column).flatten()
            lists = pa.ListArray.from_arrays(np.arange(len(b) + 1, dtype=np.int32) * width, pa.array(images_of(flat), mask=flat.is_null().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([lists if n == column else c for n, c in zip(b.schema.names, b.columns)], names=b.schema.names)

    return df.mapInArrow(run, schema)


def value_of(i: Column) -> Column:
    """The double of an image."""
    size = F.abs(i)
    e = F.shiftright(size, 52)
    part = (size - e * F.lit(1 << 52)).cast("double") / ONE
    x = F.when(e == 0, part * F.pow(F.lit(2.0), F.lit(-1022.0))).otherwise((part + 1) * F.pow(F.lit(2.0), e.cast("double") - 1023))
    x = F.when(size == 2047 * (1 << 52), float("inf")).when(size > 2047 * (1 << 52), float("nan")).otherwise(x)
    return F.when(i < 0, -x).otherwise(x)


@dataclass
class Wide:
    """Written rows with one array ``x`` of images, and how packed arrays meet them."""

    rows: DataFrame
    keys: list[str]
    columns: list[str]
    hot: DataFrame | None  # (keys, salts__) of groups dealt over several buckets

    def meet(self, packed: DataFrame) -> DataFrame:
        """Rows with the columns of ``packed`` (one row per group)."""
        if self.hot is None:
            return self.rows.join(packed, self.keys)
        salts = packed.join(self.hot, self.keys, "left").withColumn("salt__", F.explode(F.sequence(F.lit(0), F.coalesce("salts__", F.lit(1)) - 1))).drop("salts__")
        return self.rows.join(salts, [*self.keys, "salt__"])

    def pack(self, df: DataFrame, **columns: Column) -> DataFrame:
        """One row per group from rows per (group, ``var``): arrays in the order of the columns."""
        entry = F.struct("var", F.struct(*[c.alias(n) for n, c in columns.items()]).alias("v"))
        held = df.groupBy(*self.keys).agg(F.map_from_entries(F.collect_list(entry)).alias("at"))  # an entry per column
        return held.select(*self.keys, F.transform(F.sequence(F.lit(0), F.lit(len(self.columns) - 1)), lambda i: F.try_element_at("at", i)).alias("by"))

    def long(self, df: DataFrame, *carry: str) -> DataFrame:
        """(keys, carry, var, img, v): a row for each value present, beside its entry of ``by``; nothing is shuffled."""
        out = df.select(*self.keys, *carry, F.posexplode(F.arrays_zip("x", "by")).alias("var", "e")).where("e.x is not null and e.by is not null")
        return out.select(*self.keys, *carry, "var", F.col("e.x").alias("img"), F.col("e.by").alias("v"))


def wide(df: DataFrame, keys: list[str], columns: list[str], ref: Column | None = None, carry: list[str] | None = None, salt: str | None = None) -> Wide:
    """Write the rows once, with images in place of the columns. With ``salt`` (a column) they are written in buckets of
    (keys, salt), so that later joins on them move nothing; a group of over ``ROWS`` rows is dealt over several and its
    rows have the flag ``dealt__``."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    ref = F.lit(True) if ref is None else F.coalesce(ref, F.lit(False))
    use, extra, hot = df.where(known), [], None
    if salt:
        counts = use.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("salts__"))
        hot = stage(counts.where("salts__ > 1"), "hot")
        use = use.join(hot, keys, "left")
        extra = [F.pmod(F.xxhash64(salt), F.coalesce("salts__", F.lit(1))).cast("int").alias("salt__"), F.col("salts__").isNotNull().alias("dealt__")]
    entry = (lambda c: F.col(c).cast("double")) if salt else (lambda c: image(F.col(c)))
    rows = use.select(*keys, *(carry or []), ref.alias("ref"), F.array(*[entry(c) for c in columns]).alias("x"), *extra)
    if salt:
        return Wide(stage_bucketed(images(rows, "x", len(columns)), "wide", [*keys, "salt__"]), keys, columns, hot)
    return Wide(stage(rows, "wide"), keys, columns, hot)


def first_counts(w: Wide) -> DataFrame:
    """(keys, var, n, m, cells): values present and those of reference rows, by the highest bits."""
    found = w.rows.select(*w.keys, "ref", F.posexplode("x").alias("var", "img")).where("img is not null")
    return _cells(found, w.keys, FIRST)


def _cells(found: DataFrame, keys: list[str], shift: int) -> DataFrame:
    cells = found.groupBy(*keys, "var", F.shiftright("img", shift).alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.count_if("ref").alias("m"))
    entry = F.struct("cell", "n", "m")
    return cells.groupBy(*keys, "var").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sort_array(F.collect_list(entry)).alias("cells"))


def _locate(cells: Column, want: Column, shift: int, before: int | None) -> Column:
    """Each wanted (pos, by_ref, cell, skip) narrowed to one of the cells: those inside its cell are counted up from
    the ``skip`` values below it, until the position is reached."""

    def narrow(p):
        def walk(acc, c):
            count = F.when(p["by_ref"], c["m"]).otherwise(c["n"])
            here = acc["cell"].isNull() & (acc["skip"] + count >= p["pos"])
            return F.struct(
                F.when(here, c["cell"]).otherwise(acc["cell"]).alias("cell"),
                F.when(acc["cell"].isNull() & ~here, acc["skip"] + count).otherwise(acc["skip"]).alias("skip"),
                F.when(here, c["n"]).otherwise(acc["size"]).alias("size"),
            )

        inside = cells if before is None else F.filter(cells, lambda c: F.shiftright(c["cell"], before - shift) == p["cell"])
        nothing = F.struct(F.lit(None).cast("long").alias("cell"), p["skip"].alias("skip"), F.lit(0).cast("long").alias("size"))
        end = F.aggregate(inside, nothing, walk)
        return F.struct(p["pos"].alias("pos"), p["by_ref"].alias("by_ref"), end["cell"].alias("cell"), end["skip"].alias("skip"), end["size"].alias("size"))

    return F.transform(want, narrow)


def position(pos: Column, by_ref: bool = False) -> Column:
    """A wanted 1-based position, among all values or those of reference rows."""
    none = F.lit(None).cast("long")
    return F.struct(pos.cast("long").alias("pos"), F.lit(by_ref).alias("by_ref"), none.alias("cell"), F.lit(0).cast("long").alias("skip"), F.lit(0).cast("long").alias("size"))


def select(w: Wide, cells: DataFrame, want: Column, fits: int = FITS) -> DataFrame:
    """(keys, var, all other columns of ``cells`` and ``found``): for each entry of ``want`` (an array of
    :func:`position`, over the columns of ``cells``) the image of the value there; NULL beyond the last one."""
    keys = [*w.keys, "var"]
    state = cells.withColumn("want", _locate(F.col("cells"), want, FIRST, None)).drop("cells")
    shift = FIRST
    while shift:
        state = stage(state, "wanted")
        largest = state.agg(F.max(F.array_max("want.size"))).first()[0] or 0
        before, shift = shift, 0 if largest <= fits else max(0, shift - STEP)
        packed = w.pack(state, cells=F.array_distinct("want.cell"))
        found = w.long(w.meet(packed), "ref").where(F.array_contains("v.cells", F.shiftright("img", before)))
        inner = _cells(found, w.keys, shift).select(*keys, F.col("cells").alias("cells__"))
        state = state.join(inner, keys, "left").withColumn("want", _locate(F.coalesce("cells__", F.array().cast(inner.schema["cells__"].dataType)), F.col("want"), shift, before)).drop("cells__")
    return state.withColumn("found", F.col("want.cell")).drop("want")


def order_statistics(df: DataFrame, keys: list[str], columns: list[str], positions: Callable[[Column], list[Column]], fits: int = FITS) -> DataFrame:
    """(keys, var, n, values): for each column (by number) the values at 1-based positions, which may depend on n."""
    w = wide(df, keys, columns)
    found = select(w, first_counts(w), F.array(*[position(p) for p in positions(F.col("n"))]), fits)
    return stage(found.select(*keys, "var", "n", F.transform("found", value_of).alias("values")), "statistics")
