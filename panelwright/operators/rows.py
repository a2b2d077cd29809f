"""Row selection and unions.

Picking one row per key is done with min_by / max_by over a packed row. Unlike row_number, that
aggregates before the shuffle, so a key that owns a third of the table reaches the reducer as one
row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import as_col, typed_null


def _pick(df: DataFrame, keys: list[str], order: list[Column], newest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # All columns follow the requested order in the ranking struct, so ties are settled by value.
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    picker = F.max_by if newest else F.min_by
    row = picker(F.struct(*rest), rank).alias("row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns."""
    return _pick(df, keys, [as_col(o) for o in order], newest=False)


def keep_last(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the largest by ``order``, then by the remaining columns."""
    return _pick(df, keys, [as_col(o) for o in order], newest=True)


def prefer_source(df: DataFrame, keys: list[str], source: str, preferred) -> DataFrame:
    """Keep singletons; of a pair keep the preferred source; drop keys with more than two rows.

    One aggregation decides per key, which replaces a count-over-key window.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), (F.col(source) == F.lit(preferred)).cast("int"))
    picked = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n__"),
        F.count_if(F.col(source) == F.lit(preferred)).alias("p__"),
        best.alias("row"),
    )
    keep = (F.col("n__") == 1) | ((F.col("n__") == 2) & (F.col("p__") == 1))
    return picked.filter(keep).select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


def last_in_period(df: DataFrame, keys: list[str], date: str, valid: Column) -> DataFrame:
    """The latest valid row of each period key."""
    return keep_last(df.filter(valid), keys, [date])


def same_columns(a: DataFrame, b: DataFrame) -> None:
    """Raise if one table has columns that the other lacks."""
    if extra := set(a.columns) ^ set(b.columns):
        raise ValueError(f"only one of the tables has {sorted(extra)}")


def union_relaxed(a: DataFrame, b: DataFrame) -> DataFrame:
    """Vertical union of two tables with the same columns; columns whose types differ meet as double (numeric) or
    string. Differing column sets are an error: ``union_diagonal`` fills them."""
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    same_columns(a, b)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")

    def common(c: str) -> str:
        if ta[c] == tb[c]:
            return ta[c]
        if ta[c] in numeric and tb[c] in numeric:
            whole = {"tinyint", "smallint", "int", "bigint"}
            return "bigint" if {ta[c], tb[c]} <= whole else "double"
        return "string"

    cast = lambda df: df.select(*[F.col(c).cast(common(c)).alias(c) for c in a.columns])
    return cast(a).unionByName(cast(b))


def union_diagonal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Vertical union where a column missing on one side is NULL there."""
    return a.unionByName(b, allowMissingColumns=True)


def add_missing(df: DataFrame, names: list[str]) -> DataFrame:
    """Add absent columns as NULL doubles."""
    return df.withColumns({c: typed_null() for c in names if c not in df.columns})


def distinct_lookup(df: DataFrame, columns: dict[str, str], where: Column | None = None) -> DataFrame:
    """Project and rename ({source: target}), filter, drop duplicates."""
    df = df if where is None else df.filter(where)
    return df.select(*[F.col(a).alias(b) for a, b in columns.items()]).distinct()


def header_union(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row per key out of two sources, the first source winning."""
    both = a.withColumn("rank__", F.lit(0)).unionByName(b.withColumn("rank__", F.lit(1)))
    return keep_first(both, [key], ["rank__"]).drop("rank__")


def rename_and_keep(
    df: DataFrame, replace: dict[str, str], ids: list[str], keep: list[str], suffix: str = ""
) -> DataFrame:
    """Rename by first-occurrence substring replacement, keep ids and ``keep``, suffix the latter."""
    names = {}
    for c in df.columns:
        new = c
        for old, sub in replace.items():
            new = new.replace(old, sub, 1)
        names[new] = c
    picked = [F.col(names[i]).alias(i) for i in ids]
    return df.select(*picked, *[F.col(names[k]).alias(k + suffix) for k in keep])


def pivot_history(df: DataFrame, keys: list[str], item: str, value: str, items: dict[str, str]) -> DataFrame:
    """Key-value history to one column per item ({item value: column name}) in one pass."""
    aggs = [F.max(F.when(F.col(item) == k, F.col(value))).alias(v) for k, v in items.items()]
    return df.filter(F.col(item).isin(list(items))).groupBy(*keys).agg(*aggs)


def index_series(data: DataFrame, header: DataFrame, key: str, wanted) -> DataFrame:
    """Attach the series header and keep a single series; the filter runs before the join."""
    only = F.col(key) == F.lit(wanted)
    return data.filter(only).join(header.filter(only), key)
