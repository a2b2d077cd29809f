"""Joins: enrichment, intervals, currency, steps.

No broadcast is forced anywhere: lookups whose size depends on the data are left to Spark, which
broadcasts below ``spark.sql.autoBroadcastJoinThreshold`` using measured sizes under AQE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage

FAR_DATE = "9999-12-31"


def enrich(df: DataFrame, others: list[DataFrame], keys: list[str], how: str = "left") -> DataFrame:
    """Chain of joins on one key set, so the key partitioning is reused."""
    return reduce(lambda a, b: a.join(b, keys, how), others, df)


def merge_metrics(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer merge of n metric tables on ``keys`` with one shuffle.

    The frames are stacked with missing columns as NULL and folded by key; each metric column is
    unique to its frame and unique per key, so ``max`` only picks the value.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in stacked.columns if c not in keys]
    )


LEAF_DAYS, FAN, LEVELS = 32, 4, 4


def _nodes(first: Column, last: Column) -> Column:
    """The nodes (level, place) of a tree over days that cover first .. last, as large as fits and disjoint: leaves of
    ``LEAF_DAYS`` days, ``FAN`` children to a parent. The first and the last leaf may stick out. A level below the
    top adds fewer than 2 * FAN nodes; the top level takes the rest."""
    leaf = lambda day: F.floor(day / F.lit(LEAF_DAYS))
    inside = [
        (F.ceil(leaf(first) / F.lit(FAN**k)).cast("int"), (F.floor((leaf(last) + 1) / F.lit(FAN**k)) - 1).cast("int")) for k in range(LEVELS)
    ]
    run = lambda a, b: F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    node = lambda level, at: F.transform(at, lambda i: F.struct(F.lit(level).alias("level"), i.alias("place")))
    parts = []
    for k, (lo, hi) in enumerate(inside):
        places = run(lo, hi)
        if k < LEVELS - 1:  # without what parents cover
            up, down = inside[k + 1]
            places = F.when(down >= up, F.concat(run(lo, up * FAN - 1), run((down + 1) * FAN, hi))).otherwise(places)
        parts.append(node(k, places))
    return F.concat(*parts)


def _ancestors(day: Column) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("level"), F.floor(day / F.lit(LEAF_DAYS * FAN**k)).cast("int").alias("place")) for k in range(LEVELS)])


def interval_matches(points: DataFrame, intervals: DataFrame, key: str, date: str, start: str, end: str) -> DataFrame:
    """Pairs of points and intervals with start <= date <= end; a NULL bound is open.

    An interval becomes the nodes of a tree over days that cover it (see :func:`_nodes`), a point the ``LEVELS`` nodes
    above it, and the two meet in an equi join on (key, node) with the exact bounds as residual. The nodes of an
    interval are disjoint, so a pair is found once; 60 open years are 30 nodes or so, not 720 months. A hot key is
    spread over the nodes. Open bounds are cut to the range of the points, taken from one scalar subquery.
    """
    span = points.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi"))).scalar()
    cut = (
        intervals.withColumn("span__", span)
        .withColumn("a__", F.greatest(F.coalesce(start, "span__.lo"), F.col("span__.lo")))
        .withColumn("b__", F.least(F.coalesce(end, "span__.hi"), F.col("span__.hi")))
        .where(F.col("a__") <= F.col("b__"))
        .withColumn("node__", F.explode(_nodes(F.unix_date("a__"), F.unix_date("b__"))))
        .drop("span__")
    )
    p = points.withColumn("node__", F.explode(_ancestors(F.unix_date(date)))).alias("p")
    # Spark guesses the size of the nodes from the file of intervals, without the explode, and would broadcast tens of
    # times its threshold through the driver: sort-merge only, whose skew AQE splits
    s = cut.withColumnsRenamed({key: "k__", "node__": "at__"}).hint("merge").alias("s")
    cond = (F.col(f"p.{key}") == F.col("s.k__")) & (F.col("p.node__") == F.col("s.at__")) & F.col(f"p.{date}").between(F.col("s.a__"), F.col("s.b__"))
    return p.join(s, cond).drop("node__", "at__", "k__", "a__", "b__")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    date: str,
    start: str,
    end: str,
    how: str = "left",
) -> DataFrame:
    """Attach the intervals of :func:`interval_matches`. A left join numbers the written points and joins the matches
    back by number, so that only key, date and number are copied to the nodes."""
    if how == "inner":
        return interval_matches(points, intervals, key, date, start, end)
    rows = stage(points.withColumn("n__", F.monotonically_increasing_id()), "points")
    found = interval_matches(rows.select("n__", key, F.col(date).alias("d__")), intervals, key, "d__", start, end)
    return rows.join(found.drop(key, "d__"), "n__", how).drop("n__")


def primary_flag(
    df: DataFrame,
    histories: dict[str, DataFrame],
    header: DataFrame,
    key: str,
    iid: str,
    date: str,
    unique: list[str],
) -> DataFrame:
    """Flag rows whose issue id equals one of the recorded primary ids on that date.

    ``histories`` maps a column name to a table (key, <name>, effdate, thrudate); ``header`` has
    one row per key with a fallback column of the same name. The three lookups share one pass:
    the histories are stacked and joined once, then folded back to one row per ``unique`` key.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [h.select(key, name, "effdate", "thrudate") for name, h in histories.items()],
    )
    narrow = df.select(*dict.fromkeys([*unique, key, date]))
    # all ids recorded on this date; several can be valid at once
    hits = interval_matches(narrow, stacked, key, date, "effdate", "thrudate").groupBy(*unique).agg(*[F.collect_set(n).alias(f"{n}__set") for n in histories])
    flat = df.join(hits, unique, "left")
    head = header.select(key, *[F.col(n).alias(f"{n}__h") for n in histories])
    match = reduce(
        lambda a, b: a | b,
        [
            F.when(F.size(f"{n}__set") > 0, F.array_contains(f"{n}__set", F.col(iid))).otherwise(
                F.coalesce(F.col(iid) == F.col(f"{n}__h"), F.lit(False))
            )
            for n in histories
        ],
    )
    return (
        flat.join(head, key, "left")
        .withColumn("primary_sec", F.coalesce(match, F.lit(False)).cast("int"))
        .select(*df.columns, "primary_sec")
    )


def cross_rate(quotes: DataFrame, base: str = "GBP", target: str = "USD") -> DataFrame:
    """Rates to ``target`` from quotes against ``base``: rate(base->target) / rate(base->currency)."""
    own = quotes.filter(F.col("fromcurd") == base)
    to = own.filter(F.col("tocurd") == target).select("datadate", F.col("exratd").alias("t__"))
    return (
        own.join(to, "datadate")
        .select(
            F.col("tocurd").alias("curcdd"),
            "datadate",
            F.try_divide("t__", "exratd").alias("fx"),
        )
        .distinct()
    )


def fx_convert(df: DataFrame, fx: DataFrame, cols: list[str], date: str, curr: str, keep_fx: bool = False) -> DataFrame:
    """Multiply ``cols`` by the rate of (date, currency) and relabel the currency to USD."""
    rates = fx.select(F.col("datadate").alias(date), F.col("curcdd").alias(curr), "fx")
    out = df.join(rates, [date, curr], "left").withColumns({c: F.col(c) * F.col("fx") for c in cols})
    if not keep_fx:
        out = out.withColumn(curr, F.lit("USD")).drop("fx")
    return out


def crsp_links(
    prices: DataFrame, names: DataFrame, links: DataFrame, key: str, date: str, types: tuple[str, ...]
) -> DataFrame:
    """Names valid on the date, then links of the wanted types valid on the date (open bounds allowed)."""
    named = interval_join(prices, names, key, date, "namestart", "nameend")
    wanted = links.filter(F.col("linktype").isin(list(types)))
    return interval_join(named, wanted, key, date, "linkstart", "linkend")


def lookup(df: DataFrame, dim: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    return df.join(dim, keys, how)


def between_open(d: Column, lo: Column, hi: Column) -> Column:
    """lo <= d <= hi with NULL bounds open."""
    return (lo.isNull() | (d >= lo)) & (hi.isNull() | (d <= hi))
