"""Mixing sources to target weights by subset-sum budget fitting.

Each source has a budget of words, fitted with whole documents by their exact lengths: the lengths of a source are
counted, as often as documents must repeat to fill the budget; all but a small reserve of it is spent in
proportion over the lengths, and bounded-knapsack dynamic programming over the remaining counts fits the reserve,
word for word where the lengths allow (where they do not, documents may repeat once more). How many documents of
a length are taken is settled by these counts; which ones are taken once more than the others, by a seeded hash.

Rows with equal doc_id, source and size are alike in all that is returned; they are folded into one with a count
and unfolded at the end, so that a group of copies is never ranked row by row. Documents of one source and
length are ranked inside 65,536 slots of their hash. Sources are ranked in a distributed sort. What one task holds
of a source is a number per distinct length, which grows with the longest document, not with the number of rows.

A null text has no words and is returned with nothing taken; a null source is a source of its own, the last one.
A null doc_id takes part like any other. Texts of any length are counted whole. An empty table gives no rows. Columns
other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MOST = 3
#: Words of a budget that are left to the dynamic programming.
RESERVE = 1 << 13
COPIES = 1 << 12
TAKE = "source_key string, size long, all_of long, some_of long, source_size long, target double"
TAKE_T = pa.schema([("source_key", pa.string()), *((c, pa.int64()) for c in ("size", "all_of", "some_of", "source_size")), ("target", pa.float64())])


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, source_key, size, copies): words of whole texts, equal rows folded. The key is never null and
    sorts a missing source last."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    source = F.col("source").cast("string")
    key = F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), source))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), key.alias("source_key"), size.alias("size"))
    return rows.groupBy("doc_id", "source", "source_key", "size").agg(F.count(F.lit(1)).alias("copies"))


def ranked(df: DataFrame, order: str) -> DataFrame:
    """Adds ``rank`` from 0 in the order of a column, without one task for all rows: sorted and written, then
    counted by written partition."""
    low = (1 << 33) - 1
    rows = stage(df.orderBy(order).withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33)
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("c"))
    counts = counts.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before"))  # a row for each partition
    return rows.withColumn("part", part).join(counts, "part").withColumn("rank", F.col("before") + F.col("at").bitwiseAND(low)).drop("part", "before", "at")


def targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``weight`` and ``target`` to (source_key, source_size): shares of all words by weights, which repeat in the
    order of sources. A target stops at ``most`` times its source; what is cut off goes to the others by weight,
    until none is above."""
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = ranked(totals, "source_key").withColumn("weight", F.element_at(table, (F.col("rank") % len(weights) + 1).cast("int"))).drop("rank")
    rows = stage(rows.withColumn("cap", most * F.col("source_size").cast("double")), "weights")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while True:  # numbers only: the share of a unit of weight grows, and each turn stops more sources
        above = F.col("weight") * share >= F.col("cap")
        n, spent, weight = rows.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if n == capped or not weight:
            break
        capped, share = n, max(share, (total - spent) / weight)
    return rows.withColumn("target", F.least(F.col("weight") * share, "cap")).drop("cap")


def fit_lengths(size: np.ndarray, count: np.ndarray, budget: int, reserve: int = RESERVE) -> np.ndarray:
    """How many of each length to take so that their words come nearest to ``budget``."""
    order = np.argsort(-size, kind="stable")
    length, left = size[order].astype(object), count[order].astype(object)
    took = [0] * len(length)
    spend, words, total = max(0, budget - reserve), 0, sum(a * b for a, b in zip(length, left))
    due = done = 0
    for i, (a, n) in enumerate(zip(length, left)):  # longest first: what rounding leaves is carried to shorter ones
        due += spend * a * n
        if a:
            took[i] = min(n, max(0, (due - done * total) // (a * total)))
            done += took[i] * a
    words = done
    rest = budget - words
    if rest > 0:
        picks = knapsack([(a, n - took[i], i) for i, (a, n) in enumerate(zip(length, left)) if a and n > took[i]], rest)
        for i, n in picks.items():
            took[i] += n
    out = np.zeros(len(size), np.int64)
    out[order] = took
    return out


def knapsack(items: list[tuple[int, int, int]], rest: int) -> dict[int, int]:
    """Bounded knapsack over (length, count, name): counts by name whose words come nearest to ``rest``, below it
    if as near. Bits of a number are the sums that can be reached; it stops at the first exact one."""
    most = 2 * rest  # beyond that, nothing at all is nearer
    mask = (1 << (most + 1)) - 1
    reach, steps = 1, []
    for a, n, i in items:
        if a > most:
            continue
        piece, n = 1, min(n, most // a)
        while n > 0:
            m = min(piece, n)
            steps.append((a * m, m, i, reach))
            reach |= (reach << (a * m)) & mask
            n -= m
            piece *= 2
        if reach >> rest & 1:
            break
    below = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    upper = reach >> (rest + 1)
    above = rest + (upper & -upper).bit_length() if upper else None
    at = below if above is None or rest - below <= above - rest else above
    out: dict[int, int] = {}
    for words, m, i, before in reversed(steps):
        if not before >> at & 1:
            out[i] = out.get(i, 0) + m
            at -= words
    return out


def plan_lengths(rows: DataFrame, goals: DataFrame, most: int = MOST, reserve: int = RESERVE) -> DataFrame:
    """(source_key, size, all_of, some_of): how often all documents of a length are taken, and how many once more."""
    lengths = rows.groupBy("source_key", "size").agg(F.sum("copies").alias("n"))
    lengths = lengths.join(goals.select("source_key", "source_size", "target"), "source_key")

    def fit(group: pa.Table) -> pa.Table:
        words, target = group.column("source_size")[0].as_py(), group.column("target")[0].as_py()
        size, n = (group.column(c).to_numpy() for c in ("size", "n"))
        took, gap = np.zeros(len(size), np.int64), round(target)
        for times in range(max(1, -(-gap // words)), most + 1) if words else ():
            again = fit_lengths(size, n * times, round(target), reserve)
            if abs(again @ size - round(target)) < gap:
                took, gap = again, abs(again @ size - round(target))
            if not gap:
                break  # else lengths too coarse: let documents repeat once more
        cols = [group.column("source_key"), group.column("size"), took // n, took % n]
        return pa.table([*cols, group.column("source_size"), group.column("target")], schema=TAKE_T)

    return lengths.groupBy("source_key").applyInArrow(fit, TAKE)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = 0, reserve: int = RESERVE) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for each document."""
    rows = stage(sizes(docs), "sizes")
    totals = rows.groupBy("source_key").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    goals = stage(targets(totals, weights, most), "targets")
    take = stage(plan_lengths(rows, goals, most, reserve), "lengths")

    hashed = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "source_key", "size")).withColumn("slot", F.shiftright("h", 48))
    slots = hashed.groupBy("source_key", "size", "slot").agg(F.sum("copies").alias("n")).join(take, ["source_key", "size"])
    before = F.sum("n").over(Window.partitionBy("source_key", "size").orderBy("slot")) - F.col("n")
    here = F.greatest(F.lit(0), F.least(F.col("n"), F.col("some_of") - before))
    slots = slots.select("source_key", "size", "slot", "all_of", "source_size", "target", here.alias("here"))
    earlier = F.sum("copies").over(Window.partitionBy("source_key", "size", "slot").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    more = F.greatest(F.lit(0), F.least(F.col("copies"), F.col("here") - F.coalesce(earlier, F.lit(0))))
    chosen = stage(hashed.join(slots, ["source_key", "size", "slot"]).withColumn("more", more).drop("h", "slot", "here"), "chosen")

    # unfold equal rows, large groups in chunks
    one = chosen.where("copies = 1").withColumn("more", F.col("more") > 0)
    several = chosen.where("copies > 1").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))))
    several = several.repartition("source_key", "doc_id", "size", "chunk").withColumn("i", F.explode(F.sequence(F.col("chunk") * COPIES, F.least(F.col("copies"), (F.col("chunk") + 1) * COPIES) - 1)))
    several = several.withColumn("more", F.col("i") < F.col("more")).drop("chunk", "i")
    taken = F.col("size") * (F.col("all_of") + F.col("more").cast("long"))
    return one.unionByName(several).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
