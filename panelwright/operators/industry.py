"""Industry classes from code ranges, first match wins.

Ranges handed in as data may overlap; priorities decide. :func:`sweep` turns them into disjoint stretches of codes by
walking over the ends of the ranges, and rows are answered by stretch. Codes have four digits, so there are at most
10,000 stretches however many ranges are given.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The 38 industry classes as inclusive code ranges, in order.
SIC38: list[tuple[int, list[tuple[int, int]]]] = [
    (g, [r])
    for g, r in enumerate(
        [
            (100, 999), (1000, 1299), (1300, 1399), (1400, 1499), (1500, 1799), (2000, 2099),
            (2100, 2199), (2200, 2299), (2300, 2399), (2400, 2499), (2500, 2599), (2600, 2661),
            (2700, 2799), (2800, 2899), (2900, 2999), (3000, 3099), (3100, 3199), (3200, 3299),
            (3300, 3399), (3400, 3499), (3500, 3599), (3600, 3699), (3700, 3799), (3800, 3879),
            (3900, 3999), (4000, 4799), (4800, 4829), (4830, 4899), (4900, 4949), (4950, 4959),
            (4960, 4969), (4970, 4979), (5000, 5199), (5200, 5999), (6000, 6999), (7000, 8999),
            (9000, 9999),
        ],
        start=1,
    )
]


def classify(df: DataFrame, code: str, classes, out: str) -> DataFrame:
    """Class number from an ordered list of (class, ranges); NULL outside all ranges."""
    label = None
    for number, ranges in classes:
        hit = reduce(lambda a, b: a | b, [F.col(code).between(lo, hi) for lo, hi in ranges])
        label = F.when(hit, number) if label is None else label.when(hit, number)
    return df.withColumn(out, label)


FIRST_CODE, LAST_CODE = 0, 9999
BLOCK = 128


def sweep(ranges: DataFrame) -> DataFrame:
    """Range table (grp, priority, lo, hi) to all stretches between range ends that some range covers:
    (lo, hi, grp, n_classes), where ``grp`` is the class of lowest priority (ties: the smallest class) and ``n_classes``
    how many different classes claim the stretch.

    Ranges are cut to the four-digit codes; those with a missing end or class, or with lo > hi, count for nothing.
    A range is sent to the stretches it covers by their numbers, found by equi joins on its two ends.
    """
    cut = (
        ranges.filter("grp IS NOT NULL AND lo <= hi").select(
            "grp", "priority",
            F.greatest(F.col("lo").cast("int"), F.lit(FIRST_CODE)).alias("lo"),
            (F.least(F.col("hi").cast("int"), F.lit(LAST_CODE)) + 1).alias("after"),
        )
        .filter("lo < after")
        .distinct()
    )
    # at most 10,001 ends, whatever the number of ranges
    order = Window.partitionBy(F.lit(0)).orderBy("at")
    ends = cut.select(F.explode(F.array("lo", "after")).alias("at")).distinct()
    ends = ends.select("at", F.row_number().over(order).alias("n"), F.lead("at").over(order).alias("next"))
    found = cut.join(ends.select(F.col("at").alias("lo"), F.col("n").alias("first")), "lo").join(
        ends.select(F.col("at").alias("after"), F.col("n").alias("behind")), "after"
    )
    claims = found.select("grp", "priority", F.explode(F.sequence("first", F.col("behind") - 1)).alias("n"))
    won = claims.groupBy("n").agg(
        F.min_by("grp", F.struct(F.col("priority").isNull(), "priority", "grp")).alias("grp"), F.count_distinct("grp").cast("int").alias("n_classes")
    )
    return won.join(ends, "n").select(F.col("at").alias("lo"), (F.col("next") - 1).alias("hi"), "grp", "n_classes")


def disjoint_ranges(ranges: DataFrame) -> DataFrame:
    """Disjoint ranges (lo, hi, grp) with the same answers: neighbouring stretches of one class are one range."""
    order = Window.partitionBy(F.lit(0)).orderBy("lo")  # at most 10,000 stretches
    new = ~(F.lag("grp").over(order).eqNullSafe(F.col("grp")) & (F.lag("hi").over(order) + 1 == F.col("lo")))
    run = F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    flagged = sweep(ranges).withColumn("run__", run)
    return flagged.groupBy("run__").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("grp").alias("grp")).drop("run__")


def gaps(ranges: DataFrame, first: int = FIRST_CODE, last: int = LAST_CODE) -> DataFrame:
    """Stretches (lo, hi) of first .. last that no range covers."""
    order = Window.partitionBy(F.lit(0)).orderBy("lo")  # at most 10,000 ranges and the end mark
    end = ranges.sparkSession.range(1).select(F.lit(last + 1).alias("lo"), F.lit(last).alias("hi"))
    marks = disjoint_ranges(ranges).filter((F.col("hi") >= first) & (F.col("lo") <= last)).select("lo", "hi").unionByName(end)
    behind = F.coalesce(F.lag("hi").over(order) + 1, F.lit(first))
    return marks.select(behind.alias("lo"), (F.col("lo") - 1).alias("hi")).filter("lo <= hi")


def classify_by_table(df: DataFrame, code: str, ranges: DataFrame, out: str) -> DataFrame:
    """Class from a range table supplied as data; NULL for a missing code and outside all ranges.

    Each disjoint range is listed under the blocks of 128 codes it touches, and rows meet the ranges of their block;
    a code lies in one range at most, so no row is doubled. The range side is broadcast: at most 10,000 ranges and
    79 blocks more. A code that owns a third of the rows therefore moves nothing.
    """
    block = lambda c: F.floor(c / F.lit(BLOCK)).cast("int")
    listed = disjoint_ranges(ranges).select(
        F.col("lo").alias("lo__"), F.col("hi").alias("hi__"), F.col("grp").alias(out), F.explode(F.sequence(block(F.col("lo")), block(F.col("hi")))).alias("block__")
    )
    rows = df.drop(out)
    inside = (block(rows[code]) == listed["block__"]) & rows[code].between(listed["lo__"], listed["hi__"])
    return rows.join(F.broadcast(listed), inside, "left").select(*[rows[c] for c in rows.columns], listed[out])


def read_class_file(spark, path: str) -> DataFrame:
    """Range table (grp, priority, lo, hi) from the published plain-text class definitions.

    A line that starts with a number and a name opens a class; an indented ``lo-hi`` line adds a range to it. Ranges are
    numbered in the order of the file, which is their priority; lines before the first class count for nothing.
    """
    text = spark.read.text(path, wholetext=True)
    opening, span = r"(?m)^ {0,2}(\d{1,2})[ \t]+[A-Za-z]", r"(?m)^[ \t]+(\d{4}-\d{4})"
    classes = text.select(F.posexplode(F.split("value", r"(?m)^(?= {0,2}\d{1,2}[ \t]+[A-Za-z])")).alias("at", "part"))
    spans = classes.select(
        F.regexp_extract("part", opening, 1).alias("number"), "at", F.posexplode(F.regexp_extract_all("part", F.lit(span), F.lit(1))).alias("line", "span")
    ).filter("number <> ''")
    end = lambda i: F.split("span", "-").getItem(i).cast("int")
    priority = F.col("at") * (LAST_CODE + 1) + F.col("line")
    return spans.select(F.col("number").cast("int").alias("grp"), priority.alias("priority"), end(0).alias("lo"), end(1).alias("hi"))
