"""Joins in time (as-of joins with a group that holds a third of all rows, intervals of many years); regressions by group."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, joins, ols
from .base_sql import with_
from .registry import query

# one group holds a third of the customers
GRP = "CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END"
SIDES = f"""lt AS (SELECT o_orderkey, {GRP} AS grp, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus <> 'F'),
rt AS (SELECT grp, day, (max(struct_pack(p := o_totalprice, k := o_orderkey))) AS m FROM (SELECT *, {GRP} AS grp, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'F') GROUP BY 1, 2)"""


def _sides(t):
    key = F.when(F.col("o_custkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("o_custkey")).alias("grp")
    day = F.to_date("o_orderdate").alias("day")
    done = F.col("o_orderstatus") == "F"
    return t.orders.filter(~done).select("o_orderkey", key, day), t.orders.filter(done).select(key, day, F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("ref"))


@query(
    "asof_join",
    with_(SIDES) + "SELECT o_orderkey, grp, lt.day, rt.day AS day_right, m.p AS price, m.k AS ref FROM lt ASOF LEFT JOIN rt USING (grp, day)",
)
def _backward(t):
    left, right = _sides(t)
    return asof.asof_join(left, right, ["grp"], "day")


@query(
    "asof_join_forward",
    with_(SIDES)
    + """SELECT o_orderkey, l.day, CASE WHEN r.day - l.day <= 20 THEN r.day END AS day_right, CASE WHEN r.day - l.day <= 20 THEN m.p END AS price,
CASE WHEN r.day - l.day <= 20 THEN m.k END AS ref FROM lt l ASOF LEFT JOIN rt r ON l.grp = r.grp AND l.day < r.day""",
)
def _forward(t):
    left, right = _sides(t)
    return asof.asof_join(left, right, ["grp"], "day", "forward", tolerance=20, exact=False).drop("grp")


@query(
    "asof_join_nearest",
    with_(SIDES)
    + """SELECT o_orderkey, l.day, CASE WHEN a.day IS NULL OR b.day - l.day < l.day - a.day THEN b.day ELSE a.day END AS day_right,
CASE WHEN a.day IS NULL OR b.day - l.day < l.day - a.day THEN b.m.p ELSE a.m.p END AS price
FROM lt l ASOF LEFT JOIN rt a ON l.grp = a.grp AND l.day >= a.day ASOF LEFT JOIN rt b ON l.grp = b.grp AND l.day <= b.day""",
)
def _nearest(t):
    left, right = _sides(t)
    return asof.asof_join(left, right, ["grp"], "day", "nearest").drop("grp", "ref")


@query(
    "interval_join_decades",
    """WITH hist AS (SELECT c_custkey AS k, 'open' AS code, CAST(NULL AS DATE) AS a, CAST(NULL AS DATE) AS b FROM customer
UNION ALL SELECT c_custkey, 'old', DATE '1950-01-15' + CAST(c_custkey % 9000 AS INT), DATE '1994-03-03' + CAST(c_custkey % 1500 AS INT) FROM customer),
pt AS (SELECT o_orderkey, o_custkey AS k, CAST(o_orderdate AS DATE) + CAST((o_orderkey % 5 - 2) * 7000 AS INT) AS day FROM orders)
SELECT o_orderkey, k, day, code FROM pt JOIN hist USING (k) WHERE (a IS NULL OR day >= a) AND (b IS NULL OR day <= b)""",
)
def _decades(t):
    k = F.col("c_custkey")
    none = F.lit(None).cast("date")
    day = lambda s, n: F.date_add(F.lit(s).cast("date"), (k % n).cast("int"))
    hist = t.customer.select(k.alias("k"), F.lit("open").alias("code"), none.alias("a"), none.alias("b")).unionByName(
        t.customer.select(k.alias("k"), F.lit("old").alias("code"), day("1950-01-15", 9000).alias("a"), day("1994-03-03", 1500).alias("b"))
    )
    shift = ((F.col("o_orderkey") % 5 - 2) * 7000).cast("int")
    points = t.orders.select("o_orderkey", F.col("o_custkey").alias("k"), F.date_add(F.to_date("o_orderdate"), shift).alias("day"))
    return joins.interval_join(points, hist, "k", "day", "a", "b", how="inner").drop("a", "b")


OLS_ROWS = "ol AS (SELECT l_suppkey AS k, l_extendedprice AS y, l_quantity AS a, CASE WHEN l_suppkey % 2 = 1 THEN 2 * l_quantity ELSE 100 * l_discount END AS b FROM lineitem)"


@query(
    "grouped_ols_dependent",
    with_(
        OLS_ROWS,
        "m AS (SELECT k, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb, var_pop(y) AS yy, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb FROM ol GROUP BY k)",
        "s AS (SELECT *, CASE WHEN k % 2 = 1 THEN ay / aa ELSE (ay * bb - yb * ab) / (aa * bb - ab * ab) END AS b_a, CASE WHEN k % 2 = 0 THEN (yb * aa - ay * ab) / (aa * bb - ab * ab) END AS b_b FROM m)",
    )
    + """SELECT k, n, my - b_a * ma - coalesce(b_b, 0) * mb AS intercept, b_a, b_b, sqrt(n * (yy - b_a * ay - coalesce(b_b, 0) * yb) / (n - CASE WHEN k % 2 = 1 THEN 2 ELSE 3 END)) AS resid_sd,
CASE WHEN k % 2 = 1 THEN 'b' ELSE '' END AS dropped FROM s""",
    "intercept:4 b_a:5 b_b:5 resid_sd:4",
)
def _dependent(t):
    odd = F.col("l_suppkey") % 2 == 1
    df = t.lineitem.select(
        F.col("l_suppkey").alias("k"), F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("a"), F.when(odd, 2 * F.col("l_quantity")).otherwise(100 * F.col("l_discount")).alias("b")
    )
    return ols.grouped_ols(df, ["k"], "y", ["a", "b"], drop=True).drop("resid_skew").withColumn("dropped", F.array_join("dropped", ","))
