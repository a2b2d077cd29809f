"""Sources, sinks, joins, unions, row selection, expansion and gap filling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.nulls import div
from ..operators import expand, joins, rows
from ..sources import adapters, readers, scratch, sinks
from .base_sql import FXQ, INTERVALS, accounts, dense, sd, sm, with_
from .registry import query

DATE = lambda s: F.lit(s).cast("date")


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 25")
def _scan(t):
    df = readers.scan_parquet(t.spark, f"{t.root}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])
    return df.filter(F.col("l_quantity") > 25)


@query("scan_sql_source", "SELECT p_partkey, TRY_CAST(p_name AS DOUBLE) AS p_name, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand FROM part")
def _scan_sql(t):
    df = t.part.select("p_partkey", "p_name", F.substring("p_brand", 7, 10).alias("brand"))
    return readers.typed_projection(df, {"p_name": "double", "brand": "int"})


@query("scan_csv_lookup", "SELECT n_name AS excntry, n_regionkey AS cls FROM nation")
def _scan_csv(t):
    path = scratch.scratch_path(t.spark, "lookup")
    t.nation.select(F.col("n_name").alias("excntry"), F.col("n_regionkey").alias("cls")).write.csv(path, header=True)
    return readers.scan_lookup(t.spark, path, "excntry string, cls int")


@query("distinct_lookup", "SELECT DISTINCT l_partkey AS part, l_suppkey AS supp FROM lineitem WHERE l_returnflag = 'R'")
def _distinct(t):
    return rows.distinct_lookup(t.lineitem, {"l_partkey": "part", "l_suppkey": "supp"}, F.col("l_returnflag") == "R")


@query(
    "key_value_history_split",
    """SELECT o_custkey, CAST(o_orderdate AS DATE) AS effdate,
  max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus END) AS urgent,
  max(CASE WHEN o_orderpriority = '5-LOW' THEN o_orderstatus END) AS low
FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1, 2""",
)
def _kv(t):
    df = t.orders.withColumn("effdate", F.to_date("o_orderdate"))
    return rows.pivot_history(
        df, ["o_custkey", "effdate"], "o_orderpriority", "o_orderstatus", {"1-URGENT": "urgent", "5-LOW": "low"}
    )


@query(
    "index_series_extract",
    """SELECT indno, eom, v, name FROM (SELECT l_linenumber AS indno, last_day(CAST(l_shipdate AS DATE)) AS eom, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)
JOIN (SELECT DISTINCT l_linenumber AS indno, 'series ' || l_linenumber AS name FROM lineitem) USING (indno) WHERE indno = 3""",
)
def _index(t):
    li = t.lineitem.select(F.col("l_linenumber").alias("indno"), F.last_day(F.to_date("l_shipdate")).alias("eom"), "l_quantity")
    data = li.groupBy("indno", "eom").agg(F.sum("l_quantity").alias("v"))
    header = li.select("indno").distinct().withColumn("name", F.concat(F.lit("series "), F.col("indno").cast("string")))
    return rows.index_series(data, header, "indno", 3).select("indno", "eom", "v", "name")


def _back(t, df, write):
    path = scratch.scratch_path(t.spark, "sink")
    write(df, path)
    return t.spark.read.parquet(path)


@query("write_parquet", with_(sm()) + "SELECT id, eom, me FROM sm")
def _write(t):
    return _back(t, adapters.security_month(t).select("id", "eom", "me"), sinks.write_parquet)


@query("write_partitioned", with_(sm()) + "SELECT id, eom, me, excntry FROM sm")
def _write_part(t):
    df = adapters.security_month(t).select("id", "eom", "me", "excntry")
    return _back(t, df, lambda d, p: sinks.write_partitioned(d, p, "excntry", ["id", "eom"]))


@query("write_by_region", with_(sm("supplier", "nation")) + "SELECT id, eom, me, excntry, CASE WHEN source_crsp = 1 THEN 'home' ELSE 'abroad' END AS region FROM sm")
def _write_region(t):
    df = adapters.security_month(t, "supplier", "nation").select(
        "id", "eom", "me", "excntry", F.when(F.col("source_crsp") == 1, "home").otherwise("abroad").alias("region")
    )
    return _back(t, df, lambda d, p: sinks.write_partitioned(d, p, "region"))


@query(
    "final_filter_export",
    with_(sm("part"))
    + """SELECT id, eom, me, me_lag1 FROM (SELECT *, CASE WHEN midx - lag(midx) OVER w = 1 THEN lag(me) OVER w END AS me_lag1
  FROM sm WINDOW w AS (PARTITION BY id ORDER BY eom))
WHERE common = 1 AND primary_sec = 1 AND obs_main = 1 AND exch_main = 1 AND eom <= DATE '2000-12-31'""",
)
def _final(t):
    return sinks.final_filter(adapters.security_month(t, "part"), DATE("2000-12-31")).select("id", "eom", "me", "me_lag1")


@query(
    "export_projection",
    with_(sm()) + "SELECT id, eom, coalesce(CASE WHEN id % 6 <> 0 THEN excntry END, 'null_country') AS excntry, ret FROM sm WHERE ret IS NOT NULL",
    "ret",
)
def _export(t):
    df = adapters.security_month(t).withColumn("excntry", F.when(F.col("id") % 6 != 0, F.col("excntry")))
    return sinks.export_projection(df, ["id", "eom", "excntry", "ret"], "ret", "excntry")


@query("date_capped_export", with_(sm()) + "SELECT id, eom, me FROM sm WHERE eom <= DATE '1998-12-31'")
def _capped(t):
    return sinks.date_capped(adapters.security_month(t), "eom", DATE("1998-12-31")).select("id", "eom", "me")


AGG3 = "a AS (SELECT excntry, eom, count(*) AS n FROM sm GROUP BY 1, 2), b AS (SELECT excntry, eom, max(me) AS top FROM sm WHERE id % 2 = 0 GROUP BY 1, 2), c AS (SELECT excntry, eom, min(me) AS low FROM sm WHERE id % 3 = 0 GROUP BY 1, 2)"


def _agg3(t):
    df = adapters.security_month(t)
    k = ["excntry", "eom"]
    return (
        df,
        df.groupBy(*k).agg(F.count(F.lit(1)).alias("n")),
        df.filter(F.col("id") % 2 == 0).groupBy(*k).agg(F.max("me").alias("top")),
        df.filter(F.col("id") % 3 == 0).groupBy(*k).agg(F.min("me").alias("low")),
    )


@query("equi_left_join", with_(sm(), AGG3) + "SELECT id, eom, me, n, top, low FROM sm LEFT JOIN a USING (excntry, eom) LEFT JOIN b USING (excntry, eom) LEFT JOIN c USING (excntry, eom)")
def _left(t):
    df, a, b, c = _agg3(t)
    return joins.enrich(df, [a, b, c], ["excntry", "eom"]).select("id", "eom", "me", "n", "top", "low")


@query("equi_inner_join", with_(sm(), AGG3) + "SELECT id, eom, n, low FROM sm JOIN a USING (excntry, eom) JOIN c USING (excntry, eom)")
def _inner(t):
    df, a, _, c = _agg3(t)
    return joins.enrich(df, [a, c], ["excntry", "eom"], "inner").select("id", "eom", "n", "low")


@query("full_outer_coalesce_join", with_(sm(), AGG3) + "SELECT excntry, eom, n, top, low FROM a FULL JOIN b USING (excntry, eom) FULL JOIN c USING (excntry, eom)")
def _full(t):
    _, a, b, c = _agg3(t)
    return joins.merge_metrics([a, b, c], ["excntry", "eom"])


POINTS = "pt AS (SELECT o_orderkey, o_custkey AS custkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INT) - 50 AS date FROM orders)"


def _points(t):
    shift = (F.col("o_orderkey") % 200 - 50).cast("int")
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"), F.date_add(F.to_date("o_orderdate"), shift).alias("date"))


@query(
    "interval_join",
    with_(INTERVALS, POINTS)
    + "SELECT o_orderkey, custkey, date, code FROM pt LEFT JOIN iv USING (custkey) WHERE FALSE UNION ALL SELECT o_orderkey, pt.custkey, date, code FROM pt LEFT JOIN iv ON pt.custkey = iv.custkey AND date >= from_date AND (thru_date IS NULL OR date <= thru_date)",
)
def _interval(t):
    out = joins.interval_join(_points(t), adapters.validity_intervals(t), "custkey", "date", "from_date", "thru_date")
    return out.select("o_orderkey", "custkey", "date", "code")


@query(
    "interval_join_links",
    with_(
        INTERVALS,
        POINTS,
        "lk AS (SELECT custkey, CASE WHEN custkey % 4 <> 0 THEN from_date END AS linkstart, thru_date AS linkend, CASE WHEN custkey % 3 = 0 THEN 'LX' ELSE 'LC' END AS linktype FROM iv)",
    )
    + """SELECT o_orderkey, date, code, linktype FROM pt
LEFT JOIN iv ON pt.custkey = iv.custkey AND date BETWEEN iv.from_date AND coalesce(iv.thru_date, DATE '9999-12-31')
LEFT JOIN lk ON pt.custkey = lk.custkey AND (linkstart IS NULL OR date >= linkstart) AND (linkend IS NULL OR date <= linkend) AND linktype IN ('LC', 'LU', 'LS')""",
)
def _links(t):
    iv = adapters.validity_intervals(t)
    names = iv.withColumnsRenamed({"from_date": "namestart", "thru_date": "nameend"})
    c = F.col("custkey")
    links = iv.select(
        "custkey",
        F.when(c % 4 != 0, F.col("from_date")).alias("linkstart"),
        F.col("thru_date").alias("linkend"),
        F.when(c % 3 == 0, "LX").otherwise("LC").alias("linktype"),
    )
    return joins.crsp_links(_points(t), names, links, "custkey", "date", ("LC", "LU", "LS")).select("o_orderkey", "date", "code", "linktype")


PRI = """g AS (SELECT gvkey, min(eom) AS lo, max(eom) AS hi FROM sm GROUP BY 1),
h1 AS (SELECT gvkey, '01' AS prihistrow, lo AS effdate, CASE WHEN CAST(gvkey AS BIGINT) % 2 = 0 THEN lo + 700 END AS thrudate FROM g WHERE CAST(gvkey AS BIGINT) % 3 <> 0),
h2 AS (SELECT gvkey, '02W' AS prihistusa, lo + 400 AS effdate, lo + 900 AS thrudate FROM g WHERE CAST(gvkey AS BIGINT) % 4 = 1),
h3 AS (SELECT gvkey, '02' AS prihistcan, lo + 1000 AS effdate, CAST(NULL AS DATE) AS thrudate FROM g WHERE CAST(gvkey AS BIGINT) % 5 = 2),
hd AS (SELECT gvkey, '02' AS prirow, '01W' AS priusa, CASE WHEN CAST(gvkey AS BIGINT) % 7 = 3 THEN '01' END AS prican FROM g)"""


@query(
    "primary_flag_join",
    with_(sm(), PRI)
    + """SELECT id, eom, CAST(coalesce(iid = coalesce(prihistrow, prirow), FALSE) OR coalesce(iid = coalesce(prihistusa, priusa), FALSE)
  OR coalesce(iid = coalesce(prihistcan, prican), FALSE) AS INT) AS primary_sec
FROM sm s LEFT JOIN h1 ON s.gvkey = h1.gvkey AND eom BETWEEN h1.effdate AND coalesce(h1.thrudate, DATE '2262-04-11')
LEFT JOIN h2 ON s.gvkey = h2.gvkey AND eom BETWEEN h2.effdate AND coalesce(h2.thrudate, DATE '2262-04-11')
LEFT JOIN h3 ON s.gvkey = h3.gvkey AND eom BETWEEN h3.effdate AND coalesce(h3.thrudate, DATE '2262-04-11')
LEFT JOIN hd ON s.gvkey = hd.gvkey""",
)
def _primary(t):
    df = adapters.security_month(t).select("id", "gvkey", "iid", "eom")
    g = df.groupBy("gvkey").agg(F.min("eom").alias("lo"))
    k = F.col("gvkey").cast("long")
    nul = F.lit(None).cast("date")
    plus = lambda d: F.date_add("lo", d)
    h = {
        "prihistrow": g.filter(k % 3 != 0).select("gvkey", F.lit("01").alias("prihistrow"), F.col("lo").alias("effdate"), F.when(k % 2 == 0, plus(700)).alias("thrudate")),
        "prihistusa": g.filter(k % 4 == 1).select("gvkey", F.lit("02W").alias("prihistusa"), plus(400).alias("effdate"), plus(900).alias("thrudate")),
        "prihistcan": g.filter(k % 5 == 2).select("gvkey", F.lit("02").alias("prihistcan"), plus(1000).alias("effdate"), nul.alias("thrudate")),
    }
    head = g.select("gvkey", F.lit("02").alias("prihistrow"), F.lit("01W").alias("prihistusa"), F.when(k % 7 == 3, "01").alias("prihistcan"))
    return joins.primary_flag(df, h, head, "gvkey", "iid", "eom", ["id", "eom"]).select("id", "eom", "primary_sec")


CROSS = "fx1 AS (SELECT DISTINCT a.tocurd AS curcdd, a.datadate, b.exratd / a.exratd AS fx FROM fxq a JOIN fxq b USING (fromcurd, datadate) WHERE b.tocurd = 'USD')"


@query("self_join_cross_rate", with_(FXQ, CROSS) + "SELECT * FROM fx1", "fx")
def _cross(t):
    return joins.cross_rate(adapters.fx_quotes(t))


FXD = """fxs AS (SELECT curcdd, datadate, max(fx) AS fx FROM (SELECT * FROM fx1 UNION ALL SELECT 'USD', DATE '1950-01-01', 1.0) GROUP BY 1, 2),
fxl AS (SELECT *, coalesce(lead(datadate) OVER (PARTITION BY curcdd ORDER BY datadate) - 1, datadate) AS last FROM fxs),
fxd AS (SELECT curcdd, CAST(unnest(generate_series(datadate, last, INTERVAL 1 DAY)) AS DATE) AS datadate, fx FROM fxl)"""


@query("fx_daily_fill", with_(FXQ, CROSS, FXD) + "SELECT curcdd, datadate, fx FROM fxd", "fx")
def _fxd(t):
    return expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t)))


@query(
    "fx_convert",
    with_(accounts(), FXQ, CROSS, FXD)
    + """SELECT gvkey, a.datadate, 'USD' AS curcd, gp * fx AS gp, che * fx AS che FROM acc a LEFT JOIN fxd ON a.datadate = fxd.datadate AND a.curcd = fxd.curcdd""",
    "gp:5 che:5",
)
def _fxc(t):
    fx = expand.fx_daily(joins.cross_rate(adapters.fx_quotes(t)))
    acc = adapters.firm_accounting(t).select("gvkey", "curcd", "datadate", "gp", "che")
    return joins.fx_convert(acc, fx, ["gp", "che"], "datadate", "curcd")


COHORT = """SELECT b.gvkey, b.curcd, c.datadate AS calc_date, count(*) AS n FROM acc b
JOIN (SELECT DISTINCT datadate FROM acc) c ON b.datadate > make_date(year(c.datadate) - 3, 12, 31) AND b.datadate <= c.datadate AND month(b.datadate) = month(c.datadate)
GROUP BY ALL"""


@query("calendar_theta_join", with_(accounts("quarterly")) + COHORT)
def _theta(t):
    from ..operators import accounting

    acc = adapters.firm_accounting(t, "quarterly").select("gvkey", "curcd", "datadate")
    return accounting.annual_cohorts(acc, "datadate", 3).groupBy("gvkey", "curcd", "calc_date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "lateral_generate_join",
    with_(sm()) + "SELECT id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT id, min(eom) AS lo, max(eom) AS hi FROM sm GROUP BY 1)",
)
def _lateral(t):
    g = adapters.security_month(t).groupBy("id").agg(F.min("eom").alias("lo"), F.max("eom").alias("hi"))
    return g.select("id", F.explode(dates.days_or_empty(F.col("lo"), F.col("hi"))).alias("day"))


# ---- unions and row selection ---------------------------------------------------------------
LEFT_ROWS = "SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS q FROM lineitem WHERE l_linenumber <= 4"
RIGHT_ROWS = "SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS q FROM lineitem WHERE l_linenumber >= 3"


def _halves(t):
    b = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"))
    return b.filter("n <= 4"), b.filter("n >= 3")


@query("union_relaxed", f"SELECT k, CAST(n AS DOUBLE) AS n, q FROM ({LEFT_ROWS}) UNION ALL SELECT k, n + 0.5, q FROM ({RIGHT_ROWS})", "n:1")
def _union(t):
    a, b = _halves(t)
    return rows.union_relaxed(a, b.withColumn("n", F.col("n") + F.lit(0.5)))


@query("union_diagonal", f"SELECT k, n, q, NULL AS extra FROM ({LEFT_ROWS}) UNION ALL SELECT k, n, NULL, k * 2 FROM ({RIGHT_ROWS})")
def _diag(t):
    a, b = _halves(t)
    return rows.union_diagonal(a, b.drop("q").withColumn("extra", F.col("k") * 2))


@query("union_all", f"{LEFT_ROWS} UNION ALL {RIGHT_ROWS}")
def _union_all(t):
    a, b = _halves(t)
    return a.union(b)


@query("union_distinct", f"{LEFT_ROWS} UNION {RIGHT_ROWS}")
def _union_distinct(t):
    a, b = _halves(t)
    return a.union(b).distinct()


@query("full_join_all_columns", f"SELECT DISTINCT k, n, q FROM (SELECT * FROM ({LEFT_ROWS}) FULL JOIN ({RIGHT_ROWS}) USING (k, n, q))")
def _full_all(t):
    a, b = _halves(t)
    return a.unionByName(b).distinct()


@query("distinct_on_keep_first", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderdate::DATE AS d, o_orderkey FROM orders ORDER BY o_custkey, d, o_orderkey")
def _first(t):
    df = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("d"), "o_orderkey")
    return rows.keep_first(df, ["o_custkey"], ["d", "o_orderkey"])


@query("distinct_on_keep_last", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderdate::DATE AS d, o_orderkey FROM orders ORDER BY o_custkey, d DESC, o_orderkey DESC")
def _last(t):
    df = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("d"), "o_orderkey")
    return rows.keep_last(df, ["o_custkey"], ["d", "o_orderkey"])


PAIRS = """pr AS (SELECT o_custkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_orderkey % 2 AS src, max(o_totalprice) AS v FROM orders GROUP BY ALL)"""


def _pairs(t):
    return t.orders.groupBy(
        F.col("o_custkey").alias("k"), F.trunc(F.to_date("o_orderdate"), "MM").alias("m"), (F.col("o_orderkey") % 2).alias("src")
    ).agg(F.max("o_totalprice").alias("v"))


@query("prefer_source", with_(PAIRS) + "SELECT k, m, src, v FROM (SELECT *, count(*) OVER (PARTITION BY k, m) AS n FROM pr) WHERE n = 1 OR (n = 2 AND src = 1)")
def _prefer(t):
    return rows.prefer_source(_pairs(t), ["k", "m"], "src", 1)


@query(
    "last_in_period",
    with_(sd()) + "SELECT id, eom, date, prc FROM (SELECT *, max(date) OVER (PARTITION BY id, eom) AS top FROM sd WHERE bidask = 0 AND tvol > 0) WHERE date = top",
)
def _last_period(t):
    df = adapters.security_day(t).select("id", "eom", "date", "prc", "bidask", "tvol")
    ok = (F.col("bidask") == 0) & (F.col("tvol") > 0)
    return rows.last_in_period(df, ["id", "eom"], "date", ok).select("id", "eom", "date", "prc")


@query("row_index", with_(sm()) + "SELECT id, eom, row_number() OVER (PARTITION BY id ORDER BY eom) AS n FROM sm")
def _row_index(t):
    w = Window.partitionBy("id").orderBy("eom")
    return adapters.security_month(t).select("id", "eom", F.row_number().over(w).alias("n"))


@query(
    "header_union",
    """SELECT coalesce(a.k, b.k) AS k, coalesce(a.v, b.v) AS v FROM (SELECT s_suppkey AS k, min(s_name) AS v FROM supplier GROUP BY 1) a
FULL JOIN (SELECT c_custkey AS k, min(c_name) AS v FROM customer GROUP BY 1) b ON a.k = b.k""",
)
def _header(t):
    a = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("v"))
    return rows.header_union(a, t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v")), "k")


def day_rows(sql, day, code):
    return f"SELECT custkey, {day}, {code} FROM ({sql})"


def _day_rows(df, day, code):
    return df.select("custkey", day, code)


# ---- expansion --------------------------------------------------------------------------------
@query(
    "expand_interval",
    with_(INTERVALS) + day_rows("SELECT custkey, code, CAST(unnest(generate_series(from_date, thru_date, INTERVAL 1 DAY)) AS DATE) AS date FROM iv WHERE thru_date IS NOT NULL", "date", "code"),
)
def _expand(t):
    out = expand.expand_interval(adapters.validity_intervals(t), ["custkey"], "from_date", "thru_date")
    return _day_rows(out, "date", "code")


@query(
    "expand_interval_month",
    with_(INTERVALS, "e0 AS (SELECT *, unnest(range(0, (year(thru_date) - year(from_date)) * 12 + month(thru_date) - month(from_date) + 1)) AS k FROM iv WHERE thru_date IS NOT NULL)",
          "e AS (SELECT custkey, from_date, code, last_day(CAST(from_date + to_months(CAST(k AS INTEGER)) AS DATE)) AS eom FROM e0 WHERE CAST(from_date + to_months(CAST(k AS INTEGER)) AS DATE) <= thru_date)")
    + "SELECT DISTINCT ON (custkey, eom) custkey, code, eom FROM e ORDER BY custkey, eom, from_date DESC, code DESC",
)
def _expand_m(t):
    return expand.expand_interval(adapters.validity_intervals(t), ["custkey"], "from_date", "thru_date", "month", "eom")


@query(
    "carry_forward_until_next",
    with_(INTERVALS, "c AS (SELECT *, least(lead(from_date) OVER (PARTITION BY custkey ORDER BY from_date), last_day(CAST(from_date + INTERVAL 2 MONTH AS DATE))) - 1 AS stop FROM iv)")
    + day_rows("SELECT custkey, code, CAST(unnest(generate_series(from_date, stop, INTERVAL 1 DAY)) AS DATE) AS ddate FROM c", "ddate", "code"),
)
def _carry(t):
    out = expand.carry_forward(adapters.validity_intervals(t).drop("thru_date"), "custkey", "from_date", "ddate", 2)
    return _day_rows(out, "ddate", "code")


@query(
    "scd_to_daily",
    with_(INTERVALS) + day_rows("SELECT custkey, CAST(unnest(generate_series(from_date, thru_date, INTERVAL 1 DAY)) AS DATE) AS date, nullif(custkey % 4, 0) AS sic FROM iv WHERE thru_date IS NOT NULL", "date", "sic"),
)
def _scd(t):
    df = adapters.validity_intervals(t).select("custkey", "from_date", "thru_date", (F.col("custkey") % 4).alias("sic"))
    return _day_rows(expand.scd_to_daily(df, ["custkey"], "from_date", "thru_date", "sic"), "date", "sic")


@query(
    "open_interval_close",
    with_(INTERVALS)
    + """SELECT custkey, from_date, CASE WHEN lead(from_date) OVER w IS NULL AND thru_date IS NULL THEN greatest(DATE '2001-12-31', (SELECT max(from_date) FROM iv)) ELSE thru_date END AS thru_date,
  coalesce(CASE WHEN custkey % 5 <> 0 THEN CAST(substr(code, 1, 1) AS INT) END, -999) AS gics FROM iv WINDOW w AS (PARTITION BY custkey ORDER BY from_date)""",
)
def _close(t):
    df = adapters.validity_intervals(t).select(
        "custkey", "from_date", "thru_date", F.when(F.col("custkey") % 5 != 0, F.substring("code", 1, 1).cast("int")).alias("gics")
    )
    return expand.close_open_interval(df, "custkey", "from_date", "thru_date", "gics", DATE("2001-12-31"))


@query(
    "span_to_next",
    with_(INTERVALS, "c AS (SELECT *, coalesce(lead(from_date) OVER (PARTITION BY custkey ORDER BY from_date) - 1, from_date) AS stop FROM iv)")
    + day_rows("SELECT custkey, code, CAST(unnest(generate_series(from_date, stop, INTERVAL 1 DAY)) AS DATE) AS from_date FROM c", "from_date", "code"),
)
def _span(t):
    out = expand.step_fill(adapters.validity_intervals(t).drop("thru_date"), "custkey", "from_date")
    return _day_rows(out, "from_date", "code")


@query(
    "gap_fill",
    with_(
        INTERVALS,
        "c AS (SELECT *, coalesce(lead(from_date) OVER (PARTITION BY custkey ORDER BY from_date) - 1, from_date) AS aux FROM iv)",
        "g AS (SELECT custkey, from_date, code, CAST(unnest(generate_series(from_date, aux, INTERVAL 1 DAY)) AS DATE) AS day FROM c WHERE aux <> from_date)",
    )
    + day_rows("SELECT custkey, from_date, code FROM c WHERE aux = from_date UNION SELECT custkey, day, CASE WHEN day = from_date THEN code END FROM g", "from_date", "code"),
)
def _gap(t):
    return _day_rows(expand.gap_fill(adapters.validity_intervals(t), "custkey", "from_date", ["code"]), "from_date", "code")


@query("monthly_spine", with_(dense()) + "SELECT gvkey, curcd, datadate, data_available, count, gp FROM accd", "gp:6")
def _spine(t):
    acc = adapters.firm_accounting(t).select("gvkey", "curcd", "datadate", "gp")
    return expand.densify_months(acc, ["gvkey", "curcd"], "datadate")


@query(
    "security_month_spine",
    with_(sm("part"), "s AS (SELECT id, last_day(CAST(unnest(generate_series(date_trunc('month', min(eom)), date_trunc('month', max(eom)), INTERVAL 1 MONTH)) AS DATE)) AS eom FROM sm GROUP BY 1)")
    + "SELECT id, eom, me FROM s LEFT JOIN sm USING (id, eom)",
)
def _sec_spine(t):
    df = adapters.security_month(t, "part").select("id", "eom", "me")
    return expand.month_spine(df, ["id"], "eom").join(df, ["id", "eom"], "left")


@query(
    "publication_lag_expand",
    with_(
        accounts(),
        "p AS (SELECT gvkey, datadate, gp, last_day(CAST(datadate + INTERVAL 4 MONTH AS DATE)) AS a FROM acc)",
        "q AS (SELECT *, least(last_day(CAST(lead(a) OVER (PARTITION BY gvkey ORDER BY datadate) - INTERVAL 1 MONTH AS DATE)), last_day(CAST(datadate + INTERVAL 18 MONTH AS DATE))) AS b FROM p)",
    )
    + "SELECT gvkey, datadate, gp, last_day(CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE)) AS public_date FROM q WHERE b >= a",
    "gp:6",
)
def _pub(t):
    acc = adapters.firm_accounting(t).select("gvkey", "datadate", "gp")
    return expand.publication_expand(acc, "gvkey", "datadate", 4, 18)


@query("forward_fill", with_(dense()) + "SELECT gvkey, datadate, last_value(gp IGNORE NULLS) OVER (PARTITION BY gvkey ORDER BY datadate) AS gp FROM accd", "gp:6")
def _ffill(t):
    acc = adapters.firm_accounting(t).select("gvkey", "curcd", "datadate", "gp")
    d = expand.densify_months(acc, ["gvkey", "curcd"], "datadate")
    return expand.forward_fill(d, "gvkey", "datadate", ["gp"]).select("gvkey", "datadate", "gp")
