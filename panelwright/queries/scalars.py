"""Null arithmetic, guarded division, predicates, calendar and column-selection operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates, nulls
from ..operators import expand, rows, security
from ..sources import adapters
from .base_sql import accounts, dense, sd, sm, with_
from .registry import query

K = "gvkey, curcd, datadate"
KEYS = ["gvkey", "curcd", "datadate"]


@query("typed_null", with_(accounts()) + f"SELECT {K}, CAST(NULL AS DOUBLE) AS x, coalesce(CAST(NULL AS DOUBLE), \"at\") AS y FROM acc")
def _typed_null(t):
    return adapters.firm_accounting(t).select(
        *KEYS, nulls.typed_null().alias("x"), F.coalesce(nulls.typed_null(), "at").alias("y")
    )


@query("bool_false", with_(sm()) + "SELECT id, eom, CAST(coalesce(crsp_exchcd IN (1, 2), FALSE) AS INT) AS flag FROM sm")
def _bool_false(t):
    c = F.coalesce(F.col("crsp_exchcd").isin(1, 2), nulls.bool_false()).cast("int")
    return adapters.security_month(t).select("id", "eom", c.alias("flag"))


@query(
    "sum_sas",
    with_(accounts())
    + f"SELECT {K}, CASE WHEN dltt IS NOT NULL OR dlc IS NOT NULL THEN coalesce(dltt, 0) + coalesce(dlc, 0) END AS debt FROM acc",
    "debt:6",
)
def _sum_sas(t):
    return adapters.firm_accounting(t).select(*KEYS, nulls.sum_sas("dltt", "dlc").alias("debt"))


@query(
    "sub_sas",
    with_(accounts())
    + f"SELECT {K}, CASE WHEN sstk IS NOT NULL OR prstkc IS NOT NULL THEN coalesce(sstk, 0) - coalesce(prstkc, 0) END AS net FROM acc",
    "net:6",
)
def _sub_sas(t):
    return adapters.firm_accounting(t).select(*KEYS, nulls.sub_sas("sstk", "prstkc").alias("net"))


@query(
    "safe_div",
    with_(dense(), "d AS (SELECT *, coalesce(ni, 0) - 300 AS den, 1.0::DOUBLE + count / 100.0::DOUBLE AS fx FROM accd)")
    + f"""SELECT {K}, CASE WHEN den <> 0 THEN gp / den END AS m1, CASE WHEN den <> 0 THEN gp / abs(den) END AS m2,
  CASE WHEN den > 0 THEN gp / den END AS m3,
  CASE WHEN count > 12 AND lag(den, 12) OVER w > 0 THEN gp / lag(den, 12) OVER w END AS m4,
  CASE WHEN den <> 0 THEN gp * fx / den END AS m5,
  CASE WHEN lag(den, 12) OVER w <> 0 THEN gp / lag(den, 12) OVER w END AS m6,
  CASE WHEN lag(den, 12) OVER w > 0 THEN lag(gp / nullif(den, 0), 12) OVER w END AS m7,
  CASE WHEN gp > 0 AND den > 0 THEN gp / den END AS m8,
  CASE WHEN count > 3 AND lag(den, 3) OVER w > 0 THEN gp / lag(den, 3) OVER w END AS m9
FROM d WINDOW w AS (PARTITION BY gvkey, curcd ORDER BY datadate)""",
    " ".join(f"m{i}:6" for i in range(1, 10)),
)
def _safe_div(t):
    df = expand.densify_months(adapters.firm_accounting(t), ["gvkey", "curcd"], "datadate")
    df = df.withColumns({"den": nulls.zero("ni") - 300, "fx": 1 + F.col("count") / F.lit(100.0)})
    w = Window.partitionBy("gvkey", "curcd").orderBy("datadate")
    return df.select(
        *KEYS, *[nulls.safe_div("gp", "den", m, over=w).alias(f"m{m}") for m in range(1, 10)]
    )


@query(
    "coalesce_chain",
    with_(accounts())
    + f"SELECT {K}, coalesce(seq, ceq + coalesce(coalesce(pstkrv, pstkl, pstk), 0), \"at\" - lt) AS seq_x FROM acc",
    "seq_x:6",
)
def _coalesce(t):
    pstk = F.coalesce("pstkrv", "pstkl", "pstk")
    c = F.coalesce(F.col("seq"), F.col("ceq") + nulls.zero(pstk), F.col("at") - F.col("lt"))
    return adapters.firm_accounting(t).select(*KEYS, c.alias("seq_x"))


@query(
    "case_ladder",
    with_(accounts())
    + f"SELECT {K}, CASE WHEN \"at\" IS NULL THEN 'none' WHEN \"at\" > 500000 THEN 'big' WHEN \"at\" > 200000 THEN 'mid' ELSE 'small' END AS label FROM acc",
)
def _case(t):
    a = F.col("at")
    label = F.when(a.isNull(), "none").when(a > 500000, "big").when(a > 200000, "mid").otherwise("small")
    return adapters.firm_accounting(t).select(*KEYS, label.alias("label"))


@query(
    "predicates_strings",
    with_(sm())
    + """SELECT id, eom, gvkey, iid, upper(substr(excntry, 1, 3)) AS c3, lpad(CAST(id AS VARCHAR), 8, '0') AS padded,
  gvkey || '-' || iid AS sec FROM sm
WHERE excntry IN ('ASIA', 'AMERICA', 'EUROPE') AND midx BETWEEN 23960 AND 23990 AND NOT contains(iid, 'W')""",
)
def _predicates(t):
    df = adapters.security_month(t)
    keep = (
        F.col("excntry").isin("ASIA", "AMERICA", "EUROPE")
        & F.col("midx").between(23960, 23990)
        & ~F.col("iid").contains("W")
    )
    return df.filter(keep).select(
        "id", "eom", "gvkey", "iid",
        F.upper(F.substring("excntry", 1, 3)).alias("c3"),
        F.lpad(F.col("id").cast("string"), 8, "0").alias("padded"),
        F.concat_ws("-", "gvkey", "iid").alias("sec"),
    )


@query(
    "volume_adjust_by_era",
    with_(sd())
    + """SELECT id, date, CASE WHEN comp_exchg = 14 AND date < DATE '2001-02-01' THEN tvol / 2
  WHEN comp_exchg = 14 AND date <= DATE '2001-12-31' THEN tvol / 1.8::DOUBLE
  WHEN comp_exchg = 14 AND date < DATE '2003-12-31' THEN tvol / 1.6::DOUBLE ELSE tvol END AS tvol FROM sd""",
    "tvol:6",
)
def _vol_era(t):
    return adapters.security_day(t).select("id", "date", security.volume_by_era("date", "tvol", "comp_exchg", 14).alias("tvol"))


@query(
    "composite_id",
    with_(sm())
    + """SELECT DISTINCT gvkey, iid, CAST(CASE WHEN contains(iid, 'W') THEN '3' WHEN contains(iid, 'C') THEN '2' ELSE '1' END
  || gvkey || substr(iid, 1, 2) AS BIGINT) AS id FROM sm""",
)
def _composite(t):
    return adapters.security_month(t).select("gvkey", "iid").distinct().withColumn("id", security.composite_id("gvkey", "iid"))


@query(
    "month_index",
    with_(sd())
    + """SELECT id, date, year(date) * 12 + month(date) AS m, year(lag(date) OVER w) * 12 + month(lag(date) OVER w) AS m_lag
FROM sd WINDOW w AS (PARTITION BY id ORDER BY date)""",
)
def _midx(t):
    w = Window.partitionBy("id").orderBy("date")
    return adapters.security_day(t).select(
        "id", "date", dates.month_index("date").alias("m"), dates.month_index(F.lag("date").over(w)).alias("m_lag")
    )


@query(
    "month_end_shift",
    """SELECT o_orderkey, last_day(d) AS eom, last_day(CAST(d + INTERVAL 12 MONTH AS DATE)) AS eom_12,
  last_day(CAST(d - INTERVAL 1 MONTH AS DATE)) AS eom_m1, CAST(date_trunc('month', d) AS DATE) - 1 AS prev_eom
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _month_end(t):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dates.month_end(d).alias("eom"),
        dates.month_end(d, 12).alias("eom_12"),
        dates.month_end(d, -1).alias("eom_m1"),
        dates.prev_month_end(d).alias("prev_eom"),
    )


@query("rename_by_dict", with_(accounts()) + "SELECT gvkey, datadate, xrd AS rd_q, xsga AS sga_q, dlc AS debtst_q, che AS cash_q FROM acc")
def _rename(t):
    rename = {"xrd": "rd", "xsga": "sga", "dlc": "debtst", "che": "cash"}
    return rows.rename_and_keep(
        adapters.firm_accounting(t), rename, ["gvkey", "datadate"], ["rd", "sga", "debtst", "cash"], "_q"
    )


@query("regex_select", with_(sm()) + "SELECT id, eom, div_tot, div_spc FROM sm", "div_tot:9 div_spc:9")
def _regex(t):
    df = adapters.security_month(t)
    return df.select("id", "eom", df.colRegex("`^div_.*$`"))


@query(
    "null_out_non_finite",
    with_(accounts())
    + f"SELECT {K}, CASE WHEN isfinite(r) THEN r END AS r FROM (SELECT *, CASE WHEN id9 = 0 THEN 'NaN'::DOUBLE WHEN id9 = 1 THEN 'Infinity'::DOUBLE ELSE \"at\" END AS r FROM (SELECT *, CAST(gvkey AS BIGINT) % 9 AS id9 FROM acc))",
    "r:6",
)
def _finite(t):
    i9 = F.col("gvkey").cast("long") % 9
    raw = F.when(i9 == 0, F.lit(float("nan"))).when(i9 == 1, F.lit(float("inf"))).otherwise(F.col("at"))
    return adapters.firm_accounting(t).select(*KEYS, nulls.finite(raw).alias("r"))


@query(
    "clip_small",
    with_(sm())
    + """SELECT id, eom, CASE WHEN x < 1e-5 THEN 0.0 ELSE x END AS x, CASE WHEN abs(x) < 1e-5 THEN 0.0 ELSE x END AS y
FROM (SELECT id, eom, ret / 5000 AS x FROM sm)""",
    "x:10 y:10",
)
def _clip(t):
    df = adapters.security_month(t).withColumn("x", F.col("ret") / 5000)
    return df.select("id", "eom", nulls.snap_small("x").alias("x"), nulls.snap_small("x", signed=True).alias("y"))


@query(
    "horizontal_stats",
    with_(accounts())
    + f"""SELECT {K}, least(che, invt, rect) AS lo, greatest(che, invt, rect) AS hi,
  list_avg(list_filter([che, invt, rect], lambda x: x IS NOT NULL)) AS mean,
  CAST(coalesce(che > 50000, FALSE) OR coalesce(invt > 50000, FALSE) OR coalesce(rect > 50000, FALSE) AS INT) AS any_big FROM acc""",
    "mean:5",
)
def _horizontal(t):
    cs = ["che", "invt", "rect"]
    big = F.coalesce(F.greatest(*cs) > 50000, F.lit(False)).cast("int")
    return adapters.firm_accounting(t).select(
        *KEYS, F.least(*cs).alias("lo"), F.greatest(*cs).alias("hi"), nulls.mean_across(cs).alias("mean"), big.alias("any_big")
    )


@query(
    "scalar_functions",
    with_(accounts())
    + f"""SELECT {K}, CASE WHEN "at" > 0 THEN ln("at") END AS l, sqrt(abs(gp)) AS s, pow(che / 1000, 2) AS p, ceil("at" / 1000) AS c,
  greatest(1, least(3, ceil("at" / 100000))) AS clip, make_date(year(datadate) - 1, 12, 31) AS py, replace(curcd, 'C0', 'X') AS r,
  TRY_CAST(curcd AS INTEGER) AS bad FROM acc""",
    "l s:6 p:4 c clip",
)
def _scalar(t):
    a = F.col("at")
    return adapters.firm_accounting(t).select(
        *KEYS,
        F.when(a > 0, F.log(a)).alias("l"),
        F.sqrt(F.abs("gp")).alias("s"),
        F.pow(F.col("che") / 1000, F.lit(2)).alias("p"),
        F.ceil(a / 1000).cast("double").alias("c"),
        F.greatest(F.lit(1.0), F.least(F.lit(3.0), F.ceil(a / 100000).cast("double"))).alias("clip"),
        F.make_date(F.year("datadate") - 1, F.lit(12), F.lit(31)).alias("py"),
        F.replace("curcd", F.lit("C0"), F.lit("X")).alias("r"),
        F.col("curcd").try_cast("int").alias("bad"),
    )


@query(
    "list_functions",
    with_(sm(), "l AS (SELECT id, eom, list_filter([ret, lag(ret, 3) OVER w, lag(ret, 6) OVER w, lag(ret, 9) OVER w], lambda x: x IS NOT NULL) AS a FROM sm WINDOW w AS (PARTITION BY id ORDER BY eom))")
    + "SELECT id, eom, len(a) AS n, list_avg(a) AS m, list_stddev_samp(a) AS s, list_max(a) AS mx FROM l",
    "m s mx",
)
def _lists(t):
    from ..functions.stats import list_mean, list_sd

    w = Window.partitionBy("id").orderBy("eom")
    arr = F.array(*[F.lag("ret", k).over(w) for k in (0, 3, 6, 9)])
    df = adapters.security_month(t).select("id", "eom", F.filter(arr, lambda x: x.isNotNull()).alias("a"))
    return df.select("id", "eom", F.size("a").alias("n"), list_mean(F.col("a")).alias("m"), list_sd(F.col("a")).alias("s"), F.array_max("a").alias("mx"))
