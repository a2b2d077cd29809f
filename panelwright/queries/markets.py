"""Cutoffs, size groups, ranks and market returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crosssection as cs
from ..operators import industry, market
from ..sources import adapters
from .base_sql import INDUSTRY, sd, sm, with_
from .registry import query

OK = "common = 1 AND primary_sec = 1 AND obs_main = 1 AND exch_main = 1"


def qdisc(value: str, q: float, rn: str, n: str) -> str:
    return f"min(CASE WHEN {rn} >= greatest(1, ceil({q} * {n} - 1e-9)) THEN {value} END)"


def cutoffs_sql(src: str, keys: str, where: str) -> str:
    """CTE body: the twelve return percentiles from row numbers."""
    rets = ["ret", "ret_local", "ret_exc"]
    probs = {"0_1": 0.001, "1": 0.01, "99": 0.99, "99_9": 0.999}
    ranked = ", ".join(
        f"row_number() OVER (PARTITION BY {keys} ORDER BY {r} NULLS LAST) AS rn_{r}, "
        f"count({r}) OVER (PARTITION BY {keys}) AS n_{r}"
        for r in rets
    )
    aggs = ", ".join(
        qdisc(r, q, f"rn_{r}", f"n_{r}") + f" AS {r}_{s}" for r in rets for s, q in probs.items()
    )
    return (
        f"SELECT {keys}, count(ret) AS n, {aggs} FROM (SELECT *, {ranked} FROM {src} WHERE {where}) GROUP BY {keys}"
    )


CUT_DBL = " ".join(f"{r}_{s}" for r in ("ret", "ret_local", "ret_exc") for s in ("0_1", "1", "99", "99_9"))
CUT_WHERE = f"{OK} AND ret_exc IS NOT NULL AND excntry <> 'ZWE'"


def clamp(r: str) -> str:
    return (
        f"CASE WHEN source_crsp = 0 AND {r} > {r}_99_9 THEN {r}_99_9 "
        f"WHEN source_crsp = 0 AND {r} < {r}_0_1 THEN {r}_0_1 ELSE {r} END AS {r}"
    )


def market_sql(src: str, date: str, gap: int) -> str:
    return f"""SELECT excntry, {date}, count(*) AS stocks, sum(me_lag1) AS me_lag1,
  sum(dolvol_lag1) AS dolvol_lag1,
  sum(ret_local * me_lag1) / sum(me_lag1) AS mkt_vw_lcl, avg(ret_local) AS mkt_ew_lcl,
  sum(ret * me_lag1) / sum(me_lag1) AS mkt_vw, avg(ret) AS mkt_ew,
  sum(ret_exc * me_lag1) / sum(me_lag1) AS mkt_vw_exc, avg(ret_exc) AS mkt_ew_exc
FROM {src} WHERE {OK} AND ret_lag_dif <= {gap} AND me_lag1 IS NOT NULL AND ret_local IS NOT NULL
GROUP BY 1, 2"""


MKT_DBL = "me_lag1:2 dolvol_lag1:4 mkt_vw_lcl mkt_ew_lcl mkt_vw mkt_ew mkt_vw_exc mkt_ew_exc"
LAGGED = "lag(me) OVER (PARTITION BY id ORDER BY {d}) AS me_lag1, lag(dolvol) OVER (PARTITION BY id ORDER BY {d}) AS dolvol_lag1"


@query("market_returns", with_(sm(), f"ml AS (SELECT *, {LAGGED.format(d='eom')} FROM sm)") + market_sql("ml", "eom", 1), MKT_DBL)
def _market_returns(t):
    """Value- and equal-weighted monthly market returns by country."""
    return market.market_returns(adapters.security_month(t), "m")


@query(
    "market_returns_winsorized",
    with_(
        sm(),
        f"ml AS (SELECT *, {LAGGED.format(d='eom')} FROM sm)",
        f"cut AS ({cutoffs_sql('sm', 'eom', CUT_WHERE)})",
        f"mw AS (SELECT ml.* REPLACE ({clamp('ret')}, {clamp('ret_local')}, {clamp('ret_exc')}) FROM ml LEFT JOIN cut USING (eom))",
    )
    + market_sql("mw", "eom", 1),
    MKT_DBL,
)
def _market_returns_wins(t):
    sm_ = adapters.security_month(t)
    return market.market_returns(sm_, "m", market.return_cutoffs(sm_))


@query(
    "market_returns_daily",
    with_(
        sd(),
        f"dl AS (SELECT *, {LAGGED.format(d='date')} FROM sd)",
        f"mk AS ({market_sql('dl', 'date', 14)})",
        "top AS (SELECT *, max(stocks) OVER (PARTITION BY excntry, year(date), month(date)) AS top FROM mk)",
    )
    + "SELECT * EXCLUDE (top) FROM top WHERE stocks / top::DOUBLE >= 0.25",
    MKT_DBL,
)
def _market_returns_daily(t):
    return market.market_returns(adapters.security_day(t), "d")


@query(
    "drop_thin_days",
    with_(
        sd(),
        "n AS (SELECT excntry, date, count(*) AS stocks FROM sd GROUP BY 1, 2)",
        "m AS (SELECT *, max(stocks) OVER (PARTITION BY excntry, year(date), month(date)) AS top FROM n)",
    )
    + "SELECT excntry, date, stocks FROM m WHERE stocks / top::DOUBLE >= 0.6",
)
def _thin(t):
    n = adapters.security_day(t).groupBy("excntry", "date").agg(F.count(F.lit(1)).alias("stocks"))
    return market.drop_thin_days(n, "stocks", "date", ["excntry"], 0.6)


@query(
    "value_equal_weighted_mean",
    with_(sm(), f"ml AS (SELECT *, {LAGGED.format(d='eom')} FROM sm)") + market_sql("ml", "eom", 1).replace("ret_lag_dif <= 1 AND ", ""),
    MKT_DBL,
)
def _vw_ew(t):
    from pyspark.sql import Window

    w = Window.partitionBy("id").orderBy("eom")
    df = adapters.security_month(t).withColumns(
        {"me_lag1": F.lag("me").over(w), "dolvol_lag1": F.lag("dolvol").over(w)}
    )
    return market.market_index(df, "eom", 10**6)


@query(
    "quality_filter",
    with_(sm()) + f"SELECT id, eom, me, ret_exc FROM sm WHERE {OK} AND ret_exc IS NOT NULL AND me IS NOT NULL",
    "ret_exc",
)
def _quality(t):
    return market.quality_filter(adapters.security_month(t), "ret_exc", "me").select("id", "eom", "me", "ret_exc")


SIZE_CUTS = (
    "cut AS (SELECT eom, count(*) AS n, "
    + ", ".join(qdisc("me", q, "rn", "k") + f" AS nyse_p{p}" for p, q in ((1, 0.01), (20, 0.2), (50, 0.5), (80, 0.8)))
    + f""" FROM (SELECT eom, me, row_number() OVER (PARTITION BY eom ORDER BY me) AS rn,
      count(*) OVER (PARTITION BY eom) AS k FROM sm WHERE crsp_exchcd = 1 AND {OK} AND me IS NOT NULL) GROUP BY eom)"""
)
SIZE_GRP = """sg AS (SELECT sm.*, CASE WHEN me IS NULL THEN NULL WHEN nyse_p80 IS NULL OR me >= nyse_p80 THEN 'mega'
    WHEN me >= nyse_p50 THEN 'large' WHEN me >= nyse_p20 THEN 'small' WHEN me >= nyse_p1 THEN 'micro'
    ELSE 'nano' END AS size_grp FROM sm LEFT JOIN cut USING (eom))"""


@query("quantile_disc_cutoffs", with_(sm("part"), SIZE_CUTS) + "SELECT * FROM cut")
def _size_cut(t):
    return market.size_cutoffs(adapters.security_month(t, "part"))


@query("size_group", with_(sm("part"), SIZE_CUTS, SIZE_GRP) + "SELECT id, eom, size_grp FROM sg")
def _size_group(t):
    df = adapters.security_month(t, "part")
    return market.size_groups(df, market.size_cutoffs(df)).select("id", "eom", "size_grp")


@query("return_cutoffs", with_(sm("part")) + cutoffs_sql("sm", "eom", CUT_WHERE), CUT_DBL)
def _ret_cut(t):
    return market.return_cutoffs(adapters.security_month(t, "part"))


@query(
    "return_cutoffs_daily",
    with_(sd(), "sdy AS (SELECT *, year(date) AS year, month(date) AS month FROM sd)")
    + cutoffs_sql("sdy", "year, month", CUT_WHERE + " AND source_crsp = 1"),
    CUT_DBL,
)
def _ret_cut_d(t):
    return market.return_cutoffs(adapters.security_day(t), "d", crsp_only=True)


@query(
    "winsorize",
    with_(
        sm("part"),
        f"cut AS ({cutoffs_sql('sm', 'eom', CUT_WHERE)})",
        f"w AS (SELECT sm.* REPLACE ({clamp('ret')}, {clamp('ret_local')}, {clamp('ret_exc')}) FROM sm LEFT JOIN cut USING (eom))",
    )
    + "SELECT id, eom, ret, ret_local, ret_exc FROM w",
    "ret ret_local ret_exc",
)
def _wins(t):
    df = adapters.security_month(t, "part")
    return market.winsorize_returns(df, market.return_cutoffs(df), ["eom"]).select("id", "eom", "ret", "ret_local", "ret_exc")


@query(
    "winsorize_all_rows",
    with_(
        sm("part"),
        "r AS (SELECT eom, ret_exc, row_number() OVER (PARTITION BY eom ORDER BY ret_exc) AS rn, count(*) OVER (PARTITION BY eom) AS n FROM sm WHERE ret_exc IS NOT NULL)",
        f"b AS (SELECT eom, {qdisc('ret_exc', 0.05, 'rn', 'n')} AS lo, {qdisc('ret_exc', 0.95, 'rn', 'n')} AS hi FROM r GROUP BY eom)",
    )
    + "SELECT id, eom, CASE WHEN ret_exc < lo THEN lo WHEN ret_exc > hi THEN hi ELSE ret_exc END AS ret_exc FROM sm LEFT JOIN b USING (eom)",
    "ret_exc",
)
def _wins_all(t):
    df = adapters.security_month(t, "part").select("id", "eom", "ret_exc")
    b = cs.quantile_disc(df, ["eom"], "ret_exc", {"lo": 0.05, "hi": 0.95})
    return df.join(b, "eom", "left").select("id", "eom", cs.winsorize("ret_exc", "lo", "hi").alias("ret_exc"))


RANKED = """rk AS (SELECT id, eom, excntry, tvol, rank() OVER (PARTITION BY excntry, eom ORDER BY tvol) AS lo,
    rank() OVER (PARTITION BY excntry, eom ORDER BY tvol DESC) AS hi,
    count(*) OVER (PARTITION BY excntry, eom, tvol) AS ties,
    count(*) OVER (PARTITION BY excntry, eom) AS n FROM sm)"""


@query(
    "rank_avg",
    with_(sm("part"), RANKED) + "SELECT id, eom, lo + (ties - 1) / 2.0 AS rank_up, hi + (ties - 1) / 2.0 AS rank_down FROM rk",
    "rank_up:1 rank_down:1",
)
def _rank_avg(t):
    df = adapters.security_month(t, "part").select("id", "eom", "excntry", "tvol")
    k = ["excntry", "eom"]
    r = cs.rank_table(df, k, "tvol").withColumns({"rank_up": cs.average_rank(), "rank_down": cs.average_rank(True)})
    return cs.attach_ranks(df, r, k, "tvol", ["rank_up", "rank_down"]).select("id", "eom", "rank_up", "rank_down")


@query("rank_min", with_(sm("part"), RANKED) + "SELECT id, eom, lo AS rank_up, hi AS rank_down FROM rk")
def _rank_min(t):
    df = adapters.security_month(t, "part").select("id", "eom", "excntry", "tvol")
    k = ["excntry", "eom"]
    r = cs.rank_table(df, k, "tvol").withColumns({"rank_up": cs.min_rank(), "rank_down": cs.min_rank(True)})
    return cs.attach_ranks(df, r, k, "tvol", ["rank_up", "rank_down"]).select("id", "eom", "rank_up", "rank_down")


@query(
    "rank_pct",
    with_(sm("part"), RANKED)
    + "SELECT id, excntry, eom, CASE WHEN n >= 100 THEN (hi + (ties - 1) / 2.0) / n END AS rank_tvol FROM rk",
    "rank_tvol",
)
def _rank_pct(t):
    df = adapters.security_month(t, "part")
    return cs.rank_pct(df, ["id"], ["excntry", "eom"], {"tvol": True}, 100)


@query(
    "z_rank",
    with_(
        sm("part"),
        RANKED,
        "r AS (SELECT *, lo + (ties - 1) / 2.0::DOUBLE AS r FROM rk)",
    )
    + """SELECT id, excntry, eom, CASE WHEN n >= 100 THEN (r - avg(r) OVER w) / nullif(stddev_samp(r) OVER w, 0) END AS z_tvol
FROM r WINDOW w AS (PARTITION BY excntry, eom)""",
    "z_tvol",
)
def _z_rank(t):
    return cs.z_ranks(adapters.security_month(t, "part"), ["id"], ["excntry", "eom"], {"tvol": False}, 100)


@query(
    "standardize_signal",
    with_(sm("part"), "r AS (SELECT id, eom, rank() OVER (PARTITION BY eom ORDER BY tvol) AS rt, rank() OVER (PARTITION BY eom ORDER BY me) AS rm FROM sm)")
    + "SELECT id, eom, rt / max(rt) OVER (PARTITION BY eom)::DOUBLE - 0.5 AS tvol, rm / max(rm) OVER (PARTITION BY eom)::DOUBLE - 0.5 AS me FROM r",
    "tvol me",
)
def _std_signal(t):
    return cs.standardize_signal(adapters.security_month(t, "part"), ["eom"], ["tvol", "me"], ["id"])


@query(
    "asof_backward_join",
    with_(sm("part"))
    + """SELECT id, eom, coalesce(sum(ref) OVER (PARTITION BY eom ORDER BY tvol RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    / nullif(sum(ref) OVER (PARTITION BY eom), 0)::DOUBLE, 0) AS cdf
FROM (SELECT id, eom, tvol, CAST(source_crsp = 1 AND id % 2 = 0 AS INT) AS ref FROM sm)""",
    "cdf",
)
def _asof(t):
    df = adapters.security_month(t, "part").select("id", "eom", "tvol", "source_crsp")
    ref = (F.col("source_crsp") == 1) & (F.col("id") % 2 == 0)
    return cs.ecdf(df, ["eom"], "tvol", ref).select("id", "eom", "cdf")


@query(
    "median_signal",
    with_(sm("part")) + "SELECT excntry, eom, median(prc) AS median FROM sm GROUP BY 1, 2",
    "median:6",
)
def _median(t):
    return cs.group_median(adapters.security_month(t, "part"), ["excntry", "eom"], "prc")


@query(
    "count_filter_over_group",
    with_(sm("part"))
    + "SELECT excntry, eom, id, n, top FROM (SELECT *, count(ret) OVER w AS n, max(tvol) OVER w AS top FROM sm WINDOW w AS (PARTITION BY excntry, eom)) WHERE n >= 120",
)
def _count_filter(t):
    df = adapters.security_month(t, "part").select("excntry", "eom", "id", "ret", "tvol")
    # group totals come from a keyed aggregation joined back, not from a window over the group
    g = df.groupBy("excntry", "eom").agg(F.count("ret").alias("n"), F.max("tvol").alias("top"))
    return df.join(g.filter("n >= 120"), ["excntry", "eom"]).select("excntry", "eom", "id", "n", "top")


def _ladder_sql() -> str:
    arms = "\n".join(
        f"WHEN {' OR '.join(f'sic BETWEEN {a} AND {b}' for a, b in rs)} THEN {g}" for g, rs in industry.SIC38
    )
    return f"CASE {arms} END"


@query("industry_class_38", with_(INDUSTRY) + f"SELECT id, sic, {_ladder_sql()} AS ff38 FROM ic")
def _ind38(t):
    return industry.classify(adapters.industry_codes(t), "sic", industry.SIC38, "ff38")


RANGES_SQL = """rg AS (SELECT (g * 7) % 49 + 1 AS grp, g AS priority, g * 130 % 10000 AS lo, g * 130 % 10000 + 99 + (g % 5) * 40 AS hi
  FROM (SELECT DISTINCT (p_partkey % 150) AS g FROM part))"""


def _ranges(t):
    g = F.col("p_partkey") % 150
    return t.part.select(g.alias("priority")).distinct().select(
        ((F.col("priority") * 7) % 49 + 1).alias("grp"),
        "priority",
        (F.col("priority") * 130 % 10000).alias("lo"),
        (F.col("priority") * 130 % 10000 + 99 + (F.col("priority") % 5) * 40).alias("hi"),
    )


@query(
    "industry_class_49",
    with_(INDUSTRY, RANGES_SQL)
    + """SELECT id, sic, (SELECT arg_min(grp, priority) FROM rg WHERE ic.sic BETWEEN lo AND hi) AS ff49 FROM ic""",
)
def _ind49(t):
    """Classification from a range table handed in as data (first match by priority)."""
    return industry.classify_by_table(adapters.industry_codes(t), "sic", _ranges(t), "ff49").select("id", "sic", "ff49")


CODES_SQL = """cd AS (SELECT code, arg_min(grp, priority) AS grp, count(DISTINCT grp) AS n FROM (SELECT unnest(range(0, 10000)) AS code) LEFT JOIN rg ON code BETWEEN lo AND hi GROUP BY 1)"""


@query(
    "industry_ranges",
    with_(RANGES_SQL, CODES_SQL)
    + """SELECT min(code) AS lo, max(code) AS hi, max(grp) AS grp FROM (SELECT *, code - row_number() OVER (PARTITION BY grp ORDER BY code) AS run FROM cd) GROUP BY coalesce(grp, -1), run""",
)
def _ranges_disjoint(t):
    """Overlapping ranges as disjoint ones, and the gaps without a class."""
    ranges = _ranges(t)
    return industry.disjoint_ranges(ranges).unionByName(industry.gaps(ranges).withColumn("grp", F.lit(None).cast("long")))


@query("industry_claims", with_(RANGES_SQL, CODES_SQL) + "SELECT CAST(n AS BIGINT) AS n_classes, count(*) AS n_codes FROM cd WHERE n > 0 GROUP BY 1")
def _claims(t):
    """How many codes are claimed by one, two, ... classes."""
    return industry.sweep(_ranges(t)).groupBy("n_classes").agg(F.sum(F.col("hi") - F.col("lo") + 1).alias("n_codes"))
