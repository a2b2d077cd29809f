"""Per-entity history: lags, running products, gaps, momentum and payout measures.

Entities are unique per period, so a window over one entity holds at most one row per calendar
day or month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_index
from ..functions.nulls import div, snap_small
from .expand import month_spine


class History:
    """Formulas over an entity's past, evaluated with one window pass per layer.

    ``lag`` only records what is needed; ``add`` computes all recorded lags of a layer together
    and then the formulas as a plain projection, so the number of sorts and shuffles does not
    depend on the number of formulas.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: str):
        self.df = df
        self.keys = keys
        self.window = Window.partitionBy(*keys).orderBy(order)
        self._need: dict[str, Column] = {}
        self._held: list[str] | None = None

        self._over = f"(PARTITION BY {', '.join(keys)} ORDER BY {order})"

    def lag_name(self, col: str, k: int) -> str:
        """Request a lag and return the name its column will have."""
        name = f"lag{k}__{col}"
        if self._held is not None:
            if name not in self._held:
                raise ValueError(f"{name} was not asked for before rows were dropped")
        elif name not in self._need:
            self._need[name] = F.expr(f"lag(`{col}`, {k}) OVER {self._over}")
        return name

    def lag(self, col: str, k: int) -> Column:
        return F.col(self.lag_name(col, k))

    def diff(self, col: str, k: int) -> Column:
        return F.col(col) - self.lag(col, k)

    def add(self, exprs: dict[str, Column]) -> History:
        need, self._need = self._need, {}
        df = self.df
        if need:
            df = df.withColumns(need)
        self.df = df.withColumns(exprs).drop(*need)
        return self

    def keep(self, cond: Column) -> History:
        """Compute all recorded lags, then keep only the rows where ``cond`` holds: formulas added later are evaluated on
        these alone. They may use the lags recorded so far; ``done`` gives the rows without them."""
        self._held, self._need, need = list(self._need), {}, self._need
        self.df = self.df.withColumns(need).filter(cond)
        return self

    def done(self) -> DataFrame:
        return self.df.drop(*(self._held or []))


def running_product(df: DataFrame, key: str, order: str, ret: str, out: str) -> DataFrame:
    """Return index: running product of 1 + return, a missing return counting as 0."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.product(1 + F.coalesce(F.col(ret), F.lit(0.0))).over(w))


def rolling_sum(df: DataFrame, key: str, order: str, col: str, rows: int, out: str) -> DataFrame:
    """Sum of the last ``rows`` rows, NULL only when all are NULL."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.sum(col).over(w))


# Momentum windows (recent lag, distant lag) in months.
MOMENTUM = [
    (0, 1), (0, 2), (0, 3), (1, 3), (0, 6), (1, 6), (0, 9), (1, 9), (0, 12), (1, 12), (7, 12),
    (1, 18), (1, 24), (12, 24), (1, 36), (12, 36), (12, 48), (1, 48), (1, 60), (12, 60), (36, 60),
]
# Horizons in months and seasonality blocks in years.
DIVIDEND_MONTHS = [1, 3, 6, 12]
SPECIAL_MONTHS = [1, 12]
ISSUE_MONTHS = [1, 3, 6, 12]
SEASONS = [(1, 1), (2, 5), (6, 10), (11, 15), (16, 20)]


def momentum(h: History, pairs: list[tuple[int, int]]) -> dict[str, Column]:
    """ret_<far>_<near>: index growth between the two lags, if the near month has a return."""
    out = {}
    for near, far in pairs:
        base = h.lag("ri_x", far)
        recent = h.lag("ri_x", near) if near else F.col("ri_x")
        seen = h.lag("ret_x", near) if near else F.col("ret_x")
        ok = (base != 0) & (F.col("count") > far) & seen.isNotNull()
        out[f"ret_{far}_{near}"] = F.when(ok, div(recent, base) - 1)
    return out


def share_change(h: History, months: list[int], shares: str = "adj_shares") -> dict[str, Column]:
    """chcsho_<k>m: growth of split-adjusted shares."""
    return {
        f"chcsho_{k}m": F.when(
            (h.lag(shares, k) != 0) & (F.col("count") > k), div(shares, h.lag(shares, k)) - 1
        )
        for k in months
    }


def net_payout(h: History, months: list[int]) -> dict[str, Column]:
    """eqnpo_<k>m: log growth of the return index less log growth of market equity."""
    out = {}
    for k in months:
        ri0, me0 = h.lag("ri", k), h.lag("me", k)
        ok = (F.col("ri") > 0) & (ri0 > 0) & (F.col("me") > 0) & (me0 > 0) & (F.col("count") > k)
        out[f"eqnpo_{k}m"] = F.when(ok, F.log(div("ri", ri0)) - F.log(div("me", me0)))
    return out


def dividend_yields(months: list[int], w, base: str, label: str) -> dict[str, Column]:
    """<label><k>m_me: payouts of the last k months over market equity."""
    return {
        f"{label}{k}m_me": F.when(
            (F.col("count") >= k) & (F.col("me") != 0),
            div(F.sum(base).over(w.rowsBetween(-(k - 1), 0)), F.col("me")),
        )
        for k in months
    }


def seasonality(w, ret: str, first: int, last: int, period: int = 12) -> dict[str, Column]:
    """Mean same-season return over years first..last and mean of the other months.

    A missing month anywhere in the span gives NULL, as a plain sum of lags would.
    """
    frame = w.rowsBetween(-(period * last - 1), -period * (first - 1))
    length = period * (last - first + 1)
    total = F.when(F.count(ret).over(frame) == length, F.sum(ret).over(frame))
    same = reduce(
        lambda a, b: a + b,
        [F.lag(ret, period * y - 1).over(w) for y in range(first, last + 1)],
    )
    years = last - first + 1
    enough = F.col("count") >= period * last
    return {
        f"seas_{first}_{last}an": F.when(enough, same / years),
        f"seas_{first}_{last}na": F.when(enough, (total - same) / (length - years)),
    }


def market_characteristics(
    panel: DataFrame,
    market: DataFrame,
    local: bool = False,
    pairs: list[tuple[int, int]] | None = None,
    seasons: list[tuple[int, int]] | None = None,
    period: int = 12,
) -> DataFrame:
    """Monthly market characteristics per security on a complete month range.

    Everything hangs on one partitioning by id: the spine, the return indices and all horizons.
    """
    pairs = MOMENTUM if pairs is None else pairs
    seasons = SEASONS if seasons is None else seasons
    w = Window.partitionBy("id").orderBy("eom")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    one = F.lit(1.0)
    df = panel.join(market.select("excntry", "eom", "mkt_vw_exc"), ["excntry", "eom"], "left").withColumn(
        "ret_x", F.col("ret_local" if local else "ret")
    )
    df = (
        month_spine(df, ["id"], "eom")
        .join(df, ["id", "eom"], "left")
        .withColumns(
            {
                "ri": F.product(one + F.coalesce("ret", F.lit(0.0))).over(run),
                "ri_x": F.product(one + F.coalesce("ret_x", F.lit(0.0))).over(run),
                "count": F.row_number().over(w),
            }
        )
        .withColumns(
            {
                "ret_x": F.when(F.col("ret_lag_dif") == 1, F.col("ret_x")),
                "div__": F.col("div_tot") * F.col("shares"),
                "spc__": F.col("div_spc") * F.col("shares"),
                "adj_shares": F.col("shares") * F.col("adjfct"),
            }
        )
    )
    h = History(df, ["id"], "eom")
    yields = dividend_yields(DIVIDEND_MONTHS, w, "div__", "div") | dividend_yields(SPECIAL_MONTHS, w, "spc__", "divspc")
    payout = net_payout(h, ISSUE_MONTHS)
    rest = share_change(h, ISSUE_MONTHS) | momentum(h, pairs)
    for first, last in seasons:
        rest |= seasonality(w, "ret_x", first, last, period)
    h.add(yields | payout | rest)
    return h.df.select(
        "id",
        "eom",
        F.col("me").alias("market_equity"),
        *[snap_small(c).alias(c) for c in yields],
        *[snap_small(c, signed=True).alias(c) for c in payout],
        *rest,
    )


def firm_age(panel: DataFrame, listed: DataFrame, filings: DataFrame, quotes: DataFrame) -> DataFrame:
    """Months since the earliest of first listing, first filing, first quote and first panel row.

    Filing and quote dates count from December of the year before. ``listed`` is (permco, date),
    the other two (gvkey, datadate).
    """
    dec = lambda c: F.make_date(F.year(F.min(c)) - 1, F.lit(12), F.lit(31))
    a = listed.groupBy("permco").agg(F.min("date").alias("first_list"))
    b = filings.groupBy("gvkey").agg(dec("datadate").alias("first_file"))
    c = quotes.groupBy("gvkey").agg(dec("datadate").alias("first_quote"))
    own = panel.groupBy("id").agg(F.min("eom").alias("first_row"))
    first = F.least("first_list", "first_file", "first_quote", "first_row")
    return (
        panel.select("id", "eom", "permco", "gvkey")
        .join(a, "permco", "left")
        .join(b, "gvkey", "left")
        .join(c, "gvkey", "left")
        .join(own, "id")
        .select("id", "eom", (month_index("eom") - month_index(first)).alias("age"))
    )


def three_day_sums(df: DataFrame, cols: dict[str, str], key: str = "id", order: str = "date") -> DataFrame:
    """Value plus its two predecessors; NULL when any of the three is missing."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumns(
        {out: F.col(c) + F.lag(c, 1).over(w) + F.lag(c, 2).over(w) for c, out in cols.items()}
    )


def market_lead_lag(factors: DataFrame) -> DataFrame:
    """Next market return within the month and previous market return, per country.

    Factor series have one row per country and day, so the window is bounded by the calendar.
    """
    by_month = Window.partitionBy("excntry", "eom").orderBy("date")
    by_country = Window.partitionBy("excntry").orderBy("date")
    return factors.withColumn("eom", F.last_day("date")).withColumns(
        {
            "mktrf_ld1": F.lead("mktrf").over(by_month),
            "mktrf_lg1": F.lag("mktrf").over(by_country),
        }
    )
