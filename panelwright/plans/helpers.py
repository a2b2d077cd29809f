"""The helper tables that the panel builds read, made from the vendors' raw tables.

A raw table is scanned once however many helpers it fills: each row becomes an array of tagged structs, one for each
helper that takes it, and one aggregation counts equal rows. Helpers that keep repeated rows get them back from the
count, so a value that owns a third of a raw table crosses the shuffle once per map task. The result of a pass is
written by helper, and a helper is read as one partition folder with its own columns only.

Helpers that need two raw tables (unions, the header, rates, the exchange files) are put together from these.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, rows, security
from ..sources import scratch

TAG, COUNT = "helper__", "n__"


@dataclass(frozen=True)
class Helper:
    """One helper out of one raw table: ``columns`` maps its columns to SQL expressions over the raw ones; rows pass
    if ``where`` is true; ``distinct`` keeps one of equal rows."""

    name: str
    columns: dict[str, str]
    where: str = "true"
    distinct: bool = False


def _same(*names: str, **renamed: str) -> dict[str, str]:
    return {n: n for n in names} | renamed


STANDARD = "indfmt = 'INDL' AND datafmt = 'STD' AND popsrc = 'D' AND consol = 'C'"
CODES = _same("gvkey", "datadate", sic="sich", naics="naicsh")
GICS = _same("gvkey", "indfrom", "indthru", gics="gsubind")
STATUS = _same("gvkey", "iid", "secstat", "dlrsni")
DELISTED = _same("delret", "delactiontype", "delstatustype", "delreasontype", "delpaymenttype", "delistingdt", permno="CAST(permno AS BIGINT)")
HEADER = _same("gvkey", "prirow", "priusa", "prican")
LINK_TYPES = ("LC", "LU", "LS")


def _shares(count: str, factor: str) -> Helper:
    return Helper("firm_shares", _same("gvkey", "datadate", csho_fund=count, ajex_fund=factor), f"{STANDARD} AND {count} IS NOT NULL AND {factor} IS NOT NULL")


def _primary(item: str) -> Helper:
    return Helper(item, _same("gvkey", "effdate", "thrudate", **{item: "itemvalue"}), f"item = '{item.upper()}'")


#: What each raw table fills. Helpers named by several raw tables are their union.
PASSES: dict[str, list[Helper]] = {
    "comp_funda": [Helper("sic_naics_na", CODES, distinct=True), _shares("csho", "ajex")],
    "comp_g_funda": [Helper("sic_naics_gl", CODES, distinct=True)],
    "comp_fundq": [_shares("cshoq", "ajexq")],
    "crsp_stksecurityinfohist": [
        Helper("permno0", {"permno": "CAST(permno AS BIGINT)", "permco": "CAST(permco AS BIGINT)", "secinfostartdt": "secinfostartdt", "secinfoenddt": "secinfoenddt", "sic": "CAST(siccd AS BIGINT)", "naics": "CAST(naics AS BIGINT)"}, distinct=True),
        Helper("security_names", {"permno": "CAST(permno AS BIGINT)", "namestart": "CAST(secinfostartdt AS DATE)", "nameend": "CAST(secinfoenddt AS DATE)"}),
    ],
    "comp_co_hgic": [Helper("comp_hgics_na", GICS, "gvkey IS NOT NULL", distinct=True)],
    "comp_g_co_hgic": [Helper("comp_hgics_gl", GICS, "gvkey IS NOT NULL", distinct=True)],
    "crsp_stkdelists": [Helper("crsp_dsedelist", DELISTED), Helper("crsp_msedelist", DELISTED)],
    "comp_security": [Helper("sec_info", STATUS), Helper("ex_country_na", _same("exchg", "excntry"), distinct=True)],
    "comp_g_security": [Helper("sec_info", STATUS), Helper("ex_country_gl", _same("exchg", "excntry"), distinct=True)],
    "crsp_mcti": [Helper("crsp_mcti_t30ret", _same("caldt", "t30ret"))],
    "ff_factors_monthly": [Helper("ff_factors_monthly", _same("date", "rf"))],
    "comp_r_ex_codes": [Helper("comp_r_ex_codes", _same("exchgdesc", "exchgcd"))],
    "comp_company": [Helper("header_na", HEADER)],
    "comp_g_company": [Helper("header_gl", HEADER)],
    "comp_sec_history": [_primary("prihistusa"), _primary("prihistcan")],
    "comp_g_sec_history": [_primary("prihistrow")],
    "comp_exrt_dly": [Helper("rates", _same("fromcurd", "tocurd", "datadate", "exratd"), "fromcurd = 'GBP'", distinct=True)],
    "crsp_ccmxpf_lnkhist": [
        Helper("links", {"permno": "CAST(lpermno AS BIGINT)", "linkstart": "CAST(linkdt AS DATE)", "linkend": "CAST(linkenddt AS DATE)", "linktype": "linktype", "gvkey": "gvkey", "iid": "liid"}, f"linktype IN {LINK_TYPES}"),
    ],
}


def one_pass(raw: DataFrame, helpers: list[Helper]) -> DataFrame:
    """All helpers of one raw table, stacked: the tag and the columns of all, NULL where a helper lacks one.

    Columns of one name must have one type in all helpers of a table. An empty raw table gives empty helpers.
    """
    if len({h.name for h in helpers}) < len(helpers):
        raise ValueError("a table fills a helper once")
    types: dict[str, str] = {}
    for h in helpers:
        for name, kind in raw.select(*[F.expr(e).alias(c) for c, e in h.columns.items()]).dtypes:
            if types.setdefault(name, kind) != kind:
                raise ValueError(f"{name} is {types[name]} in one helper and {kind} in {h.name}")
    once = [h.name for h in helpers if h.distinct]

    def row(h: Helper) -> Column:
        cells = [(F.expr(h.columns[c]) if c in h.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        return F.when(F.expr(h.where), F.struct(F.lit(h.name).alias(TAG), *cells))

    tagged = raw.select(F.explode(F.array_compact(F.array(*[row(h) for h in helpers]))).alias("row")).select("row.*")
    counted = tagged.groupBy(TAG, *types).agg(F.count(F.lit(1)).alias(COUNT))
    if len(once) == len(helpers):
        return counted.drop(COUNT)
    # rows are handed back from their count in chunks, so that no array grows with the table
    chunk = 10_000
    n = F.when(F.col(TAG).isin(once), F.lit(1)).otherwise(F.col(COUNT))
    begun = counted.withColumn("at__", F.explode(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(chunk).cast("long"))))
    again = F.sequence(F.col("at__"), F.least(F.col("at__") + chunk, n) - 1)
    return begun.select(TAG, *types, F.explode(again).alias("copy__")).drop("copy__")


def split(spark: SparkSession, raw: DataFrame, helpers: list[Helper], label: str) -> dict[str, DataFrame]:
    """The helpers of one raw table, from one scan of it: written by helper, read back one folder each."""
    stacked = one_pass(raw, helpers)
    path = scratch.scratch_path(spark, label)
    stacked.write.partitionBy(TAG).parquet(path)
    whole = spark.read.schema(stacked.schema).parquet(path)
    return {h.name: whole.filter(F.col(TAG) == h.name).select(*h.columns) for h in helpers}


@dataclass
class RawTables:
    """The raw tables by name, and the price files of the reference exchange ("m", "d"), if wanted."""

    tables: dict[str, DataFrame]
    prices: dict[str, DataFrame] = field(default_factory=dict)


def _header(home: DataFrame, world: DataFrame) -> DataFrame:
    return rows.header_union(home, world, "gvkey")


def raw_helpers(spark: SparkSession, raw: RawTables) -> dict[str, DataFrame]:
    """All helper tables by name; a raw table that is not there leaves out what needs it."""
    parts: dict[str, list[DataFrame]] = {}
    for table, helpers in PASSES.items():
        if table in raw.tables:
            for name, df in split(spark, raw.tables[table], helpers, f"raw-{table}").items():
                parts.setdefault(name, []).append(df)
    out = {name: reduce(DataFrame.unionByName, dfs) for name, dfs in parts.items()}

    def combine(name: str, needs: list[str], make: Callable[..., DataFrame]) -> None:
        if all(n in out for n in needs):
            out[name] = make(*[out.pop(n) for n in needs])

    combine("ex_country", ["ex_country_gl", "ex_country_na"], DataFrame.unionByName)
    combine("header", ["header_na", "header_gl"], _header)
    combine("fx1", ["rates"], joins.cross_rate)
    if "security_names" in out and "links" in out:
        names, links = out.pop("security_names"), out.pop("links")
        for freq, prices in raw.prices.items():
            fields = security.crsp_fields(prices, freq)
            linked = joins.crsp_links(fields, names, links, "permno", "date", LINK_TYPES)
            out[f"crsp_sf_{freq}"] = linked.select(*fields.columns, "gvkey", "iid")
    return out
