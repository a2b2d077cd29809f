"""A cross-section of registered queries against DuckDB on the smallest data; tools/check.py runs all."""

import math

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry

NAMES = [
    "market_returns", "return_cutoffs", "size_group", "rank_avg", "z_rank", "safe_div", "interval_join", "primary_flag_join", "fx_convert", "gap_fill",
    "write_partitioned", "publication_lag_expand", "market_chars_monthly", "quarterize", "ttm", "rvol", "ff3_resid", "mktcorr", "accounting_helpers",
    "f_score", "comp_daily", "world_panel", "char_portfolios", "hml", "panel_compare", "world_panel_daily", "winsorize_daily_return",
    "standardize_accounting_quarterly", "asof_join", "asof_join_forward", "asof_join_nearest", "interval_join_decades", "grouped_ols_dependent", "breakpoints_30_70",
    "median_signal", "daily_portfolios", "char_portfolios_153", "build_raw_helpers",
]
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def tidy(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def one(x):
        if hasattr(x, "isoformat"):
            return x.isoformat()[:10]
        return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    out = [tuple(one(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = tidy(df.columns, df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    want = tidy([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for x, y in zip(g, w):
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-6))


def test_every_query_has_an_oracle():
    """Those of the panel library; the training-data queries have one where SQL can express them."""
    from panelwright.queries import load

    assert set(load().QUERIES) == set(load().ORACLES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["excntry", "eom", "stocks"]
