"""Helper tables: one scan of a raw table fills several, repeated rows are kept or folded as asked."""

import datetime as dt

import pytest

from panelwright.plans.helpers import PASSES, Helper, RawTables, one_pass, raw_helpers, split

SCHEMA = "gvkey string, kind string, amount int"
ROWS = [("1", "a", 5), ("1", "a", 5), ("1", "b", None), (None, "a", 5), (None, None, None), ("2", "b", 7)]
PAIR = [Helper("all_rows", {"key": "gvkey", "amount": "amount"}), Helper("kinds", {"kind": "upper(kind)"}, "gvkey IS NOT NULL", distinct=True)]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_one_scan_fills_both(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    plan = one_pass(raw, PAIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    out = split(spark, raw, PAIR, "pair")
    assert got(out["all_rows"]) == sorted([(r[0], r[2]) for r in ROWS], key=repr)
    assert got(out["kinds"]) == [("A",), ("B",)]
    assert out["kinds"].columns == ["kind"]


def test_repeats_beyond_a_chunk(spark):
    raw = spark.range(25_003).selectExpr("'x' AS gvkey", "'a' AS kind", "1 AS amount")
    out = split(spark, raw, PAIR, "many")
    assert out["all_rows"].count() == 25_003 and out["kinds"].count() == 1


def test_empty_and_odd_tables(spark):
    out = split(spark, spark.createDataFrame([], SCHEMA), PAIR, "empty")
    assert [df.count() for df in out.values()] == [0, 0]
    raw = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError):
        one_pass(raw, [Helper("a", {"x": "gvkey"}), Helper("b", {"x": "amount"})])
    with pytest.raises(ValueError):
        one_pass(raw, [PAIR[0], PAIR[0]])


def test_unions_header_and_links(spark):
    day = dt.date
    company = spark.createDataFrame([("1", "01W", None, None), ("2", "02W", None, None)], "gvkey string, prirow string, priusa string, prican string")
    world = spark.createDataFrame([("2", "99W", None, None), ("3", "03W", None, None)], company.schema)
    names = spark.createDataFrame([(7, 1, day(2000, 1, 1), day(2000, 12, 31), 100, 1), (7, 1, day(2000, 1, 1), day(2000, 12, 31), 100, 1)], "permno int, permco int, secinfostartdt date, secinfoenddt date, siccd int, naics int")
    links = spark.createDataFrame([(7, None, day(2000, 6, 30), "LC", "000001", "01"), (7, None, None, "XX", "000002", "02")], "lpermno int, linkdt date, linkenddt date, linktype string, gvkey string, liid string")
    cols = "permno permco dlycaldt dlyprc dlyprcflg dlyret dlyretx dlyvol dlycumfacshr dlyhigh dlylow shrout securitytype securitysubtype sharetype issuertype usincflg primaryexch conditionaltype".split()
    row = lambda d: (7, 1, d, 5.0, "TR", 0.1, 0.1, 9.0, 1.0, 6.0, 4.0, 2000.0, "EQTY", "COM", "NS", "CORP", "Y", "N", "RW")
    daily = spark.createDataFrame([row(day(2000, 3, 1)), row(day(2000, 9, 1))], cols)
    tables = {"comp_company": company, "comp_g_company": world, "crsp_stksecurityinfohist": names, "crsp_ccmxpf_lnkhist": links}
    out = raw_helpers(spark, RawTables(tables, {"d": daily}))
    assert set(out) == {"header", "permno0", "crsp_sf_d"}
    assert got(out["header"].select("gvkey", "prirow")) == [("1", "01W"), ("2", "02W"), ("3", "03W")]
    assert out["permno0"].count() == 1
    # the name is there twice, so each price is; the link ends in June
    assert got(out["crsp_sf_d"].select("date", "gvkey", "iid")) == sorted([(day(2000, 3, 1), "000001", "01")] * 2 + [(day(2000, 9, 1), None, None)] * 2, key=repr)


def test_every_raw_table_has_its_own_helper_names():
    assert sum(len(h) for h in PASSES.values()) >= 20
    for helpers in PASSES.values():
        assert len({h.name for h in helpers}) == len(helpers)
