import datetime as dt

from panelwright.operators import expand


def test_months_are_filled_without_a_join(spark):
    """The spine of each firm with its rows; repeated rows stay, others than month ends and rows without an id give no data."""
    day = dt.date
    rows = [
        ("a", day(2020, 1, 31), 1), ("a", day(2020, 4, 30), 2), ("b", day(2020, 1, 15), 3), ("b", day(2020, 2, 10), 4), ("b", day(2020, 2, 29), 5),
        ("c", day(2020, 3, 31), 6), ("c", day(2020, 3, 31), 7), ("c", day(2020, 5, 2), 8), ("c", None, 9), (None, day(2020, 1, 31), 10), (None, day(2020, 1, 31), 11),
    ]
    df = spark.createDataFrame(rows, "k string, d date, x int")
    out = expand.densify_months(df, ["k"], "d")
    assert out.columns == ["k", "d", "x", "data_available", "count"]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    key = lambda r: tuple((v is not None, v) for v in r)
    got = sorted((tuple(r) for r in out.select("k", "d", "x", "data_available").collect()), key=key)
    spine = expand.month_spine(df, ["k"], "d").join(df, ["k", "d"], "left").selectExpr("k", "d", "x", "CAST(x IS NOT NULL AS INT)")
    assert got == sorted((tuple(r) for r in spine.collect()), key=key)
