from panelwright.operators import expand


def test_intervals_are_shuffled_not_their_days(spark):
    rows_ = "(1, DATE'1950-01-01', DATE'2049-12-31', 'a'), (2, DATE'2020-01-01', DATE'2020-01-03', 'b'), (2, DATE'2020-01-03', DATE'2020-01-05', 'c'), (2, DATE'2020-01-06', DATE'2020-01-06', 'd'), (2, DATE'2020-01-06', DATE'2020-01-06', 'e')"
    df = spark.sql(f"SELECT * FROM VALUES {rows_} t(k, s, e, code)")
    out = expand.expand_interval(df, ["k"], "s", "e")
    assert out.where("k = 1 AND code = 'a'").count() == 36525
    assert [r.code for r in out.where("k = 2").orderBy("date").collect()] == ["b", "b", "c", "c", "c", "e"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    above = [line for line in plan.splitlines() if "Generate" in line or "Aggregate" in line]
    assert "Generate" in above[0]  # the rows that share no day are not grouped after the explode
