from panelwright.operators import joins


def test_exploded_intervals_are_not_broadcast(spark, tmp_path):
    """A file of intervals below the broadcast threshold is many times as large as nodes."""
    spark.range(5000).selectExpr("id AS k", "DATE'1950-01-05' AS a", "DATE'2049-12-30' AS b").write.parquet(f"{tmp_path}/i")
    spark.range(5000).selectExpr("id AS k", "date_add(DATE'1950-01-01', CAST(id * 7 % 36000 AS INT)) AS d").write.parquet(f"{tmp_path}/p")
    out = joins.interval_join(spark.read.parquet(f"{tmp_path}/p"), spark.read.parquet(f"{tmp_path}/i"), "k", "d", "a", "b", "inner")
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 5000 - spark.read.parquet(f"{tmp_path}/p").where("d < DATE'1950-01-05'").count()
