import pytest
from pyspark.sql import functions as F

from panelwright.operators import accounting, scores
from panelwright.operators.panel import History

ROW = dict(
    at=1000, at_x=1000, lt=400, seq_x=600, be_x=570, ca_x=300, cl_x=150, che=100, dltt=250, dlc=50, debt_x=300, sale_x=500, gp_x=200, ebitda_x=150,
    ebit_x=120, pi_x=100, ni_x=80, nix_x=80, dp=30, ocf_x=100, div_x=20, eqis_x=0, re=400, ppent=500, me_fiscal=800,
)


def firm(spark, months=24, **change):
    row = {k: float(v) for k, v in (ROW | change).items()}
    df = spark.range(1, months + 1).select(
        F.lit("001").alias("gvkey"), F.lit("USD").alias("curcd"), F.last_day(F.add_months(F.lit("2019-12-31").cast("date"), F.col("id").cast("int"))).alias("datadate"),
        F.col("id").cast("int").alias("count"), *[F.lit(v).alias(k) for k, v in row.items()],
    )
    return History(df, ["gvkey", "curcd"], "datadate")


def last(h, exprs, name):
    return h.add(exprs).df.orderBy(F.desc("datadate")).first()[name]


def test_z_score_known_value(spark):
    h = firm(spark, 1, ca_x=400, cl_x=200, re=300, ebitda_x=150, me_fiscal=800, lt=400, sale_x=1200)
    assert last(h, scores.z_score(), "z_score") == pytest.approx(1.2 * 0.2 + 1.4 * 0.3 + 3.3 * 0.15 + 0.6 * 2 + 1.2)
    assert last(firm(spark, 1, ca_x=400, cl_x=200, re=300, ebitda_x=150, sale_x=1200), scores.z_score(), "z_score") == pytest.approx(3.555)


def test_z_score_null_on_zero_liabilities(spark):
    assert last(firm(spark, 1, lt=0), scores.z_score(), "z_score") is None


def test_kz_index(spark):
    h = firm(spark)
    want = -1.002 * 110 / 500 + 0.283 * (1000 + 800 - 570) / 1000 + 3.139 * 300 / 900 - 39.368 * 20 / 500 - 1.315 * 100 / 500
    assert last(h, scores.kz_index(h), "kz_index") == pytest.approx(want)


def test_scores_need_a_year_of_history(spark):
    for make, name in ((scores.kz_index, "kz_index"), (scores.o_score, "o_score"), (scores.intrinsic_value, "intrinsic_value")):
        h = firm(spark, 12)
        assert last(h, make(h), name) is None


def test_intrinsic_value(spark):
    h = firm(spark)
    po, roe, be, r = 20 / 80, 80 / 570, 570, 0.12
    want = be + (roe - r) / (1 + r) * be + (roe - r) / ((1 + r) * r) * (1 + (1 - po) * roe) * be
    assert last(h, scores.intrinsic_value(h), "intrinsic_value") == pytest.approx(want)


def test_f_score_needs_two_years_and_counts(spark):
    h = firm(spark, 24)
    assert last(h, scores.f_score(h), "f_score") is None
    h = firm(spark, 37)
    # constant accounts: profit, cash flow, accruals and no issuance score; no change scores
    assert last(h, scores.f_score(h), "f_score") == 4


def test_duration_is_missing_without_history_and_finite_with(spark):
    rows = scores.equity_duration(firm(spark, 24).df).orderBy("datadate").collect()
    assert rows[0].ed_cd is None and rows[0].ed_err == 0.0
    assert rows[-1].ed_cd == pytest.approx(rows[-2].ed_cd) and rows[-1].ed_constant == pytest.approx(10 + 1.12 / 0.12)


def test_characteristic_list():
    names = accounting.characteristic_names()
    assert len(names) == len(set(names)) == 315
