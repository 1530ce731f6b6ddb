"""Rates algebra, monthly rollups, Fisher real rate and rolling compounding."""

import math
import pytest

from decimal import Decimal

from pyspark.sql import functions as F

from helpers import OBS_SCHEMA, obs_rows, settings_for
from ratelake.functions.rates import compound, compound_rate, factor, to_percent
from ratelake.operators.rolling import rolling_compound
from ratelake.plans.gold import build_gold, monthly_rates


def test_factor_roundtrip(spark):
    df = spark.createDataFrame([(Decimal("0.05000000"),), (Decimal("-1.50000000"),)], "r decimal(18,8)")
    got = df.select(to_percent(factor("r")).cast("decimal(18,8)").alias("x")).collect()
    assert [g.x for g in got] == [Decimal("0.05000000"), Decimal("-1.50000000")]


def test_exp_ln_compound_equals_product(spark):
    vals = [0.05, 0.051, 0.049, 0.0475, 0.06, -0.2]
    df = spark.createDataFrame([(v,) for v in vals], "r double")
    got = df.agg(compound("r").alias("c"), F.product(F.lit(1) + F.col("r") / 100).alias("p")).first()
    assert math.isclose(got.c, got.p, rel_tol=1e-14)
    expected = 1.0
    for v in vals:
        expected *= 1 + v / 100
    assert math.isclose(got.c, expected, rel_tol=1e-14)


def test_compounding_is_order_independent(spark):
    vals = [(i, 0.01 * (i % 7) - 0.02) for i in range(200)]
    a = spark.createDataFrame(vals, "i int, r double")
    b = a.repartition(7, "i")
    ca = a.agg(compound_rate("r")).first()[0]
    cb = b.agg(compound_rate("r")).first()[0]
    assert math.isclose(ca, cb, rel_tol=1e-12)


def test_fisher_is_ratio_not_difference(spark, root):
    obs = spark.createDataFrame(obs_rows(months=1, days=20, daily="0.05", monthly="0.40"), OBS_SCHEMA)
    m = monthly_rates(obs, "selic", "ipca").first()
    assert math.isclose(m.real_factor, m.policy_factor / m.inflation_factor)
    real = (m.real_factor - 1) * 100
    naive = (m.policy_factor - 1) * 100 - 0.40
    assert not math.isclose(real, naive, rel_tol=1e-9)


def test_gold_24_complete_months(spark, root):
    st = settings_for(root, months=24)
    obs = spark.createDataFrame(obs_rows(months=24), OBS_SCHEMA)
    gold = build_gold(obs, st).orderBy("year_month").collect()
    assert len(gold) == 24
    assert sum(1 for g in gold if g.real_12m is not None) == 13
    assert all(g.months_in_window == min(i + 1, 12) for i, g in enumerate(gold))
    assert all(g.policy_days == 20 for g in gold)
    # 20 days at 0.05 % compounded.
    expected = Decimal(str(round(((1.0005) ** 20 - 1) * 100, 8)))
    assert abs(gold[0].policy_month - expected) <= Decimal("0.00000001")


def test_onepass_equals_join_with_missing_sides(spark, root):
    rows = obs_rows(months=14)
    # drop the monthly row of month 3 and the daily rows of month 5
    rows = [r for r in rows if not (r[1] == "ipca" and r[4] == "2020-03")]
    rows = [r for r in rows if not (r[1] == "selic" and r[4] == "2020-05")]
    obs = spark.createDataFrame(rows, OBS_SCHEMA)
    st = settings_for(root, months=14)
    a = build_gold(obs, st, strategy="join", with_processed_at=False)
    b = build_gold(obs, st, strategy="onepass", with_processed_at=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    may = [r for r in a.collect() if r.year_month == "2020-05"][0]
    assert may.policy_days is None and may.policy_month is None and may.real_month is None


def test_rolling_gates_differ_when_a_factor_is_missing(spark, root):
    rows = [r for r in obs_rows(months=13) if not (r[1] == "ipca" and r[4] == "2020-06")]
    obs = spark.createDataFrame(rows, OBS_SCHEMA)
    st = settings_for(root, months=13)
    by_rows = {r.year_month: r for r in build_gold(obs, st, gate="rows").collect()}
    by_fac = {r.year_month: r for r in build_gold(obs, st, gate="factors").collect()}
    # 12 rows in the window but only 11 inflation factors.
    assert by_rows["2020-12"].inflation_12m is not None
    assert by_fac["2020-12"].inflation_12m is None
    assert by_fac["2020-12"].policy_12m is not None


def test_calendar_frame_leaves_gap_windows_incomplete(spark, root):
    rows = [r for r in obs_rows(months=17) if r[4] != "2020-04"]
    obs = spark.createDataFrame(rows, OBS_SCHEMA)
    st = settings_for(root, months=17)
    by_rows = {r.year_month: r for r in build_gold(obs, st, frame="rows").collect()}
    by_cal = {r.year_month: r for r in build_gold(obs, st, frame="months").collect()}
    assert by_rows["2021-01"].policy_12m is not None  # 12 rows span 13 months
    assert by_cal["2021-01"].policy_12m is None and by_cal["2021-01"].months_in_window == 11
    assert by_cal["2021-03"].months_in_window == 11 and by_cal["2021-03"].policy_12m is None
    assert by_cal["2021-04"].months_in_window == 12 and by_cal["2021-04"].policy_12m is not None


def test_rolling_window_of_one_is_identity(spark):
    df = spark.createDataFrame([("2020-01", 1.01), ("2020-02", 0.99), ("2020-03", 1.2)], "year_month string, f double")
    got = rolling_compound(df, {"x": "f"}, months=1, one_series=True).orderBy("year_month").collect()
    for r in got:
        assert math.isclose(r.x, (r.f - 1) * 100, rel_tol=1e-12)


def test_rolling_is_per_entity(spark):
    rows = [(e, f"2020-{m:02d}", 1.01) for e in ("a", "b") for m in range(1, 13)]
    rows += [("b", "2021-01", 1.01)]
    df = spark.createDataFrame(rows, "e string, year_month string, f double")
    got = rolling_compound(df, {"x": "f"}, partition_by=["e"]).filter("x IS NOT NULL").collect()
    assert sorted((r.e, r.year_month) for r in got) == [("a", "2020-12"), ("b", "2020-12"), ("b", "2021-01")]


def test_nonpositive_factor_vanishes_from_product(spark):
    """ln(f<=0) is NULL and SUM skips it: the factor gate catches it."""
    df = spark.createDataFrame([("2020-01", 0.0), ("2020-02", 1.1)], "year_month string, f double")
    rows = rolling_compound(df, {"x": "f"}, months=2, gate="rows", one_series=True).collect()
    fac = rolling_compound(df, {"x": "f"}, months=2, gate="factors", one_series=True).collect()
    assert rows[1].x is not None and math.isclose(rows[1].x, 10.0, rel_tol=1e-9)
    assert fac[1].x is None


def test_global_window_must_be_declared(spark):
    df = spark.createDataFrame([("2020-01", 1.0)], "year_month string, f double")
    with pytest.raises(ValueError, match="one_series"):
        rolling_compound(df, {"x": "f"})
