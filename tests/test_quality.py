"""Quality suites: each check passes on clean data and fails on its defect."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from helpers import OBS_SCHEMA, obs_rows, settings_for, write_json
from ratelake.operators.quality import DataQualityError, dense, evaluate, gate, given, in_range, not_null, periods, rows, unique
from ratelake.plans.checks import bronze_results, gold_results, silver_results
from ratelake.plans.gold import build_gold
from ratelake.schemas import BRONZE

T0 = dt.datetime(2024, 1, 1)


def _silver(spark, rows):
    df = spark.createDataFrame(rows, OBS_SCHEMA)
    return df.withColumn("source_file", F.lit("/l/x.json")).withColumn("ingested_at", F.lit(T0))


def _status(results_df):
    return {r.name: r.passed for r in results_df.collect()}


def test_gate_lists_every_failure():
    res = [Row(layer="l", name=n, passed=ok, expected="= 0", observed=str(i)) for i, (n, ok) in enumerate([("a", True), ("b", False), ("c", False)])]
    with pytest.raises(DataQualityError, match="2 of 3 rules broken: b is 1, not = 0, c is 2") as e:
        gate(res, "l")
    assert [r.name for r in e.value.broken] == ["b", "c"]
    assert len(gate(res[:1], "l")) == 1


def test_evaluate_is_one_row_per_rule_and_null_breaks_a_rule(spark):
    df = spark.createDataFrame([(3, None), (5, 1), (5, None)], "a bigint, b bigint")
    rules = [rows(2, ">="), not_null("a", "b"), in_range("a", 0, 4), unique(df, ["a"]), unique(df, ["b"]),
             periods("a", F.lit(True), "a", 2), dense(df, "x", F.col("a") > 0, "a", 2), given("absent", F.lit(None), 0)]
    got = {r.name: (r.passed, r.observed, r.expected) for r in evaluate(df, rules, "t").collect()}
    assert got == {
        "rows": (True, "3", ">= 2"), "not_null(a, b)": (False, "2", "= 0"), "in_range(a in 0 .. 4)": (False, "2", "= 0"),
        "unique(a)": (False, "1", "= 0"), "unique(b)": (False, "1", "= 0"), "periods(a)": (True, "2", "= 2"),
        "dense(x, 2 per a)": (False, "1", "= 0"), "absent": (False, None, "= 0"),
    }


def test_empty_table(spark):
    df = spark.createDataFrame([], "a bigint")
    got = {r.name: r.passed for r in evaluate(df, [rows(1, ">="), not_null("a"), unique(df, ["a"])], "t").collect()}
    assert got == {"rows": False, "not_null(a)": True, "unique(a)": True}


def test_clean_24_months_pass_all_silver_and_gold(spark, root):
    st = settings_for(root, months=24)
    silver = _silver(spark, obs_rows(months=24))
    assert all(_status(silver_results(silver, st)).values())
    gold = build_gold(silver, st)
    assert all(_status(gold_results(gold, st)).values())


@pytest.mark.parametrize(
    "defect, failing",
    [
        ("dup_key", {"unique(series_id, ref_date)"}),
        ("domain", {"in_range(selic value in 0.0 .. 1.0)"}),
        ("window", {"in_range(ref_date in 2020-01-01 .. 2021-12-31)"}),
        ("ipca_day2", {"never(ipca not on day 1)"}),
        ("thin", {"dense(selic, 15 per year_month)"}),
        ("missing_ipca", {"periods(ipca)"}),
        ("nonpos", {"never(rate at or below -100 %)", "in_range(selic value in 0.0 .. 1.0)"}),
    ],
)
def test_each_silver_check_fails_on_its_defect(spark, root, defect, failing):
    st = settings_for(root, months=24)
    rows = obs_rows(months=24)
    if defect == "dup_key":
        rows.append(rows[0])
    elif defect == "domain":
        rows[0] = rows[0][:5] + (Decimal("1.01"),)
    elif defect == "window":
        rows.append((11, "selic", "diaria", dt.date(2019, 12, 31), "2019-12", Decimal("0.05")))
        # keep its own month thick enough: add 14 more days
        rows += [(11, "selic", "diaria", dt.date(2019, 12, d), "2019-12", Decimal("0.05")) for d in range(1, 15)]
    elif defect == "ipca_day2":
        i = next(i for i, r in enumerate(rows) if r[1] == "ipca")
        rows[i] = rows[i][:3] + (dt.date(2020, 1, 2),) + rows[i][4:]
    elif defect == "thin":
        rows = [r for r in rows if not (r[1] == "selic" and r[4] == "2020-03" and r[3].day > 14)]
    elif defect == "missing_ipca":
        rows = [r for r in rows if not (r[1] == "ipca" and r[4] == "2020-07")]
    elif defect == "nonpos":
        rows[0] = rows[0][:5] + (Decimal("-100.00000000"),)
    got = _status(silver_results(_silver(spark, rows), st))
    assert {k for k, v in got.items() if not v} == failing


def test_silver_rejected_and_unmapped_come_from_bronze(spark, root):
    st = settings_for(root, months=24)
    bronze = spark.createDataFrame(
        [("xx", "0.05", "/l/selic.json", T0, T0), ("01/01/2020", "0.05", "/l/other.json", T0, T0)], BRONZE
    )
    got = _status(silver_results(_silver(spark, obs_rows(months=24)), st, bronze))
    assert not got["rejected_rows"] and not got["unmapped_rows"]


def test_bronze_checks(spark, root):
    st = settings_for(root)
    ok = spark.createDataFrame(
        [("01/01/2020", "0.05", "/l/selic.json", T0, T0), ("01/01/2020", "0.3", "/l/ipca.json", T0, T0)], BRONZE
    )
    assert all(_status(bronze_results(ok, st, landing=False)).values())
    bad = spark.createDataFrame(
        [(None, None, "/l/selic.json", T0, T0), ("01/01/2020", "0.05", None, T0, None)], BRONZE
    )
    got = _status(bronze_results(bad, st, landing=False))
    assert {k for k, v in got.items() if not v} == {
        "not_null(source_file, ingested_at)",
        "series_present",
        "never(no raw field)",
    }
    empty = spark.createDataFrame([], BRONZE)
    assert not _status(bronze_results(empty, st, landing=False))["rows"]


def test_gold_checks_fail_on_gaps(spark, root):
    st = settings_for(root, months=24)
    rows = [r for r in obs_rows(months=24) if not (r[1] == "ipca" and r[4] == "2020-05")]
    rows = [r for r in rows if not (r[1] == "selic" and r[4] == "2021-02" and r[3].day > 10)]
    gold = build_gold(_silver(spark, rows), st)
    got = _status(gold_results(gold, st))
    assert {k for k, v in got.items() if not v} == {"not_null(policy_mean_day, policy_month, inflation_month, real_month)", "never(fewer than 15 policy days)"}
    short = build_gold(_silver(spark, obs_rows(months=20)), st)
    got = _status(gold_results(short, st))
    assert not got["rows"] and not got["rolling_complete"]


def test_fisher_check_catches_a_wrong_real_rate(spark, root):
    st = settings_for(root, months=24)
    gold = build_gold(_silver(spark, obs_rows(months=24)), st)
    broken = gold.withColumn(
        "real_month",
        F.when(F.col("year_month") == "2020-03", F.col("policy_month") - F.col("inflation_month")).otherwise(
            F.col("real_month")
        ),
    )
    assert not _status(gold_results(broken, st))["never(real x inflation differs from policy)"]


def test_key_grain_counts_null_keys_like_distinct(spark):
    from ratelake.plans.reports import key_grain

    df = spark.createDataFrame([(1, None), (1, None), (2, 3), (None, None)], "a int, b int")
    r = key_grain(df, ["a", "b"]).first()
    assert (r.rows, r.distinct_keys, r.distinct_complete_keys, r.duplicate_rows) == (4, 3, 1, 1)


def test_gold_grain_and_not_null_checks_fail(spark, root):
    st = settings_for(root, months=24)
    gold = build_gold(_silver(spark, obs_rows(months=24)), st)
    doubled = gold.unionByName(gold.filter("year_month = '2020-06'"))
    got = _status(gold_results(doubled, st))
    assert not got["unique(year_month)"] and not got["rows"]
    rows = obs_rows(months=24)
    silver = _silver(spark, rows).withColumn(
        "granularity", F.when(F.col("ref_date") == F.lit("2020-01-02").cast("date"), None).otherwise(F.col("granularity"))
    )
    assert not _status(silver_results(silver, st))["not_null(series_id, series_name, granularity, ref_date, year_month, value)"]


def test_unique_key_groups_by_the_key_itself(spark, root):
    """Two rows of one key under different series names are duplicates."""
    st = settings_for(root, months=24)
    extra = obs_rows(months=24)
    extra.append((extra[0][0], "other", *extra[0][2:]))
    assert not _status(silver_results(_silver(spark, extra), st))["unique(series_id, ref_date)"]


def test_rules_on_what_was_dropped_are_listed_only_with_bronze(spark, root):
    st = settings_for(root, months=24)
    silver = _silver(spark, obs_rows(months=24))
    assert not {"rejected_rows", "unmapped_rows"} & set(_status(silver_results(silver, st)))
    empty = spark.createDataFrame([], BRONZE)
    assert _status(silver_results(silver, st, empty))["rejected_rows"]


def test_landing_rules(spark, root):
    st = settings_for(root)
    bronze = spark.createDataFrame([("01/01/2020", "0.05", "/l/selic.json", T0, T0)], BRONZE)
    got = _status(bronze_results(bronze, st))  # no landing folder yet
    assert not got["landing_files"] and got["landing_files_without_rows"]
    write_json(f"{st.landing}/selic.json", [{"data": "01/01/2020", "valor": "1"}])
    got = _status(bronze_results(bronze, st))  # landed, but Bronze has rows of another file
    assert got["landing_files"] and not got["landing_files_without_rows"]
